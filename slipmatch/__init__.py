"""slipmatch: reconcile declared daily slips against raw sales, as Spark plans."""

from slipmatch.operators.upsert import upsert
from slipmatch.plans.daily import ClosingDay
from slipmatch.plans.reconcile import reconcile, reconcile_tables
from slipmatch.sources.tables import Tables

__all__ = ["ClosingDay", "Tables", "reconcile", "reconcile_tables", "upsert"]
