"""The daily run, and the single look-ups it is made of."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from slipmatch.functions.dates import as_date
from slipmatch.operators import events, export, tickets, totals
from slipmatch.operators.grams import index_of
from slipmatch.plans.reconcile import incongruent_tickets, reconcile_tables, rejected_tickets, valid_tickets
from slipmatch.plans.store import ResultStore
from slipmatch.schemas import INCONGRUENT_TABLE, VALID_TABLE
from slipmatch.sources.shared import remove, write_aside
from slipmatch.sources.tables import Tables

# Names of the exported reports.
VALID_REPORT, INCONGRUENT_REPORT = "fichas_validadas", "fichas_discrepantes"

Day = dt.date | dt.datetime | None


@dataclass
class ClosingDay:
    """Reconciles the tickets emitted on one date; the date defaults to yesterday."""

    tables: Tables
    store: ResultStore

    def ticket_summary(self, day: Day = None) -> DataFrame:
        day = as_date(day)
        return tickets.ticket_summary(self.tables.tickets, self.tables.agencies, day, day)

    def ticket_details(self, agency_code: str, company: str, day: Day = None) -> DataFrame:
        day, t = as_date(day), self.tables
        return tickets.ticket_details(t.tickets, t.agencies, t.items, day, day, agency_code, company)

    def sold_totals(self, agency_name: str, day: Day = None) -> DataFrame:
        """Sold sums per company, of the day before the emission date."""
        return _of_agency(totals.sold_totals(*self._sales(), *_only(day)), agency_name)

    def cancelled_totals(self, agency_name: str, day: Day = None) -> DataFrame:
        return _of_agency(totals.cancelled_totals(*self._sales(), *_only(day)), agency_name)

    def extra_events(self, agency_name: str, day: Day = None) -> DataFrame:
        """Extra events in the order of their descriptions."""
        t = self.tables
        found = events.extra_events(
            t.cash_events, t.event_kinds, t.event_types, t.payments, t.shift_accounts, t.sale_points, *_only(day)
        )
        return _of_agency(found, agency_name).orderBy("bill_description")

    def check(self, day: Day = None, as_of: dt.datetime | None = None) -> dict[str, int | None]:
        """Reconcile and upsert both result tables.

        Gives the affected rows of each table (None: no rows came) and the rejected
        tickets. The verdicts are written once and read from there by all three.
        """
        day = as_date(day)
        index = index_of(self.tables.event_types)
        aside = write_aside(reconcile_tables(self.tables, day, day, index=index), "verdicts")
        remove(self.store.spark, index.path)
        verdicts = aside.read(self.store.spark)
        outcome = {
            VALID_TABLE: self.store.upsert(VALID_TABLE, valid_tickets(verdicts), as_of=as_of),
            INCONGRUENT_TABLE: self.store.upsert(INCONGRUENT_TABLE, incongruent_tickets(verdicts), as_of=as_of),
            "rejected": rejected_tickets(verdicts).count(),
        }
        remove(self.store.spark, aside.path)
        return outcome

    def export(self, folder: str, day: Day = None, files: int | None = None) -> None:
        """Both reports of the closing day before ``day``, below ``folder``: a file of the
        report's name each, or with ``files`` a folder of so many part files at most."""
        day = as_date(day)
        for table, name in ((VALID_TABLE, VALID_REPORT), (INCONGRUENT_TABLE, INCONGRUENT_REPORT)):
            rows = self.store.read_day(table, day - dt.timedelta(days=1))
            if rows is not None:
                if files is None:
                    export.write_named_report(rows, f"{folder}/{name}.csv")
                else:
                    export.write_report(rows, f"{folder}/{name}", files)

    def _sales(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        return self.tables.sales, self.tables.sale_types, self.tables.sale_points


def _only(day: Day) -> tuple[dt.date, dt.date]:
    day = as_date(day)
    return day, day


def _of_agency(rows: DataFrame, agency_name: str) -> DataFrame:
    """The filter moves below the sums, down to the sale points."""
    return rows.where(F.col("agency_name") == agency_name)
