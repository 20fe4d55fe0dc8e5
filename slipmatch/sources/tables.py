"""The eleven source tables as one bundle, read from parquet or over JDBC."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from slipmatch.schemas import ACCOUNTING, SALE_DAY, SALES
from slipmatch.sources import jdbc
from slipmatch.sources.shared import written

# Field of the bundle by source table.
FIELDS = {
    "G6X010": "tickets",
    "GI6010": "agencies",
    "GZG010": "items",
    "caja": "sales",
    "tipo_venta": "sale_types",
    "punto_venta": "sale_points",
    "caja_diversos": "cash_events",
    "evento_extra": "event_kinds",
    "tipo_evento_extra": "event_types",
    "caja_diversos_pago": "payments",
    "conta_corrente_ptovta": "shift_accounts",
}

MASTER_DATA = {"GI6010", "tipo_venta", "punto_venta", "evento_extra", "tipo_evento_extra"}


@dataclass(frozen=True)
class Tables:
    tickets: DataFrame
    agencies: DataFrame
    items: DataFrame
    sales: DataFrame
    sale_types: DataFrame
    sale_points: DataFrame
    cash_events: DataFrame
    event_kinds: DataFrame
    event_types: DataFrame
    payments: DataFrame
    shift_accounts: DataFrame

    def but(self, **changed: DataFrame) -> Tables:
        """The same tables with some of them changed."""
        return Tables(**{field: changed[field] if field in changed else getattr(self, field) for field in FIELDS.values()})

    @classmethod
    def from_parquet(cls, spark: SparkSession, folder: str, sales_by_day: bool = False) -> Tables:
        """Tables stored as ``<folder>/<table>``, with declared schemas.

        Items partitioned by ticket number let a run skip those of other tickets. Sales
        partitioned by ``SALE_DAY``, the date of the sale (``sales_by_day``), let it skip the
        days that no ticket is about, whether or not the run is given dates.
        """
        layouts = {**ACCOUNTING, **SALES}
        if sales_by_day:
            layouts["caja"] += f", {SALE_DAY} date"
        return cls(
            **{
                field: spark.read.schema(layouts[table]).parquet(f"{folder}/{table}")
                for table, field in FIELDS.items()
            }
        )

    @classmethod
    def from_jdbc(cls, spark: SparkSession, accounting: dict, sales: dict, split: dict | None = None) -> Tables:
        """Tables read over JDBC; ``split`` gives a ``JdbcSplit`` for each fact table.

        A fact table without one would be read by a single task, so that is an error.
        Master data is copied to the shared folder first. Spark knows no sizes of JDBC
        tables; of files it does, and can tell which it may broadcast.
        """
        split = split or {}
        whole = sorted(set(FIELDS) - MASTER_DATA - set(split))
        if whole:
            raise ValueError(f"no split given for the fact tables {whole}")
        read = {
            table: jdbc.read_table(spark, accounting if table in ACCOUNTING else sales, table, split.get(table))
            for table in FIELDS
        }
        return cls(
            **{
                field: written(read[table], table) if table in MASTER_DATA else read[table]
                for table, field in FIELDS.items()
            }
        )
