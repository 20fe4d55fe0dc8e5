"""Sales side: sold and cancelled totals per agency, day and company."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from slipmatch.functions.dates import sold_between
from slipmatch.functions.money import cents, or_zero, row_total
from slipmatch.functions.text import key_text

# The five measures of a sale and the names of their sums.
MEASURES = {
    "ticket_total": "preciopagado",
    "boarding_tax_total": "importetaxaembarque",
    "toll_tax_total": "importepedagio",
    "others_total": "importeoutros",
    "insurance_total": "importeseguro",
}
CANCELLED = "C"  # fixed value of indstatusboleto

SOLD, CANCELLED_TOTAL, SOME_CANCELLED = 1, 2, 4
ALL_MARKS = SOLD | CANCELLED_TOTAL | SOME_CANCELLED


def sold_totals(
    sales: DataFrame,
    sale_types: DataFrame,
    sale_points: DataFrame,
    first: dt.date | None = None,
    last: dt.date | None = None,
) -> DataFrame:
    """Five sums and ``receipt_total`` over sales not cancelled; a NULL status is neither."""
    sums = _measure_sums(sales, sale_types, sale_points, first, last, F.col("indstatusboleto") != CANCELLED)
    return sums.withColumn("receipt_total", row_total(MEASURES))


def cancelled_totals(
    sales: DataFrame,
    sale_types: DataFrame,
    sale_points: DataFrame,
    first: dt.date | None = None,
    last: dt.date | None = None,
) -> DataFrame:
    """The same sums over cancelled sales, with ``cancelled_total``."""
    sums = _measure_sums(sales, sale_types, sale_points, first, last, F.col("indstatusboleto") == CANCELLED)
    return sums.withColumn("cancelled_total", row_total(MEASURES))


def both_totals(
    sales: DataFrame,
    sale_types: DataFrame,
    sale_points: DataFrame,
    first: dt.date | None = None,
    last: dt.date | None = None,
) -> DataFrame:
    """Sold and cancelled row totals side by side, out of one scan of the sales."""
    amount = row_total(MEASURES.values())
    cancelled = F.col("indstatusboleto") == CANCELLED
    parts = {
        "receipt_total": F.when(~cancelled, amount),
        "sold_rows": F.when(~cancelled, 1),
        "cancelled_total": F.when(cancelled, amount),
        "cancelled_rows": F.when(cancelled, 1),
    }
    return _rolled_up(sales, sale_types, sale_points, first, last, F.col("indstatusboleto").isNotNull(), parts)


def known_amounts(totals: DataFrame, wanted: int = ALL_MARKS) -> DataFrame:
    """Amounts the sales side knows, per agency and day, to be looked up by equality.

    ``marks`` adds up what an amount is, as far as ``wanted``: a company's sold total, a
    company's cancelled total, and, at amount 0 only, a sign that something was cancelled
    at all. Looking amounts up spares both a list of companies per agency and a join of
    every ticket with every company. Look-ups that are made together take all marks, so
    that they share one shuffle of the amounts.
    """
    sold, cancelled = F.col("sold_rows") > 0, F.col("cancelled_rows") > 0
    entries = F.array(
        _entry(sold, F.col("receipt_total"), SOLD),
        _entry(cancelled, F.col("cancelled_total"), CANCELLED_TOTAL),
        _entry(cancelled, F.lit(0), SOME_CANCELLED),
    )
    return (
        totals.where(F.col("agency_name").isNotNull())
        .select("agency_name", "sale_date", F.inline(entries))
        .where(F.col("mark").bitwiseAND(wanted) != 0)
        .groupBy("agency_name", "sale_date", "amount")
        .agg(F.bit_or("mark").alias("marks"))
    )


def has_mark(mark: int) -> Column:
    return F.coalesce(F.col("marks").bitwiseAND(mark) != 0, F.lit(False))


def _entry(present: Column, amount: Column, mark: int) -> Column:
    return F.struct(cents(or_zero(amount)).alias("amount"), F.when(present, mark).alias("mark"))


def _measure_sums(sales, sale_types, sale_points, first, last, status: Column) -> DataFrame:
    parts = {total: F.col(measure) for total, measure in MEASURES.items()}
    return _rolled_up(sales, sale_types, sale_points, first, last, status, parts)


def _rolled_up(sales, sale_types, sale_points, first, last, status: Column, parts: dict[str, Column]) -> DataFrame:
    """Sums of ``parts`` by agency name, sale day and company.

    Sales are summed by sale point and day first, so what meets the sale points, and any
    shuffle that join may need, is no longer one row per sale: a busy sale point costs no more
    than another. Sale types are few and are looked up before the sums, which else were sums by
    type, hardly fewer than the sales. Repeated types multiply the sums, as in the plain join;
    they enter as a count.
    """
    types = sale_types.groupBy("tipoventa_id").agg(F.count("*").alias("repeats"))
    small = (
        sales.where((F.col("activo") == 1) & status & sold_between(F.col("fechorventa"), first, last))
        .join(types, "tipoventa_id")
        .groupBy("puntoventa_id", F.to_date("fechorventa").alias("sale_date"))
        .agg(*[F.sum(part * F.col("repeats")).alias(name) for name, part in parts.items()])
    )
    points = sale_points.select(
        "puntoventa_id",
        key_text("nombpuntoventa").alias("agency_name"),
        F.col("empresa_id").alias("associated_company"),
    )
    return (
        small.join(points, "puntoventa_id")
        .groupBy("agency_name", "sale_date", "associated_company")
        .agg(*[F.sum(name).alias(name) for name in parts])
    )
