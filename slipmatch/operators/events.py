"""Sales side: extra cash events per agency, day, description, nature and company."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from slipmatch.functions.dates import sold_between
from slipmatch.functions.money import or_zero
from slipmatch.functions.text import key_text, strip

SHIFT = ["empresa_id", "puntoventa_id", "turno_id", "usuario_id", "feccorte"]


def extra_events(
    cash_events: DataFrame,
    event_kinds: DataFrame,
    event_types: DataFrame,
    payments: DataFrame,
    shift_accounts: DataFrame,
    sale_points: DataFrame,
    first: dt.date | None = None,
    last: dt.date | None = None,
) -> DataFrame:
    """Paid sums of events that were not reprinted, from the chain of six tables.

    Repeated rows of the shift account multiply the sum, as in the plain join; they enter
    as a count so that they multiply no rows.
    """
    in_range = sold_between(F.col("feccorte"), first, last)
    not_reprinted = (F.col("indreimpresion") == 0) | F.col("indreimpresion").isNull()
    shifts = shift_accounts.where(in_range).groupBy(*SHIFT).agg(F.count("*").alias("repeats"))
    due = (
        cash_events.where(not_reprinted & in_range)
        .select("cajadiversos_id", "eventoextra_id", "puntoventa_id", "turno_id", "usuario_id", "feccorte")
        # No sums yet: events of one kind and shift are few, so a shuffle for them saves no rows.
        # Adaptive execution splits these joins where a kind or shift is common.
        .join(event_kinds.select("eventoextra_id", "tipoeventoextra_id", "empresa_id"), "eventoextra_id")
        .join(shifts, SHIFT)
        .select(
            "cajadiversos_id",
            "puntoventa_id",
            "tipoeventoextra_id",
            F.to_date("feccorte").alias("sale_date"),
            "repeats",
        )
    )
    # Payments last: events without a shift account of their company then never travel to them.
    paid = due.join(payments.select("cajadiversos_id", or_zero("importe").alias("value")), "cajadiversos_id")
    points = sale_points.select(
        "puntoventa_id",
        key_text("nombpuntoventa").alias("agency_name"),
        F.col("empresa_id").alias("associated_company"),
    )
    types = event_types.select(
        "tipoeventoextra_id",
        F.col("desctipoevento").alias("bill_description"),
        F.col("natureza").alias("nature"),
    )
    # No sums by ids before names are looked up, for the same reason: sums by name shrink in the
    # tasks that read the joins.
    return (
        paid.select(
            "puntoventa_id",
            "tipoeventoextra_id",
            "sale_date",
            (F.col("value") * F.col("repeats")).alias("total"),
        )
        .join(types, "tipoeventoextra_id")
        .join(points, "puntoventa_id")
        .groupBy("agency_name", "sale_date", "bill_description", "nature", "associated_company")
        .agg(F.sum("total").alias("total"))
        .withColumn("description", strip("bill_description"))
    )
