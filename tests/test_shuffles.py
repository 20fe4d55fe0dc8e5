"""What travels between tasks: no sums that shrink nothing, no rows made before a shuffle."""

from __future__ import annotations

import re

from bench_of_slips import plain
from pyspark.sql import functions as F

from slipmatch.operators.events import extra_events
from slipmatch.operators.totals import both_totals
from slipmatch.sources import retail

FOLDER = "/root/testdata/sf0.001"


def exchanges(df) -> list[str]:
    text = df._jdf.queryExecution().executedPlan().toString()
    return [re.sub(r"#\d+L?", "", keys) for keys in re.findall(r"hashpartitioning\((.*), \d+\)", text)]


def test_sales_are_summed_by_point_and_day_at_once(spark):
    t = plain().sale(100).sale(50).sale(30, "C").tables(spark)
    kinds = t.sale_types.unionByName(t.sale_types)
    found = both_totals(t.sales, kinds, t.sale_points)
    assert not any("puntoventa_id" in keys and "tipoventa_id" in keys for keys in exchanges(found))
    assert any(keys.startswith("puntoventa_id, ") for keys in exchanges(found))
    once, twice = (both_totals(t.sales, x, t.sale_points).first() for x in (t.sale_types, kinds))
    assert [twice[c] for c in ("receipt_total", "sold_rows", "cancelled_total", "cancelled_rows")] == [
        2 * once[c] for c in ("receipt_total", "sold_rows", "cancelled_total", "cancelled_rows")
    ]


def test_events_are_summed_by_name_only(spark):
    t = plain().event("MULTA", 2).event("MULTA", 3).tables(spark)
    found = extra_events(
        t.cash_events, t.event_kinds, t.event_types, t.payments,
        t.shift_accounts.unionByName(t.shift_accounts), t.sale_points,
    )
    assert not any(keys.startswith("puntoventa_id, tipoeventoextra_id") for keys in exchanges(found))
    assert sum(r["total"] for r in found.collect()) == 10


def test_events_without_a_shift_account_do_not_travel_to_payments(spark):
    t = plain().event("MULTA", 2).event("AVISO", 3, shifts=2).event("TAXA", 4, point=2, shifts=None).tables(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = extra_events(
            t.cash_events, t.event_kinds, t.event_types, t.payments, t.shift_accounts, t.sale_points
        )
        keys = exchanges(found)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Plans are printed from the result down.
    assert keys.index("cajadiversos_id") < keys.index("empresa_id, puntoventa_id, turno_id, usuario_id, feccorte")
    assert sorted((r["description"], r["total"]) for r in found.collect()) == [("AVISO", 3), ("MULTA", 2)]


def test_users_of_a_shift_are_made_after_its_shuffle(spark):
    orders = retail.read(spark, FOLDER, "orders")
    found = retail._shift_accounts(orders.unionByName(orders))
    assert exchanges(found) and not any("usuario_id" in keys for keys in exchanges(found))
    users = F.explode(F.array(*[F.lit(u).cast("bigint") for u in (0, 1, 2)]))
    once = orders.select(
        (F.col("o_orderkey") % 2).cast("int").alias("empresa_id"), F.col("o_custkey").alias("puntoventa_id"),
        retail._shift().alias("turno_id"), users.alias("usuario_id"), F.col("o_orderdate").alias("feccorte"),
    ).distinct()
    wanted = once.unionByName(once.where("turno_id = 4 AND usuario_id = 1"))
    assert found.exceptAll(wanted).isEmpty() and wanted.exceptAll(found).isEmpty()


def test_derived_tables_are_written_small(spark):
    paths = [f.rsplit("/", 1)[1] for f in retail.load(spark, FOLDER).payments.inputFiles()]
    assert paths and all(".zstd." in p for p in paths)
