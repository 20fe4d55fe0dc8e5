"""Tables written when asked for, the joins of the events, and partitions by the input's size."""

from __future__ import annotations

import datetime as dt

import pytest
from bench_of_slips import DAY, plain
from pyspark.sql import functions as F

import __spark_entry__ as contract
from slipmatch import session
from slipmatch.operators import rules
from slipmatch.operators.events import extra_events
from slipmatch.plans.reconcile import reconcile_tables
from slipmatch.sources import retail

INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
ADVISED = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
SCANNED = "spark.sql.files.maxPartitionBytes"


@pytest.fixture
def folder(spark, tmp_path):
    at = dt.datetime(1998, 3, 14)
    rows = {
        "customer": ([(1, "A", 3)], "c_custkey long, c_name string, c_nationkey int"),
        "part": ([(1, "ECONOMY TIN"), (2, "PROMO TIN")], "p_partkey long, p_type string"),
        "orders": ([(1, 1, at, "1-URGENT"), (2, 1, at, "4-LOW")], "o_orderkey long, o_custkey long, o_orderdate timestamp, o_orderpriority string"),
        "lineitem": (
            [(1, 1, 1, 1, 5.0, 100.0, 0.1, 0.05, "A", "F"), (2, 2, 4, 2, 3.0, 50.0, 0.0, 0.0, "R", "F")],
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
            "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string",
        ),
    }
    for name, (values, layout) in rows.items():
        spark.createDataFrame(values, layout).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_a_query_writes_only_what_it_reads(spark, folder):
    key = (spark.sparkContext.applicationId, folder)
    events = contract.all_events(spark, folder).collect()
    assert [(r["description"], r["total"]) for r in events] == [("ECONOMY TIN", 5.0), ("PROMO TIN", 0.0)]
    assert set(retail._stored[key]) == set(retail.EVENTS)
    contract.scan_tickets(spark, folder).collect()
    assert "items" not in retail._stored[key] and "cash_events" in retail._stored[key]
    assert contract.reconcile_verdict(spark, folder).count() == 2
    assert set(retail._stored[key]) == {"totals", *retail.FIELDS.values()}


def test_events_of_one_kind_and_shift_are_summed_once(spark):
    """Three joins take one shuffle of the events each: none is added for sums in between."""
    t = plain().event("MULTA", 2).event("MULTA", 3).tables(spark)
    for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(key, "-1")
    try:
        found = extra_events(t.cash_events, t.event_kinds, t.event_types, t.payments, t.shift_accounts, t.sale_points)
        text = found._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning(eventoextra_id" in text and text.count("hashpartitioning(eventoextra_id") == 2
        assert sum(r["total"] for r in found.collect()) == 5
    finally:
        for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
            spark.conf.unset(key)


def test_partitions_grow_with_the_input(spark):
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        session.sized(spark, session.PARTITION_BYTES)
        assert spark.conf.get(INITIAL, None) is None
        session.sized(spark, session.PARTITION_BYTES * 500)
        assert spark.conf.get(INITIAL) == "500" and spark.conf.get("spark.sql.shuffle.partitions") == kept
    finally:
        spark.conf.unset(INITIAL)
        spark.conf.unset(ADVISED)
        spark.conf.unset(SCANNED)


def test_what_a_task_reads_does_not_grow_with_the_input(spark, tmp_path):
    """Tens of MB of items, which no core count would divide, in several scans and merged partitions."""
    parallel = ["spark.sql.files.minPartitionNum", "spark.sql.adaptive.coalescePartitions.parallelismFirst"]
    spark.range(0, 400_000, 1, 16).select(
        F.lit("20250506").alias("emission"),
        F.col("id").cast("string").alias("agency_code"),
        F.lit("1").alias("associated_company"),
        F.concat(F.lit("BILHETE CANCELADO "), F.sha2(F.col("id").cast("string"), 512)).alias("transaction_description"),
        F.lit(1).cast("decimal(12,2)").alias("lowest"),
        F.lit(False).alias("lacks_value"),
    ).write.parquet(f"{tmp_path}/items")
    try:
        session.sized(spark, session.PARTITION_BYTES * 100)
        for key, value in zip(parallel, ("1", "false")):
            spark.conf.set(key, value)
        items = spark.read.parquet(f"{tmp_path}/items")
        assert items.rdd.getNumPartitions() >= 4
        firsts = rules.first_items(items)
        assert firsts.rdd.getNumPartitions() >= 6
        assert firsts.where("cancelled_item.value = 1").count() == 400_000
    finally:
        for key in (INITIAL, ADVISED, SCANNED, *parallel):
            spark.conf.unset(key)


def test_many_rows_of_a_small_file_are_not_broadcast(spark, tmp_path):
    """Rows in order take a few bytes each in files, many times that in the driver."""
    limits = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    kept = [spark.conf.get(key, None) for key in limits]
    master = spark.range(0, 1_000_000, 1, 2).select("id", F.format_string("%010d", "id").alias("code"), F.lit("1").alias("company"))
    master.write.parquet(f"{tmp_path}/master", compression="zstd")
    master.limit(20).write.parquet(f"{tmp_path}/few")
    facts, master, few = spark.range(3_000_000), spark.read.parquet(f"{tmp_path}/master"), spark.read.parquet(f"{tmp_path}/few")
    plan = lambda side: facts.join(side, "id")._jdf.queryExecution().executedPlan().toString()
    try:
        for key in limits:
            spark.conf.unset(key)
        assert "BroadcastHashJoin" in plan(master)
        session.sized(spark, session.BROADCAST_FREELY)
        assert "BroadcastHashJoin" in plan(master)
        session.sized(spark, session.BROADCAST_FREELY + 1)
        assert "BroadcastHashJoin" not in plan(master) and "BroadcastHashJoin" in plan(few)
        # What is known to be small still is broadcast, by the limit that held before.
        some = facts.join(master.where("id < 50000"), "id")
        assert some.count() == 50_000
        assert spark.conf.get(limits[1]) == str(10 << 20)
        for key in limits:
            spark.conf.set(key, "-1")
        session.sized(spark, session.BROADCAST_FREELY + 1)
        assert [spark.conf.get(key) for key in limits] == ["-1", "-1"]
    finally:
        for key, value in zip(limits, kept):
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_an_index_that_is_given_is_used(spark):
    from slipmatch.operators.grams import index_of

    tables = plain().ticket(100).item("TX MULTA X", 2).event("MULTA", 2).tables(spark)
    index = index_of(tables.event_types)
    assert index.path and sorted(reconcile_tables(tables, DAY, DAY, index=index).collect()) == sorted(
        reconcile_tables(tables, DAY, DAY).collect()
    )
