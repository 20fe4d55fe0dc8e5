"""What the plans must keep: one scan per fact, pruned and filtered scans, no pair-making joins."""

from __future__ import annotations

import re

import pytest
from bench_of_slips import DAY, plain

import __spark_entry__ as contract
from slipmatch.plans.reconcile import reconcile_tables
from slipmatch.schemas import SALE_DAY
from slipmatch.sources import retail
from slipmatch.sources.tables import FIELDS, Tables

FOLDER = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted_plan_of(df) -> str:
    """Unlike the plain text, not cut off within long filters."""
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def final_plan_of(df) -> str:
    df.collect()
    text = plan_of(df)
    return text[text.index("== Final Plan ==") : text.index("== Initial Plan ==")]


@pytest.fixture
def no_broadcast(spark):
    """As if every table were large."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for key in keys:
        spark.conf.set(key, "-1")
    yield
    for key in keys:
        spark.conf.unset(key)


@pytest.mark.parametrize("name", list(contract.own_queries()))
def test_no_pairs_no_python(spark, no_broadcast, name):
    text = plan_of(contract.queries()[name](spark, FOLDER))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BroadcastHashJoin", "Python", "Pandas"):
        assert bad not in text


def scans(text: str, column: str) -> int:
    return len(re.findall(rf"FileScan parquet \[[^\]]*\b{column}#", text))


@pytest.mark.parametrize("large", [False, True])
def test_each_fact_is_scanned_once(spark, request, large):
    if large:
        request.getfixturevalue("no_broadcast")
    text = final_plan_of(reconcile_tables(retail.load(spark, FOLDER)))
    for column in ("preciopagado", "GZG_VALOR", "importe", "indreimpresion", "feccorte", "G6X_AGENCI", "GI6_CODIGO"):
        want = 2 if column == "feccorte" else 1
        assert scans(text, column) == want, column
    if not large:
        assert len(re.findall(r"Exchange hashpartitioning", text)) - len(re.findall("ReusedExchange", text)) <= 15


def test_the_target_of_an_upsert_is_read_once(spark, no_broadcast, tmp_path):
    from slipmatch.operators import upsert as u

    layout = "nome string, ficha string, extra string, data_processamento timestamp"
    spark.createDataFrame([("A", "1", "x", None)], layout).write.parquet(str(tmp_path / "target"))
    target = spark.read.schema(layout).parquet(str(tmp_path / "target"))
    source = spark.createDataFrame([("A", "1", "y"), ("B", "2", "y")], "nome string, ficha string, extra string")
    prepared = u.prepared(target, u.stamped(source), include=["nome", "ficha"])
    assert plan_of(u.updated(*prepared)).count("Location: InMemoryFileIndex") == 1
    result = u.upsert(target, source, include=["nome", "ficha"])
    assert str(tmp_path / "target") not in formatted_plan_of(result)
    assert sorted(r[u.CHANGE] for r in result.collect()) == [u.INSERTED, u.KEPT]


def test_event_search_is_an_equi_join(spark, no_broadcast):
    text = plan_of(contract.event_match(spark, FOLDER))
    joins = [line for line in text.splitlines() if "Contains(" in line or "contains(" in line.lower()]
    assert any("SortMergeJoin" in line and "emission" in line for line in joins)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory) -> Tables:
    """Source tables as files, items partitioned by ticket number."""
    folder = str(tmp_path_factory.mktemp("stored"))
    slips = plain().ticket(100).item("POS", 1).item("POS", 1, number="20240101").event("MULTA", 1)
    tables = slips.tables(spark)
    for table, field in FIELDS.items():
        writer = getattr(tables, field).write
        (writer.partitionBy("GZG_NUMFCH") if table == "GZG010" else writer).parquet(f"{folder}/{table}")
    return Tables.from_parquet(spark, folder)


def test_daily_filters_reach_the_scans(spark, stored):
    pushed = re.findall(r"PushedFilters: \[([^\]]*)\]", formatted_plan_of(reconcile_tables(stored, DAY, DAY)))
    sales = [p for p in pushed if "fechorventa" in p]
    assert sales and all("Equal(fechorventa,2025-05-05 " in p and "LessThan(fechorventa,2025-05-06 " in p for p in sales)
    assert any("GreaterThanOrEqual(G6X_DTREME,20250506)" in p for p in pushed)
    shifts = [p for p in pushed if "feccorte" in p]
    assert shifts and all("GreaterThanOrEqual(feccorte,2025-05-05 " in p for p in shifts)


def test_daily_run_prunes_items_by_ticket_number(spark, stored):
    frame = reconcile_tables(stored, DAY, DAY)
    assert "dynamicpruningexpression(rtrim(GZG_NUMFCH" in formatted_plan_of(frame)
    assert scans(final_plan_of(frame), "GZG_VALOR") == 1
    assert [r["verdict"] for r in frame.collect()] == ["incongruent"]


def test_sales_of_days_without_tickets_are_not_read(spark, tmp_path):
    """Few tickets against many days of sales, and no dates given."""
    import datetime as dt

    from pyspark.sql import functions as F

    slips = plain().ticket(100).ticket(0, emission="20250509").item("POS", 1)
    for day in range(1, 28):
        slips.sale(7, at=dt.datetime(2025, 4, day, 9))
    tables = slips.tables(spark)
    for table, field in FIELDS.items():
        rows = getattr(tables, field)
        if table == "caja":
            rows.withColumn(SALE_DAY, F.to_date("fechorventa")).write.partitionBy(SALE_DAY).parquet(f"{tmp_path}/{table}")
        else:
            rows.write.parquet(f"{tmp_path}/{table}")
    frame = reconcile_tables(Tables.from_parquet(spark, str(tmp_path), sales_by_day=True))
    assert f"dynamicpruningexpression({SALE_DAY}" in formatted_plan_of(frame)
    text = final_plan_of(frame)
    assert scans(text, "preciopagado") == 1 and scans(text, "G6X_AGENCI") == 1
    assert sorted(frame.collect()) == sorted(reconcile_tables(tables).collect())


def test_unused_columns_are_not_read(spark):
    text = plan_of(contract.flag_items(spark, FOLDER))
    assert scans(text, "G6X_VLRREI") == 0 and scans(text, "GZG_TIPO") == 0
