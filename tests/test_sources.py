"""Readers and query helpers. The JDBC scan itself needs a database and is not run here."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

import pytest
from bench_of_slips import DAY, plain

from slipmatch.functions.text import WHITESPACE, strip, without_semicolons
from slipmatch.operators.export import closing_day
from slipmatch.sources.jdbc import JdbcSplit, oracle, scan_options, sql_server
from slipmatch.plans.reconcile import reconcile_tables
from slipmatch.sources.query import first_row, run_query
from slipmatch.sources.tables import FIELDS, MASTER_DATA, Tables


def test_jdbc_options():
    connection = sql_server("host", 1433, "erp", "me", "secret")
    assert connection["url"] == "jdbc:sqlserver://host:1433;databaseName=erp"
    options = scan_options(connection, "G6X010", None)
    assert options["dbtable"] == "G6X010" and "G6X_VLRREI decimal(12,2)" in options["customSchema"]
    assert "partitionColumn" not in options


def test_jdbc_split():
    split = JdbcSplit("fechorventa", "2025-01-01", "2025-02-01", 31)
    options = scan_options(oracle("host", 1521, "svc", "me", "secret"), "caja", split)
    assert options["url"] == "jdbc:oracle:thin:@//host:1521/svc"
    assert (options["partitionColumn"], options["numPartitions"]) == ("fechorventa", "31")
    assert "customSchema" not in scan_options({}, "another_table", None)


def test_master_data_is_copied(spark, monkeypatch):
    """Read over JDBC in name only: the scan is replaced, what is done with it is not."""
    given = plain().ticket(100).tables(spark)
    asked = []

    def read_table(_, connection, table, split):
        asked.append((connection, table, split))
        return getattr(given, FIELDS[table])

    monkeypatch.setattr("slipmatch.sources.jdbc.read_table", read_table)
    split = JdbcSplit("puntoventa_id", 1, 100, 4)
    splits = dict.fromkeys(set(FIELDS) - MASTER_DATA, split)
    with pytest.raises(ValueError, match="G6X010"):
        Tables.from_jdbc(spark, {"url": "erp"}, {"url": "sales"}, {"caja": split})
    tables = Tables.from_jdbc(spark, {"url": "erp"}, {"url": "sales"}, splits)
    assert ({"url": "sales"}, "caja", split) in asked and ({"url": "erp"}, "GI6010", None) in asked
    copied = {t for t, field in FIELDS.items() if getattr(tables, field).inputFiles()}
    assert copied == MASTER_DATA
    assert [r["verdict"] for r in reconcile_tables(tables, DAY, DAY).collect()] == ["valid"]


def test_bound_arguments_are_values(spark):
    rows = spark.createDataFrame([("a' OR '1'='1",), ("b",)], "name string")
    found = run_query(spark, "SELECT * FROM {rows} WHERE name = :name", {"name": "a' OR '1'='1"}, rows=rows)
    assert [r[0] for r in found.collect()] == ["a' OR '1'='1"]
    assert run_query(spark, "SELECT 1 AS one").first()["one"] == 1


def test_first_row(spark):
    rows = spark.createDataFrame([(2,), (1,)], "n int")
    assert first_row(rows, "n").collect()[0]["n"] == 1
    assert first_row(rows.where("n > 5"), "n").isEmpty()
    with pytest.raises(ValueError):
        first_row(rows)


def test_strip_is_pythons(spark):
    texts = [f"{c}a {c} b{c}" for c in WHITESPACE] + ["", "  ", "x"]
    got = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "t string, i int").select("i", strip("t").alias("t"))
    assert {r["i"]: r["t"] for r in got.collect()} == {i: t.strip() for i, t in enumerate(texts)}


def test_semicolons(spark):
    row = without_semicolons(spark.createDataFrame([("a;b;", 1, None)], "t string, n int, u string")).first()
    assert tuple(row) == ("a b ", 1, None)


def test_closing_day_compares_numbers(spark):
    import datetime as dt

    numbers = ["20250505", " 20250505", "020250505", "x", None, "20250506"]
    rows = spark.createDataFrame([(n,) for n in numbers], "num_ficha_protheus string")
    found = closing_day(rows, dt.date(2025, 5, 5)).collect()
    assert [r[0] for r in found] == numbers[:3]


def test_a_plain_local_session_finds_a_folder(tmp_path):
    """Nothing names a folder: neither the session nor the machine's defaults."""
    code = """
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate()
assert spark.conf.get("spark.checkpoint.dir", None) is None
import __spark_entry__ as contract
from slipmatch.session import shared_dir
assert contract.queries()["scan_tickets"](spark, "/root/testdata/sf0.001").count() > 0
assert shared_dir(spark) == shared_dir(spark)
"""
    root = Path(__file__).resolve().parent.parent
    env = {**os.environ, "PYTHONPATH": str(root), "SPARK_CONF_DIR": str(tmp_path)}
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=300, env=env)


def test_a_local_session_takes_a_folder(tmp_path):
    code = f"""
from slipmatch.session import local_session, shared_dir
spark = local_session("own", 1, folder={str(tmp_path / "own")!r})
assert shared_dir(spark) == {str(tmp_path / "own")!r}
"""
    root = Path(__file__).resolve().parent.parent
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=300, env={**os.environ, "PYTHONPATH": str(root)})
