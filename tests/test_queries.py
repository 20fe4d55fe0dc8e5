"""Every registered query against its SQL text, on whole test tables."""

from __future__ import annotations

import os

import pytest
from compare import connect, duck_rows, spark_rows

import __spark_entry__ as contract

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = connect(FOLDER)
    yield con
    con.close()


def test_every_query_has_a_text():
    assert set(contract.own_queries()) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", list(contract.own_queries()))
def test_query(spark, duck, name):
    columns, rows = spark_rows(contract.queries()[name](spark, FOLDER))
    want_columns, want_rows = duck_rows(duck, contract.oracle_sql()[name])
    assert columns == want_columns
    assert rows == want_rows


def test_known_verdict_counts(spark):
    """Counts worked out beforehand for the middle test size."""
    from pyspark.sql import functions as F

    folder = "/root/testdata/sf0.01"
    said = {
        "zero": "Ficha de remessa zerada.",
        "receipt": "Valor da receita não está batendo.",
        "cancelled": "Valores de bilhetes cancelados e devolvidos não batem.",
        "missing": "não encontrada no Protheus.",
        "differs": "não bate com o valor encontrado",
        "pos": "A ficha contém Vendas POS.",
        "requisitions": "A ficha contém requisições.",
        "none": "Não há bilhetes cancelados",
        "nothing": "Nada a declarar.",
    }
    row = contract.reconcile_verdict(spark, folder).agg(
        F.count_if(F.col("verdict") == "valid").alias("valid"),
        F.count_if(F.col("verdict") == "incongruent").alias("incongruent"),
        *[F.count_if(F.contains("message", F.lit(text))).alias(key) for key, text in said.items()],
        F.countDistinct("message").alias("distinct"),
    )
    assert row.first().asDict() == {
        "valid": 9307,
        "incongruent": 4943,
        "zero": 3846,
        "receipt": 1875,
        "cancelled": 1837,
        "missing": 1480,
        "differs": 1130,
        "pos": 1915,
        "requisitions": 1948,
        "none": 2091,
        "nothing": 2065,
        "distinct": 650,
    }


def test_the_tables_hold_what_multiplies(spark):
    """Events of every line, a sale type that stands there twice, shift accounts that do."""
    from pyspark.sql import functions as F

    from slipmatch.sources import retail

    tables = retail.load(spark, FOLDER)
    lines = retail.read(spark, FOLDER, "lineitem").count()
    assert tables.cash_events.count() == tables.payments.count() == tables.sales.count() == lines
    for table in (tables.sale_types, tables.shift_accounts):
        repeated = table.groupBy(*table.columns).agg(F.count("*").alias("n")).where("n = 2").drop("n")
        assert not repeated.isEmpty()
        used = tables.sales if "tipoventa_id" in table.columns else tables.cash_events
        assert not used.join(repeated, [c for c in repeated.columns if c in used.columns], "left_semi").isEmpty()


def test_every_reject_cause_occurs(spark):
    causes = {r["cause"] for r in contract.reconcile_rejects(spark, "/root/testdata/sf0.01").collect()}
    assert len(causes) == 5
