"""Named, parameterised SQL over DataFrames, with bound arguments."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession


def run_query(
    spark: SparkSession, text: str, args: Mapping[str, object] | None = None, **views: DataFrame
) -> DataFrame:
    """Rows of a SQL text: ``:name`` marks a bound value, ``{name}`` a DataFrame."""
    return spark.sql(text, args=dict(args or {}), **views)


def first_row(rows: DataFrame, *order: str | Column) -> DataFrame:
    """First row by an explicit order; no row if there is none."""
    if not order:
        raise ValueError("the first row needs an order")
    return rows.orderBy(*order).limit(1)
