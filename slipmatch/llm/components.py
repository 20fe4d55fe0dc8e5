"""Connected components by contraction, one small table per round."""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, functions as F

from slipmatch.llm.tables import Asides
from slipmatch.sources.shared import Written, remove, write_aside


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``component`` (its smallest node) for all ends of the edges ``a``, ``b``.

    Each round, every node takes the smallest of itself and its neighbours, and twice the
    choice of its choice; edges then connect choices, and those within one choice are done.
    Hot nodes are no trouble: minima are taken map-side, and joins can be split.
    """
    spark, asides = edges.sparkSession, Asides(edges.sparkSession)
    label: Written | None = None
    for turn in itertools.count():
        ends = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = ends.groupBy("a").agg(F.min("b").alias("least")).select(
            F.col("a").alias("node"), F.least("a", "least").alias("component")
        )
        chosen = asides.write(_jumped(_jumped(asides.write(least, "least"))), "choices")
        old, label = label, write_aside(chosen if label is None else _through(label.read(spark), chosen), "labels")
        edges = asides.write(_contracted(edges, chosen), f"contracted-{turn}")
        asides.drop("least", "choices", *([f"contracted-{turn - 1}"] if turn else []))
        if old is not None:
            remove(spark, old.path)
        if edges.isEmpty():
            asides.drop(f"contracted-{turn}")
            return label.read(spark)


def _jumped(chosen: DataFrame) -> DataFrame:
    return _through(chosen, chosen)


def _through(label: DataFrame, chosen: DataFrame) -> DataFrame:
    """Labels replaced by what those chose."""
    step = chosen.select(F.col("node").alias("component"), F.col("component").alias("further"))
    return label.join(step, "component", "left").select("node", F.coalesce("further", "component").alias("component"))


def _contracted(edges: DataFrame, chosen: DataFrame) -> DataFrame:
    for end in ("a", "b"):
        step = chosen.select(F.col("node").alias(end), F.col("component").alias(f"to_{end}"))
        edges = edges.join(step, end)
    return (
        edges.where(F.col("to_a") != F.col("to_b"))
        .select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b"))
        .distinct()
    )
