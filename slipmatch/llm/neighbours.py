"""Approximate nearest neighbours with learned partitions.

On a bounded sample the graph of nearest neighbours is cut into equally large parts, and a
small classifier learns from it in which parts a vector's neighbours lie. Every row is indexed
under its most probable part. A query goes to as many of its most probable parts as reached
the wanted share of neighbours on the sample, where all candidates are scored exactly.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import astuple, dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from slipmatch.sources.shared import written

SAMPLE = 8192
PARTS = 16
GRAPH_NEIGHBOURS = 10
HIDDEN, EPOCHS, RATE, BATCH, SEED = 128, 30, 0.05, 64, 11
WANTED_RECALL = 0.96
# Vectors and queries of one comparison, and queries scored at once in it.
BLOCK_ROWS, QUERY_ROWS, STEP = 8192, 4096, 128


def usable(vector: Column) -> Column:
    """Whether a vector has components, all of them finite and one of them not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def vectors(table: DataFrame) -> DataFrame:
    """vec_id and double vector of all rows that take part.

    Left out are null ids and vectors that aren't ``usable`` or not as long as most are (the
    shorter length, if two are as frequent). Rows under one id are one row, the greatest.
    """
    rows = table.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("vector"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    sizes = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").first()
    rows = rows.where(F.size("vector") == (sizes["size"] if sizes else 0))
    return rows.groupBy("vec_id").agg(F.max("vector").alias("vector"))


def neighbour_lists(data: np.ndarray, k: int) -> np.ndarray:
    """Each row's k nearest other rows by inner product."""
    k = min(k, len(data) - 1)
    out = np.empty((len(data), max(k, 0)), dtype=np.int64)
    for first in range(0, len(data) if k > 0 else 0, 512):
        scores = data[first : first + 512] @ data.T
        scores[np.arange(len(scores)), np.arange(first, first + len(scores))] = -np.inf
        out[first : first + 512] = np.argpartition(-scores, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(lists: np.ndarray, parts: int, rng: np.random.Generator) -> np.ndarray:
    """Cuts the graph in halves again and again, so that few edges are cut; halves differ by
    one row at most. Each cut is the median of a vector that changes slowly along edges,
    improved by swaps."""
    part = np.zeros(len(lists), dtype=np.int64)
    for _ in range(parts.bit_length() - 1):
        halves = np.zeros(len(lists), dtype=np.int64)
        for p in range(part.max() + 1):
            own = np.flatnonzero(part == p)
            halves[own] = _bisected(lists, own, rng)
        part = 2 * part + halves
    return part


def _bisected(lists: np.ndarray, own: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    n = len(own)
    at = np.full(len(lists), -1)
    at[own] = np.arange(n)
    source = np.repeat(np.arange(n), lists.shape[1])
    target = at[lists[own].ravel()]
    source, target = source[target >= 0], target[target >= 0]
    source, target = np.concatenate([source, target]), np.concatenate([target, source])
    degree = np.bincount(source, minlength=n) + 1.0
    slow = rng.normal(size=n)
    for _ in range(60):
        slow = 0.5 * slow + 0.5 * (np.bincount(source, slow[target], minlength=n) + slow) / degree
        slow -= (slow * degree).sum() / degree.sum()
        slow /= np.abs(slow).max() + 1e-300
    side = np.zeros(n, dtype=np.int64)
    side[np.argsort(slow, kind="stable")[n // 2 :]] = 1
    for _ in range(10):
        there = np.bincount(source, side[target], minlength=n)
        gain = np.where(side == 1, degree - 1 - 2 * there, 2 * there - degree + 1)
        left, right = (np.flatnonzero((side == s) & (gain > 0)) for s in (0, 1))
        left, right = left[np.argsort(-gain[left], kind="stable")], right[np.argsort(-gain[right], kind="stable")]
        swaps = min(len(left), len(right)) // 2
        if not swaps:
            break
        side[left[:swaps]], side[right[:swaps]] = 1, 0
    return side


@dataclass
class Router:
    """Two layers and a softmax, and how many parts a query asks."""

    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    second_bias: np.ndarray
    probes: int

    def logits(self, data: np.ndarray) -> np.ndarray:
        return np.maximum(data @ self.first + self.first_bias, 0) @ self.second + self.second_bias


def fitted(data: np.ndarray, parts: int = PARTS, wanted: float = WANTED_RECALL) -> Router:
    """Graph, parts, classifier and number of probes from the sample ``data``."""
    rng = np.random.default_rng(SEED)
    while parts > 1 and len(data) < 8 * parts:
        parts //= 2
    dimensions = data.shape[1]
    router = Router(
        rng.normal(0, 1 / math.sqrt(max(1, dimensions)), (dimensions, HIDDEN)),
        np.zeros(HIDDEN),
        rng.normal(0, 1 / math.sqrt(HIDDEN), (HIDDEN, parts)),
        np.zeros(parts),
        parts,
    )
    if parts == 1:
        return router
    scale = np.sqrt((data**2).sum(axis=1).mean() / dimensions)
    lists = neighbour_lists(data, GRAPH_NEIGHBOURS)
    part = balanced_parts(lists, parts, rng)
    share = np.zeros((len(data), parts))
    for near in lists.T:
        share[np.arange(len(data)), part[near]] += 1
    share[np.arange(len(data)), part] += 1
    share /= share.sum(axis=1, keepdims=True)
    held = np.arange(len(data)) % 8 == 7
    train = np.flatnonzero(~held)
    scaled = data / scale
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        order = rng.permutation(train)
        for at in range(0, len(order), BATCH):
            some = order[at : at + BATCH]
            x = scaled[some]
            hidden = np.maximum(x @ router.first + router.first_bias, 0)
            logits = hidden @ router.second + router.second_bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            error = (p / p.sum(axis=1, keepdims=True) - share[some]) / len(some)
            back = (error @ router.second.T) * (hidden > 0)
            router.second -= rate * 4 * hidden.T @ error
            router.second_bias -= rate * 4 * error.sum(axis=0)
            router.first -= rate * 4 * x.T @ back
            router.first_bias -= rate * 4 * back.sum(axis=0)
    router.first /= scale
    logits = router.logits(data)
    index = logits.argmax(axis=1)
    order = np.argsort(-logits[held], axis=1, kind="stable")
    place = np.argsort(order, axis=1, kind="stable")
    where = place[np.arange(held.sum())[:, None], index[lists[held]]]
    reached = [(where < m).mean() for m in range(1, parts + 1)]
    router.probes = 1 + next(i for i, r in enumerate(reached) if r >= wanted or i == parts - 1)
    return router


def _sampled(rows: DataFrame, most: int) -> np.ndarray:
    """About ``most`` vectors, at most twice as many, chosen by a hash of their id."""
    n = rows.count()
    share = most / max(n, 1)
    chosen = rows if share >= 1 else rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    got = chosen.limit(2 * most).collect()
    got.sort(key=lambda r: r["vec_id"])
    return np.array([r["vector"] for r in got]) if got else np.zeros((0, 1))


def search(table: DataFrame, is_query: Column, k: int = 20, parts: int = PARTS, wanted: float = WANTED_RECALL) -> DataFrame:
    """query_id, rank, vec_id and score of the k nearest found for each row where ``is_query`` holds.

    A query's own id is no candidate; equal scores go to the smaller id. Fewer than k
    candidates are all given. ``is_query`` is an expression over vec_id; see ``vectors`` for
    the rows that take no part. Further columns are left out; an empty table gives no rows.
    """
    rows = written(vectors(table), "vectors")
    context = table.sparkSession.sparkContext
    router = fitted(_sampled(rows, SAMPLE), parts, wanted)
    held = context.broadcast(astuple(router))

    def route(batches):
        router = Router(*held.value)
        for frame in batches:
            data = np.stack(frame["vector"].to_numpy()) if len(frame) else np.zeros((0, len(router.first)))
            order = np.argsort(-router.logits(data), axis=1, kind="stable")[:, : router.probes]
            frame["parts"] = list(order.astype(np.int32))
            yield frame

    routed = written(rows.mapInPandas(route, "vec_id long, vector array<double>, parts array<int>"), "routed")
    part = F.col("parts")[0]
    asking = routed.where(is_query)
    counted = routed.groupBy(part.alias("part")).count().collect()
    asked = asking.select(F.explode("parts").alias("part")).groupBy("part").count().collect()
    blocks, groups = ({r["part"]: math.ceil(r["count"] / size) for r in some} for some, size in ((counted, BLOCK_ROWS), (asked, QUERY_ROWS)))

    def number(of: dict[int, int], part: Column) -> Column:
        out = F.lit(1)
        for p, n in of.items():
            out = F.when(part == p, n).otherwise(out)
        return out

    salt = F.xxhash64("vec_id", F.lit(SEED))
    each = F.explode(F.sequence(F.lit(0), number(groups, F.col("part")) - 1)).alias("group")
    stored = (
        routed.select("vec_id", "vector", part.alias("part"))
        .withColumn("block", F.pmod(salt, number(blocks, F.col("part"))).cast("int"))
        .select("part", "block", each, "vec_id", "vector")
    )
    each = F.explode(F.sequence(F.lit(0), number(blocks, F.col("part")) - 1)).alias("block")
    wants = (
        asking.select(F.col("vec_id").alias("query_id"), F.col("vector").alias("query"), F.explode("parts").alias("part"))
        .withColumn("group", F.pmod(F.xxhash64("query_id", F.lit(SEED)), number(groups, F.col("part"))).cast("int"))
        .select("part", each, "group", "query_id", "query")
    )
    # Both sides' keys are ints: keys of unlike types would be dealt unlike.
    keys = ["part", "block", "group"]
    near = (
        stored.groupBy(*keys)
        .cogroup(wants.groupBy(*keys))
        .applyInPandas(_scorer(k), "query_id long, vec_id long, score double")
    )
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return near.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)


def _scorer(k: int):
    def score(stored: pd.DataFrame, wants: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if len(stored) and len(wants):
            data, ids = np.stack(stored["vector"].to_numpy()), stored["vec_id"].to_numpy()
            asked = wants["query_id"].to_numpy()
            queries = np.stack(wants["query"].to_numpy())
            for first in range(0, len(queries), STEP):
                some, names = queries[first : first + STEP], asked[first : first + STEP]
                scores = some @ data.T
                scores[names[:, None] == ids[None, :]] = -np.inf
                for row, name, query in zip(scores, names, some, strict=True):
                    out.append((np.full(k, name), *_best(row, ids, data, query, k)))
        if not out:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        return pd.DataFrame(
            {
                "query_id": np.concatenate([q[: len(i)] for q, i, _ in out]),
                "vec_id": np.concatenate([i for _, i, _ in out]),
                "score": np.concatenate([s for _, _, s in out]),
            }
        )

    return score


def _best(row: np.ndarray, ids: np.ndarray, data: np.ndarray, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best ids and their scores, computed anew in an order that is the same in all blocks."""
    least = np.partition(row, len(row) - k)[len(row) - k] if len(row) > k else -np.inf
    near = np.flatnonzero((row >= least - 1e-9 * max(1.0, abs(least))) & (row > -np.inf)) if least > -np.inf else np.flatnonzero(row > -np.inf)
    exact = (data[near] * query).sum(axis=1)
    order = np.lexsort((ids[near], -exact))[:k]
    return ids[near][order], exact[order]


def brute_force(table: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """``search`` with one part that holds everything: exact, for measuring recall."""
    return search(table, is_query, k, parts=1)


def recall(found: DataFrame, exact: DataFrame) -> float:
    pair: Sequence[str] = ["query_id", "vec_id"]
    hit = found.select(*pair).join(exact.select(*pair), list(pair), "left_semi").count()
    return hit / max(1, exact.count())
