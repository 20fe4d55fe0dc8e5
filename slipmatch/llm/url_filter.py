"""URL filter: a few allow and block rules, and a block list held in a Bloom filter cascade.

Level 0 of the cascade is a Bloom filter over the listed keys. The keys of the universe that
pass it without being listed go into level 1, the listed keys that pass level 1 into level 2,
and so on until a level lets nobody pass wrongly. A key of the universe is listed if the
first level that does not hold it is an odd one, so membership is exact without any join.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from slipmatch.sources.shared import written

ALLOW, BLOCK = "allow", "block"

# A slice of the listed keys has at most this many; one of its levels then takes 2.5 MB.
SLICE_KEYS = 1_000_000
BITS_PER_KEY, HASHES = 20, 6


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return f"{self.host}/{self.path}"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Lower-cased host, and the path up to query or fragment; both empty without ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(host, upper, lower), path


def longest_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, null without one.

    A rule fits its host, all subdomains, and the paths that start with its own. Length is
    that of the whole rule; of two equally long ones the one with the longer host wins.
    """
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), len(r.host), r.name)):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(f"/{rule.path}")
        if not rule.path:
            fits = (host == rule.host) | host.endswith(f".{rule.host}")
        name = F.when(fits, rule.name).otherwise(name)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


class Cascade:
    """Bit maps of all levels over 64-bit key hashes."""

    def __init__(self, levels: list[tuple[int, np.ndarray]]):
        self.levels = levels

    def holds(self, keys: np.ndarray) -> np.ndarray:
        listed = np.zeros(len(keys), dtype=bool)
        at = np.arange(len(keys))
        for level, (bits, words) in enumerate(self.levels):
            at = at[_inside(keys[at], level, bits, words)]
            listed[at] = level % 2 == 0
        return listed


def _places(keys: np.ndarray, level: int, bits: int) -> list[np.ndarray]:
    with np.errstate(over="ignore"):
        h = keys.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15) * np.uint64(level + 1)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
        first, step = h ^ (h >> np.uint64(31)), (h >> np.uint64(17)) | np.uint64(1)
        return [(first + np.uint64(i) * step) % np.uint64(bits) for i in range(HASHES)]


def _inside(keys: np.ndarray, level: int, bits: int, words: np.ndarray) -> np.ndarray:
    found = np.ones(len(keys), dtype=bool)
    for place in _places(keys, level, bits):
        found &= (words[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1
    return found


def _level(keys: DataFrame, level: int, n: int) -> tuple[int, np.ndarray]:
    """One level's bit map: each task sets its bits, words of equal place are or-ed together.

    At most ``n * BITS_PER_KEY / 64`` words come to the driver, ``n`` being bounded by
    ``SLICE_KEYS`` for listed keys and far less for false positives.
    """
    bits = 64 * max(1, math.ceil(n * BITS_PER_KEY / 64))

    def set_bits(batches):
        for frame in batches:
            place = np.concatenate(_places(frame["key"].to_numpy(np.int64), level, bits))
            word, mask = (place >> np.uint64(6)).astype(np.int64), np.uint64(1) << (place & np.uint64(63))
            yield pd.DataFrame({"word": word, "mask": mask.view(np.int64)})

    set_words = (
        keys.select("key")
        .mapInPandas(set_bits, "word long, mask long")
        .groupBy("word")
        .agg(F.bit_or("mask").alias("mask"))
        .toPandas()
    )
    words = np.zeros(bits // 64, dtype=np.uint64)
    words[set_words["word"].to_numpy(np.int64)] = set_words["mask"].to_numpy(np.int64).view(np.uint64)
    return bits, words


def cascade(universe: DataFrame) -> Cascade:
    """From distinct rows ``key`` long, ``listed`` boolean: all keys that will ever be asked."""
    sides = (universe.where("listed"), universe.where("NOT listed"))
    levels: list[tuple[int, np.ndarray]] = []
    while True:
        level = len(levels)
        # Keys of this level's side that all levels so far let pass.
        side = sides[level % 2]
        rest = written(_passing(side, levels), f"cascade-{level}") if levels else side
        n = rest.count()
        if n == 0:
            return Cascade(levels)
        levels = [*levels, _level(rest, level, n)]


def _passing(side: DataFrame, levels: list[tuple[int, np.ndarray]]) -> DataFrame:
    def passing(batches):
        for frame in batches:
            keys = frame["key"].to_numpy(np.int64)
            at = np.arange(len(keys))
            for level, (bits, words) in enumerate(levels):
                at = at[_inside(keys[at], level, bits, words)]
            yield pd.DataFrame({"key": keys[at]})

    return side.select("key").mapInPandas(passing, "key long")


def _asked(held):
    @F.pandas_udf("boolean")
    def holds(keys: pd.Series) -> pd.Series:
        return pd.Series(Cascade(held.value).holds(keys.to_numpy(np.int64)))

    return holds


def with_membership(rows: DataFrame, key: str, listed: Column, name: str = "listed") -> DataFrame:
    """``rows`` with ``name``: whether ``key`` is among the keys for which ``listed`` holds.

    ``listed`` is an expression over the key column, evaluated once per distinct key; a null
    key is never listed. Long lists are dealt over slices by hash, each with a cascade of
    bounded size of its own. Keys are told apart by a 64-bit hash.
    """
    hashed = F.xxhash64(F.col(key))
    universe = (
        rows.select(key)
        .where(F.col(key).isNotNull())
        .distinct()
        .select(hashed.alias("key"), F.coalesce(listed, F.lit(False)).alias("listed"))
    )
    universe = written(universe, "url-keys")
    n = universe.where("listed").count()
    slices = max(1, math.ceil(n / SLICE_KEYS))
    answer = F.lit(False)
    for i in range(slices):
        inside = F.pmod("key", F.lit(slices)) == i
        holds = _asked(rows.sparkSession.sparkContext.broadcast(cascade(universe.where(inside)).levels))
        answer = F.when(F.pmod(hashed, F.lit(slices)) == i, holds(hashed)).otherwise(answer)
    return rows.withColumn(name, F.col(key).isNotNull() & answer)


def judge_urls(pages: DataFrame, rules: Sequence[Rule], listed_host: Column, keep: Sequence[str] = ("page_id",)) -> DataFrame:
    """Every row's host, path, fitting rule and verdict.

    The longest rule decides; without one a host is blocked if it is listed (``listed_host``
    is an expression over the column ``host``), which the cascade answers. A null url or one
    without ``://`` has an empty host, which is never listed. Repeated rows each get a row;
    other columns than ``keep`` are left out.
    """
    host, path = host_and_path(F.col("url"))
    parsed = pages.select(*keep, host.alias("host"), path.alias("path"))
    rule, said = longest_rule(F.col("host"), F.col("path"), rules)
    judged = with_membership(parsed, "host", listed_host)
    return judged.select(
        *keep,
        "host",
        "path",
        rule.alias("rule"),
        F.coalesce(said, F.when(F.col("listed"), BLOCK).otherwise(ALLOW)).alias("verdict"),
    )
