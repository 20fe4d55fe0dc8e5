"""Mixing sources to target weights by Sainte-Laguë apportionment.

The documents of each source form one line in a seeded order, cut into blocks of equally many
words. Blocks are given to sources by highest quotients target / (2 n + 1), n being the blocks
a source has got. A source's line is then taken block by block from its start, and round again
where the quota exceeds it. The mix is not dealt over output shards: ``shard_quotas`` tells what
each shard would get, but ``mixed`` and ``drawn`` don't use it.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

BLOCK_WORDS = 16
SEED = 20_240_229
BUCKETS = 1024
WORD = r"[^\x20\x09-\x0D]+"

Source = str | None


def in_order(sources) -> list[Source]:
    """By code point, null last."""
    return sorted(sources, key=lambda s: (s is None, s or ""))


def weights(sources, cycle: Sequence[int] = (5, 2, 1)) -> dict[Source, int]:
    return {s: cycle[i % len(cycle)] for i, s in enumerate(in_order(sources))}


def targets(sizes: Mapping[Source, int], weight: Mapping[Source, float], share: float, most: float) -> dict[Source, float]:
    """``share`` of all words by weight; a target stops at ``most`` times its source's size and
    the excess is shared again among the others, until none is above or all are full."""
    rest, left = share * sum(sizes.values()), set(sizes)
    out: dict[Source, float] = {}
    while left:
        total = sum(weight[s] for s in left)
        full = {s for s in left if rest * weight[s] / total > most * sizes[s]}
        if not full:
            return out | {s: rest * weight[s] / total for s in left}
        out |= {s: most * float(sizes[s]) for s in full}
        rest -= sum(out[s] for s in full)
        left -= full
    return out


def quotas(votes: Mapping[Source, float], most: Mapping[Source, int], blocks: int) -> dict[Source, int]:
    """Sainte-Laguë: ``blocks`` blocks by highest quotients votes / (2 n + 1), at most ``most`` each.

    A source has won its n-th block (from 0) if its quotient is at least some level, so the
    level is searched by halving and only the blocks around it are dealt singly; ties go to
    the first source in order.
    """
    order = in_order(s for s in votes if votes[s] > 0 and most[s] > 0)
    blocks = min(blocks, sum(most[s] for s in order))

    def at(level: float) -> dict[Source, int]:
        return {s: min(most[s], max(0, math.floor((votes[s] / level + 1) / 2))) for s in order}

    low, high = 0.0, max([votes[s] for s in order], default=1.0) * 2
    for _ in range(200):
        middle = (low + high) / 2
        if middle in (low, high) or middle == 0:
            break
        low, high = (middle, high) if sum(at(middle).values()) >= blocks else (low, middle)
    got = at(high) if order else {}
    while sum(got.values()) < blocks:
        best = max((s for s in order if got[s] < most[s]), key=lambda s: (votes[s] / (2 * got[s] + 1), -order.index(s)))
        got[best] += 1
    return {s: got.get(s, 0) for s in votes}


def shard_quotas(votes: Mapping[Source, float], most: Mapping[Source, int], blocks: int, shards: int) -> list[dict[Source, int]]:
    """Blocks of each source in each shard: shard i takes the next ``blocks / shards`` winners."""
    marks = [quotas(votes, most, blocks * i // shards) for i in range(shards + 1)]
    return [{s: after[s] - before[s] for s in votes} for before, after in zip(marks, marks[1:], strict=False)]


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mixed(
    docs: DataFrame,
    share: float = 1.5,
    most: float = 2.0,
    cycle: Sequence[int] = (5, 2, 1),
    block: int = BLOCK_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """Rows ``document`` (a struct of all columns), size, source_size, target and ``taken``: how many of its words the mix takes.

    The whole document is taken ``taken // size`` times, and then its first words up to the
    rest. Null and empty texts have size 0 and nothing taken; a null source is a source of
    its own. Equal rows have places of their own; which comes first makes no difference. Per-source totals,
    one row per source, are the only thing the driver sees. A hot source is cut into
    ``BUCKETS`` buckets of its seeded order, so that no task adds up a whole source.
    """
    spark = docs.sparkSession
    rows = docs.select(F.struct("*").alias("document"), "doc_id", "text", "source")
    sized = rows.select(
        "document",
        "doc_id",
        "source",
        word_count(F.col("text")).alias("size"),
        F.xxhash64(F.lit(seed), "doc_id", "text").alias("seeded"),
    )
    sized = sized.withColumn("bucket", F.pmod(F.shiftrightunsigned("seeded", 32), F.lit(BUCKETS)))
    sizes = {r["source"]: r["words"] for r in sized.groupBy("source").agg(F.sum("size").alias("words")).collect()}
    target = targets(sizes, weights(sizes, cycle), share, most)
    most_blocks = {s: math.ceil(most * n / block) for s, n in sizes.items()}
    quota = quotas(target, most_blocks, round(sum(target.values()) / block))
    plan = spark.createDataFrame(
        [(s, sizes[s], float(target[s]), min(quota[s] * block, math.floor(most * sizes[s]))) for s in in_order(sizes)],
        "source string, source_size long, target double, words long",
    ).alias("p")
    buckets = (
        sized.groupBy("source", "bucket")
        .agg(F.sum("size").alias("words"))
        .withColumn("upto", F.sum("words").over(Window.partitionBy("source").orderBy("bucket")))
        .select("source", "bucket", (F.col("upto") - F.col("words")).alias("before"))
        .alias("b")
    )
    line = Window.partitionBy("source", "bucket").orderBy("seeded", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    start = F.col("b.before") + F.col("upto") - F.col("size")
    taken = F.lit(0).cast("long")
    for lap in range(math.ceil(most)):
        begin = start + lap * F.col("p.source_size")
        taken = taken + F.greatest(F.lit(0), F.least(F.col("size"), F.col("p.words") - begin))
    same = F.col("s.source").eqNullSafe(F.col("b.source")) & (F.col("s.bucket") == F.col("b.bucket"))
    return (
        sized.withColumn("upto", F.sum("size").over(line))
        .alias("s")
        .join(buckets, same)
        .join(plan, F.col("s.source").eqNullSafe(F.col("p.source")))
        .select("document", "size", "p.source_size", "p.target", taken.cast("long").alias("taken"))
    )


def drawn(docs: DataFrame, **options) -> DataFrame:
    """The mix itself, in the columns of ``docs``: a row for each time a document is taken.

    Where only its first words are taken, the text ends after them; ``n_chars``, if there is
    one, follows the text.
    """
    out = mixed(docs, **options).where(F.col("taken") > 0)
    whole = F.floor(F.col("taken") / F.col("size"))
    rest = F.col("taken") - whole * F.col("size")
    parts = F.concat(
        F.array_repeat(F.col("size"), whole.cast("int")),
        F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<long>")),
    )
    out = out.select("document", "size", F.explode(parts).alias("words")).select(
        F.struct("document.*").alias("document"), "words", (F.col("words") < F.col("size")).alias("cut")
    )
    text = F.col("document.text")
    pieces = F.split(text, r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    text = F.when(F.col("cut"), F.array_join(F.slice(pieces, F.lit(1), F.col("words").cast("int")), "")).otherwise(text)

    def column(name: str) -> Column:
        if name == "text":
            return text.alias(name)
        old = F.col("document")[name]
        if name == "n_chars":
            return F.when(F.col("cut"), F.length(text)).otherwise(old).cast(docs.schema[name].dataType).alias(name)
        return old.alias(name)

    return out.select(*[column(c) for c in docs.columns])
