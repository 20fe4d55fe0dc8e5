"""Collocations by Toivonen's sampling: a sample proposes phrases, full passes count exactly.

1. A share of the documents is mined for phrases that occur at least ``SAMPLE_LEAST`` times
   in it. They are the proposal; its negative border are the phrases that are not proposed
   but whose parts of one word less both are, and all single words.
2. A pass over all documents counts proposal and border.
3. A border phrase that turns out frequent is a failure of the sample. Failures join the
   proposal, and another pass counts what that adds to the border, until no pass fails. A
   frequent phrase has only frequent parts, so then every frequent phrase has been counted.
4. These passes count 64-bit fingerprints, of which phrases may share one, so a count is never
   too low. A last pass counts the texts of the phrases found frequent; those counts are exact,
   but for two phrases that share a fingerprint within the same megabyte of text.

Which phrases a pass looks for goes to the tasks as bitmaps of a size that follows the
phrases, up to 16 MB. Phrases that get in by chance are counted too and change nothing.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from slipmatch.llm.tables import batch_rows, runs
from slipmatch.llm.words import LOWERED, U, mix, prefix_sums, stretch_hashes
from slipmatch.sources.shared import remove, write_aside, written

# One document in so many is in the sample, and a phrase is proposed from so many occurrences in it on.
SAMPLE_EVERY, SAMPLE_LEAST = 4, 2
# A bitmap has 2 to the power of these many bits: so many that one in SPARSE is set, within bounds.
LEAST_BITS, MOST_BITS, SPARSE = 20, 27, 16
CHUNK_BITS = 20
SALTS = 256
# Rows of an Arrow batch.
BATCH_ROWS = 1000
NO_LANG = "und"

STEP, LENGTHS = U(0xD6E8FEB86659FD93), U(7)
WORD, BLANK, BREAK = 0, 1, 2
COUNTS = "lang string, words int, phrase binary, n long"


def _kinds() -> np.ndarray:
    out = np.full(256, WORD, dtype=np.uint8)
    out[[0x20, 0x09]] = BLANK
    out[[*b".,;:!?", *range(0x0A, 0x0E)]] = BREAK
    return out


def _lowered() -> np.ndarray:
    out = np.arange(256, dtype=np.uint8)
    out[65:91] += 32
    return out


KIND, LOWER = _kinds(), _lowered()


def lang_print(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


class Phrases:
    """The words of a run of texts, and where phrases of 1 to ``most`` words start."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, langs: list[str], most: int):
        kind = KIND[data]
        inner = kind == WORD
        first = inner.copy()
        first[1:] &= ~inner[:-1]
        last = inner.copy()
        last[:-1] &= ~inner[1:]
        edges = offsets[(offsets > 0) & (offsets < len(data))]
        first[edges] |= inner[edges]
        last[edges - 1] |= inner[edges - 1]
        self.data, self.starts, self.ends = data, np.flatnonzero(first), np.flatnonzero(last) + 1
        self.text = np.searchsorted(offsets, self.starts, "right") - 1
        piece = np.cumsum(kind == BREAK, dtype=np.int64)[self.starts] if len(data) else np.zeros(0, dtype=np.int64)
        prints = {lang: U(lang_print(lang)) for lang in set(langs)}
        of_text = np.array([prints[lang] for lang in langs], dtype=np.uint64)[self.text]
        word = stretch_hashes(prefix_sums(data, LOWERED), self.starts, self.ends)
        n = len(word)
        # at[k]: first words of the phrases of k words; prints[k]: their fingerprints, by first
        # word. The lowest three bits of a fingerprint are the number of words.
        self.at: dict[int, np.ndarray] = {}
        self.prints: dict[int, np.ndarray] = {}
        rolled, whole = of_text, np.ones(n, dtype=bool)
        for k in range(1, most + 1):
            shift = k - 1
            if shift:
                whole = whole.copy()
                whole[max(0, n - shift) :] = False
                whole[: n - shift] &= (piece[: n - shift] == piece[shift:]) & (self.text[: n - shift] == self.text[shift:])
            following = np.zeros(n, dtype=np.uint64)
            following[: n - shift] = word[shift:]
            rolled = mix(rolled * STEP + following)
            self.at[k], self.prints[k] = np.flatnonzero(whole), (rolled & ~LENGTHS) | U(k)

    def phrase(self, at: np.ndarray, k: int) -> list[bytes]:
        """Phrases lower-cased, with one blank between words."""
        lowered = LOWER[self.data]
        lowered[lowered == 0x09] = 0x20
        raw = lowered.tobytes()
        begin, end = self.starts[at], self.ends[at + k - 1]
        letters = (self.ends - self.starts)[at]
        for further in range(1, k):
            letters = letters + (self.ends - self.starts)[at + further]
        plain = end - begin == letters + k - 1
        return [
            raw[b:e] if p else b" ".join(x for x in raw[b:e].split(b" ") if x)
            for b, e, p in zip(begin.tolist(), end.tolist(), plain.tolist(), strict=True)
        ]


def bits_for(phrases: int) -> int:
    return min(MOST_BITS, max(LEAST_BITS, (SPARSE * phrases).bit_length()))


class Proposal(NamedTuple):
    """A bitmap of the fingerprints proposed."""

    bitmap: np.ndarray

    def has(self, prints: np.ndarray) -> np.ndarray:
        place = prints >> U(64 - (len(self.bitmap) * 8 - 1).bit_length())
        return (self.bitmap[(place >> U(3)).astype(np.int64)] >> (place & U(7)).astype(np.uint8)) & np.uint8(1) > 0

    def joined(self, other: Proposal) -> Proposal:
        return Proposal(self.bitmap | other.bitmap)


def proposal(prints: DataFrame, bits: int) -> Proposal:
    """From rows ``print``: bits set word by word, then packed; the driver sees the bitmap, whatever the rows."""
    words = (
        prints.select(F.shiftrightunsigned("print", 64 - bits).alias("place"))
        .selectExpr("int(shiftright(place, 5)) AS word", "shiftleft(1L, int(place % 32)) AS bit")
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
        .withColumn("chunk", F.shiftright("word", CHUNK_BITS - 5))
    )

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        chunk = np.zeros(1 << (CHUNK_BITS - 5), dtype="<u4")
        chunk[frame["word"].to_numpy() % len(chunk)] = frame["bits"].to_numpy().astype(np.uint32)
        return pd.DataFrame({"chunk": [frame["chunk"].iloc[0]], "content": [chunk.tobytes()]})

    bitmap, size = np.zeros(1 << (bits - 3), dtype=np.uint8), 1 << (CHUNK_BITS - 3)
    for row in words.groupBy("chunk").applyInPandas(pack, "chunk int, content binary").toLocalIterator():
        bitmap[row["chunk"] * size : (row["chunk"] + 1) * size] = np.frombuffer(row["content"], dtype=np.uint8)
    return Proposal(bitmap)


def _parsed(batches, most: int):
    for batch in batches:
        for part, data, offsets in runs(batch, "text"):
            langs = part.column("lang").to_pylist()
            yield langs, Phrases(data, offsets, langs, most)


def _counts(prints: list[np.ndarray]) -> pa.RecordBatch:
    some, n = np.unique(np.concatenate(prints), return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(some.view(np.int64)), pa.array(n, pa.int64())], ["print", "n"])


def _frequent(counted: DataFrame, least: int) -> DataFrame:
    return counted.groupBy("print").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("print")


def sampled(docs: DataFrame, most: int) -> DataFrame:
    """``print`` of the phrases of fewer than ``most`` words that the sample proposes."""

    def mine(batches):
        for _, found in _parsed(batches, most - 1):
            yield _counts([found.prints[k][found.at[k]] for k in range(1, most)])

    sample = docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(SAMPLE_EVERY)) == 0).select("lang", "text")
    return _frequent(sample.mapInArrow(mine, "print long, n long"), SAMPLE_LEAST)


class Pass(NamedTuple):
    """What a pass counts: phrases whose parts are proposed, but for those counted before."""

    proposed: Proposal
    before: Proposal | None

    def wanted(self, found: Phrases, k: int) -> np.ndarray:
        at = found.at[k]
        if k == 1:
            return at if self.before is None else at[:0]
        left, right = found.prints[k - 1][at], found.prints[k - 1][at + 1]
        chosen = self.proposed.has(left) & self.proposed.has(right)
        if self.before is not None:
            chosen &= ~(self.before.has(left) & self.before.has(right))
        return at[chosen]


def counted(docs: DataFrame, step: Pass, most: int, least: int) -> DataFrame:
    """``print`` of the phrases this pass counts that occur ``least`` times or more."""
    held = docs.sparkSession.sparkContext.broadcast(step)

    def count(batches):
        for _, found in _parsed(batches, most):
            yield _counts([found.prints[k][held.value.wanted(found, k)] for k in range(1, most + 1)])

    return _frequent(docs.select("lang", "text").mapInArrow(count, "print long, n long"), least)


def failures(frequent: DataFrame, step: Pass, most: int) -> DataFrame:
    """Frequent phrases of fewer than ``most`` words that the pass did not have proposed."""
    held = frequent.sparkSession.sparkContext.broadcast(step.proposed)

    def unproposed(batches):
        for batch in batches:
            prints = batch.column("print").to_numpy(zero_copy_only=False).view(np.uint64)
            failed = prints[((prints & LENGTHS) < U(most)) & ~held.value.has(prints)]
            yield pa.RecordBatch.from_arrays([pa.array(failed.view(np.int64))], ["print"])

    return frequent.mapInArrow(unproposed, "print long")


def mined(docs: DataFrame, most: int, least: int) -> DataFrame:
    """lang, words, phrase, n of all words and phrases of up to ``most`` words that occur ``least``
    times or more in a language; ``words`` 0 gives the number of words of the language."""
    spark = docs.sparkSession
    sample = write_aside(sampled(docs, most), "sample-phrases")
    bits = bits_for(sample.read(spark).count())
    step, passes = Pass(proposal(sample.read(spark), bits), None), [sample]
    frequent: DataFrame | None = None
    while True:
        passes.append(write_aside(counted(docs, step, most, least), "frequent-phrases"))
        own = passes[-1].read(spark)
        frequent = own if frequent is None else frequent.unionByName(own)
        failed = write_aside(failures(own, step, most), "failed-phrases")
        passes.append(failed)
        if failed.read(spark).isEmpty():
            break
        step = Pass(step.proposed.joined(proposal(failed.read(spark), bits)), step.proposed)
    found = written(_texts(docs, proposal(frequent, bits_for(frequent.count())), most, least), "phrase-counts")
    for done in passes:
        remove(spark, done.path)
    return found


def _texts(docs: DataFrame, frequent: Proposal, most: int, least: int) -> DataFrame:
    """Exact counts, by their texts, of the phrases whose fingerprints are frequent."""
    held = docs.sparkSession.sparkContext.broadcast(frequent)

    def count(batches):
        for langs, found in _parsed(batches, most):
            names = np.array(langs, dtype=object)
            sizes = np.bincount(found.text, minlength=len(langs))
            for lang in sorted(set(langs)):
                yield _rows([lang], 0, [b""], [int(sizes[names == lang].sum())])
            for k in range(1, most + 1):
                at = found.at[k][held.value.has(found.prints[k][found.at[k]])]
                if len(at):
                    _, place, n = np.unique(found.prints[k][at], return_index=True, return_counts=True)
                    at = at[place]
                    yield _rows(names[found.text[at]], k, found.phrase(at, k), n)

    summed = (
        docs.select("lang", "text")
        .mapInArrow(count, COUNTS)
        .groupBy("lang", "words", F.col("phrase").cast("string").alias("phrase"))
        .agg(F.sum("n").alias("n"))
    )
    return summed.where((F.col("words") == 0) | (F.col("n") >= least))


def _rows(langs, k: int, phrases: list[bytes], n) -> pa.RecordBatch:
    columns = [pa.array(langs, pa.string()), pa.array(np.full(len(n), k, dtype=np.int32)), pa.array(phrases, pa.binary()), pa.array(n, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, ["lang", "words", "phrase", "n"])


def _big(count: str) -> Column:
    return F.col(count).cast("decimal(15,0)")


def scored(found: DataFrame, at_least: int) -> DataFrame:
    """lang, words, phrase, a, l, r and score of phrases of ``at_least`` words or more, by their lowest-scoring cut.

    Counts up to 10^15 are exact: products have 38 digits.
    """
    parts = F.split("phrase", " ")
    cut = F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("cut")
    cuts = found.where(F.col("words") >= at_least).select("lang", "words", "phrase", F.col("n").alias("a"), parts.alias("parts"), cut).select(
        "lang",
        "words",
        "phrase",
        "a",
        "cut",
        F.array_join(F.slice("parts", F.lit(1), F.col("cut")), " ").alias("left"),
        F.array_join(F.slice("parts", F.col("cut") + 1, F.col("words")), " ").alias("right"),
    )
    known = found.where(F.col("words") > 0)
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(known.select("lang", F.col("phrase").alias(side), F.col("n").alias(name)), ["lang", side])
    top = F.lit(1_000_000).cast("decimal(7,0)") * (_big("a") * _big("a"))
    cuts = cuts.withColumn("top", top).withColumn("bottom", _big("l") * _big("r")).withColumn("score", F.expr("top div bottom"))
    return (
        cuts.groupBy("lang", "words", "phrase", "a")
        .agg(F.min(F.struct("score", "cut", "l", "r")).alias("worst"))
        .select("lang", "words", "phrase", "a", "worst.l", "worst.r", "worst.score")
    )


def _covered(candidates: DataFrame, least_words: int, percent: int) -> DataFrame:
    """lang, phrase of candidates most of whose occurrences are within one longer candidate."""
    parts = F.split("phrase", " ")
    longer = candidates.where(F.col("words") > least_words).select("lang", "words", F.col("a").alias("above"), parts.alias("parts"))
    for name, most in (("size", F.col("words") - 1), ("first", F.col("words") - F.col("size") + 1)):
        low = F.lit(least_words if name == "size" else 1)
        longer = longer.select("*", F.explode(F.sequence(low, most)).alias(name))
    inner = (
        longer.select("lang", F.array_join(F.slice("parts", F.col("first"), F.col("size")), " ").alias("phrase"), "above")
        .groupBy("lang", "phrase")
        .agg(F.max("above").alias("above"))
    )
    both = candidates.select("lang", "phrase", "a").join(inner, ["lang", "phrase"])
    return both.where(100 * F.col("above") >= percent * F.col("a")).select("lang", "phrase")


def collocations(
    docs: DataFrame, least_words: int = 2, most_words: int = 3, least: int = 10, covered: int = 50, top: int = 2000
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's ``top`` collocations.

    A null lang is ``und``; null and empty texts have no words, and phrases never cross texts.
    Repeated rows count each. Ranks are found in ``SALTS`` parts of a language first, so that
    no task sorts all its phrases. Other columns are left out. The bound ``top`` is the feature.
    """
    texts = docs.select("doc_id", F.coalesce("lang", F.lit(NO_LANG)).alias("lang"), "text")
    with batch_rows(docs.sparkSession, BATCH_ROWS):
        found = mined(texts, most_words, least)
    candidates = scored(found, least_words)
    kept = candidates.join(_covered(candidates, least_words, covered), ["lang", "phrase"], "left_anti")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    for keys in (["lang", "salt"], ["lang"]):
        kept = kept.withColumn("salt", salt).withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
        kept = kept.where(F.col("rank") <= top)
    words = found.where(F.col("words") == 0).select("lang", F.col("n").alias("total"))
    return kept.join(words, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score"
    )
