"""Importance resampling towards a target text: n-gram buckets, their gains, and a seeded draw.

Separators collapse to single spaces; then an overlapped regular expression with look-arounds
at word boundaries gives the span of every n-gram, and the CRC-32 of the span's bytes its
bucket. Buckets are counted over all documents and over all target texts. The log ratio of a
bucket's two shares is its gain; a document's weight adds up the gains of its n-grams, and
Gumbel noise from a hash of its id turns the highest scores into a draw without replacement.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window, functions as F

from slipmatch.sources.shared import written

BUCKETS = 10_000
SEED = 2024
# N-grams whose buckets a task remembers; the memory is emptied when full.
MEMO_GRAMS = 300_000
ROWS = 256
SCANNED = "doc_id long, n_words long, n_features long, buckets binary"


def _folding() -> bytes:
    """A-Z lower-cased; all other ASCII but 0-9 and a-z to a space; other bytes as they are."""
    word = b"0123456789abcdefghijklmnopqrstuvwxyz"
    return bytes(b + 32 if 65 <= b <= 90 else b if b in word or b >= 0x80 else 0x20 for b in range(256))


FOLDED = _folding()


def collapsed(text: str) -> bytes:
    """Words of the text's UTF-8 bytes, with one space between two."""
    return b" ".join(text.encode().translate(FOLDED).split())


def gram_pattern(words: int) -> bytes:
    """Runs of so many words, from word boundary to word boundary."""
    return rb"(?<![^ ])[^ ]+(?: [^ ]+){%d}(?![^ ])" % (words - 1)


def gram_spans(data: bytes, least: int, most: int) -> Iterator[tuple[int, int]]:
    """Spans of all runs of ``least`` to ``most`` words of collapsed text, overlapping ones too."""
    for words in range(least, most + 1):
        for found in regex.finditer(gram_pattern(words), data, overlapped=True):
            yield found.span()


def scanned(texts: DataFrame, least: int = 1, most: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """doc_id, n_words, n_features and the packed buckets of all features of each text.

    Null and empty texts have none; a text of fewer than ``least`` words has words but no features.
    """

    def scan(batches):
        memo: dict[bytes, int] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                words, packed = [], []
                for text in part.column("text").to_pylist():
                    data = collapsed(text or "")
                    found = []
                    for begin, end in gram_spans(data, least, most):
                        gram = data[begin:end]
                        bucket = memo.get(gram)
                        if bucket is None:
                            if len(memo) >= MEMO_GRAMS:
                                memo.clear()
                            bucket = memo[gram] = zlib.crc32(gram) % buckets
                        found.append(bucket)
                    words.append(data.count(b" ") + 1 if data else 0)
                    packed.append(np.array(found, dtype="<u4").tobytes())
                sizes = [len(p) // 4 for p in packed]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(words, pa.int64()), pa.array(sizes, pa.int64()), pa.array(packed, pa.binary())],
                    ["doc_id", "n_words", "n_features", "buckets"],
                )

    return texts.mapInArrow(scan, SCANNED)


def bucket_counts(found: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features in each bucket: a task sends a row for each bucket at most, the driver sees one for each."""

    def count(batches):
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for packed in batch.column("buckets"):
                total += np.bincount(np.frombuffer(packed.as_buffer(), dtype="<u4"), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], ["bucket", "n"])

    summed = found.select("buckets").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, dtype=np.int64)
    for row in summed.collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> list[int]:
    """Thousandths of the log ratio of each bucket's smoothed shares, rounded down, in doubles."""
    n, s_all, t_all = len(raw), float(raw.sum()), float(target.sum())
    return [
        math.floor(1000 * math.log((float(t) + 1) * (s_all + n) / ((float(s) + 1) * (t_all + n))))
        for s, t in zip(raw.tolist(), target.tolist(), strict=True)
    ]


def weighted(found: DataFrame, gain: list[int]) -> DataFrame:
    """``weight``: the sum of the gains of a document's features, 0 without any."""
    of_bucket = np.array(gain, dtype=np.int64)

    def weigh(batches):
        for batch in batches:
            weights = [int(of_bucket[np.frombuffer(p.as_buffer(), dtype="<u4")].sum()) for p in batch.column("buckets")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "n_words", "n_features")), pa.array(weights, pa.int64())],
                ["doc_id", "n_words", "n_features", "weight"],
            )

    return found.mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Thousandths of Gumbel noise from the first 32 bits of a hash of seed and id; a null id is empty text."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def ranked(scored: DataFrame, least_words: int, percent: int) -> DataFrame:
    """``rank`` of the drawn: ``percent`` of the documents with enough words, by highest score.

    Rows are dealt over ranges of (score, doc_id), sorted within each and counted; the number
    of a row is its place in its range plus the sizes of the ranges before. So neither a common
    score nor a large table meets in one task.
    """
    enough = F.col("n_words") >= least_words
    order = [F.desc("score"), F.asc("doc_id")]
    placed = (
        scored.where(enough)
        .repartitionByRange(*order, "n_features", "weight")
        .sortWithinPartitions(*order)
        # Partition number above, row number below.
        .withColumn("place", F.monotonically_increasing_id())
    )
    placed = written(placed, "draw-order").withColumn("range", F.shiftright("place", 33))
    sizes = placed.groupBy("range").agg(F.count("*").alias("rows"))
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "range",
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"),
        F.floor(F.sum("rows").over(Window.partitionBy()) * percent / 100).alias("drawn"),
    )
    number = F.col("before") + F.col("place").bitwiseAND((1 << 33) - 1) + 1
    counted = placed.join(starts, "range").withColumn("rank", F.when(number <= F.col("drawn"), number))
    columns = ["doc_id", "n_features", "weight", "score", "rank"]
    rest = scored.where(~enough).withColumn("rank", F.lit(None).cast("long"))
    return counted.select(*columns).unionByName(rest.select(*columns))


def resampled(
    docs: DataFrame,
    target: DataFrame,
    least: int = 1,
    most: int = 1,
    buckets: int = BUCKETS,
    least_words: int = 20,
    percent: int = 10,
    seed: int = SEED,
) -> DataFrame:
    """doc_id, n_features, weight, score and rank (null if not drawn) of every document.

    Features are runs of ``least`` to ``most`` words of whole texts, repeats counted. Null and
    empty texts have none and are never drawn; an empty target or corpus counts nothing. Equal
    rows each have a place of their own; among equal scores the smaller doc_id, null first,
    comes first. Other columns are left out. The driver sees one count for each bucket.
    """
    raw = written(scanned(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), least, most, buckets), "features")
    wanted = scanned(target.select(F.lit(None).cast("long").alias("doc_id"), "text"), least, most, buckets)
    gain = gains(bucket_counts(raw, buckets), bucket_counts(wanted, buckets))
    scored = weighted(raw, gain).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    return ranked(written(scored, "scores"), least_words, percent)
