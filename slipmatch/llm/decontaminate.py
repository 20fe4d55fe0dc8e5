"""Benchmark decontamination by SimHash fingerprints of item-sized windows.

Every run of ``W`` words of a document has a 64-bit SimHash; ``W`` follows the size of the
items, and every run of ``W`` words of an item is fingerprinted too. A multi-index over the
four 16-bit blocks of the items' fingerprints finds all that differ in at most ``RADIUS`` bits:
of four blocks one must then be equal. Each find lays the item over the document, and the
window of the item's size there is compared with it exactly, by weighted word shingles.

``W`` is so short that a passage with similarity 0.8 or more always keeps one run of ``W``
words unchanged, whose fingerprint is equal, so no such passage is missed. This is tested for
substituted words in items of 5 to 399 words; for words put in or left out it is not proven.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from slipmatch.llm.tables import runs
from slipmatch.llm.words import U, Words, shingles, words

WORDS = 5
SIMILARITY = 0.8
RADIUS, BLOCKS = 3, 4
LONGEST_RUN = 16
# Words of benchmark items that one pass over the documents looks for; more take more passes.
PASS_WORDS = 2_000_000
CHUNK = 1 << 14


def run_size(n: int) -> int:
    """Size of the runs an item of ``n`` words is found by: a power of two, half of it at most.

    With s shingles of five words, similarity 0.8 leaves at most s / 9 of them to differ, and
    each changed word that isn't near an end costs five: one change in 45 words or so. That leaves a
    whole run of this size at any place of the changes; runs of 32 could all be broken in 64, 94 or 95 words.
    """
    return min(LONGEST_RUN, 1 << max(0, (max(2, n) // 2).bit_length() - 1))


def fingerprints(hashes: np.ndarray, size: int) -> np.ndarray:
    """SimHash of every run of ``size`` words: bit j is set if most words' hashes have it set."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.empty(n, dtype=np.uint64)
    for first in range(0, n, CHUNK):
        own = hashes[first : min(first + CHUNK, n) + size - 1]
        bits = np.unpackbits(own.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").T
        sums = np.zeros((64, len(own) + 1), dtype=np.int16)
        # Sums may wrap; their differences over a run don't.
        np.cumsum(bits, axis=1, dtype=np.int16, out=sums[:, 1:])
        most = (sums[:, size:] - sums[:, :-size]) > size // 2
        packed = np.packbits(most, axis=0, bitorder="little")
        out[first : first + most.shape[1]] = np.ascontiguousarray(packed.T).view(np.uint64)[:, 0]
    return out


class Items(NamedTuple):
    ids: list[int]
    # Word hashes of all items one after another, and where each begins.
    hashes: np.ndarray
    offsets: np.ndarray


def as_items(rows: list[tuple[int, str]]) -> Items:
    """Items without words are left out: there is nothing to find."""
    encoded = [(i, (text or "").encode()) for i, text in rows]
    data = np.frombuffer(b"".join(t for _, t in encoded), dtype=np.uint8)
    found = words(data, np.concatenate([[0], np.cumsum([len(t) for _, t in encoded])]).astype(np.int64))
    sizes = np.diff(found.offsets)
    kept = np.flatnonzero(sizes > 0)
    return Items([encoded[i][0] for i in kept], found.hashes, np.append(found.offsets[:-1][kept], found.offsets[-1]))


class Index:
    """All runs of the items of one run size, by the blocks of their fingerprints."""

    def __init__(self, items: Items, size: int, of: list[int]):
        self.size = size
        prints, item, place = [], [], []
        for i in of:
            own = fingerprints(items.hashes[items.offsets[i] : items.offsets[i + 1]], size)
            prints.append(own)
            item.append(np.full(len(own), i))
            place.append(np.arange(len(own)))
        self.prints, self.item, self.place = np.concatenate(prints), np.concatenate(item), np.concatenate(place)
        self.orders, self.keys, self.present = [], [], []
        for block in range(BLOCKS):
            key = self._block(self.prints, block)
            order = np.argsort(key, kind="stable")
            self.orders.append(order)
            self.keys.append(key[order])
            self.present.append(np.bincount(key, minlength=1 << 16) > 0)

    @staticmethod
    def _block(prints: np.ndarray, block: int) -> np.ndarray:
        return ((prints >> U(16 * block)) & U(0xFFFF)).astype(np.int64)

    def near(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (position in ``prints``, run of the index) at most RADIUS bits apart."""
        at = [np.zeros(0, dtype=np.int64)]
        run = [np.zeros(0, dtype=np.int64)]
        for block in range(BLOCKS):
            key = self._block(prints, block)
            hit = np.flatnonzero(self.present[block][key])
            for first in range(0, len(hit), CHUNK):
                some = hit[first : first + CHUNK]
                low = np.searchsorted(self.keys[block], key[some], "left")
                n = np.searchsorted(self.keys[block], key[some], "right") - low
                position = np.repeat(some, n)
                inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                entry = self.orders[block][np.repeat(low, n) + inside]
                near = np.bitwise_count(prints[position] ^ self.prints[entry]) <= RADIUS
                at.append(position[near])
                run.append(entry[near])
        return np.concatenate(at), np.concatenate(run)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard of two lists of shingles: sums of lesser over sums of greater counts."""
    values, side = np.unique(np.concatenate([a, b]), return_inverse=True)
    in_a = np.bincount(side[: len(a)], minlength=len(values))
    in_b = np.bincount(side[len(a) :], minlength=len(values))
    return float(np.minimum(in_a, in_b).sum() / max(1, np.maximum(in_a, in_b).sum()))


def _shingled(hashes: np.ndarray) -> np.ndarray:
    nothing = np.zeros(0, dtype=np.int64)
    return shingles(Words(hashes, nothing, nothing, np.array([0, len(hashes)])), WORDS)[0]


def leaks(docs: DataFrame, benchmark: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """doc_id, item_id, similarity, first_word, n_words: items found in documents, at the best place.

    Null texts and items without words hold and give nothing. Copies of a document are found
    each; a row without an id can't be told apart from others and is reported under null.
    Repeated ids are one document. An empty benchmark or table gives no rows. The benchmark
    goes to the tasks in parts of bounded size, each of which takes one pass.
    """
    spark = docs.sparkSession
    sized = benchmark.select(F.col("item_id").cast("long"), "text").where(F.col("text").isNotNull())
    total = sized.agg(F.sum(F.size(F.split("text", r"[\x20\x09-\x0D]+")))).first()[0] or 0
    passes = max(1, math.ceil(total / PASS_WORDS))
    schema = "doc_id long, item_id long, similarity double, first_word long, n_words long"
    found = None
    for part in range(passes):
        own = sized.where(F.pmod(F.xxhash64("text"), F.lit(passes)) == part)
        items = as_items(sorted({(r["item_id"], r["text"]) for r in own.collect()}, key=repr))
        held = spark.sparkContext.broadcast(tuple(items))
        some = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_finder(held, least), schema)
        found = some if found is None else found.unionByName(some)
    best = F.max(F.struct("similarity", (-F.col("first_word")).alias("minus"), "n_words")).alias("best")
    return (
        found.groupBy("doc_id", "item_id")
        .agg(best)
        .select("doc_id", "item_id", "best.similarity", (-F.col("best.minus")).alias("first_word"), "best.n_words")
    )


def _finder(held, least: float):
    def find(batches):
        items = Items(*held.value)
        sizes = np.diff(items.offsets)
        by_run: dict[int, list[int]] = {}
        for i, n in enumerate(sizes):
            by_run.setdefault(min(run_size(int(n)), int(n)), []).append(i)
        indexes = [Index(items, size, of) for size, of in sorted(by_run.items())]
        of_item = [_shingled(items.hashes[a:b]) for a, b in zip(items.offsets, items.offsets[1:], strict=False)]
        for batch in batches:
            for part, data, offsets in runs(batch, "text"):
                found = words(data, offsets)
                rows = _found(found, items, indexes, of_item, least)
                doc_id = part.column("doc_id").take(pa.array([r[0] for r in rows], pa.int64()))
                columns = [doc_id, pa.array([items.ids[r[1]] for r in rows], pa.int64())]
                columns.append(pa.array([r[2] for r in rows], pa.float64()))
                columns += [pa.array([r[k] for r in rows], pa.int64()) for k in (3, 4)]
                yield pa.RecordBatch.from_arrays(
                    columns, ["doc_id", "item_id", "similarity", "first_word", "n_words"]
                )

    return find


def _found(found, items: Items, indexes: list[Index], of_item: list[np.ndarray], least: float) -> list[tuple]:
    """(text, item, similarity, first word, words) of the best window for each text and item."""
    best: dict[tuple[int, int], tuple[float, int, int]] = {}
    for index in indexes:
        at, run = index.near(fingerprints(found.hashes, index.size))
        if not len(at):
            continue
        text = np.searchsorted(found.offsets, at, "right") - 1
        begin, end = found.offsets[text], found.offsets[text + 1]
        item = index.item[run]
        size = items.offsets[item + 1] - items.offsets[item]
        # The item laid over the text, kept inside it.
        start = np.clip(at - index.place[run], begin, np.maximum(begin, end - size))
        stop = np.minimum(start + size, end)
        inside = at + index.size <= end
        places = np.unique(np.stack([text, item, start, stop])[:, inside], axis=1)
        for t, i, a, b in places.T.tolist():
            alike = similarity(_shingled(found.hashes[a:b]), of_item[i])
            # Places come in order, so the first of equally good ones stays.
            if alike >= least and alike > best.get((t, i), (0.0, 0, 0))[0]:
                best[t, i] = (alike, a - int(found.offsets[t]), b - a)
    return [(t, i, alike, first, n) for (t, i), (alike, first, n) in sorted(best.items())]


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents in which no item is found. Rows without an id stay unless one of them leaks."""
    hit = leaks(docs, benchmark).select("doc_id").distinct().alias("hit")
    return docs.alias("all").join(hit, F.col("all.doc_id").cast("long").eqNullSafe(F.col("hit.doc_id")), "left_anti")
