"""Exact removal of repeated byte strings by content-chosen anchors and fingerprints.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts earlier: in a document
of smaller id, or earlier in the same one. This is no recursive bucket-pointer refinement: a bucket
is a hash of the bytes around an anchor, no round refines by other suffixes' buckets. Four rounds:

1. Of each string of LENGTH bytes the suffix at its smallest q-gram hash is its anchor, a
   choice that depends on the string alone, so equal strings have equal anchors. One suffix
   in 35 or so is an anchor. Its bucket is refined at once by the bytes before it, or after
   it, that half of its strings have in common.
2. Documents none of whose buckets occurs twice are done. Bucket identifiers travel packed,
   once for each batch of documents; which documents go on is kept in a bitmap of fixed size,
   in which some that needn't may slip through.
3. Within a bucket, suffixes are told apart by an identifier of all bytes that their strings
   reach. A class of suffixes that agree in it agrees in all those strings: every document
   but the smallest loses them.
4. Only where a bucket has several classes are the smallest documents' strings told apart one
   by one, by identifiers of LENGTH bytes.

Identifiers are 64-bit fingerprints of the bytes; that two strings share one by chance takes
about four billion different strings.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from slipmatch.llm.tables import runs, to_utf8
from slipmatch.llm.words import BYTES, INVERSE, U, mix, powers, prefix_sums, stretch_hashes
from slipmatch.session import shared_dir
from slipmatch.sources.shared import written

LENGTH, GRAM = 100, 32
SPAN = LENGTH - GRAM + 1
HALF = SPAN // 2
POSITION_BITS = 28
BITMAP_BITS = 27
# A document's buckets are dealt over this many parts at least, so that the bits its parts
# send grow with the documents and not with the parts.
LEAST_PARTS = 256


class Suffixes:
    """Anchors of the texts in a run of bytes, and the strings that have them."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        n = len(data)
        self.offsets = offsets
        self.sums = prefix_sums(data, BYTES)
        if n < LENGTH:
            nothing = np.zeros(0, dtype=np.int64)
            self.first = self.last = self.text = nothing
            self.bucket = self.key = nothing.astype(np.uint64)
            return
        grams = mix((self.sums[GRAM:] - self.sums[:-GRAM]) * powers(INVERSE, n + 1)[: n - GRAM + 1] + U(GRAM))
        mask = U((1 << POSITION_BITS) - 1)
        least = (grams & ~mask) | np.arange(len(grams), dtype=np.uint64)
        width = 1
        while 2 * width <= SPAN:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        rest = SPAN - width
        least = np.minimum(least[: len(least) - rest], least[rest:])
        anchor = (least & mask).astype(np.int64)
        whole = np.ones(len(anchor), dtype=bool)
        for begin, end in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            whole[max(begin, end - LENGTH + 1) : end] = False
        change = np.ones(len(anchor) + 1, dtype=bool)
        change[1:-1] = (anchor[1:] != anchor[:-1]) | (whole[1:] != whole[:-1])
        # First and last start of the strings of each anchor.
        self.first = np.flatnonzero(whole & change[:-1])
        self.last = np.flatnonzero(whole & change[1:])
        at = anchor[self.first]
        # Strings that start HALF or more before the anchor, and the others.
        early = self.first <= at - HALF
        late = self.last > at - HALF
        ends = np.minimum(self.last, at - HALF)[early]
        begins = np.maximum(self.first, at - HALF + 1)[late]
        left = stretch_hashes(self.sums, at[early] - HALF, at[early] + GRAM)
        right = mix(stretch_hashes(self.sums, at[late], at[late] + LENGTH - HALF + 1) + U(1))
        first = np.concatenate([self.first[early], begins])
        order = np.argsort(first, kind="stable")
        self.last = np.concatenate([ends, self.last[late]])[order]
        self.first = first[order]
        at = np.concatenate([at[early], at[late]])[order]
        self.bucket = np.concatenate([left, right])[order]
        reach = stretch_hashes(self.sums, self.first, self.last + LENGTH)
        self.key = mix(reach + (at - self.first).astype(np.uint64) * U(0x9E3779B97F4A7C15))
        self.text = np.searchsorted(offsets, self.first, "right") - 1

    def strings(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Identifier and start of all strings of the chosen anchors."""
        sizes = self.last[chosen] - self.first[chosen] + 1
        inside = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        starts = np.repeat(self.first[chosen], sizes) + inside
        return stretch_hashes(self.sums, starts, starts + LENGTH), starts


def _packed(parts: int):
    """Buckets of each batch of documents, once each, dealt into ``parts`` packed rows.

    A bucket has 40 bits here, a document 32. Documents that share a bucket within the batch
    are sure to go on. So a batch sends no bucket twice, however hot it is.
    """

    def pack(batches):
        for batch in batches:
            found = []
            for part, data, offsets in runs(batch, "text"):
                s = Suffixes(data, offsets)
                doc = part.column("mark").to_numpy(zero_copy_only=False)[s.text]
                found.append((s.bucket >> U(24), doc))
            if not found:
                continue
            bucket, doc = (np.concatenate(c) for c in zip(*found, strict=True))
            _, first, at, n = np.unique(bucket, return_index=True, return_inverse=True, return_counts=True)
            sure = np.unique(doc[n[at] > 1])
            bucket, doc = bucket[first], doc[first]
            of = (bucket % U(parts)).astype(np.int64)
            order = np.lexsort((doc, of))
            bucket, doc, of = bucket[order], doc[order], of[order]
            bounds = np.searchsorted(of, np.arange(parts + 1))
            rows = [
                (
                    i,
                    (bucket[a:b] & U(0xFFFFFFFF)).astype(np.uint32).tobytes(),
                    (bucket[a:b] >> U(32)).astype(np.uint8).tobytes(),
                    doc[a:b].astype(np.int32).tobytes(),
                    sure[i::parts].astype(np.int32).tobytes(),
                )
                for i, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False))
                if b > a or len(sure) > i
            ]
            kinds = [pa.int32(), *[pa.binary()] * 4]
            columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["part", "low", "high", "docs", "sure"])

    return pack


def _marked(rows: pd.DataFrame) -> pd.DataFrame:
    """The documents of one part's buckets that occur in several batches, as bits."""
    low, high, docs, sure = (
        np.frombuffer(b"".join(rows[c]), dtype=kind)
        for c, kind in (("low", np.uint32), ("high", np.uint8), ("docs", np.int32), ("sure", np.int32))
    )
    bucket = (high.astype(np.uint64) << U(32)) | low
    order = np.argsort(bucket, kind="stable")
    bucket, docs = bucket[order], docs[order]
    same = bucket[1:] == bucket[:-1]
    again = np.zeros(len(bucket), dtype=bool)
    again[1:] = same
    again[:-1] |= same
    return _bits(np.concatenate([docs[again], sure]))


def _bits(marks: np.ndarray) -> pd.DataFrame:
    place = np.unique(marks.astype(np.int32).view(np.uint32) >> np.uint32(32 - BITMAP_BITS)).astype(np.int64)
    word = place >> 6
    starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]])[: len(word)])
    bit = np.left_shift(U(1), (place & 63).astype(np.uint64))
    mask = np.bitwise_or.reduceat(bit, starts) if len(starts) else bit
    return pd.DataFrame({"word": word[starts], "mask": mask.view(np.int64)})


def _in_bitmap(held):
    @F.pandas_udf("boolean")
    def inside(marks: pd.Series) -> pd.Series:
        place = (marks.to_numpy(np.int32).view(np.uint32) >> np.uint32(32 - BITMAP_BITS)).astype(np.int64)
        return pd.Series((held.value[place >> 6] >> (place & 63).astype(np.uint64)) & U(1) == 1)

    return inside


def _going_on(named: DataFrame) -> Column:
    """Whether a document, by its ``mark``, may share a bucket with another or with itself.

    The bitmap has ``2 ** BITMAP_BITS`` bits, 16 MB, whatever the input; the driver merges it.
    """
    parts = max(LEAST_PARTS, 2 * named.rdd.getNumPartitions())
    packed = named.mapInArrow(_packed(parts), "part int, low binary, high binary, docs binary, sure binary")
    bits = (
        packed.groupBy("part")
        .applyInPandas(_marked, "word long, mask long")
        .groupBy("word")
        .agg(F.bit_or("mask").alias("mask"))
        .toPandas()
    )
    bitmap = np.zeros(1 << (BITMAP_BITS - 6), dtype=np.uint64)
    bitmap[bits["word"].to_numpy(np.int64)] = bits["mask"].to_numpy(np.int64).view(np.uint64)
    return _in_bitmap(named.sparkSession.sparkContext.broadcast(bitmap))(F.col("mark"))


def _dealt(df: DataFrame, name: str, buckets: int) -> DataFrame:
    """``df`` written in buckets of doc_id, so that later joins needn't move it again."""
    spark = df.sparkSession
    table = f"slipmatch_{name}_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark)}/slipmatch/{spark.sparkContext.applicationId}/{table}"
    writer = df.repartition(buckets, "doc_id").write.option("path", path).option("compression", "zstd")
    writer.bucketBy(buckets, "doc_id").saveAsTable(table)
    return spark.table(table)


def _smallest(bucket: np.ndarray, key: np.ndarray, doc: np.ndarray) -> pa.RecordBatch:
    """One row for each class in a batch: its smallest document and its number of suffixes."""
    order = np.argsort(key, kind="stable")
    bucket, key, doc = bucket[order], key[order], doc[order]
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])[: len(key)])
    sizes = np.diff(np.append(starts, len(key)))
    smallest = np.minimum.reduceat(doc, starts) if len(starts) else doc
    columns = [bucket[starts].view(np.int64), key[starts].view(np.int64), smallest, sizes]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["bucket", "key", "smallest", "n"])


def _classes(batches):
    """Classes of suffixes, added up within each batch of documents before they travel."""
    for batch in batches:
        found = []
        for part, data, offsets in runs(batch, "text"):
            s = Suffixes(data, offsets)
            doc = part.column("doc_id").to_numpy(zero_copy_only=False)[s.text]
            found.append((s.bucket, s.key, doc))
        if found:
            yield _smallest(*(np.concatenate(c) for c in zip(*found, strict=True)))


def _members(batches):
    """The classes each document has suffixes in."""
    for batch in batches:
        for part, data, offsets in runs(batch, "text"):
            s = Suffixes(data, offsets)
            doc = part.column("doc_id").to_numpy(zero_copy_only=False)[s.text]
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), pa.array(s.key.view(np.int64))], ["doc_id", "key"]
            )


def _ids(part: pa.RecordBatch, column: str, i: int) -> np.ndarray:
    return np.asarray(part.column(column)[i].values if part.column(column)[i].is_valid else [], dtype=np.int64)


def _open_strings(batches):
    """Strings that each document, smallest of its class, may still share with another class."""
    for batch in batches:
        for part, data, offsets in runs(batch, "text"):
            s = Suffixes(data, offsets)
            keys = s.key.view(np.int64)
            bounds = np.searchsorted(s.text, np.arange(len(part) + 1))
            for i in range(len(part)):
                still = _ids(part, "still", i)
                if len(still):
                    own = np.arange(bounds[i], bounds[i + 1])
                    strings = np.unique(s.strings(own[np.isin(keys[own], still)])[0]).view(np.int64)
                    doc = pa.array(np.full(len(strings), part.column("doc_id")[i].as_py()), pa.int64())
                    yield pa.RecordBatch.from_arrays([doc, pa.array(strings)], ["doc_id", "string"])


def _removed(batches):
    """What goes of each document, and the digest of what stays."""
    names = ["doc_id", "text_sha256", "n_removed", "n_spans", "kept_sha256"]
    for batch in batches:
        for part, data, offsets in runs(batch, "text"):
            s = Suffixes(data, offsets)
            keys = s.key.view(np.int64)
            bounds = np.searchsorted(s.text, np.arange(len(part) + 1))
            rows = []
            for i in range(len(part)):
                own = np.arange(bounds[i], bounds[i + 1])
                begin, end = int(offsets[i]), int(offsets[i + 1])
                change = np.zeros(end - begin + 1, dtype=np.int64)
                gone = own[np.isin(keys[own], _ids(part, "gone", i))]
                np.add.at(change, s.first[gone] - begin, 1)
                np.add.at(change, s.last[gone] + LENGTH - begin, -1)
                # Strings repeated within the document, and those another class has earlier.
                _, at, n = np.unique(s.bucket[own], return_inverse=True, return_counts=True)
                still = np.isin(keys[own], _ids(part, "still", i))
                strings, starts = s.strings(own[(n[at] > 1) | still])
                order = np.lexsort((starts, strings))
                strings, starts = strings[order], starts[order]
                again = np.zeros(len(strings), dtype=bool)
                again[1:] = strings[1:] == strings[:-1]
                again |= np.isin(strings.view(np.int64), _ids(part, "strings", i))
                np.add.at(change, starts[again] - begin, 1)
                np.add.at(change, starts[again] + LENGTH - begin, -1)
                cut = np.cumsum(change[:-1]) > 0
                spans = int(cut[:1].sum() + np.count_nonzero(cut[1:] & ~cut[:-1]))
                digest = hashlib.sha256(data[begin:end][~cut].tobytes()).hexdigest()
                rows.append((int(cut.sum()), spans, digest))
            columns = [part.column("doc_id"), part.column("text_sha256")]
            columns += [pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, names)


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row.

    Null texts count as empty. Rows without an id have no place in the order: they lose
    nothing and nothing is lost to them. Rows under one id are one document in several rows, each of
    which is compared with other ids and with itself. Further columns are left out.
    """
    spark = docs.sparkSession
    named = docs.select(F.col("doc_id").cast("long"), F.hash(F.col("doc_id").cast("long")).alias("mark"), "text")
    named = named.where("doc_id IS NOT NULL AND octet_length(text) >= 100")
    named = named.where(_going_on(named)).select("doc_id", "text")
    named = _dealt(named, "texts", max(int(spark.conf.get("spark.sql.shuffle.partitions")), named.rdd.getNumPartitions() // 4))
    # Dealt by bucket, so that all classes of a bucket meet without another shuffle.
    dealt = named.mapInArrow(_classes, "bucket long, key long, smallest long, n long").repartition("bucket")
    classes = dealt.groupBy("bucket", "key").agg(F.min("smallest").alias("smallest"), F.sum("n").alias("n"))
    whole = Window.partitionBy("bucket")
    live = (
        classes.select(
            "key", "smallest", F.sum("n").over(whole).alias("total"), (F.count("*").over(whole) > 1).alias("several")
        )
        .where("total > 1")
        .drop("total")
    )
    live = written(live, "live-classes")
    fates = named.mapInArrow(_members, "doc_id long, key long").join(live, "key").groupBy("doc_id").agg(
        F.collect_set(F.when(F.col("smallest") < F.col("doc_id"), F.col("key"))).alias("gone"),
        F.collect_set(F.when((F.col("smallest") == F.col("doc_id")) & F.col("several"), F.col("key"))).alias("still"),
    )
    fates = written(fates, "fates")
    strings = written(
        named.join(fates.where("size(still) > 0").select("doc_id", "still"), "doc_id").mapInArrow(
            _open_strings, "doc_id long, string long"
        ),
        "open-strings",
    )
    earliest = strings.groupBy("string").agg(F.min("doc_id").alias("earliest"), F.count("*").alias("n")).where("n > 1")
    shared = (
        strings.join(earliest, "string")
        .where("earliest < doc_id")
        .groupBy("doc_id")
        .agg(F.collect_set("string").alias("strings"))
    )
    touched = named.join(fates, "doc_id").join(shared, "doc_id", "left")
    touched = touched.withColumn("text_sha256", F.sha2(F.col("text").cast("binary"), 256))
    result = "doc_id long, text_sha256 string, n_removed long, n_spans long, kept_sha256 string"
    cut = touched.mapInArrow(_removed, result).dropDuplicates(["doc_id", "text_sha256"])
    text = to_utf8("text")
    whole = docs.select(
        F.col("doc_id").cast("long"), F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("text_sha256")
    )
    return whole.join(cut, ["doc_id", "text_sha256"], "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("kept_sha256", "text_sha256").alias("kept_sha256"),
    )
