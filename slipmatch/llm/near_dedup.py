"""Near-duplicates by MinHash, with odd sketches between banding and exact comparison.

A document's set of word shingles gives ``SAMPLES`` minima. Bands of them find candidates; all
of them, folded into a bitmap in which each flips one bit (an odd sketch), tell by the
population count of an XOR how similar two candidates are, so that only pairs near or above
the limit are compared on their full sets. Documents with equal sets stand for one another: a node
is a set, by its digest, named by their smallest id. Sets of one id are linked as they are.

Within a band's bucket no pairs are spelt out. First every member is compared with one hub,
the member that shares most buckets. Links found so make components, and only members that
are still apart from their hub's component are then compared with the others in the bucket,
other components' members only, and only in the first bucket that two of them share. Nothing
is capped: a link between two components is lost only if no band of it agrees, or its sketches
differ by more than ``DEVIATIONS``, which is rare.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from slipmatch.llm.components import components
from slipmatch.llm.tables import Asides, batch_rows, runs
from slipmatch.llm.words import U, mix, powers, shingles, words
from slipmatch.sources.shared import written

# Rows of an Arrow batch.
BATCH_ROWS = 1000
WORDS = 5
BANDS, ROWS = 25, 5
SAMPLES = 512
SKETCH_WORDS = 16
SKETCH_BITS = 64 * SKETCH_WORDS
# Pairs this many standard deviations below the limit are still compared in full.
DEVIATIONS = 4

FACTORS = mix(np.arange(1, SAMPLES + 1, dtype=np.uint64)) | U(1)
MASKS = mix(np.arange(1001, SAMPLES + 1001, dtype=np.uint64))
BAND_COLUMNS = [f"b{i}" for i in range(BANDS)]
SKETCH = [f"o{i}" for i in range(SKETCH_WORDS)]
# Ordered by id, so a component's smallest node has its smallest id.
NODE = "struct<id: long, d0: long, d1: long>"
SIGNATURE = ["d0", "d1", *BAND_COLUMNS, *SKETCH]


def sketch_limit(percent: float) -> int:
    """The most bits that sketches of sets of the given similarity differ in, deviations included."""
    s = percent / 100
    differing = 2 * SAMPLES * (1 - s) + DEVIATIONS * 2 * math.sqrt(SAMPLES * s * (1 - s))
    odd = SKETCH_BITS / 2 * (1 - (1 - 2 / SKETCH_BITS) ** differing)
    return math.ceil(odd + math.sqrt(odd))


def _digest(members: np.ndarray) -> tuple[np.uint64, np.uint64]:
    # Sums over a set don't depend on its order.
    return mix(members).sum(dtype=np.uint64), mix(members ^ U(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, and for texts with words a digest of the set, bands and sketch."""
    schema = "doc_id long, n_shingles long, " + ", ".join(f"{c} long" for c in SIGNATURE)

    def sign(batches):
        for batch in batches:
            for part, data, offsets in runs(batch, "text"):
                hashes, starts = shingles(words(data, offsets), WORDS)
                yield _signed(part.column("doc_id"), hashes, starts)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(sign, schema)


def _signed(doc_id: pa.Array, hashes: np.ndarray, starts: np.ndarray) -> pa.RecordBatch:
    n = len(starts) - 1
    sizes, digests = np.zeros(n, dtype=np.int64), np.zeros((n, 2), dtype=np.uint64)
    for i in range(n):
        own = np.unique(hashes[starts[i] : starts[i + 1]])
        sizes[i] = len(own)
        digests[i] = _digest(own)
    full = np.flatnonzero(np.diff(starts) > 0)
    minima = np.zeros((SAMPLES, n), dtype=np.uint64)
    if len(full):
        for k in range(SAMPLES):
            minima[k, full] = np.minimum.reduceat((hashes ^ MASKS[k]) * FACTORS[k], starts[full])
    columns: list = [doc_id, pa.array(sizes)]
    empty = sizes == 0

    def add(values: np.ndarray) -> None:
        columns.append(pa.array(values.view(np.int64), mask=empty))

    add(np.ascontiguousarray(digests[:, 0]))
    add(np.ascontiguousarray(digests[:, 1]))
    for band in range(BANDS):
        own = minima[band * ROWS : (band + 1) * ROWS]
        add(mix((own * powers(0xD1342543DE82EF95, ROWS)[:, None]).sum(axis=0, dtype=np.uint64) + U(band)))
    odd = np.zeros((SKETCH_WORDS, n), dtype=np.uint64)
    rows = np.arange(n)
    for k in range(SAMPLES):
        bit = mix(minima[k] + MASKS[k]) % U(SKETCH_BITS)
        odd[(bit >> U(6)).astype(np.int64), rows] ^= U(1) << (bit & U(63))
    for word in odd:
        add(word)
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", *SIGNATURE])


def _apart(a: str, b: str) -> Column:
    """Bits in which two sketches differ; ``a`` and ``b`` are prefixes of their columns."""
    total = F.lit(0)
    for word in SKETCH:
        total = total + F.bit_count(F.col(a + word).bitwiseXOR(F.col(b + word)))
    return total


def _first_shared(a: str, b: str) -> Column:
    """The first band in which two nodes are in one bucket; ``a`` and ``b`` are prefixes."""
    shared = [F.when(F.col(a + c) == F.col(b + c), F.lit(i)) for i, c in enumerate(BAND_COLUMNS)]
    return F.coalesce(*shared)


def _linked(pairs: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs ``a``, ``b`` whose full sets are similar enough."""
    ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    asides = Asides(docs.sparkSession)
    wanted = asides.write(ends.select("node.*"), "pair-ends")

    def sets(batches):
        for batch in batches:
            for part, data, offsets in runs(batch, "text"):
                hashes, starts = shingles(words(data, offsets), WORDS)
                own = [np.unique(hashes[a:b]) for a, b in zip(starts[:-1], starts[1:], strict=True)]
                digests = np.array([_digest(x) for x in own], dtype=np.uint64).reshape(-1, 2).view(np.int64)
                columns = [pa.array(np.ascontiguousarray(digests[:, k])) for k in (0, 1)]
                columns.append(pa.array([x.tobytes() for x in own], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, ["d0", "d1", "members"])

    ids = wanted.select(F.col("id").alias("doc_id")).distinct()
    members = docs.select(F.col("doc_id").cast("long"), "text").join(ids, "doc_id", "left_semi").mapInArrow(
        sets, "d0 long, d1 long, members binary"
    )
    # Other texts under the same id have other digests.
    members = members.dropDuplicates(["d0", "d1"]).join(wanted.select("d0", "d1"), ["d0", "d1"], "left_semi")
    members = asides.write(members, "shingle-sets")

    def compare(batches):
        for batch in batches:
            lists = (batch.column("of_a"), batch.column("of_b"))
            hit = np.zeros(len(batch), dtype=bool)
            for i in range(len(batch)):
                a, b = (np.frombuffer(column[i].as_buffer(), dtype=np.uint64) for column in lists)
                both = np.concatenate([a, b])
                both.sort(kind="stable")
                shared = int(np.count_nonzero(both[1:] == both[:-1]))
                hit[i] = 100 * shared >= percent * (len(a) + len(b) - shared)
            yield batch.select(["a", "b"]).filter(pa.array(hit))

    for end in ("a", "b"):
        of_end = members.select(F.struct("d0", "d1").alias(f"set_{end}"), F.col("members").alias(f"of_{end}"))
        pairs = pairs.join(of_end, F.struct(f"{end}.d0", f"{end}.d1") == F.col(f"set_{end}"))
    links = written(pairs.select("a", "b", "of_a", "of_b").mapInArrow(compare, f"a {NODE}, b {NODE}"), "links")
    asides.drop("pair-ends", "shingle-sets")
    return links


def _of_one_id(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges ``a``, ``b`` between the sets of ids that have several."""
    extremes = [f(c).alias(f"{f.__name__}_{c}") for c in ("d0", "d1") for f in (F.min, F.max)]
    several = rows.groupBy("doc_id").agg(*extremes).where("min_d0 < max_d0 OR min_d1 < max_d1").select("doc_id")
    own = rows.select("doc_id", "d0", "d1").join(several, "doc_id").join(nodes.select("node", "d0", "d1"), ["d0", "d1"])
    own = written(own.select("doc_id", "node").distinct(), "sets-of-one-id")
    first = own.groupBy("doc_id").agg(F.min("node").alias("a"))
    return own.join(first, "doc_id").where("node != a").select("a", F.col("node").alias("b")).distinct()


def groups(docs: DataFrame, percent: int) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row.

    ``percent`` is the least intersection per union. Null texts and texts without words have
    no shingles and form components of their own. Rows under one id are all that document;
    a row without an id stands for nothing, so its component is its links' smallest id, or
    null. Further columns are left out.
    """
    with batch_rows(docs.sparkSession, BATCH_ROWS):
        return _groups(docs, percent)


def _groups(docs: DataFrame, percent: int) -> DataFrame:
    asides = Asides(docs.sparkSession)
    signed = written(signatures(docs), "signatures")
    limit = sketch_limit(percent)
    firsts = [F.first(c).alias(c) for c in (*BAND_COLUMNS, *SKETCH)]
    named = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    nodes = written(
        named.groupBy("d0", "d1")
        .agg(F.min("doc_id").alias("id"), F.first("n_shingles").alias("n_shingles"), *firsts)
        .select(F.struct("id", "d0", "d1").alias("node"), "d0", "d1", "n_shingles", *BAND_COLUMNS, *SKETCH),
        "nodes",
    )
    bands = F.posexplode(F.array(*BAND_COLUMNS)).alias("band", "bucket")
    # Nodes alone go through the buckets; sketches meet the distinct pairs, once for each end.
    spread = nodes.select("node", bands)
    crowded = spread.groupBy("band", "bucket").agg(F.count("*").alias("n")).where("n > 1")
    members = asides.write(spread.join(crowded, ["band", "bucket"]), "bucket-members")
    support = members.groupBy("node").agg(F.sum("n").alias("support"))
    hub = F.max(F.struct("support", "node")).alias("hub")
    hubs = asides.write(members.join(support, "node").groupBy("band", "bucket").agg(hub), "bucket-hubs").select(
        "band", "bucket", F.col("hub.node").alias("h_node")
    )
    to_hub = (
        members.join(hubs, ["band", "bucket"])
        .where(F.col("node") != F.col("h_node"))
        .select(F.least("node", "h_node").alias("a"), F.greatest("node", "h_node").alias("b"))
        .distinct()
    )
    for end in ("a", "b"):
        to_hub = to_hub.join(nodes.select(F.col("node").alias(end), *[F.col(c).alias(end + c) for c in SKETCH]), end)
    to_hub = asides.write(to_hub.where(_apart("a", "b") <= limit).select("a", "b"), "hub-pairs")
    links = asides.write(_linked(to_hub, docs, percent).unionByName(_of_one_id(named, nodes)), "hub-links")
    first = components(links)
    label = first.withColumnRenamed("component", "label")
    # Members that no link joins to their hub's component, against all others of the bucket.
    placed = members.join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
    hub_label = hubs.select("band", "bucket", "h_node").join(
        label.withColumnRenamed("node", "h_node").withColumnRenamed("label", "h_label"), "h_node", "left"
    )
    hub_label = hub_label.select("band", "bucket", "h_node", F.coalesce("h_label", "h_node").alias("h_label"))
    placed = placed.join(hub_label, ["band", "bucket"])
    mixed = placed.groupBy("band", "bucket").agg(F.bool_or(F.col("label") != F.col("h_label")).alias("is_mixed"))
    # In a bucket of two components one end of any pair is apart from the hub's, so a pair meets
    # in the first bucket it shares, or has met its hub there.
    places = nodes.select("node", "n_shingles", *SKETCH, *BAND_COLUMNS)
    placed = asides.write(placed.join(mixed.where("is_mixed"), ["band", "bucket"]).join(places, "node"), "mixed-buckets")
    asides.drop("bucket-members", "bucket-hubs")
    minor = placed.where(F.col("label") != F.col("h_label")).select(
        "band", "bucket", *[F.col(c).alias(f"m_{c}") for c in ("node", "label", "n_shingles", *SKETCH, *BAND_COLUMNS)]
    )
    once = (F.col("label") == F.col("h_label")) | (F.col("node") > F.col("m_node"))
    rest = (
        minor.join(placed, ["band", "bucket"])
        .where((F.col("label") != F.col("m_label")) & once & (F.col("node") != F.col("h_node")))
        .where((_apart("", "m_") <= limit) & (_first_shared("", "m_") == F.col("band")))
        .where(100 * F.least("n_shingles", "m_n_shingles") >= percent * F.greatest("n_shingles", "m_n_shingles"))
        .select(F.least("node", "m_node").alias("a"), F.greatest("node", "m_node").alias("b"))
    )
    rest = asides.write(rest.join(to_hub, ["a", "b"], "left_anti"), "rest-pairs")
    asides.drop("hub-pairs", "mixed-buckets")
    if not rest.isEmpty():
        first = components(links.unionByName(_linked(rest, docs, percent)))
    asides.drop("hub-links", "rest-pairs")
    found = nodes.join(first, "node", "left").select("d0", "d1", F.coalesce("component", "node")["id"].alias("component_id"))
    whole = signed.where("n_shingles > 0").select("doc_id", "n_shingles", "d0", "d1").join(found, ["d0", "d1"], "left")
    alone = signed.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return (
        whole.select("doc_id", "n_shingles", "component_id")
        .unionByName(alone)
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
    )


def deduplicated(docs: DataFrame, percent: int) -> DataFrame:
    """The documents that are the smallest id of their component, in all their rows; rows
    without an id can't be told apart and all stay."""
    fate = groups(docs, percent)
    kept = fate.where("kept").select("doc_id").distinct().alias("kept")
    named = docs.alias("all").join(kept, F.col("all.doc_id").cast("long") == F.col("kept.doc_id"), "left_semi")
    return named.unionByName(docs.where(F.col("doc_id").isNull()))
