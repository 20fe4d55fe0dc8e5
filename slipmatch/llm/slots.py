"""Sharding by fixed virtual slots.

Records are hashed into thousands of slots, a number that never changes. Bytes are summed
per slot, and a small versioned table says which shard holds which slot. Rebalancing edits
that table: only the records of the slots it moves have to move.
"""

from __future__ import annotations

import heapq
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from slipmatch.llm.tables import to_utf8

SLOTS = 4096
MAP_SCHEMA = "virtual_slot int, shard int, bytes long, version int"


def with_slot(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """Rows ``doc_id``, ``size``, ``text_crc32`` and ``virtual_slot``, by a hash of id and text.

    The text takes part so that rows with a null or repeated doc_id spread too. A null text
    counts as an empty one: size 1, crc32 0.
    """
    text = to_utf8("text")
    return docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(slots)).cast("int").alias("virtual_slot"),
    )


def slot_bytes(slotted: DataFrame) -> dict[int, int]:
    """Bytes of each slot that has any: one row per slot, so a bounded number."""
    rows = slotted.groupBy("virtual_slot").agg(F.sum("size").alias("bytes")).collect()
    return {r["virtual_slot"]: r["bytes"] for r in rows}


def first_map(sizes: Mapping[int, int], shards: int, slots: int = SLOTS) -> dict[int, int]:
    """Each slot to the shard with the fewest bytes so far, largest slots first; ties to the lower number."""
    load = [(0, shard) for shard in range(shards)]
    out = {}
    for slot in sorted(range(slots), key=lambda s: (-sizes.get(s, 0), s)):
        held, shard = heapq.heappop(load)
        out[slot] = shard
        heapq.heappush(load, (held + sizes.get(slot, 0), shard))
    return out


def rebalanced(old: Mapping[int, int], sizes: Mapping[int, int], shards: int) -> dict[int, int]:
    """The map edited for new sizes or a larger number of shards, moving as few slots as it can.

    Slots of shards that are gone are dealt anew. Then, while it narrows the two, a slot goes
    from the fullest shard to the emptiest: the largest that fits half their difference.
    """
    out = dict(old)
    held = [0] * shards
    mine: list[set[int]] = [set() for _ in range(shards)]
    homeless = []
    for slot, shard in sorted(old.items()):
        if shard < shards:
            held[shard] += sizes.get(slot, 0)
            mine[shard].add(slot)
        else:
            homeless.append(slot)

    def give(slot: int, shard: int) -> None:
        out[slot] = shard
        held[shard] += sizes.get(slot, 0)
        mine[shard].add(slot)

    for slot in sorted(homeless, key=lambda s: (-sizes.get(s, 0), s)):
        give(slot, min(range(shards), key=lambda s: (held[s], s)))
    while True:
        full = max(range(shards), key=lambda s: (held[s], -s))
        empty = min(range(shards), key=lambda s: (held[s], s))
        room = (held[full] - held[empty]) // 2
        movable = [s for s in mine[full] if 0 < sizes.get(s, 0) <= room]
        if not movable:
            return out
        slot = max(movable, key=lambda s: (sizes.get(s, 0), -s))
        mine[full].remove(slot)
        held[full] -= sizes[slot]
        give(slot, empty)


class SlotMaps:
    """The versions of a map, each a small table below ``folder``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def put(self, version: int, shard_of: Mapping[int, int], sizes: Mapping[int, int]) -> DataFrame:
        """Stores a version; a version that stands already is an error."""
        rows = [(slot, shard, sizes.get(slot, 0), version) for slot, shard in sorted(shard_of.items())]
        path = f"{self.folder}/version={version}"
        self.spark.createDataFrame(rows, MAP_SCHEMA).drop("version").coalesce(1).write.mode("error").parquet(path)
        return self.get(version)

    def get(self, version: int) -> DataFrame:
        return self.spark.read.schema(MAP_SCHEMA).parquet(f"{self.folder}/version={version}").withColumn(
            "version", F.lit(version)
        )


def placed(slotted: DataFrame, slot_map: DataFrame) -> DataFrame:
    """``shard``, and ``slot``: each record's place in its shard, gapless from 0.

    Places are counted per virtual slot and offset by the slots before it, so no task sees a
    whole shard. The map has one row per slot and is broadcast.
    """
    rows = slotted.groupBy("virtual_slot").agg(F.count("*").alias("rows"))
    counted = {r["virtual_slot"]: r["rows"] for r in rows.collect()}
    shard_of = {r["virtual_slot"]: (r["shard"], r["version"]) for r in slot_map.collect()}
    before: dict[int, int] = {}
    starts = []
    for slot, (shard, version) in sorted(shard_of.items()):
        starts.append((slot, shard, version, before.get(shard, 0)))
        before[shard] = before.get(shard, 0) + counted.get(slot, 0)
    starts = slotted.sparkSession.createDataFrame(
        starts, "virtual_slot int, shard int, map_version int, start long"
    )
    within = F.row_number().over(Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size"))
    return (
        slotted.withColumn("place", within - 1)
        .join(F.broadcast(starts), "virtual_slot")
        .withColumn("slot", (F.col("start") + F.col("place")).cast("long"))
        .drop("start", "place")
    )


def shard(docs: DataFrame, shards: int, folder: str, version: int = 1, slots: int = SLOTS) -> DataFrame:
    """Each document's virtual slot, shard and place, by a first map stored below ``folder``.

    Shards are near equal in bytes (``law``): as near as whole slots allow. Empty tables give
    no rows; equal rows get places of their own; further columns are left out.
    """
    slotted = with_slot(docs, slots)
    sizes = slot_bytes(slotted)
    slot_map = SlotMaps(docs.sparkSession, folder).put(version, first_map(sizes, shards, slots), sizes)
    return placed(slotted, slot_map).withColumn("law", F.lit("bytes"))
