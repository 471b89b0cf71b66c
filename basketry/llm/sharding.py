"""Sharding over fixed virtual slots.

A record's hash decides its slot for ever; a small versioned table maps slots
to shards.  Rebalancing edits that table only: it moves as few slots as make
the shards' bytes near equal, and a record moves only with its slot.  The slots
are a parameter (4096), so their byte counts and the map have that many rows,
whatever the input.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketry.llm.shared import new_folder, release

SLOTS = 4096
MAP = "version int, virtual_slot int, shard int, bytes long, documents long"


def with_slot(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``(doc_id, size, text_crc32, virtual_slot)``; size: UTF-8 bytes of the
    text (null: none) plus 1.  The hash covers id and text, so rows without an
    id or with a repeated one spread too; equal rows share a slot."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    key = F.xxhash64(F.col("doc_id").cast("long"), text)
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.pmod(key, F.lit(slots)).cast("int").alias("virtual_slot"),
        key.alias("_key"),
    )


def slot_loads(records: DataFrame) -> dict[int, tuple[int, int]]:
    """Bytes and records of every slot that has any: at most ``slots`` entries."""
    rows = records.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("documents"))
    return {r.virtual_slot: (r.bytes, r.documents) for r in rows.collect()}


def initial_map(slots: int, shards: int) -> list[int]:
    """Equal ranges of slots."""
    return [slot * shards // slots for slot in range(slots)]


def add_shard(slot_map: list[int], loads: dict[int, int]) -> list[int]:
    """A map with one more shard: it takes slots from the fullest shards until it
    has its share; no slot moves between old shards."""
    shards = max(slot_map) + 1
    target = sum(loads.values()) / (shards + 1)
    out, moved = list(slot_map), 0
    by = [sorted((s for s, k in enumerate(slot_map) if k == shard), key=lambda s: loads.get(s, 0)) for shard in range(shards)]
    full = [(-sum(loads.get(s, 0) for s in mine), shard) for shard, mine in enumerate(by)]
    heapq.heapify(full)
    while full and moved < target:
        total, shard = heapq.heappop(full)
        if -total <= target or not by[shard]:
            break
        slot = by[shard].pop()
        out[slot], moved = shards, moved + loads.get(slot, 0)
        heapq.heappush(full, (total + loads.get(slot, 0), shard))
    return out


def rebalanced(slot_map: list[int], shards: int, loads: dict[int, int]) -> list[int]:
    """The map with the slots moved that shards above the mean can spare, largest
    first into the emptiest shard, then single moves and swaps between the
    fullest and the emptiest shard as long as they narrow the gap."""
    out = list(slot_map)
    held: list[set[int]] = [set() for _ in range(shards)]
    for slot, shard in enumerate(out):
        if loads.get(slot, 0):
            held[shard].add(slot)
    size = [sum(loads[s] for s in mine) for mine in held]
    mean = sum(size) / shards
    loose = []
    for shard in range(shards):
        for slot in sorted(held[shard], key=lambda s: (-loads[s], s)):
            if size[shard] <= mean:
                break
            if size[shard] - loads[slot] >= mean or size[shard] - mean > loads[slot] / 2:
                held[shard].discard(slot)
                size[shard] -= loads[slot]
                loose.append(slot)
    for slot in sorted(loose, key=lambda s: (-loads[s], s)):
        shard = min(range(shards), key=lambda k: (size[k], k))
        held[shard].add(slot)
        size[shard] += loads[slot]
    for _ in range(16 * shards):
        high, low = max(range(shards), key=size.__getitem__), min(range(shards), key=size.__getitem__)
        gap = size[high] - size[low]
        if gap * 100_000 <= mean:
            break
        # the exchange that comes nearest to half the gap; None: nothing goes back
        small = sorted([(loads[s], s) for s in held[low]]) + [(0, -1)]
        best = min(
            ((abs(gap - 2 * (loads[a] - b)), a, s) for a in held[high] for b, s in small if 0 < loads[a] - b < gap),
            default=None,
        ) if len(held[high]) * len(small) <= 2_000_000 else None
        if best is None or best[0] >= gap:
            break
        _, a, b = best
        held[high].discard(a)
        held[low].add(a)
        size[high], size[low] = size[high] - loads[a], size[low] + loads[a]
        if b >= 0:
            held[low].discard(b)
            held[high].add(b)
            size[high], size[low] = size[high] + loads[b], size[low] - loads[b]
    for shard, mine in enumerate(held):
        for slot in mine:
            out[slot] = shard
    return out


def save_map(spark: SparkSession, folder: str, version: int, slot_map: list[int], loads: dict[int, tuple[int, int]]) -> None:
    """Store one version; earlier ones stay, and an existing one is not replaced."""
    rows = [(version, slot, shard, *loads.get(slot, (0, 0))) for slot, shard in enumerate(slot_map)]
    spark.createDataFrame(rows, MAP).coalesce(1).write.parquet(f"{folder}/version={version:06d}")


def load_map(spark: SparkSession, folder: str, version: int) -> DataFrame:
    return spark.read.schema(MAP).parquet(f"{folder}/version={version:06d}")


def sharded(docs: DataFrame, shards: int = 8, slots: int = SLOTS, folder: str | None = None) -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard, virtual_slot,
    map_version)``: shards of near equal bytes.

    Version 0 of the map gives every shard a range of slots, version 1 is
    rebalanced by the bytes of ``docs``.  ``slot`` is the row's place in its
    shard, from 0 without gaps; ``grown_shard`` is null under this law.  A null
    text counts one byte.  An empty table has an empty result.
    """
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "slots")
    records = with_slot(docs, slots)
    loads = slot_loads(records)
    start = initial_map(slots, shards)
    final = rebalanced(start, shards, {s: b for s, (b, _) in loads.items()})
    save_map(spark, folder, 0, start, loads)
    save_map(spark, folder, 1, final, loads)
    release(spark)
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    current = load_map(spark, folder, 1).withColumn("first", F.coalesce(F.sum("documents").over(before), F.lit(0)))
    place = F.row_number().over(Window.partitionBy("virtual_slot").orderBy("_key", "doc_id", "text_crc32"))
    rows = records.withColumn("place", place).join(F.broadcast(current.drop("bytes", "documents")), "virtual_slot")
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("first") + F.col("place") - 1).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", F.col("version").alias("map_version"),
    )
