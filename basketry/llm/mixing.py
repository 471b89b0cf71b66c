"""Mixing sources to target weights by proportionate-fair scheduling.

Each source's documents, in hashed order, are cut into blocks of equal bytes.
With weight ``q / period`` block ``k`` of a source may start at slot
``floor(k * period / q)`` and must be over by ``ceil((k + 1) * period / q)``;
earliest deadline first over the released blocks meets all of these, so after
any number of slots a source is less than one block away from its share.  The
weights are whole parts of a period, so the order repeats: one period is
scheduled (a parameter bounds it) and the slot of every other block is
arithmetic.  Nothing runs over the corpus in sequence.

No document is left out.  The mix ends when the source that is shortest of its
share has been used up once, and sources that end earlier begin another pass; or,
with ``once``, no document is repeated: a source that ends leaves its slots empty.
"""

from __future__ import annotations

import heapq
from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK_BYTES = 1 << 16
PERIOD = 10_000  # slots; weights are whole multiples of 1 / PERIOD
MOST_SOURCES = 5_000  # more raise an error; the schedule is bounded by PERIOD
GROUP_ROWS, GROUP_BYTES = 100_000, 64 << 20  # of one task's window, about
EXPONENT = 0.7  # default weights: shares of bytes to this power


def quanta(weights: Mapping[str, float], period: int = PERIOD) -> dict[str, int]:
    """Weights as whole parts of ``period``, at least one each (largest remainder)."""
    names = sorted(weights)
    if not names:
        return {}
    if len(names) > min(MOST_SOURCES, period) or min(weights.values()) <= 0:
        raise ValueError(f"1 to {min(MOST_SOURCES, period)} sources with positive weights, please")
    total, spare = sum(weights.values()), period - len(names)
    exact = {n: weights[n] / total * spare for n in names}
    parts = {n: 1 + int(exact[n]) for n in names}
    left = period - sum(parts.values())
    for n in sorted(names, key=lambda n: (int(exact[n]) - exact[n], n))[:left]:
        parts[n] += 1
    return parts


def schedule(parts: Mapping[str, int]) -> list[str]:
    """The source of every slot of one period: earliest deadline first among
    released blocks, ties by name."""
    period = sum(parts.values())
    waiting: list[list[tuple[str, int]]] = [[] for _ in range(period + 1)]
    for name in sorted(parts):
        waiting[0].append((name, 0))
    ready: list[tuple[int, str, int]] = []
    slots = []
    for now in range(period):
        for name, k in waiting[now]:
            heapq.heappush(ready, (-(-(k + 1) * period // parts[name]), name, k))
        _, name, k = heapq.heappop(ready)
        slots.append(name)
        if k + 1 < parts[name]:
            waiting[max(now + 1, (k + 1) * period // parts[name])].append((name, k + 1))
    return slots


def _source_name() -> F.Column:
    return F.when(F.col("source").isNull(), F.lit("null")).otherwise(F.concat(F.lit("="), F.col("source").cast("string")))


def mixed(
    docs: DataFrame,
    weights: Mapping[str | None, float] | None = None,
    block_bytes: int = BLOCK_BYTES,
    period: int = PERIOD,
    once: bool = False,
) -> DataFrame:
    """The rows of ``docs`` with ``mix_pass`` (from 0), ``mix_block`` (the block
    of its source), ``mix_slot`` (the block's place in the mix) and ``mix_start``
    (the row's first byte in its block); ordering by the last two is the mix.

    ``weights``: source to weight of text bytes (UTF-8, one more per document);
    a source without one raises.  None: every source's share to the power 0.7.
    A null source is a source of its own; null and empty texts count one byte.
    A block is where a document begins, so a document may reach beyond it: a source
    is less than one block and its longest document off its share.
    Equal rows keep their number.  All columns are kept; columns named ``mix_*``
    in ``docs`` are replaced.  Rows appear once per pass, at least once; with
    ``once`` exactly once.
    """
    spark = docs.sparkSession
    columns = [c for c in docs.columns if not c.startswith("mix_")]
    name = _source_name()
    size = (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long")
    order = F.xxhash64(F.col("doc_id").cast("long"), "text")
    stats = docs.select(name.alias("name"), size.alias("size")).groupBy("name").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    held = {r.name: (r.bytes, r.n) for r in stats.limit(MOST_SOURCES + 1).collect()}
    if weights is None:
        total = sum(b for b, _ in held.values())
        wanted = {n: (b / total) ** EXPONENT for n, (b, _) in held.items()}
    else:
        given = {"null" if s is None else f"={s}": w for s, w in weights.items()}
        wanted = {n: given[n] for n in held}
    parts = quanta(wanted, period)
    most = max((-(-held[n][0] * period // q) for n, q in parts.items()), default=0)
    rows = []
    for n, q in parts.items():
        size_, count = held[n]
        groups = 1 + max(count // GROUP_ROWS, size_ // GROUP_BYTES)
        rows.append((n, size_, count, q, size_ if once else q * most // period + 1, groups))
    sources = spark.createDataFrame(rows, "_name string, _bytes long, _n long, _parts long, _limit long, _groups long")
    seen: dict[str, int] = {}
    places = []
    for slot, n in enumerate(schedule(parts)):
        places.append((n, seen.get(n, 0), slot))
        seen[n] = seen.get(n, 0) + 1
    table = spark.createDataFrame(places, "_name string, _turn long, _at long")

    # first byte of each row within its source: prefix sums over salted groups in hashed order
    group = F.floor((F.shiftrightunsigned("_order", 11) / F.lit(float(1 << 53))) * F.col("_groups"))
    base = (
        docs.select(
            F.struct(*columns).alias("_row"), name.alias("_name"), size.alias("_size"), order.alias("_order"),
            F.col("doc_id").cast("long").alias("_id"),
        )
        .join(F.broadcast(sources), "_name").withColumn("_group", group)
    )
    sums = base.groupBy("_name", "_group").agg(F.sum("_size").alias("_sum"))
    earlier = F.sum("_sum").over(Window.partitionBy("_name").orderBy("_group").rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.select("_name", "_group", F.coalesce(earlier, F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_name", "_group").orderBy("_order", "_id", "_size").rowsBetween(Window.unboundedPreceding, -1)
    placed = base.withColumn("_inside", F.coalesce(F.sum("_size").over(inside), F.lit(0))).join(sums, ["_name", "_group"])
    start = F.col("_before") + F.col("_inside")
    last = F.floor((F.col("_limit") - start - 1) / F.col("_bytes"))
    passes = placed.withColumn("_start", start).withColumn("mix_pass", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    at = F.col("mix_pass") * F.col("_bytes") + F.col("_start")
    blocks = passes.withColumn("mix_block", F.floor(at / block_bytes)).withColumn("mix_start", F.pmod(at, F.lit(block_bytes)))
    turn = blocks.withColumn("_turn", F.pmod("mix_block", "_parts")).join(F.broadcast(table), ["_name", "_turn"])
    slot = F.floor(F.col("mix_block") / F.col("_parts")) * period + F.col("_at")
    return turn.select("_row.*", F.col("mix_pass").cast("int").alias("mix_pass"), "mix_block", slot.alias("mix_slot"), "mix_start")
