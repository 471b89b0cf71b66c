"""Best-fit decreasing packing of pieces into sequences of fixed length.

Best-fit decreasing treats equal lengths alike, so it runs over the histogram
of lengths: at most ``capacity`` numbers, whatever the input.  A segment tree
over the remaining capacities finds the tightest open sequence in logarithmic
time, and a whole range of equally full sequences is filled in one step.  The
result is a list of steps ("pieces 100 to 899 of length 700 go two each into the
sequences from 4,000 on, at offset 2,600").  A step leaves less room than the
length it placed, and less than half of the room there was, so a range is
touched at most ``log2(capacity)`` times and the list has fewer than
``2 * capacity * (log2(capacity) + 1)`` entries: a proven bound, so it is
broadcast.  Pieces find their step by their rank among pieces of their length;
ranks are counted in salted groups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.shared import save
from basketry.llm.tokens import by_bytes, encoded_rows

RANK_GROUP = 100_000  # rows of one salt, about


class OpenSequences:
    """Ranges of equally full sequences, by remaining capacity; a segment tree
    knows under which nodes there are any."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.filled = [False] * (2 * self.leaves)
        self.ranges: list[list[tuple[int, int]]] = [[] for _ in range(self.leaves)]

    def _mark(self, room: int) -> None:
        node = room + self.leaves
        self.filled[node] = bool(self.ranges[room])
        while node > 1:
            node //= 2
            self.filled[node] = self.filled[2 * node] or self.filled[2 * node + 1]

    def add(self, room: int, first: int, count: int) -> None:
        if room and count:
            self.ranges[room].append((first, count))
            self._mark(room)

    def tightest(self, length: int) -> int | None:
        """The smallest remaining capacity of at least ``length`` that any open sequence has."""
        node = length + self.leaves
        while not self.filled[node]:
            while node % 2:  # a right child: up until there is a right sibling
                node //= 2
                if node == 0:
                    return None
            node += 1
        while node < self.leaves:
            node = 2 * node if self.filled[2 * node] else 2 * node + 1
        return node - self.leaves

    def take(self, room: int) -> tuple[int, int]:
        found = self.ranges[room].pop()
        self._mark(room)
        return found


def packing_steps(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """``(length, first rank, first sequence, pieces per sequence, offset)``: the
    pieces of that length from that rank on, up to the next step."""
    open_, steps, sequences = OpenSequences(capacity), [], 0
    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            room = open_.tightest(length)
            if room is None:
                room, count = capacity, -(-left // (capacity // length))
                first, sequences = sequences, sequences + count
            else:
                first, count = open_.take(room)
            each = room // length
            full = min(count, left // each)
            if full:
                steps.append((length, rank, first, each, capacity - room))
                open_.add(room - each * length, first, full)
                rank, left = rank + full * each, left - full * each
            rest = left if full < count else 0
            if rest:
                steps.append((length, rank, first + full, rest, capacity - room))
                open_.add(room - rest * length, first + full, 1)
                rank, left = rank + rest, 0
            if full + bool(rest) < count:
                open_.add(room, first + full + bool(rest), count - full - bool(rest))
    return steps


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, place: str | None = None) -> DataFrame:
    """``(doc_id, piece, start, length, ids, place)``: the token ids of every document
    and the end id, cut into pieces of at most ``capacity`` ids (little-endian
    unsigned 32-bit numbers).  A null text is the end id alone.  ``place`` is
    the named column of ``docs``, a number, or 0."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pieces(batch: pa.RecordBatch) -> Iterator[tuple]:
            for row, ids in encoded_rows(batch.column(1), tokenizer, end_id):
                for piece, low in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[low : low + 4 * capacity]
                    yield row, piece, low // 4, len(part) // 4, part

        for batch in batches:
            for part in by_bytes(pieces(batch)):
                row, piece, start, length, ids = zip(*part)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()), pa.array(ids, pa.binary()), batch.column(2).take(pa.array(row)),
                    ],
                    ["doc_id", "piece", "start", "length", "ids", "place"],
                )

    at = (F.col(place) if place else F.lit(0)).cast("long")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", at.alias("place")).mapInArrow(
        cut, "doc_id long, piece int, start long, length long, ids binary, place long"
    )


def pack(pieces: DataFrame, key: list[str], capacity: int, groups: Column | None = None) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``.

    ``pieces`` has a ``length`` from 1 to ``capacity`` (anything else raises) and
    is read twice, so it should be a table.  Pieces of one length are ordered by
    ``key`` within groups of a bounded number of rows; rows that are equal in it may
    change places.  The groups are salts, or the given numbers, which then come in
    their order.  Offsets of a sequence have no gaps.  All other columns are kept.
    """
    odd = F.max(F.when(F.col("length").isNull() | ~F.col("length").between(1, capacity), 1).otherwise(0))
    by_length = pieces.groupBy("length").agg(F.count("*").alias("n"), odd.alias("odd")).collect()
    if any(r.odd for r in by_length):
        raise ValueError(f"pieces must have a length from 1 to {capacity}")
    histogram = {r.length: r.n for r in by_length}
    steps = np.array(packing_steps(histogram, capacity), np.int64).reshape(-1, 5)
    steps = steps[np.lexsort((steps[:, 1], steps[:, 0]))]
    shared = pieces.sparkSession.sparkContext.broadcast(steps)

    salts = 1 + sum(histogram.values()) // RANK_GROUP
    salt = F.pmod(F.xxhash64(*key), F.lit(salts)) if groups is None else groups
    salted = pieces.withColumn("_salt", salt)
    sizes = salted.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1))
    bases = sizes.select("length", "_salt", F.coalesce(before, F.lit(0)).alias("_base"))
    place = F.row_number().over(Window.partitionBy("length", "_salt").orderBy(*key))
    ranked = salted.withColumn("_place", place).join(bases, ["length", "_salt"])
    ranked = ranked.withColumn("_rank", F.col("_base") + F.col("_place") - 1)
    kept = ranked.select("length", "_rank", *[c for c in pieces.columns if c != "length"])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        keys = table[:, 0] * (1 << 48) + table[:, 1]
        for batch in batches:
            length, rank = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            at = np.searchsorted(keys, length * (1 << 48) + rank, "right") - 1
            inside = rank - table[at, 1]
            sequence = table[at, 2] + inside // table[at, 3]
            offset = table[at, 4] + inside % table[at, 3] * length
            rest = [batch.column(c) for c in range(2, batch.num_columns)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *rest, pa.array(sequence), pa.array(offset)], names
            )

    names = ["length", *kept.columns[2:], "sequence_id", "offset"]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema if f.name != "_rank")
    return kept.mapInArrow(assign, f"{kinds}, sequence_id long, offset long")


def packed_documents(
    docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = 4096, place: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """The stored pieces with their token ids, and their places in sequences:
    ``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)``.

    Null and empty texts are one piece with the end id.  Rows without doc_id and
    rows that repeat one are packed like all others.  ``place``: a column of
    ``docs`` that orders pieces of one length, so that documents that come early are
    in early sequences; a file's number above its lowest 33 bits and a row's below.
    """
    pieces = save(token_pieces(docs, tokenizer, end_id, capacity, place), "pieces")
    light = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "place")
    key = ["place", "doc_id", "piece", "start", "ids_crc32"]
    places = pack(light, key, capacity, F.shiftright("place", 33) if place else None)
    order = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return pieces, places.select(order)
