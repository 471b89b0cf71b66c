"""Join of documents whose shingle sets have a Jaccard similarity of 0.8 or more.

``1 - similarity`` is a metric, and the join works on it:

1. Documents with the same set are one point (a group by the set's digest).
2. A point can only have a partner if at least that share of its shingles also
   lies in another document.  Shingles are dealt out by hash, as packed arrays with
   places in their flush, and only the number of repeated ones per place comes
   back; this removes all points that merely share a passage.
3. Regions: any two linked points share one of the rarest shingles of each
   (n - ceil(0.8 n) + 1 of them), so the points around a rare shingle form a
   region.  Every region elects pivots; distances to pivots are exact.
4. Voronoi cells and windows: a point within the radius of a pivot belongs to
   the pivot's part.  What is left to compare in a region are points of different
   parts, and by the triangle inequality only those whose distances to the
   region's first pivot differ by at most the radius, and whose shingles differ in
   few enough of 512 parities.  The region joins again,
   first with pivots of its largest parts, then with ever more of its smallest
   ones, until one part is left in it or every pair was compared or excluded.

The result is exact: a pair is skipped only if it is excluded by a bound or
already in one component.  The order of step 3 uses counts in a table of fixed
size (``ORDER_SLOTS``); it decides how much is compared, never what is found.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.components import connected_components
from basketry.llm.shared import delete, possible, save
from basketry.llm.words import texts_shingles
from basketry.llm.worker import claim, give_back, giving_back

FLUSH = 1_500_000  # shingles held by a task before it sends them on
BUCKET = 3_000_000  # shingles of one reduce group, about
ORDER_BITS = 20  # the table of counts has 2**20 entries: 4 MB, whatever the input
SMALL = 256  # points of a region that are compared without more pivots
CROWD_TURNS = 1  # rounds in which a region's largest parts give the pivots
CROWD_PIVOTS = 8  # pivots of a region in these rounds
PARITIES = 8  # 64-bit numbers with parities of a point's shingles
NAME = 8  # bytes of a set's digest that name it in a flush
LOCAL = 0xFFFF  # marks a shingle that several points of one flush have
LOCAL_HERE = 0xFFFFFFFF  # the same in a bucket


def digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def set_profiles(docs: DataFrame, width: int) -> DataFrame:
    """``(doc_id, n_shingles, digest)`` of every row."""

    @giving_back
    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("jaccard_join")
        for batch in batches:
            sizes, digests = np.zeros(batch.num_rows, np.int64), [b""] * batch.num_rows
            for i, s in texts_shingles(batch.column(1), width):
                sizes[i], digests[i] = len(s), digest(s) if len(s) else b""
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes), pa.array(digests, pa.binary())], ["doc_id", "n_shingles", "digest"]
            )

    return docs.select("doc_id", "text").mapInArrow(
        profile, "doc_id long, n_shingles long, digest binary"
    )


def _pack(values: np.ndarray) -> bytes:
    """Ascending 32-bit numbers as differences, byte plane by byte plane: the
    upper planes are nearly all zeros and vanish when the shuffle compresses."""
    steps = np.diff(values, prepend=np.uint32(0)).astype("<u4")
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 4).T).tobytes()


def _unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype=np.uint32)


DEALT = "bucket int, flush long, names binary, rest binary, places binary, counts binary"


def repeated_shingles(docs: DataFrame, width: int, total: int) -> DataFrame:
    """``(name, n)``: how many shingles of each set also lie in another document; the
    name is the beginning of the set's digest.
    A copy that another flush has counts as another document, and a few unique
    shingles may count as repeated (36 bits and more are compared), never the other
    way round.  Sets without any repeated shingle are left out.

    A set's name travels once a flush; in the buckets it is a place of two bytes.  A
    flush is named by its partition and its place there, so a task that runs again
    gives the rows it gave before (``docs`` come from files)."""
    bits = min(16, max(4, (max(total, 1) // BUCKET).bit_length()))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("jaccard_join")
        seen: dict[bytes, int] = {}
        parts: list[np.ndarray] = []
        held = 0
        name = TaskContext.get().partitionId() << 32

        def flush() -> pa.RecordBatch:
            keys = np.concatenate(parts)
            keys.sort()
            hashes, owners = keys >> np.uint64(16), (keys & np.uint64(0xFFFF)).astype(np.uint16)
            first = np.flatnonzero(np.diff(hashes, prepend=hashes[0] ^ np.uint64(1)))
            counts = np.diff(first, append=len(hashes))
            several = np.repeat(counts > 1, counts)
            local = np.bincount(owners[several], minlength=len(seen))
            owners = np.where(counts > 1, np.uint16(LOCAL), owners[first])
            hashes = hashes[first]
            buckets = (hashes >> np.uint64(48 - bits)).astype(np.int32)
            rest = ((hashes >> np.uint64(16 - bits)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            cuts = np.flatnonzero(np.diff(buckets, prepend=-1))
            # what is counted here already goes with the names
            rows = [[-1 - int(buckets[0]), name, b"".join(seen), b"", b"", local.astype("<u4").tobytes()]]
            for low, high in zip(cuts, [*cuts[1:], len(buckets)]):
                rows.append([int(buckets[low]), name, b"", _pack(rest[low:high]), owners[low:high].astype("<u2").tobytes(), b""])
            kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 4]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], [f.split()[0] for f in DEALT.split(", ")])

        for batch in batches:
            for _, s in texts_shingles(batch.column(0), width):
                if not len(s) or (digested := digest(s)[:NAME]) in seen:
                    continue
                parts.append((s & np.uint64(0xFFFFFFFFFFFF0000)) | np.uint64(len(seen)))
                seen[digested] = len(seen)
                held += len(s)
                if held >= FLUSH or len(seen) == LOCAL:
                    yield flush()
                    seen, parts, held = {}, [], 0
                    name += 1
                    give_back()
        if held:
            yield flush()
            parts.clear()
            give_back()

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        out = {"flush": [], "names": [], "places": [], "counts": []}
        places, hashes, owners, base = [], [], [], 0
        for r in pdf.itertuples(index=False):
            if r.bucket < 0:
                for column, value in zip(out.values(), (r.flush, r.names, b"", r.counts)):
                    column.append(value)
                continue
            place = np.frombuffer(r.places, "<u2")
            used, mine = np.unique(place, return_inverse=True)
            mine = np.where(place == LOCAL, LOCAL_HERE, mine + base)
            used = used[used != LOCAL]
            hashes.append(_unpack(r.rest))
            owners.append(mine.astype(np.uint32))
            places.append((r.flush, base, used))
            base += len(used)
        if hashes:
            # one number per (shingle, set of a flush)
            keys = np.concatenate(hashes).astype(np.uint64)
            keys <<= np.uint64(32)
            keys |= np.concatenate(owners)
            del hashes, owners
            keys.sort()
            shingle, owner = keys >> np.uint64(32), (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
            del keys
            first = np.flatnonzero(np.diff(shingle, prepend=shingle[0] ^ np.uint64(1)))
            counts = np.diff(first, append=len(shingle))
            marked = np.maximum.reduceat(owner, first) == LOCAL_HERE
            repeated = np.repeat((counts > 1) | marked, counts) & (owner != LOCAL_HERE)
            total = np.bincount(owner[repeated], minlength=base)
            for name, low, used in places:
                here = total[low : low + len(used)]
                if here.any():
                    values = (name, b"", used[here > 0].tobytes(), here[here > 0].astype("<u4").tobytes())
                    for column, value in zip(out.values(), values):
                        column.append(value)
        give_back()
        return pd.DataFrame(out)

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        told = pdf[pdf["names"].str.len() > 0].iloc[0]
        names, total = np.frombuffer(told["names"], f"V{NAME}"), np.frombuffer(told["counts"], "<u4").astype(np.int64)
        for places, counts in zip(pdf["places"], pdf["counts"]):
            if places:
                total[np.frombuffer(places, "<u2")] += np.frombuffer(counts, "<u4")  # each place once
        some = np.flatnonzero(total)
        return pd.DataFrame({"name": names[some].tolist(), "n": total[some]})

    dealt = docs.select("text").mapInArrow(deal, DEALT)
    counted = dealt.groupBy("bucket").applyInPandas(count, "flush long, names binary, places binary, counts binary")
    found = counted.groupBy("flush").applyInPandas(add, "name binary, n long")
    return found.groupBy("name").agg(F.max("n").alias("n"))  # a set is in the flushes of all its copies


def _parities(shingles: np.ndarray) -> list[int]:
    """Whether an odd number of the shingles falls into each of 512 classes, as 64-bit numbers."""
    odd = np.bincount((shingles >> np.uint64(20) & np.uint64(64 * PARITIES - 1)).astype(np.int64), minlength=64 * PARITIES) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()


def _points(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """``(doc, n, shingles, parities)`` of the documents whose digests are ``wanted``."""

    @giving_back
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("jaccard_join")
        for batch in batches:
            asked = batch.column(2).to_pylist()
            rows, sets = [], []
            for i, s in texts_shingles(batch.column(1), width):
                if digest(s) == asked[i]:
                    rows.append(i)
                    sets.append(s)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows, pa.int64())),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([s.tobytes() for s in sets], pa.binary()),
                    pa.array([_parities(s) for s in sets], pa.list_(pa.int64())),
                ],
                ["doc", "n", "shingles", "parities"],
            )

    rows = possible(docs, "doc_id", wanted.select("doc_id"))
    return rows.join(wanted, "doc_id").select("doc_id", "text", "digest").mapInArrow(
        gather, "doc long, n long, shingles binary, parities array<long>"
    )


def _order_table(points: DataFrame) -> np.ndarray:
    """How often shingles fall into each of 2**ORDER_BITS slots, over all points."""

    @giving_back
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("jaccard_join")
        total = np.zeros(1 << ORDER_BITS, np.int64)
        for batch in batches:
            for s in batch.column(0).to_pylist():
                np.add.at(total, (np.frombuffer(s, np.uint64) >> np.uint64(64 - ORDER_BITS)).astype(np.int64), 1)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["slot", "n"])

    counted = points.select("shingles").mapInArrow(count, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    table = np.zeros(1 << ORDER_BITS, np.int64)
    got = counted.toArrow()
    table[got["slot"].to_numpy()] = got["n"].to_numpy()
    return np.minimum(table, 2**31 - 1).astype(np.int32)


def _regions(points: DataFrame, percent: int) -> DataFrame:
    """``(region, doc, n, room)``: the rarest shingles of each point; ``room``:
    how many of its shingles are not rarer."""
    table = points.sparkSession.sparkContext.broadcast(_order_table(points))

    @giving_back
    def rarest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("jaccard_join")
        counts = table.value
        for batch in batches:
            regions, rooms, lengths = [], [], []
            for s in batch.column(2).to_pylist():
                s = np.frombuffer(s, np.uint64)
                keep = len(s) - -(-percent * len(s) // 100) + 1
                often = counts[(s >> np.uint64(64 - ORDER_BITS)).astype(np.int64)]
                regions.append(s[np.lexsort((s, often))[:keep]].view(np.int64))
                rooms.append(len(s) - np.arange(keep))
                lengths.append(keep)
            flat = np.concatenate(regions) if regions else np.zeros(0, np.int64)
            rows = pa.array(np.repeat(np.arange(batch.num_rows), lengths))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(flat), batch.column(0).take(rows), batch.column(1).take(rows),
                    pa.array(np.concatenate(rooms) if rooms else np.zeros(0, np.int64)),
                ],
                ["region", "doc", "n", "room"],
            )

    return points.select("doc", "n", "shingles").mapInArrow(rarest, "region long, doc long, n long, room long")


def _distances(pairs: DataFrame, points: DataFrame) -> DataFrame:
    """``(doc, pivot, common, n, m)`` for pairs ``(pivot, doc)``."""

    @giving_back
    def overlap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("jaccard_join")
        for batch in batches:
            a, b = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            common = [
                len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True))
                for x, y in zip(a, b)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array(common, pa.int64()),
                    pa.array([len(x) // 8 for x in a], pa.int64()), pa.array([len(y) // 8 for y in b], pa.int64()),
                ],
                ["doc", "pivot", "common", "n", "m"],
            )

    left = possible(points.select("doc", F.col("shingles").alias("left")), "doc", pairs.select("doc"))
    right = points.select(F.col("doc").alias("pivot"), F.col("shingles").alias("right"))
    right = possible(right, "pivot", pairs.select("pivot"))
    joined = pairs.join(left, "doc").join(right, "pivot").select("doc", "pivot", "left", "right")
    return joined.mapInArrow(overlap, "doc long, pivot long, common long, n long, m long")


def _first_pivots(entries: DataFrame) -> DataFrame:
    """``(region, pivot, m, its_room)`` of the regions with several points.  The pivot is
    the first by a hash of its id, so regions of one crowd tend to elect the
    same point."""
    first = F.min(F.struct(F.xxhash64("doc").alias("order"), "doc", "n", "room")).alias("at")
    elected = entries.groupBy("region").agg(F.count("*").alias("size"), first).filter("size > 1")
    return elected.select("region", F.col("at.doc").alias("pivot"), F.col("at.n").alias("m"), F.col("at.room").alias("its_room"))


def _more_pivots(entries: DataFrame, pivots: int, crowd: bool) -> DataFrame:
    """``(region, pivot, m, its_room, its_part, its_far, last, q0...)``: ``pivots`` points
    of each region.  ``crowd``: of its largest parts; a point that belongs there
    soon meets a similar one.  Else of its smallest parts, which must meet all
    that is left; of a region of at most ``SMALL`` points all."""
    small = F.lit(0 if crowd else SMALL)
    parts = entries.groupBy("region", "part").agg(F.count("*").alias("part_size"))
    sizes = parts.groupBy("region").agg(F.sum("part_size").alias("size"))
    by_part = [F.desc("part_size"), F.xxhash64("part")] if crowd else [F.asc("part_size")]
    order = Window.partitionBy("region").orderBy(*by_part, F.xxhash64("doc"), "doc")
    known = entries.join(sizes, "region").join(parts, ["region", "part"])
    ranked = known.filter(F.col("size") > small).withColumn("place", F.row_number().over(order))
    some = ranked.filter(F.col("place") <= pivots).drop("place").union(known.filter(F.col("size") <= small))
    return some.select(
        "region", F.col("doc").alias("pivot"), F.col("n").alias("m"), F.col("room").alias("its_room"), F.col("part").alias("its_part"),
        *[F.col(f"p{k}").alias(f"q{k}") for k in range(PARITIES)], F.col("far").alias("its_far"), (F.col("size") <= small).alias("last"),
    )


def _parted(entries: DataFrame, measured: DataFrame, percent: int) -> DataFrame:
    """``entries`` with the parts that the measured links join."""
    joined = connected_components(measured.filter(_similar(percent)), "part", "its_part")
    entries = entries.join(joined.withColumnRenamed("node", "part"), "part", "left")
    return entries.withColumn("part", F.coalesce("component", "part")).drop("component")


def _similar(percent: int) -> F.Column:
    return F.col("common") * 100 >= (F.col("n") + F.col("m") - F.col("common")) * percent


def _several(entries: DataFrame) -> DataFrame:
    """The entries of regions with several parts."""
    mixed = entries.groupBy("region").agg(F.min("part").alias("one"), F.max("part").alias("other")).filter("one != other")
    return entries.join(mixed.select("region"), "region")


def links_of_points(points: DataFrame, percent: int) -> DataFrame:
    """Links ``(a, b)`` that connect all points which the join connects: a pair
    whose ends these links connect already may be left out."""
    radius = 1 - percent / 100
    distance = 1 - F.col("common") / (F.col("n") + F.col("m") - F.col("common"))
    # the region's shingle being the rarest common one, no more can be common than either point has from it on;
    # a pair with a rarer common one meets in that region
    fits = F.least("room", "its_room") * (100 + percent) >= (F.col("n") + F.col("m")) * percent
    # part: a name that only connected points share; far: the distance to the region's first pivot
    rarest = save(_regions(points, percent), "regions")
    entries = save(rarest.join(_first_pivots(rarest), "region").withColumn("part", F.col("doc")), "regions")
    parities = points.select("doc", *[F.col("parities")[k].alias(f"p{k}") for k in range(PARITIES)])
    its_parities = parities.toDF("pivot", *[f"q{k}" for k in range(PARITIES)])
    # classes with another parity: at least so many shingles are not common
    apart = sum((F.bit_count(F.col(f"p{k}").bitwiseXOR(F.col(f"q{k}"))) for k in range(PARITIES)), F.lit(0))
    alike = apart * (100 + percent) <= (F.col("n") + F.col("m")) * (100 - percent)
    asked = entries.filter(F.col("doc") != F.col("pivot")).filter(fits).select("doc", "pivot", "n", "m").distinct()
    # points that meet by chance are told apart before any shingles are sent
    asked = save(asked.join(parities, "doc").join(its_parities, "pivot").filter(alike).select("doc", "pivot"), "asked")
    measured = save(_distances(asked, points).withColumns({"part": F.col("doc"), "its_part": F.col("pivot")}), "measured")
    links = measured.filter(_similar(percent)).select("doc", "pivot")
    far = measured.select("doc", "pivot", distance.alias("far"))
    rest = entries.filter(F.col("doc") != F.col("pivot")).drop("m", "its_room").join(far, ["doc", "pivot"], "left").drop("pivot")
    # the pivot has met every point of its region
    rest = save(_several(_parted(rest, measured, percent)).join(parities, "doc"), "regions")
    delete(points.sparkSession, rarest, entries, asked)
    entries, turn, pivots = rest, 0, CROWD_PIVOTS
    while entries.limit(1).count():
        chosen = save(_more_pivots(entries, pivots, turn < CROWD_TURNS), "pivots")
        window = F.coalesce(F.abs(F.col("far") - F.col("its_far")) <= radius + 1e-9, F.lit(True))
        asked = entries.join(chosen, "region").filter((F.col("part") != F.col("its_part")) & fits & window & alike)
        asked = asked.filter(~F.col("last") | (F.col("doc") < F.col("pivot")))  # both are pivots there
        asked = save(asked.groupBy("doc", "pivot").agg(F.min("part").alias("part"), F.min("its_part").alias("its_part")), "asked")
        measured = save(_distances(asked.select("doc", "pivot"), points).join(asked, ["doc", "pivot"]), "measured")
        links = links.union(measured.filter(_similar(percent)).select("doc", "pivot"))
        met = chosen.select("region", F.col("pivot").alias("doc"))
        rest = entries.join(met, ["region", "doc"], "left_anti")
        if rest.limit(1).count():
            rest = _several(_parted(rest, measured, percent))
        before, entries = entries, save(rest, "regions")
        delete(points.sparkSession, before, chosen, asked)
        turn += 1
        pivots = CROWD_PIVOTS if turn < CROWD_TURNS else 64 * 16 ** (turn - CROWD_TURNS)
    return links.toDF("a", "b")


def jaccard_components(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``(doc_id, n_shingles, component_id)``, one row per row of ``docs``.

    Two documents are linked if ``100 * common shingles >= percent * all``;
    ``component_id`` is the smallest doc_id that links reach.  Texts are
    lower-cased (A-Z).  A null or empty text, or one of white space, has no
    shingles and no links.  A row without doc_id takes no part: its component
    is null.  Rows that repeat a doc_id are one document with all their links.
    Only ``doc_id`` and ``text`` are read; other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    profiles = save(set_profiles(docs, width), "profiles")
    total = profiles.agg(F.sum("n_shingles")).first()[0] or 0
    known = profiles.filter("n_shingles > 0 and doc_id is not null")
    sets = known.groupBy("digest", "n_shingles").agg(F.min("doc_id").alias("first"))
    repeated = repeated_shingles(docs, width, total)
    named = F.substring("digest", 1, NAME) == F.col("name")
    wanted = sets.join(repeated, named).filter(F.col("n") * 100 >= F.col("n_shingles") * percent)
    wanted = save(wanted.select(F.col("first").alias("doc_id"), "digest"), "wanted")
    points = save(_points(docs, wanted, width), "points")
    copies = known.join(sets.select("digest", "first"), "digest").filter("doc_id != first")
    links = copies.select(F.col("first").alias("a"), F.col("doc_id").alias("b"))
    found = connected_components(links.union(links_of_points(points, percent)))
    return (
        profiles.select("doc_id", "n_shingles").join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    )
