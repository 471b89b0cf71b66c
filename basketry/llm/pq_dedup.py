"""Near-duplicate vectors by product quantisation.

Vectors are scaled to length one, so a cosine of 0.98 is a distance of 0.2.
Coarse centres divide them into inverted lists; what is left of a vector is kept
as one code per subspace, with its exact quantisation error.  A query probes all
lists that can hold a partner: a point within the radius lies in another list
only if the bisecting plane of the two centres is within the radius.  In a list,
the distance from the uncoded query to the coded vector comes from table
look-ups; by the triangle inequality a partner's is at most the radius plus the
vector's quantisation error.  What passes is compared by its exact cosine.  Both
bounds are exact, so no pair is lost whatever the codebooks, which are fitted on
a bounded sample.

Equal vectors of a label are one point.  Lists are stored in blocks of bounded
size, and the queries of a block come in chunks, so a list that holds a third of
all vectors becomes many tasks.  Only link counts and the links of a spanning
forest of each block leave a task, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.components import connected_components
from basketry.llm.shared import save
from basketry.llm.vectors import kmeans, nearest_centre, squared_distances, stacked, unit, usable_vectors

SAMPLE = 16_384  # vectors on which the codebooks are fitted
MOST_LISTS = 1024  # coarse centres
LIST_LENGTH = 200  # vectors for one more coarse centre
SUBSPACES = 16
CODES = 256
BLOCK = 2_000  # vectors of a stored block
CHUNK = 4_000  # queries of a block that come together


class Codebook:
    """Coarse centres and subspace codewords for vectors of one length.  Without
    a sample: one centre at zero and no codes, which prunes nothing."""

    def __init__(self, dim: int, sample: np.ndarray, lists: int):
        self.cuts = np.array_split(np.arange(dim), min(SUBSPACES, dim))
        self.centres = kmeans(sample, lists, 6, 1) if len(sample) else np.zeros((1, dim))
        rest = sample - self.centres[nearest_centre(sample, self.centres)[0]] if len(sample) else sample.reshape(0, dim)
        self.words = [kmeans(rest[:, c], CODES, 5, 2) if len(rest) else np.zeros((1, len(c))) for c in self.cuts]
        self.gaps = np.sqrt(squared_distances(self.centres, self.centres))

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """List, codes, quantisation error and the constant part of the squared distance of each row."""
        at, _ = nearest_centre(x, self.centres)
        rest = x - self.centres[at]
        codes = np.stack([nearest_centre(rest[:, c], w)[0] for c, w in zip(self.cuts, self.words)], 1).astype(np.uint8)
        coded = self.decode(codes)
        error = np.linalg.norm(rest - coded, axis=1)
        constant = (coded * coded).sum(1) + 2 * (self.centres[at] * coded).sum(1)
        return at, codes, error, constant

    def decode(self, codes: np.ndarray) -> np.ndarray:
        out = np.zeros((len(codes), sum(map(len, self.cuts))))
        for m, (c, w) in enumerate(zip(self.cuts, self.words)):
            out[:, c] = w[codes[:, m]]
        return out

    def probes(self, x: np.ndarray, radius: float) -> np.ndarray:
        """For each row, which lists can hold a point within ``radius``."""
        d = squared_distances(x, self.centres)
        at = d.argmin(1)
        room = 2 * (radius + 1e-9) * self.gaps[at] + 1e-9
        return d - d[np.arange(len(x)), at][:, None] <= room

    def tables(self, x: np.ndarray) -> np.ndarray:
        """Dot products of each row's subvectors with the codewords."""
        out = np.zeros((len(self.cuts), len(x), CODES), np.float32)
        for m, (c, w) in enumerate(zip(self.cuts, self.words)):
            out[m, :, : len(w)] = x[:, c] @ w.T
        return out


def _codebooks(points: DataFrame, n: int) -> dict[int, Codebook]:
    rows = points.select("dim", "vec").orderBy(F.xxhash64("digest"), "digest").limit(SAMPLE).toArrow()
    lists = max(1, min(MOST_LISTS, n // LIST_LENGTH))
    dims = np.array(rows["dim"].to_pylist(), np.int64)
    books = {}
    for dim in np.unique(dims).tolist():
        sample = unit(stacked(rows["vec"].take(pa.array(np.flatnonzero(dims == dim))), dim))
        books[dim] = Codebook(dim, sample, lists)
    return books


def _by_dim(dims: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    for dim in np.unique(dims).tolist():
        yield dim, np.flatnonzero(dims == dim)


def _forest(linked: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what the matrix of links connects: one fewer than
    members for each connected part."""
    out = []
    rows = np.flatnonzero(linked.any(1))
    waiting = np.zeros(len(linked), bool)
    waiting[rows] = True
    for seed in rows.tolist():
        if not waiting[seed]:
            continue
        waiting[seed] = False
        front, known = np.array([seed]), np.zeros(linked.shape[1], bool)
        while len(front):
            reached = linked[front].any(0) & ~known
            known |= reached
            out += [(int(left[front[int(linked[front, j].argmax())]]), int(right[j])) for j in np.flatnonzero(reached)]
            more = np.flatnonzero(linked[:, reached].any(1) & waiting) if reached.any() else np.zeros(0, np.int64)
            back = np.flatnonzero(reached)
            out += [(int(left[i]), int(right[back[int(linked[i, back].argmax())]])) for i in more]
            waiting[more] = False
            front = more
    return out


def near_duplicates(table: DataFrame, threshold: float = 0.98, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label") -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row per row of ``table``.

    Two rows are linked if they have the same label, vectors of the same length,
    and a cosine (in doubles) of ``threshold`` or more.  A null id or label, and
    a vector that is null, empty, zero or holds a null or non-finite number,
    links with nothing; a row without id has null as component and is not kept.
    Rows with equal vectors are linked; rows that repeat an id count as vectors
    of their own and share a component.  Other columns are ignored.
    """
    spark = table.sparkSession
    radius = float(np.sqrt(2 - 2 * threshold))
    rows = save(usable_vectors(table, id_column, vector_column, label_column), "vectors")
    points = rows.groupBy("label", "dim", "digest").agg(
        F.min("vec_id").alias("point"), F.count("*").alias("copies"), F.first("vec").alias("vec")
    )
    # an id may have several vectors: points are numbered by a hash of all that makes them differ
    points = save(points.withColumn("key", F.xxhash64("label", "dim", "digest", "point")), "points")
    books = spark.sparkContext.broadcast(_codebooks(points, points.count()))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(2).to_numpy()
            for dim, at in _by_dim(dims):
                part = batch.take(pa.array(at))
                book = books.value.get(dim) or Codebook(dim, np.zeros((0, dim)), 1)
                lists, codes, error, constant = book.encode(unit(stacked(part.column(3), dim)))
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns, pa.array(lists.astype(np.int32)),
                        pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error), pa.array(constant),
                    ],
                    [*batch.schema.names, "list", "codes", "error", "constant"],
                )

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, at in _by_dim(batch.column(2).to_numpy()):
                for low in range(0, len(at), 512):
                    part = batch.take(pa.array(at[low : low + 512]))
                    book = books.value.get(dim) or Codebook(dim, np.zeros((0, dim)), 1)
                    query, lists = np.nonzero(book.probes(unit(stacked(part.column(3), dim)), radius))
                    taken = pa.array(query)
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).take(taken), part.column(1).take(taken), part.column(2).take(taken), pa.array(lists.astype(np.int32))],
                        ["key", "label", "dim", "list"],
                    )

    base = points.select("key", "label", "dim", "vec", "copies")
    coded = save(
        base.mapInArrow(encode, "key long, label string, dim int, vec binary, copies long, list int, codes binary, error double, constant double"),
        "codes",
    )
    # blocks: the lists of a label one after the other, a long list over several blocks
    sizes = coded.groupBy("label", "dim", "list").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("label", "dim").orderBy("list").rowsBetween(Window.unboundedPreceding, -1))
    start = F.coalesce(before, F.lit(0))
    ranges = sizes.select(
        "label", "dim", "list", F.floor(start / BLOCK).alias("first"), F.floor((start + F.col("n") - 1) / BLOCK).alias("last")
    )
    ranges = save(ranges, "ranges")
    place = ["label", "dim", "list"]
    stored = coded.join(ranges, place).withColumn("block", F.col("first") + F.pmod("key", F.col("last") - F.col("first") + 1))
    asked = base.select("key", "label", "dim", "vec").mapInArrow(probe, "key long, label string, dim int, list int")
    asked = asked.join(ranges, place).withColumn("block", F.explode(F.sequence("first", "last")))
    asked = save(asked.groupBy("label", "dim", "block", "key").agg(F.collect_list("list").alias("lists")), "probes")
    chunks = asked.groupBy("label", "dim", "block").agg((F.floor(F.count("*") / CHUNK) + 1).alias("chunks"))
    cell = ["label", "dim", "block", "chunk"]
    queries = (
        asked.join(chunks, cell[:3]).withColumn("chunk", F.pmod(F.xxhash64("key"), F.col("chunks")))
        .join(base.select("key", "vec"), "key").select(*cell, "key", "vec", "lists")
    )
    index = stored.join(chunks, cell[:3]).withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    index = index.select(*cell, "key", "vec", "copies", "list", "codes", "error", "constant")

    def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = {"a": [], "b": [], "links": []}
        if len(left) and len(right):
            dim = int(left["dim"].iloc[0])
            book = books.value.get(dim) or Codebook(dim, np.zeros((0, dim)), 1)
            x, y = unit(stacked(left["vec"], dim)), unit(stacked(right["vec"], dim))
            keys, others, copies = left["key"].to_numpy(), right["key"].to_numpy(), right["copies"].to_numpy()
            codes = np.frombuffer(b"".join(right["codes"]), np.uint8).reshape(len(right), -1)
            bound = (radius + right["error"].to_numpy() + 1e-4) ** 2
            constant, lists = right["constant"].to_numpy(), right["list"].to_numpy()
            linked = np.zeros((len(left), len(right)), bool)
            asked_lists = left["lists"].to_numpy()
            probing: dict[int, list[int]] = {}
            for q, some in enumerate(asked_lists):
                for k in some:
                    probing.setdefault(int(k), []).append(q)
            step = 512
            for low in range(0, len(left), step):
                tables = book.tables(x[low : low + step])
                for k in np.unique(lists).tolist():
                    items = np.flatnonzero(lists == k)
                    q = np.array([i for i in probing.get(k, ()) if low <= i < low + step], np.int64)
                    if not len(q):
                        continue
                    for some in range(0, len(items), step):
                        part = items[some : some + step]
                        dots = np.zeros((len(q), len(part)), np.float32)
                        for m in range(codes.shape[1]):
                            dots += tables[m][q - low][:, codes[part, m]]
                        lead = squared_distances(x[q], book.centres[k : k + 1])
                        near = lead - 2 * dots + constant[part][None] <= bound[part][None]
                        i, j = np.nonzero(near)
                        i, j = q[i], part[j]
                        for at in range(0, len(i), 1 << 16):
                            a, b = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
                            hit = np.einsum("ij,ij->i", x[a], y[b]) >= threshold
                            linked[a[hit], b[hit]] = True
            linked &= keys[:, None] != others[None]
            some = np.flatnonzero(linked.any(1))
            out["a"], out["b"], out["links"] = keys[some].tolist(), [None] * len(some), (linked[some] @ copies).tolist()
            pairs = _forest(linked, keys, others)
            out["a"] += [a for a, _ in pairs]
            out["b"] += [b for _, b in pairs]
            out["links"] += [None] * len(pairs)
        return pd.DataFrame({"a": pd.array(out["a"], "Int64"), "b": pd.array(out["b"], "Int64"), "links": pd.array(out["links"], "Int64")})

    found = queries.groupBy(*cell).cogroup(index.groupBy(*cell)).applyInPandas(compare, "a long, b long, links long")
    found = save(found, "found")
    counts = found.filter("links is not null").groupBy(F.col("a").alias("key")).agg(F.sum("links").alias("links"))
    names = points.select("key", "point")
    links = found.filter("b is not null").select("a", "b").join(names.toDF("a", "from"), "a").join(names.toDF("b", "to"), "b")
    member = rows.join(points.drop("vec"), ["label", "dim", "digest"])
    same = member.filter("vec_id != point").select(F.col("point").alias("from"), F.col("vec_id").alias("to"))
    components = connected_components(links.select("from", "to").union(same), "from", "to")
    linked = member.join(counts, "key", "left").select(
        "vec_id", "label", "digest", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
    )
    return _per_row(table, linked, components, id_column, vector_column, label_column)


def _per_row(table: DataFrame, linked: DataFrame, components: DataFrame, id_column: str, vector_column: str, label_column: str) -> DataFrame:
    """One row per row of the table: the counts of its usable rows, zero for the others."""
    odd = F.exists(F.col(vector_column), lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    zero = F.forall(F.col(vector_column), lambda v: v == 0)
    usable = F.col(id_column).isNotNull() & F.col(label_column).isNotNull() & F.col(vector_column).isNotNull()
    usable = F.coalesce(usable & ~F.coalesce(odd, F.lit(False)) & ~F.coalesce(zero, F.lit(False)), F.lit(False))
    others = table.filter(~usable).select(F.col(id_column).cast("long").alias("vec_id"), F.lit(0).cast("long").alias("n_links"))
    every = linked.select("vec_id", "n_links").union(others)
    every = every.join(components.withColumnRenamed("node", "vec_id"), "vec_id", "left")
    component = F.coalesce("component", "vec_id")
    return every.select(
        "vec_id", "n_links", component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept")
    )
