"""Nearest neighbours by a graph that NN-descent builds and a greedy search over it.

Building: points start with the nearest of a cell of points around a pivot; then
each round joins, at every point, some of its neighbours and of the points that
have it as a neighbour, and offers those to each other that come nearer than
what they have.  Rounds end when few lists change.  Distances of this phase use
vectors rounded to one byte per number; the rounding moves a distance by about a
hundredth of it and can only cost recall, never a score.

Searching: a query keeps the best points seen, expands all of them that it has
not expanded, and stops when there is none left.  A query that is itself a point
starts there, any other at the pivots.  The best are compared again by their
original vectors in doubles.

Equal vectors are one point; of the ids of a point no more than the smallest
``neighbours + 1`` can be in a result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.shared import delete, release, save
from basketry.llm.vectors import squared_distances, stacked, usable_vectors


@dataclass(frozen=True)
class GraphSettings:
    degree: int = 28  # neighbours a point keeps
    joined: int = 28  # points that meet at a point in one round
    offers: int = 8  # of them that a point takes from one meeting, at most
    rounds: int = 5  # at most
    settled: float = 0.02  # share of changed neighbours at which rounds end
    pivots: int = 2_048  # of the starting cells, at most
    cell: int = 200  # points of a cell, about; a larger cell is cut by hash
    beam: int = 160  # points a query keeps
    entries: int = 16  # pivots at which a query starts that is no point


def _rounded(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    scale = np.abs(x).max(axis=1) / 127
    return np.rint(x / scale[:, None]).astype(np.int8), scale


def _unrounded(codes, scales, count: int) -> np.ndarray:
    flat = np.frombuffer(b"".join(codes), np.int8).reshape(count, -1).astype(np.float32)
    return flat * np.asarray(scales, np.float32)[:, None]


def distinct_points(table: DataFrame, id_column: str, vector_column: str, kept_ids: int) -> tuple[DataFrame, DataFrame]:
    """``(point, dim, vec, codes, scale)`` and ``(point, vec_id)``: the smallest ids of each point."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, scales = [], []
            for v in batch.column(2).to_pylist():
                c, s = _rounded(np.frombuffer(v, "<f8")[None])
                codes.append(c.tobytes())
                scales.append(float(s[0]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(codes, pa.binary()), pa.array(scales)], [*batch.schema.names, "codes", "scale"]
            )

    rows = save(usable_vectors(table, id_column, vector_column).select("vec_id", "dim", "digest", "vec"), "vectors")
    order = Window.partitionBy("dim", "digest").orderBy("vec_id")
    smallest = rows.select("vec_id", "dim", "digest").distinct().withColumn("place", F.row_number().over(order))
    key = F.xxhash64("dim", "digest").alias("point")
    ids = save(smallest.filter(F.col("place") <= kept_ids).select(key, "vec_id"), "point-ids")
    points = rows.groupBy("dim", "digest").agg(F.first("vec").alias("vec")).select(key, "dim", "vec")
    coded = points.mapInArrow(encode, "point long, dim int, vec binary, codes binary, scale double")
    return save(coded, "points"), ids


def _cells(points: DataFrame, s: GraphSettings, turn: int, n: int) -> DataFrame:
    """``(point, nbr, dist)`` among the points of a cell."""
    pivots = max(1, min(s.pivots, 2 * n // s.cell))
    chosen = points.orderBy(F.xxhash64("point", F.lit(turn)), "point").select("dim", "vec").limit(pivots).toArrow()
    dims = np.array(chosen["dim"].to_pylist(), np.int64)
    centres = {d: stacked(chosen["vec"].take(pa.array(np.flatnonzero(dims == d))), d) for d in np.unique(dims).tolist()}
    shared = points.sparkSession.sparkContext.broadcast(centres)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(1).to_numpy()
            for dim in np.unique(dims).tolist():
                part = batch.take(pa.array(np.flatnonzero(dims == dim)))
                near = np.zeros(len(part), np.int64)
                if dim in shared.value:
                    for low in range(0, len(part), 1024):
                        x = stacked(part.column(2).slice(low, 1024), dim)
                        near[low : low + len(x)] = squared_distances(x, shared.value[dim]).argmin(1)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(near), part.column(3), part.column(4)],
                    ["point", "dim", "cell", "codes", "scale"],
                )

    placed = points.select("point", "dim", "vec", "codes", "scale").mapInArrow(
        assign, "point long, dim int, cell long, codes binary, scale double"
    )
    placed = save(placed, "cells")
    sizes = placed.groupBy("dim", "cell").agg((1 + F.floor(F.count("*") / (2 * s.cell))).alias("parts"))
    cut = placed.join(sizes, ["dim", "cell"]).withColumn("part", F.pmod(F.xxhash64("point", F.lit(turn)), F.col("parts")))

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        names = pdf["point"].to_numpy()
        x = _unrounded(pdf["codes"], pdf["scale"], len(pdf))
        d = squared_distances(x, x)
        np.fill_diagonal(d, np.inf)
        k = min(s.degree, len(names) - 1)
        if k < 1:
            return pd.DataFrame({"point": [], "nbr": [], "dist": []})
        at = np.argpartition(d, k - 1, axis=1)[:, :k]
        return pd.DataFrame(
            {"point": np.repeat(names, k), "nbr": names[at].ravel(), "dist": np.take_along_axis(d, at, 1).ravel().astype(float)}
        )

    return cut.groupBy("dim", "cell", "part").applyInPandas(meet, "point long, nbr long, dist double")


def _nearest(edges: DataFrame, degree: int) -> DataFrame:
    """The nearest ``degree`` neighbours of each point; ``new`` if no earlier round knew them."""
    one = edges.groupBy("point", "nbr").agg(F.min("dist").alias("dist"), F.min("new").alias("new"))
    order = Window.partitionBy("point").orderBy("dist", "nbr")
    return one.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= degree).drop("place")


def neighbour_graph(points: DataFrame, s: GraphSettings, n: int) -> DataFrame:
    """``(point, nbr, dist, new)``; ``dist`` is squared."""

    def meeting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list[np.ndarray]] = [[], [], []]
            for some in batch.column(0).to_pylist():
                names = np.array([m["member"] for m in some], np.int64)
                fresh = np.array([m["new"] for m in some], bool)
                d = squared_distances(*[_unrounded([m["codes"] for m in some], [m["scale"] for m in some], len(some))] * 2)
                worst = np.array([m["worst"] for m in some])
                wanted = (fresh[:, None] | fresh[None]) & (names[:, None] != names[None]) & (d < worst[:, None])
                d = np.where(wanted, d, np.inf)
                k = min(s.offers, len(names))
                at = np.argpartition(d, k - 1, axis=1)[:, :k]
                near = np.take_along_axis(d, at, 1)
                i, j = np.nonzero(np.isfinite(near))
                out[0].append(names[i])
                out[1].append(names[at[i, j]])
                out[2].append(near[i, j].astype(float))
            arrays = [pa.array(np.concatenate(c) if c else np.zeros(0, k)) for c, k in zip(out, (np.int64, np.int64, float))]
            yield pa.RecordBatch.from_arrays(arrays, ["point", "nbr", "dist"])

    start = _cells(points, s, 1, n).union(_cells(points, s, 2, n)).withColumn("new", F.lit(1))
    graph = save(_nearest(start, s.degree), "graph")
    vectors = points.select(F.col("point").alias("member"), "codes", "scale")
    for _ in range(s.rounds):
        worst = graph.groupBy(F.col("point").alias("member")).agg(
            F.when(F.count("*") >= s.degree, F.max("dist")).otherwise(F.lit(float("inf"))).alias("worst")
        )
        both = graph.select(F.col("point").alias("centre"), F.col("nbr").alias("member"), "dist", "new").union(
            graph.select("nbr", "point", "dist", "new")
        )
        both = both.groupBy("centre", "member").agg(F.min("dist").alias("dist"), F.max("new").alias("new"))
        order = Window.partitionBy("centre").orderBy(F.desc("new"), "dist", "member")
        chosen = both.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= s.joined)
        chosen = chosen.select("centre", "member", "new").join(vectors, "member").join(worst, "member")
        groups = chosen.groupBy("centre").agg(F.collect_list(F.struct("member", "new", "codes", "scale", "worst")).alias("some"))
        offers = groups.select("some").mapInArrow(meeting, "point long, nbr long, dist double")
        known = graph.withColumn("new", F.lit(0))
        after = save(_nearest(known.union(offers.withColumn("new", F.lit(1))), s.degree), "graph")
        changed = after.agg(F.avg("new")).first()[0] or 0
        delete(points.sparkSession, graph)
        graph = after
        if changed < s.settled:
            break
    return graph


def _adjacency(graph: DataFrame, points: DataFrame, degree: int) -> DataFrame:
    """``(point, around)``: the neighbours of each point and the nearest points
    that have it as a neighbour, with their rounded vectors."""
    order = Window.partitionBy("nbr").orderBy("dist", "point")
    back = graph.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= degree)
    both = graph.select("point", "nbr").union(back.select("nbr", "point")).distinct()
    vectors = points.select(F.col("point").alias("nbr"), "codes", "scale")
    return both.join(vectors, "nbr").groupBy("point").agg(F.collect_list(F.struct("nbr", "codes", "scale")).alias("around"))


STATE = "query long, dim int, vec binary, seen binary, names binary, dists binary, open binary"


def _advance(beam: int):
    """Take the points around the expanded ones into each query's best."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                seen = np.frombuffer(r["seen"], np.int64)
                names, dists = np.frombuffer(r["names"], np.int64), np.frombuffer(r["dists"], np.float64)
                open_ = np.zeros(len(names), bool)  # all that were open have just been expanded
                around = {m["nbr"]: m for part in r["found"] or [] for m in part}
                new = np.setdiff1d(np.fromiter(around, np.int64, len(around)), seen)
                if len(new):
                    some = [around[k] for k in new.tolist()]
                    x = _unrounded([m["codes"] for m in some], [m["scale"] for m in some], len(some))
                    d = squared_distances(np.frombuffer(r["vec"], "<f8")[None].astype(np.float32), x)[0].astype(float)
                    names, dists = np.concatenate([names, new]), np.concatenate([dists, d])
                    open_ = np.concatenate([open_, np.ones(len(new), bool)])
                    best = np.lexsort((names, dists))[:beam]
                    names, dists, open_ = names[best], dists[best], open_[best]
                    seen = np.union1d(seen, new)
                rows.append((r["query"], r["dim"], r["vec"], seen.tobytes(), names.tobytes(), dists.tobytes(), names[open_].tobytes()))
            columns = list(zip(*rows)) if rows else [()] * 7
            kinds = [pa.int64(), pa.int32(), *[pa.binary()] * 5]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["query", "dim", "vec", "seen", "names", "dists", "open"]
            )

    return step


def _numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(query, point)`` for every packed point of a query."""
    for batch in batches:
        lists = [np.frombuffer(v, np.int64) for v in batch.column(1).to_pylist()]
        rows = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        flat = np.concatenate(lists) if lists else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), pa.array(flat)], ["query", "point"])


def greedy_search(queries: DataFrame, graph: DataFrame, points: DataFrame, s: GraphSettings) -> DataFrame:
    """``(query, point)``: the best points of ``queries (query, dim, vec)`` that the search meets."""
    spark = queries.sparkSession
    adjacency = save(_adjacency(graph, points, s.degree), "adjacency")
    # entries: the query's own point, if it is one, and else pivots of its length
    own = queries.join(points.select(F.col("point").alias("query"), F.lit(True).alias("own")), "query", "left")
    order = Window.partitionBy("dim").orderBy(F.xxhash64("point"), "point")
    pivots = points.select("dim", "point").withColumn("place", F.row_number().over(order)).filter(F.col("place") <= s.entries)
    entry = own.filter("own").select("query", F.col("query").alias("point")).union(
        own.filter("own is null").join(F.broadcast(pivots), "dim").select("query", "point")
    )
    empty = F.lit(b"").cast("binary")
    state = save(queries.select("query", "dim", "vec", *[empty.alias(c) for c in ("seen", "names", "dists", "open")]), "state")
    # the entries count as found, at the distances their rounded vectors give
    first = entry.join(points.select("point", "codes", "scale"), "point").select(
        "query", F.array(F.struct(F.col("point").alias("nbr"), "codes", "scale")).alias("around")
    )
    while True:
        found = first.groupBy("query").agg(F.collect_list("around").alias("found"))
        joined = state.join(found, "query", "left")
        after = save(joined.mapInArrow(_advance(s.beam), STATE), "state")
        delete(spark, state)
        state = after
        front = state.filter(F.octet_length("open") > 0).select("query", "open").mapInArrow(_numbers, "query long, point long")
        if not front.limit(1).count():
            break
        first = front.join(adjacency, "point").select("query", "around")
    best = save(state.select("query", "names").mapInArrow(_numbers, "query long, point long"), "best")
    delete(spark, adjacency, state)
    return best


def nearest(
    table: DataFrame,
    queries: DataFrame,
    neighbours: int = 10,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    settings: GraphSettings = GraphSettings(),
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row of ``queries`` (rows of
    the same form) its nearest rows of ``table`` but those with its own id,
    nearest first, ties to the smaller id.

    ``score`` is the Euclidean distance of the original vectors in doubles.  A
    null id, and a vector that is null, empty, zero or holds a null or
    non-finite number, takes no part on either side; vectors of another length
    are no candidates.  Fewer candidates give fewer rows.  Rows that repeat an
    id with an equal vector count once.  Other columns are ignored.
    """
    spark = table.sparkSession
    points, ids = distinct_points(table, id_column, vector_column, neighbours + 1)
    n = points.count()
    graph = neighbour_graph(points, settings, n)
    asked = usable_vectors(queries, id_column, vector_column).select("vec_id", F.xxhash64("dim", "digest").alias("query"), "dim", "vec")
    asked = save(asked.distinct(), "queries")
    vectors = asked.groupBy("query", "dim").agg(F.first("vec").alias("vec"))
    best = greedy_search(vectors, graph, points, settings)

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [
                float(np.sqrt(((np.frombuffer(a, "<f8") - np.frombuffer(b, "<f8")) ** 2).sum()))
                for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores, pa.float64())], ["query", "point", "score"])

    pairs = best.join(vectors.select("query", F.col("vec").alias("mine")), "query").join(points.select("point", "vec"), "point")
    scored = pairs.select("query", "point", "mine", "vec").mapInArrow(exact, "query long, point long, score double")
    scored = scored.join(ids, "point")
    order = Window.partitionBy("query").orderBy("score", "vec_id")
    # a query leaves out its own id: one more than asked for is enough
    top = scored.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= neighbours + 1)
    named = asked.select("query", F.col("vec_id").alias("query_id")).join(top, "query").filter("vec_id != query_id")
    order = Window.partitionBy("query_id", "query").orderBy("score", "vec_id")
    ranked = named.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= neighbours)
    release(spark)
    return ranked.select("query_id", "rank", "vec_id", "score")
