"""Connected components of a graph held as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.shared import delete, save


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)``: the smallest node that each linked node reaches.

    Alternates two steps until no link changes: every node sends its larger
    neighbours to its smallest one, then its smaller neighbours to its smallest
    one.  A long chain needs a logarithmic number of rounds.  Both steps
    pre-aggregate a minimum per node; nothing is gathered per node, so a node
    with many links stays many rows.  Null ends and loops are no links.
    """
    low, high = F.least(a, b).alias("low"), F.greatest(a, b).alias("high")
    edges = links.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).select(low, high).filter("low < high").distinct()
    edges = save(edges, "links")
    state = _state(edges)
    while True:
        after = save(_small_star(_large_star(edges)), "links")
        delete(links.sparkSession, edges)
        before, state, edges = state, _state(after), after
        if state == before:
            break
    found = edges.select(F.col("high").alias("node"), F.col("low").alias("component"))
    roots = edges.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct()
    return found.union(roots)


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("low", "high")), F.sum(F.hash("high", "low"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("high", "low")).toDF("node", "other")
    smallest = both.groupBy("node").agg(F.min("other").alias("root"))
    moved = both.filter("other > node").join(smallest, "node")
    return moved.select(F.least("root", "node").alias("low"), F.col("other").alias("high"))


def _small_star(edges: DataFrame) -> DataFrame:
    smallest = edges.groupBy("high").agg(F.min("low").alias("root"))
    moved = edges.join(smallest, "high").filter("low > root").select("root", F.col("low").alias("high"))
    return moved.union(smallest.select("root", "high")).distinct().toDF("low", "high")
