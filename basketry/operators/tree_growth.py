"""Regression trees grown level by level from histograms of packed rows.

A row is its bins, a few bits a feature packed into 16-bit words, the number of its
(label, weight) pair and its margin: some 25 bytes.  Blocks of rows stay where they
are; each level is one pass over them that adds up weighted residuals, weights and
rows per node, feature and bin.  Of two children only the smaller is counted, the
other is what is left of its parent.  What reaches the driver is one histogram a
node, whatever the number of rows.
"""

from __future__ import annotations

import math
import operator
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import RDD, SparkContext, StorageLevel, TaskContext
from pyspark.sql import DataFrame

WORD_BITS = 10  # bits of a word in use: histograms of all nodes of a level stay in a core's cache
WORD = 1 << WORD_BITS
BLOCK_ROWS = 1 << 14
COUNTED_ROWS = 1 << 15  # rows of several blocks that are counted together
HELD = 1 << 12  # distinct values of a feature that are counted one by one
GATHERED = 128  # tasks whose sums are added up on the driver, below 40 MB; of more, on the executors
LOSS = -1  # key of the held-out loss among the nodes' sums


class Block(NamedTuple):
    place: tuple[int, int]  # partition and number in it
    held_out: bool
    words: np.ndarray  # one line a word, one column a row
    pair: np.ndarray  # number of the row's (label, weight)
    margin: np.ndarray


# --- bins ---------------------------------------------------------------------


def merged(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values with their counts; of more than ``HELD`` values, those next to
    each other stand together under the largest, about equal counts in each."""
    distinct, place = np.unique(values, return_inverse=True)
    counts = np.bincount(place, counts, len(distinct))
    if len(distinct) <= HELD:
        return distinct, counts
    before = counts.cumsum() - counts
    last = np.flatnonzero(np.diff(before * HELD // counts.sum(), append=HELD))
    return distinct[last], np.diff(counts.cumsum()[last], prepend=0)


COUNTS = "feature int, values array<double>, counts array<double>"


def value_counts(rows: DataFrame, size: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Values of each element of the array column ``features`` with their counts, over
    all rows; exact up to ``HELD`` distinct values, ranks of about 1 / ``HELD`` beyond."""

    def lines(found: list[tuple[int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        kinds = (pa.int32(), pa.list_(pa.float64()), pa.list_(pa.float64()))
        return pa.RecordBatch.from_arrays([pa.array(list(x), k) for x, k in zip(zip(*found), kinds)], ["feature", "values", "counts"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[] for _ in range(size)]
        for batch in batches:
            values = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            for f, parts in enumerate(held):
                parts.append(np.unique(values[:, f], return_counts=True))
                if len(parts) > 1 and sum(len(v) for v, _ in parts) > 16 * HELD:
                    parts[:] = [merged(*map(np.concatenate, zip(*parts)))]
        if any(held):
            yield lines([(f, *merged(*map(np.concatenate, zip(*parts)))) for f, parts in enumerate(held)])

    def add(table: pa.Table) -> pa.Table:
        values, counts = (pa.concat_arrays(table[c].chunks).flatten().to_numpy() for c in ("values", "counts"))
        return pa.Table.from_batches([lines([(table["feature"][0].as_py(), *merged(values, counts))])])

    counted = rows.select("features").mapInArrow(count, COUNTS).groupBy("feature").applyInArrow(add, COUNTS)
    found = {r["feature"]: (np.array(r["values"]), np.array(r["counts"])) for r in counted.collect()}
    return [found.get(f, (np.zeros(0), np.zeros(0))) for f in range(size)]


def cuts(distinct: np.ndarray, counts: np.ndarray, max_bins: int) -> np.ndarray:
    """Thresholds between values: between all of them, or, if these are more than the
    bins, where bins hold about equal numbers of rows."""
    place = np.arange(len(distinct))
    if len(distinct) > max_bins:
        reached = counts.cumsum()
        place = np.unique(np.searchsorted(reached, reached[-1] * np.arange(1, max_bins) / max_bins))
    place = place[place < len(distinct) - 1]
    # halves are added, as the sum of two large values may not be a number
    between = distinct[place] / 2 + distinct[place + 1] / 2
    return np.where(between < distinct[place + 1], between, distinct[place])


@dataclass(frozen=True)
class Layout:
    """Where the bin of each feature lies: word, shift and number of bits."""

    cuts: list[np.ndarray]
    word: np.ndarray
    shift: np.ndarray
    bits: np.ndarray
    words: int

    @classmethod
    def of(cls, cut_points: list[np.ndarray]) -> Layout:
        bits = np.array([len(c).bit_length() for c in cut_points])
        word, shift, used = np.zeros_like(bits), np.zeros_like(bits), [0]
        for f in np.argsort(-bits, kind="stable"):
            at = next((i for i, n in enumerate(used) if n + bits[f] <= WORD_BITS), len(used))
            if at == len(used):
                used.append(0)
            word[f], shift[f] = at, used[at]
            used[at] += int(bits[f])
        return cls(cut_points, word, shift, bits, len(used))

    @property
    def bins(self) -> int:
        return 1 << int(self.bits.max())

    def pack(self, values: np.ndarray) -> np.ndarray:
        """Words of rows; ``values``: one line a row."""
        words = np.zeros((self.words, len(values)), np.uint16)
        for f, cut in enumerate(self.cuts):
            if len(cut):
                words[self.word[f]] |= (np.searchsorted(cut, values[:, f]) << self.shift[f]).astype(np.uint16)
        return words

    def per_bin(self, sums: np.ndarray) -> np.ndarray:
        """(node, feature, bin) from (word, node, value of the word)."""
        nodes = sums.shape[1]
        found = np.zeros((nodes, len(self.cuts), self.bins))
        for f, (w, shift, bits) in enumerate(zip(self.word, self.shift, self.bits)):
            found[:, f, : 1 << bits] = sums[w].reshape(nodes, -1, 1 << bits, 1 << shift).sum((1, 3))
        return found


def packed(rows: DataFrame, layout: Layout, pairs: list[tuple[float, float]], held_out: bool) -> RDD:
    """Blocks of rows with columns ``features`` (array), ``label``, ``weight``, ``margin``."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(start, BLOCK_ROWS)
                label, weight, margin = (part.column(c).to_numpy(zero_copy_only=False) for c in ("label", "weight", "margin"))
                values = part.column("features").flatten().to_numpy(zero_copy_only=False).reshape(len(label), -1)
                pair = np.zeros(len(label), np.uint8)
                for i, (a, b) in enumerate(pairs):
                    pair[(label == a) & (weight == b)] = i
                made = (layout.pack(values), pair, margin.astype(float))
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in made], ["words", "pair", "margin"])

    def blocks(lines: Iterator) -> Iterator[Block]:
        partition = TaskContext.get().partitionId()
        for i, line in enumerate(lines):
            pair = np.frombuffer(line.pair, np.uint8)
            words = np.frombuffer(line.words, np.uint16).reshape(layout.words, len(pair))
            yield Block((partition, i), held_out, words, pair, np.frombuffer(line.margin, float))

    return rows.mapInArrow(pack, "words binary, pair binary, margin binary").rdd.mapPartitions(blocks)


# --- a tree -------------------------------------------------------------------


@dataclass
class Node:
    """Sums of its sampled rows; a split, if it has children."""

    rows: float
    weight: float
    total: float
    squares: float = math.nan  # unknown in a leaf that no pass counted
    feature: int = -1
    bin: int = 0
    gain: float = 0.0
    left: Node | None = None
    right: Node | None = None

    @property
    def prediction(self) -> float:
        return self.total / self.weight if self.weight else 0.0

    @property
    def impurity(self) -> float:
        return self.squares / self.weight - self.prediction**2 if self.weight else 0.0


@dataclass(frozen=True)
class Growing:
    """How one tree is grown; ``seed`` decides its rows and its nodes' features."""

    max_depth: int
    feature_share: float
    min_rows: int
    seed: int


def best_split(node: Node, sums: np.ndarray, layout: Layout, features: np.ndarray, min_rows: int) -> bool:
    """Split a node where the variance falls most; ``sums``: residuals, weights and
    rows per feature and bin.  False if no split helps."""
    left = sums[:, features, :].cumsum(-1)[:, :, :-1]
    right = np.array([node.total, node.weight, node.rows])[:, None, None] - left
    places = np.array([len(c) for c in layout.cuts])[features, None]
    allowed = (np.arange(left.shape[2]) < places) & (np.minimum(left[2], right[2]) >= min_rows) & (np.minimum(left[1], right[1]) > 0)
    if not allowed.any():
        return False
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = (left[0] ** 2 / left[1] + right[0] ** 2 / right[1] - node.total**2 / node.weight) / node.weight
    gain = np.where(allowed, gain, -np.inf)
    f, b = np.unravel_index(gain.argmax(), gain.shape)
    if gain[f, b] <= 0:
        return False
    node.feature, node.bin, node.gain = int(features[f]), int(b), float(gain[f, b])
    node.left, node.right = (Node(float(x[2, f, b]), float(x[1, f, b]), float(x[0, f, b])) for x in (left, right))
    return True


def levels(root: Node, layout: Layout) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per level, the word that each place looks at, and the place its value leads to.
    A node that ends early is its own left child."""
    made, at = [], {0: root}
    while any(n.left for n in at.values()):
        word, to = np.zeros(1 << len(made), np.intp), np.arange(1 << len(made))[:, None] * 2 + np.zeros(WORD, np.intp)
        below = {}
        for place, node in at.items():
            if node.left:
                f = node.feature
                word[place] = layout.word[f]
                to[place] += ((np.arange(WORD) >> layout.shift[f]) & ((1 << int(layout.bits[f])) - 1)) > node.bin
                below[2 * place], below[2 * place + 1] = node.left, node.right
            else:
                below[2 * place] = node
        made.append((word, to.ravel()))
        at = below
    return made


def leaves(root: Node, depth: int) -> dict[int, Node]:
    at = {0: root}
    for _ in range(depth):
        at = {p: n for q, m in at.items() for p, n in ([(2 * q, m.left), (2 * q + 1, m.right)] if m.left else [(2 * q, m)])}
    return at


def walked(words: np.ndarray, tables: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Place of each row below the last of these levels."""
    n = words.shape[1]
    place, column, flat = np.zeros(n, np.intp), np.arange(n), words.ravel()
    for word, to in tables:
        place = to.take((place << WORD_BITS) + flat.take((word * n).take(place) + column))
    return place


def residuals(sign: np.ndarray, margin: np.ndarray) -> np.ndarray:
    """Negative gradient of the logistic loss at the margin."""
    with np.errstate(over="ignore"):
        return 4 * sign / (1 + np.exp(2 * sign * margin))


class Rows:
    """The packed rows of a boosting: passes over them, and their margins."""

    def __init__(self, rows: RDD, held_out: RDD, layout: Layout, pairs: list[tuple[float, float]], row_share: float):
        self.layout, self.row_share = layout, row_share
        self.parts = [x.persist(StorageLevel.MEMORY_AND_DISK) for x in (rows, held_out)]
        self.sign = np.array([1.0 if label == 1 else -1.0 for label, _ in pairs])
        self.weight = np.array([w for _, w in pairs])
        self.before: list[RDD] = []
        self.written: list[str] = []

    def _sums(self, tree: Node, slot: np.ndarray, slots: int, seed: int, loss: bool = False) -> dict[int, np.ndarray]:
        """Per slot, residuals, weights and rows of each feature and bin, then the squares.
        ``slot``: the slot of each place below the tree so far, -1 if it is not counted."""
        layout, sign, weight, row_share = self.layout, self.sign, self.weight, self.row_share

        def add(blocks: Iterator[Block]) -> Iterator[tuple[int, np.ndarray]]:
            sums, squares, lost = np.zeros((3, layout.words, slots * WORD)), np.zeros(slots), np.zeros(2)
            tables, counted, chosen = levels(tree, layout), False, []

            def count() -> None:
                at, weights, weighted = (np.concatenate([x[i] for x in chosen]) for i in range(3))
                for w in range(layout.words):
                    cell = at + np.concatenate([x[3][w] for x in chosen])
                    sums[0, w] += np.bincount(cell, weighted, slots * WORD)
                    sums[1, w] += np.bincount(cell, weights, slots * WORD)
                    sums[2, w] += np.bincount(cell, minlength=slots * WORD)
                chosen.clear()

            for block in blocks:
                if block.held_out:
                    if loss:
                        signs, weights = sign.take(block.pair), weight.take(block.pair)
                        lost += (2 * np.logaddexp(0, -2 * signs * block.margin)) @ weights, weights.sum()
                    continue
                counted = True
                at = slot.take(walked(block.words, tables))
                taken = at >= 0
                if row_share < 1:
                    draw = np.random.Generator(np.random.SFC64([seed, *block.place]))
                    taken &= draw.random(len(at), np.float32) < row_share
                i = np.flatnonzero(taken)
                at, pair = at.take(i), block.pair.take(i)
                weights, gradient = weight.take(pair), residuals(sign.take(pair), block.margin.take(i))
                weighted = gradient * weights
                squares += np.bincount(at, weighted * gradient, slots)
                chosen.append((at << WORD_BITS, weights, weighted, block.words.take(i, 1)))
                if sum(len(x[0]) for x in chosen) >= COUNTED_ROWS:
                    count()
            if chosen:
                count()
            if loss:
                yield LOSS, lost
            if counted:
                per = np.stack([layout.per_bin(x.reshape(layout.words, slots, WORD)) for x in sums], 1)
                for s in range(slots):
                    yield s, np.append(per[s].ravel(), squares[s])

        blocks = self.parts[0].context.union(self.parts) if loss else self.parts[0]
        made = blocks.mapPartitions(add)
        if blocks.getNumPartitions() > GATHERED:
            made = made.reduceByKey(operator.add, min(slots + loss, blocks.context.defaultParallelism))
        sums: dict[int, np.ndarray] = {}
        for s, found in made.collect():
            sums[s] = sums[s] + found if s in sums else found
        return sums

    def _split_sums(self, found: np.ndarray) -> tuple[np.ndarray, float]:
        return found[:-1].reshape(3, len(self.layout.cuts), self.layout.bins), float(found[-1])

    def root(self, seed: int) -> tuple[np.ndarray | None, float]:
        """Sums at the root of the tree with this seed, and the loss of the held-out rows."""
        found = self._sums(Node(0, 0, 0), np.zeros(1, np.intp), 1, seed, loss=True)
        lost, weight = found.pop(LOSS)
        return found.get(0), float(lost / weight) if weight else math.nan

    def tree(self, growing: Growing, at_root: np.ndarray | None) -> Node:
        """Grow one tree from the sums at its root."""
        if at_root is None:
            return Node(0, 0, 0)
        sums, squares = self._split_sums(at_root)
        total, weight, rows = sums[:, 0].sum(-1)
        root = Node(rows, weight, total, squares)
        draw, size = np.random.default_rng([growing.seed, 1]), len(self.layout.cuts)
        chosen = int(np.ceil(round(growing.feature_share * size, 6)))
        open_nodes = {0: (root, sums)}
        for depth in range(growing.max_depth):
            split = {}
            for place, (node, sums) in open_nodes.items():
                features = np.sort(draw.permutation(size)[:chosen])
                if best_split(node, sums, self.layout, features, growing.min_rows):
                    split[place] = (node, sums)
            # children that may be split again; the smaller is counted, the other is the rest
            if depth + 1 == growing.max_depth:
                break
            split = {p: x for p, x in split.items() if max(x[0].left.rows, x[0].right.rows) >= 2 * growing.min_rows}
            if not split:
                break
            smaller = {p: (2 * p, n.left) if n.left.rows <= n.right.rows else (2 * p + 1, n.right) for p, (n, _) in split.items()}
            slot = np.full(2 << depth, -1, np.intp)
            for s, (place, _) in enumerate(smaller.values()):
                slot[place] = s
            found = self._sums(root, slot, len(smaller), growing.seed)
            open_nodes = {}
            for s, (p, (node, sums)) in enumerate(split.items()):
                place, child = smaller[p]
                counted, child.squares = self._split_sums(found[s])
                other = node.right if child is node.left else node.left
                other.squares = max(node.squares - child.squares, 0.0)
                open_nodes[place], open_nodes[place ^ 1] = (child, counted), (other, sums - counted)
        return root

    def move(self, tree: Node, by: float, write: bool) -> None:
        """Add ``by`` times the answers of a tree to the margins; the old ones go with
        ``moved``, after the next pass.  ``write``: that pass ends their lineage in a file."""
        layout = self.layout

        def add(blocks: Iterator[Block]) -> Iterator[Block]:
            tables = levels(tree, layout)
            answer = np.zeros(1 << len(tables))
            for place, node in leaves(tree, len(tables)).items():
                answer[place] = by * node.prediction
            for block in blocks:
                yield block._replace(margin=block.margin + answer.take(walked(block.words, tables)))

        self.before, self.parts = self.parts, [x.mapPartitions(add).persist(StorageLevel.MEMORY_AND_DISK) for x in self.parts]
        if write:
            for x in self.parts:
                x.checkpoint()

    def moved(self) -> None:
        for x in self.before:
            x.unpersist()
        if files := [f for x in self.parts if (f := x.getCheckpointFile())]:
            self._delete()
            self.written = files

    def _delete(self) -> None:
        context = self.parts[0].context
        for file in self.written:
            path = context._jvm.org.apache.hadoop.fs.Path(file)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
        self.written = []

    def close(self) -> None:
        for x in self.parts:
            x.unpersist()
        self._delete()


def model_of(root: Node, layout: Layout, name: str):
    """The tree as Spark's regression tree (inside the JVM)."""
    jvm, gateway = SparkContext._active_spark_context._jvm, SparkContext._gateway

    def made(node: Node):
        sums = gateway.new_array(gateway.jvm.double, 3)
        sums[0], sums[1], sums[2] = float(node.weight), float(node.total), float(node.squares)
        held = jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator(sums, int(node.rows))
        if node.left is None:
            return jvm.org.apache.spark.ml.tree.LeafNode(node.prediction, node.impurity, held)
        cut = jvm.org.apache.spark.ml.tree.ContinuousSplit(node.feature, float(layout.cuts[node.feature][node.bin]))
        return jvm.org.apache.spark.ml.tree.InternalNode(
            node.prediction, node.impurity, node.gain, made(node.left), made(node.right), cut, held
        )

    return jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel(name, made(root), len(layout.cuts))
