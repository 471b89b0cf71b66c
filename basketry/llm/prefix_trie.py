"""Trie of conversation prefixes in balanced parentheses.

A conversation is a sequence of turns; each turn is a 16-byte digest of role and
text, so a conversation is a path of digests and equal prefixes are equal bytes.
Equal paths are one weighted path.  The paths are range-partitioned in
byte order, and each partition is cut into shards of a bounded number of nodes.  A
shard's trie is a sequence of parentheses in depth-first order: ``findclose``,
by minima of blocks of excess and a tree over them, delimits the subtree
of a node; the rank of ``()`` between the two places counts its leaves;
differences of cumulative arrays give members and savings.

Only nodes on a shard's first and last path (its spines) can go on in another
shard.  All other nodes are final.  The spines, with what hangs from their nodes
in sums, are paths again: they are merged by the same step, level by level, until
one shard is left.  A level turns a shard of at least ``MIN_PATHS`` paths into
two, so the levels are few.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.shared import save

KEY = 16  # bytes of a turn's digest, and of a node's
SHARD_NODES = 50_000  # nodes of the paths of a shard; one more path may go in
MIN_PATHS = 8
BLOCK = 64  # parentheses of a block
HASH_CHUNK = 1 << 16  # bytes of ids joined before they are shuffled
NO_MEMBERS = hashlib.sha256(b"").hexdigest()
#: What each node of a path brings along: words of its turn, conversations that end in it, and of the
#: subtrees that hang from it elsewhere: conversations, children, leaves, savings, smallest conversation.
WORDS, ENDS, MEMBERS, CHILDREN, LEAVES, SAVED, SMALLEST = range(7)
NOBODY = np.iinfo(np.int64).max

LEVEL = (
    "node binary, depth long, conv_id long, parent binary, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, path binary, notes binary"
)
_KINDS = [pa.binary(), pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 5, pa.binary(), pa.binary()]
_NAMES = [part.split()[0] for part in LEVEL.split(", ")]
ROOT = hashlib.sha256(b"root").digest()[:KEY]


def _below(node: bytes, turn: bytes) -> bytes:
    """The digest of the node that ``turn`` leads to."""
    return hashlib.sha256(node + turn).digest()[:KEY]


def find_close(excess: np.ndarray, opens: np.ndarray) -> np.ndarray:
    """The place of the parenthesis that closes each one in ``opens``.

    It is the first later place with the excess that stood before the opening
    one.  The rest of its own block is searched first; then the tree of block
    minima leads to the next block that goes so low, and that block is searched.
    """
    blocks = -(-len(excess) // BLOCK)
    leaves = 1 << max(0, blocks - 1).bit_length()
    padded = np.full(leaves * BLOCK, np.iinfo(np.int32).max, np.int32)
    padded[: len(excess)] = excess
    least = np.empty(2 * leaves, np.int32)
    least[leaves:] = padded.reshape(leaves, BLOCK).min(axis=1)
    for node in range(leaves.bit_length() - 2, -1, -1):  # levels of the tree, upwards
        low = 1 << node
        least[low : 2 * low] = np.minimum(least[2 * low : 4 * low : 2], least[2 * low + 1 : 4 * low : 2])
    goal = excess[opens] - 1
    found = np.full(len(opens), -1, np.int64)

    def scan(which: np.ndarray, start: np.ndarray) -> None:
        """Look for the goals in the rest of the blocks that hold ``start``."""
        at = start.copy()
        while len(which):
            hit = padded[at] <= goal[which]
            found[which[hit]] = at[hit]
            at = at + 1
            go = ~hit & (at % BLOCK != 0)
            which, at = which[go], at[go]

    first = opens + 1
    inside = np.flatnonzero(first % BLOCK != 0)
    scan(inside, first[inside])
    rest = np.flatnonzero(found < 0)
    block = opens[rest] // BLOCK + leaves
    climbing = np.arange(len(rest))
    while len(climbing):  # up until a right sibling goes low enough
        here = block[climbing]
        right = np.where(here % 2 == 0, here + 1, 0)
        hit = (right > 0) & (least[right] <= goal[rest[climbing]])
        block[climbing] = np.where(hit, right, here // 2)
        climbing = climbing[~hit]
    while (block < leaves).any():  # down to the leftmost such block
        inner = block < leaves
        left = 2 * block[inner]
        block[inner] = np.where(least[left] <= goal[rest[inner]], left, left + 1)
    scan(rest, (block - leaves) * BLOCK)
    return found


def least_in_ranges(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Minimum of ``values[low:high]`` for each range, by minima over powers of two."""
    out = np.empty(len(low), values.dtype)
    size = high - low
    table, width = values, 1
    while True:
        now = np.flatnonzero((size >= width) & (size < 2 * width))
        out[now] = np.minimum(table[low[now]], table[high[now] - width])
        if 2 * width > size.max():
            return out
        table = np.minimum(table[:-width], table[width:])
        width *= 2


class Shard:
    """The trie of consecutive paths in byte order."""

    def __init__(self):
        self.paths: list[bytes] = []
        self.shared: list[int] = []  # nodes that a path has in common with the one before, root included
        self.notes: list[np.ndarray] = []
        self.nodes = 0

    def add(self, path: bytes, notes: np.ndarray) -> None:
        shared = 0
        if self.paths:
            last, n = self.paths[-1], min(len(self.paths[-1]), len(path))
            same = np.frombuffer(last, np.uint8, n) == np.frombuffer(path, np.uint8, n)
            shared = 1 + int(n if same.all() else np.argmin(same)) // KEY
        self.paths.append(path)
        self.shared.append(shared)
        self.notes.append(notes)
        self.nodes += notes.shape[1]

    def full(self) -> bool:
        return self.nodes >= SHARD_NODES and len(self.paths) >= MIN_PATHS

    def rows(self, last: bool) -> Iterator[pa.RecordBatch]:
        """Final nodes, and unless this is the last shard its two spines."""
        sizes = np.array([x.shape[1] for x in self.notes])  # nodes of a path, root included
        shared = np.array(self.shared)
        new = sizes - shared
        # a path closes what it doesn't share with the one before and opens its own
        closes = np.append(sizes[:-1] - shared[1:], sizes[-1])
        signs = np.repeat(np.tile([1, -1], len(sizes)), np.column_stack([new, closes]).ravel()).astype(np.int32)
        excess = np.cumsum(signs, dtype=np.int32)
        opens = np.flatnonzero(signs > 0)
        depth = excess[opens].astype(np.int64) - 1
        shut = find_close(excess, opens)
        upto = np.cumsum(signs > 0)  # nodes opened so far
        first, end = upto[opens] - 1, upto[shut]  # a subtree's range among the nodes

        notes = np.concatenate([x[:, s:] for x, s in zip(self.notes, self.shared)], axis=1)
        begins = np.concatenate([[0], np.cumsum(new)])
        line = np.arange(int(sizes.max()))
        for i, (x, s) in enumerate(zip(self.notes, self.shared)):  # nodes of earlier paths, met again
            if x[ENDS:SMALLEST, :s].any() or (x[SMALLEST, :s] != NOBODY).any():
                held = line[:s]
                notes[ENDS:SMALLEST, held] += x[ENDS:SMALLEST, :s]
                notes[SMALLEST, held] = np.minimum(notes[SMALLEST, held], x[SMALLEST, :s])
            line[s : s + new[i]] = np.arange(begins[i], begins[i + 1])

        def total(values: np.ndarray) -> np.ndarray:
            upto = np.concatenate([[0], np.cumsum(values)])
            return upto[end] - upto[first]

        members = total(notes[ENDS] + notes[MEMBERS])
        smallest = least_in_ranges(notes[SMALLEST], first, end)
        spine = np.zeros(len(opens), bool)
        if not last:
            spine[: sizes[0]] = True
            spine[line[: sizes[-1]]] = True
        parent = np.full(len(opens), -1, np.int64)
        chain: list[int] = []
        inner = np.zeros(len(opens), np.int64)
        for i, d in enumerate(depth.tolist()):
            del chain[d:]
            if chain:
                parent[i] = chain[-1]
            chain.append(i)
        own = parent[1:]
        np.add.at(inner, own, 1)
        children = inner + notes[CHILDREN]
        pair = np.append((signs[:-1] > 0) & (signs[1:] < 0), False)
        pairs = np.concatenate([[0], np.cumsum(pair)])
        leaf = pair[opens] & (notes[CHILDREN] == 0) & ~spine
        apart = total((pair[opens] & ~leaf).astype(np.int64))  # pairs that may go on in another shard
        leaves = pairs[shut] - pairs[opens] - apart + total(notes[LEAVES])
        gain = np.where(spine, 0, (members - 1) * notes[WORDS])
        saved = total(gain + notes[SAVED])

        keys: list[bytes] = []
        turns = [p[KEY * (d - 1) : KEY * d] for p, s, n in zip(self.paths, self.shared, sizes.tolist()) for d in range(s, n)]
        parents = parent.tolist()
        for i, turn in enumerate(turns):
            keys.append(_below(keys[parents[i]], turn) if parents[i] >= 0 else ROOT)

        final = np.flatnonzero(~spine)
        for low in range(0, len(final), 32_768):
            at = final[low : low + 32_768]
            up = parent[at]
            waits = (up < 0) | spine[up]  # the root has no parent; that of a spine's child is found later
            yield _rows(
                node=[keys[i] for i in at], depth=depth[at], conv_id=smallest[at],
                parent=[keys[i] if i >= 0 else None for i in up.tolist()],
                parent_conv_id=pa.array(smallest[up], pa.int64(), mask=waits),
                n_convs=members[at], n_children=children[at], n_leaves=leaves[at], saved_tokens=saved[at],
            )
        if not last:
            yield self._spines(line, sizes, parent, spine, notes, members, smallest, inner, leaves, saved)

    def _spines(self, line, sizes, parent, spine, notes, members, smallest, inner, leaves, saved) -> pa.RecordBatch:
        """First and last path; each spine node with the sums of what hangs from it
        apart from its child on a spine.  Nodes of both paths have their sums on the first."""
        hangs = np.zeros_like(notes)
        hangs[WORDS], hangs[ENDS] = notes[WORDS], notes[ENDS]
        on = np.flatnonzero(spine)
        hangs[MEMBERS, on] = members[on] - notes[ENDS, on]
        hangs[CHILDREN, on] = inner[on] + notes[CHILDREN, on]
        hangs[LEAVES, on], hangs[SAVED, on] = leaves[on], saved[on]
        below = on[parent[on] >= 0]
        for row, values in ((MEMBERS, members), (CHILDREN, np.ones_like(members)), (LEAVES, leaves), (SAVED, saved)):
            np.subtract.at(hangs[row], parent[below], values[below])
        # a smallest member may be counted again in a child on the spine: a minimum doesn't mind
        hangs[SMALLEST] = smallest
        one = np.arange(sizes[0])
        out = [(self.paths[0], hangs[:, one])]
        if len(self.paths) > 1:
            two = line[: sizes[-1]]
            again = hangs[:, two].copy()
            both = two < sizes[0]
            again[ENDS:SMALLEST, both] = 0
            out.append((self.paths[-1], again))
        return _rows(path=[p for p, _ in out], notes=[np.ascontiguousarray(x, "<i8").tobytes() for _, x in out])


def _rows(**columns) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    arrays = []
    for name, kind in zip(_NAMES, _KINDS):
        values = columns.get(name)
        arrays.append(pa.nulls(n, kind) if values is None else values if isinstance(values, pa.Array) else pa.array(values, kind))
    return pa.RecordBatch.from_arrays(arrays, _NAMES)


def _level(paths: DataFrame, last: bool) -> DataFrame:
    """Nodes and spines of ``paths (path, notes)``, which lie in byte order."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = Shard()
        for batch in batches:
            for path, notes in zip(batch.column(0), batch.column(1)):
                path = path.as_py()
                if not last and shard.full():
                    yield from shard.rows(last)
                    shard = Shard()
                shard.add(path, np.frombuffer(notes.as_buffer(), "<i8").reshape(7, len(path) // KEY + 1))
        if shard.paths:
            yield from shard.rows(last)

    return paths.select("path", "notes").mapInArrow(encode, LEVEL)


def rebuilt_turns(turns: DataFrame) -> DataFrame:
    """``(conv_id, place, turn, words)`` of every conversation: the first h turns of
    conversation ``conv_id - conv_id % 20``, then its own without their first h, with
    h = crc32(conv_id as text) % 4.  A conversation without a turn left has one
    row with a null ``turn``.

    Turns are ordered by ``turn``, null first, those of one number by the digest
    of role and text; null role or text is empty.  Rows without conv_id belong to
    no conversation.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    digest = F.unhex(F.substring(F.sha2(whole.cast("binary"), 256), 1, 2 * KEY))
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    given = turns.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("number"), digest.alias("turn"), words.alias("words")
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("number").asc_nulls_first(), "turn")
    numbered = save(given.select("conv_id", F.row_number().over(order).alias("place"), "turn", "words"), "turns")
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    heads = numbered.filter("place <= 3 AND conv_id % 20 = 0").withColumnRenamed("conv_id", "base")
    every = numbered.filter("place = 1").select("conv_id", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % 20).alias("base"))
    copied = every.join(heads, "base").filter("place <= h").select("conv_id", "place", "turn", "words")
    own = numbered.filter(F.col("place") > h)
    empty = every.select("conv_id", F.lit(0).alias("place"), F.lit(None).cast("binary").alias("turn"), F.lit(0).cast("long").alias("words"))
    return own.unionByName(copied).unionByName(empty)


PATHS = "conv_id long, path binary, words binary, node binary"


def conversation_paths(rebuilt: DataFrame) -> DataFrame:
    """``(conv_id, path, words, node)``: one row per conversation, with the digest of
    the node in which it ends.  A conversation's turns stream through one task in
    order; a row holds 24 bytes a turn."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, path, words, node = None, bytearray(), [], ROOT

        def row():
            return conv, bytes(path), np.array(words, "<i8").tobytes(), node

        for batch in batches:
            done = []
            for c, turn, count in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
                if c != conv:
                    if conv is not None:
                        done.append(row())
                    conv, path, words, node = c, bytearray(), [], ROOT
                if turn is not None:
                    path += turn
                    words.append(count)
                    node = _below(node, turn)
            if done:
                yield _path_rows(done)
        if conv is not None:
            yield _path_rows([row()])

    ordered = rebuilt.repartition("conv_id").sortWithinPartitions("conv_id", "place")
    return ordered.select("conv_id", "place", "turn", "words").mapInArrow(gather, PATHS)


def _path_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    arrays = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
    return pa.RecordBatch.from_arrays(arrays, ["conv_id", "path", "words", "node"])


def digests_of_ids(members: DataFrame) -> DataFrame:
    """``(node, ends_sha256)`` of ``members (node, conv_id)``: SHA-256 of the ids of a
    node in numeric order, joined by commas.  Ids are sorted over all tasks and joined
    to strings of 64 KB there; a node's strings then stream through one task, which
    holds one state of the hash."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, first, held, size = None, 0, [], 0
        for batch in batches:
            done = []
            for key, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if held and (key != node or size >= HASH_CHUNK):
                    done.append((node, first, ",".join(held)))
                    held, size = [], 0
                if not held:
                    node, first = key, conv
                held.append(str(conv))
                size += len(held[-1]) + 1
            if done:
                yield _chunks(done)
        if held:
            yield _chunks([(node, first, ",".join(held))])

    def _chunks(rows):
        arrays = [pa.array(c, k) for c, k in zip(zip(*rows), (pa.binary(), pa.int64(), pa.string()))]
        return pa.RecordBatch.from_arrays(arrays, ["node", "first", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, hashlib.sha256()
        for batch in batches:
            done = []
            for key, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if key != node:
                    if node is not None:
                        done.append((node, state.hexdigest()))
                    node, state = key, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if done:
                yield _digests(done)
        if node is not None:
            yield _digests([(node, state.hexdigest())])

    def _digests(rows):
        arrays = [pa.array(c, k) for c, k in zip(zip(*rows), (pa.binary(), pa.string()))]
        return pa.RecordBatch.from_arrays(arrays, ["node", "ends_sha256"])

    ordered = members.select("node", "conv_id").repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    chunks = ordered.mapInArrow(join, "node binary, first long, ids string")
    return chunks.repartition("node").sortWithinPartitions("node", "first").mapInArrow(digest, "node binary, ends_sha256 string")


def _noted(paths: DataFrame) -> DataFrame:
    """``(path, notes)`` of distinct paths with their members."""

    def note(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            notes = []
            for words, n, conv in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
                counts = np.frombuffer(words, "<i8")
                x = np.zeros((7, len(counts) + 1), "<i8")
                x[WORDS, 1:], x[SMALLEST], x[ENDS, -1], x[SMALLEST, -1] = counts, NOBODY, n, conv
                notes.append(x.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(notes, pa.binary())], ["path", "notes"])

    return paths.select("path", "words", "n", "conv_id").mapInArrow(note, "path binary, notes binary")


def prefix_trie(turns: DataFrame) -> DataFrame:
    """Every node of the trie of rebuilt conversations, from
    ``turns (conv_id, turn, role, text)``:

    ``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256)``.  An empty table has no nodes, not even a root.  Rows that repeat a
    turn are turns of their own.  Turns are compared by 128 bits of SHA-256.
    """
    convs = save(conversation_paths(rebuilt_turns(turns)), "paths")
    groups = convs.groupBy("path", "words").agg(F.count("*").alias("n"), F.min("conv_id").alias("conv_id"))
    paths = save(groups, "distinct-paths")
    levels, last = [], False
    nodes, count = _size(paths)
    ranged = _noted(paths.repartitionByRange("path").sortWithinPartitions("path"))
    while True:
        last = nodes <= SHARD_NODES or count <= MIN_PATHS
        if last and levels:
            ranged = paths.coalesce(1).sortWithinPartitions("path")
        elif last:
            ranged = _noted(paths.coalesce(1).sortWithinPartitions("path"))
        done = save(_level(ranged, last), "trie")
        levels.append(done.filter("node IS NOT NULL").drop("path", "notes"))
        if last:
            break
        paths = done.filter("path IS NOT NULL").select("path", "notes")
        nodes, count = _size(paths)
        parts = max(1, min(nodes // SHARD_NODES, count // (2 * MIN_PATHS)))
        ranged = paths.repartitionByRange(parts, "path").sortWithinPartitions("path")

    found = levels[0]
    for level in levels[1:]:
        found = found.unionByName(level)
    if len(levels) > 1:  # parents of the children of spines
        spines = levels[1]
        for level in levels[2:]:
            spines = spines.unionByName(level)
        known = spines.select(F.col("node").alias("asked"), F.col("conv_id").alias("late"))
        asked = F.when(F.col("parent_conv_id").isNull() & F.col("parent").isNotNull(), F.col("parent")).otherwise(F.col("node"))
        found = found.withColumn("asked", asked).join(known, "asked", "left")
        late = F.when(F.col("parent").isNotNull(), F.coalesce("parent_conv_id", "late"))
        found = found.withColumn("parent_conv_id", late)
    ends = found.join(digests_of_ids(convs), "node", "left")
    return ends.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(NO_MEMBERS)).alias("ends_sha256"),
    )


def _size(paths: DataFrame) -> tuple[int, int]:
    row = paths.agg(F.coalesce(F.sum(F.octet_length("path") / KEY + 1), F.lit(0)), F.count("*")).first()
    return int(row[0]), int(row[1])
