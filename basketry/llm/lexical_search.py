"""Ranked lexical search by NRA (no random access) over impact-sorted lists.

The index divides the documents into slices of bounded size.  In a slice every
term has one list of its documents, highest impact first.  The impact depends on
the number of documents and of terms in all slices, so scores of different slices
compare.  A search joins the lists with the terms of the queries and deals them
out by (slice, block of queries).  There NRA reads all lists of a query at the same
depth: what was read is a document's lower bound; the impacts reached in the
lists where it was not seen yet make its upper bound.  It goes on, four times as
deep each turn, until no unseen document can reach the k-th best and every
document that can has equal bounds: membership, ties and scores are final.  The
best k of a slice are exact, so the best k of all slices are too.

Nothing depends on the number of queries or of documents that share a term: a
frequent term is one bounded list in each slice.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.shared import save

#: Maximal runs of letters, digits and all that is not ASCII; A-Z is lower-cased before.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_TERM_BYTES = re.compile(rb"[0-9a-z\x80-\xff]+")  # the same in lower-cased UTF-8
SLICE_DOCUMENTS = 1 << 16  # at most: places are 16-bit numbers
SLICE_PAIRS = 2_000_000  # (term, document) pairs of a slice; one more document may go in
BLOCK_ITEMS = 256  # queries of a block, about
FIRST_DEPTH = 64
_STREAMED = 4 << 20  # longer texts are not split into a list of terms

FOUND = [("item_id", pa.int64()), ("item", pa.string()), ("doc_id", pa.int64()), ("score", pa.int64())]
INDEX = "slice long, term string, documents long, places binary, impacts binary, ids array<long>"


def _terms(text: bytes) -> Counter:
    text = text.lower()  # bytes: A-Z alone
    if len(text) < _STREAMED:
        return Counter(_TERM_BYTES.findall(text))
    return Counter(m.group() for m in _TERM_BYTES.finditer(text))


def corpus_size(docs: DataFrame) -> tuple[int, int]:
    """``(N, L)``: documents with at least one term, and all their terms."""
    n = F.regexp_count(F.col("text"), F.lit(TERM)).cast("long")
    row = docs.select(n.alias("n")).agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    return int(row[0]), int(row[1])


class _Slice:
    """Documents of a slice, gathered until it is full."""

    def __init__(self):
        self.ids: list[int | None] = []
        self.sizes: list[int] = []
        self.numbers: dict[bytes, int] = {}
        self.rows: list[tuple[np.ndarray, np.ndarray]] = []
        self.pairs = 0

    def add(self, doc_id: int | None, terms: Counter) -> None:
        number = self.numbers
        which = np.fromiter((number.setdefault(t, len(number)) for t in terms), np.int32, len(terms))
        self.rows.append((which, np.fromiter(terms.values(), np.int64, len(terms))))
        self.ids.append(doc_id)
        self.sizes.append(sum(terms.values()))
        self.pairs += len(terms)

    def lists(self, name: int, all_documents: int, all_terms: int) -> Iterator[pa.RecordBatch]:
        """A row with the ids (null term), then one row per term.  Places follow
        the order of doc_id, null last, so they break ties of scores as ids do."""
        order = sorted(range(len(self.ids)), key=lambda i: (self.ids[i] is None, self.ids[i] or 0))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        counts = [len(w) for w, _ in self.rows]
        term = np.concatenate([w for w, _ in self.rows])
        tf = np.concatenate([t for _, t in self.rows])
        size = np.repeat(np.array(self.sizes, np.int64), counts)
        where = np.repeat(place, counts)
        m = 75 + 25 * size * all_documents // all_terms
        impact = 1_000_000_000 * tf // (1000 * tf + 12 * m)  # below 10**6
        by = np.lexsort((where, -impact, term))
        places, impacts = where[by].astype("<u2"), impact[by].astype("<i4")
        ends = np.cumsum(np.bincount(term, minlength=len(self.numbers)))
        yield _index_rows([name], [None], [len(order)], [b""], [b""], [[self.ids[i] for i in order]])
        names = list(self.numbers)
        for low in range(0, len(names), 8192):
            part = range(low, min(low + 8192, len(names)))
            cuts = [(int(ends[t - 1]) if t else 0, int(ends[t])) for t in part]
            yield _index_rows(
                [name] * len(cuts), [names[t].decode() for t in part], [b - a for a, b in cuts],
                [places[a:b].tobytes() for a, b in cuts], [impacts[a:b].tobytes() for a, b in cuts], [None] * len(cuts),
            )


def _index_rows(*columns) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64())]
    names = ["slice", "term", "documents", "places", "impacts", "ids"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def build_index(docs: DataFrame) -> tuple[DataFrame, int]:
    """The stored index of ``docs (doc_id, text)`` and the number of documents in it.

    Documents without terms (null, empty, or only other characters) are not in
    it.  Rows that repeat a doc_id are documents of their own; a null doc_id is a
    document like any other.
    """
    all_documents, all_terms = corpus_size(docs)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, made, held = TaskContext.get().partitionId() << 32, 0, _Slice()
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for i in range(batch.num_rows):
                terms = _terms(texts[i].as_py() or b"")
                if terms:
                    held.add(ids[i].as_py(), terms)
                if held.pairs >= SLICE_PAIRS or len(held.ids) == SLICE_DOCUMENTS:
                    yield from held.lists(base + made, all_documents, all_terms)
                    made, held = made + 1, _Slice()
        if held.ids:
            yield from held.lists(base + made, all_documents, all_terms)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return save(rows.mapInArrow(build, INDEX), "index"), all_documents


def query_terms(items: DataFrame) -> tuple[DataFrame, int]:
    """``(block, term, uses)`` with ``uses`` an array of ``(item_id, item, times)``
    of one block, and the number of blocks.  Rows equal in ``item_id`` and ``text``
    are one query; ``item`` tells apart those with one id and different texts."""
    kept = items.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("text IS NOT NULL").distinct()
    blocks = 1 + kept.count() // BLOCK_ITEMS
    lowered = F.translate("text", ascii_uppercase, ascii_lowercase)
    terms = kept.select(
        "item_id", F.md5("text").alias("item"), F.explode(F.regexp_extract_all(lowered, F.lit(TERM), F.lit(0))).alias("term")
    )
    times = terms.groupBy("item_id", "item", "term").agg(F.count("*").alias("times"))
    block = F.pmod(F.xxhash64("item_id", "item"), F.lit(blocks))
    use = F.struct("item_id", "item", "times")
    return times.groupBy(block.alias("block"), "term").agg(F.collect_list(use).alias("uses")), blocks


def nra(lists: list[tuple[np.ndarray, np.ndarray, int]], documents: int, k: int) -> list[tuple[int, int]]:
    """The best ``k`` of a slice, as ``(place, score)``, all if fewer have a score above 0.

    ``lists``: ``(places, impacts, weight)`` of each term of the query, impacts
    descending and above 0, weights above 0.
    """
    lower = np.zeros(documents, np.int64)
    depth, read = FIRST_DEPTH, 0
    while True:
        for places, impacts, weight in lists:
            lower[places[read:depth]] += impacts[read:depth].astype(np.int64) * weight  # a document is in a list once
        reached = [int(impacts[depth - 1]) * weight if depth < len(impacts) else 0 for _, impacts, weight in lists]
        unseen = sum(reached)  # the most that a document can have which no list has shown
        seen = np.flatnonzero(lower)
        best = int(np.partition(lower[seen], -k)[-k]) if len(seen) >= k else 0
        if not unseen or unseen < best:
            spare = np.full(documents, unseen, np.int64)
            for (places, _, _), value in zip(lists, reached):
                if value:
                    spare[places[:depth]] -= value
            can = seen[lower[seen] + spare[seen] >= best]
            if not spare[can].any():
                ranked = can[np.lexsort((can, -lower[can]))][:k]
                return [(int(p), int(lower[p])) for p in ranked]
        read, depth = depth, depth * 4


def search(index: DataFrame, all_documents: int, items: DataFrame, k: int = 20) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` documents with the highest
    scores above 0 for every query of ``items (item_id, text)``.

    Equal scores are ordered by doc_id, null last.  A query without terms, or
    without any term of the corpus, has no rows.  Other columns are not read.
    """
    terms, blocks = query_terms(items)
    terms = save(terms, "terms")
    wanted = index.join(terms.select("term").distinct(), "term", "left_semi")
    wanted = save(wanted, "lists")
    df = wanted.groupBy("term").agg(F.sum("documents").alias("df"))
    ratio = (2.0 * all_documents + 2) / (2 * F.col("df") + 1)
    weight = F.floor(1000 * F.log(ratio)).cast("long")
    weighed = terms.join(df, "term").select("term", "block", "uses", weight.alias("weight")).filter("weight > 0")
    lists = wanted.join(weighed, "term").select("slice", "block", "documents", "places", "impacts", "ids", "weight", "uses")
    every_block = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))
    heads = index.filter("term IS NULL").select(
        "slice", every_block.alias("block"), "documents", "places", "impacts", "ids",
        F.lit(None).cast("long").alias("weight"), F.lit(None).cast(weighed.schema["uses"].dataType).alias("uses"),
    )

    def best(group: pa.Table) -> pa.Table:
        ids, queries = [], {}
        for row in group.select(["ids", "places", "impacts", "weight", "uses"]).to_batches(max_chunksize=1024):
            for r in row.to_pylist():
                if r["uses"] is None:
                    ids = r["ids"]
                    continue
                where, impact = np.frombuffer(r["places"], "<u2"), np.frombuffer(r["impacts"], "<i4")
                for use in r["uses"]:
                    key = (use["item_id"], use["item"])
                    queries.setdefault(key, []).append((where, impact, r["weight"] * use["times"]))
        out = [
            (item_id, item, ids[place], score)
            for (item_id, item), lists in queries.items()
            for place, score in nra(lists, len(ids), k)
        ]
        columns = list(zip(*out)) or [[], [], [], []]
        return pa.table({c: pa.array(v, t) for (c, t), v in zip(FOUND, columns)})

    found = lists.unionByName(heads).groupBy("slice", "block").applyInArrow(
        best, "item_id long, item string, doc_id long, score long"
    )
    order = Window.partitionBy("item_id", "item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
