"""Removal of word passages that an earlier document already has.

A window is 50 consecutive words; the words of a window that also starts in a
document with a smaller doc_id go.  Suffix automata of reference shards find
those windows:

1. Every window has an anchor, the smallest hash among its ten-word sequences.
   Consecutive windows with one anchor are a run.  Equal windows have equal
   anchors, so only runs that share an anchor can share a window, whatever
   document they are in.
2. Runs whose anchor one document alone has are done.  Equal runs become one
   content, with the smallest doc_id that has it; an anchor with one content
   needs no more.
3. An anchor whose contents have more words than a shard (a phrase inside many
   different texts) is done by window: the 128-bit digests of its windows are
   grouped to their smallest doc_id, with sums before the shuffle, so neither a
   frequent anchor nor a frequent window is one task's work.
4. The other contents are dealt into shards by anchor.  A task builds the suffix
   automaton of its shard's contents over words, each state with the smallest
   doc_id among its occurrences, and streams the contents through it: where the
   matching statistics reach 50 words, the state of those 50 words tells the
   first document that has the window.
5. Runs take the answers of their content, and documents the spans of their runs.

An automaton is met only by the contents of its shard, so it goes to one task,
not to all: a broadcast automaton would grow with the corpus.  No anchor brings more than
``SHARD_WORDS`` words to a shard.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.shared import save
from basketry.llm.words import hashed_texts, mix, sequence_hashes
from basketry.llm.worker import claim, giving_back

GRAM = 10  # words of an anchor
NOBODY = (1 << 63) - 1
SHARD_WORDS = 30_000  # of one automaton, about
_STEP = np.uint64(0xD1342543DE82EF95)
_BACK = np.uint64(pow(0xD1342543DE82EF95, -1, 2**64))


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` consecutive numbers."""
    done = 1
    while 2 * done <= width:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    return np.minimum(x[: len(x) - (width - done)], x[width - done :]) if done < width else x


def _prefix_numbers(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of a polynomial over words, and what undoes the place."""
    up = np.full(len(numbers) + 1, _STEP, np.uint64)
    down = np.full(len(numbers) + 1, _BACK, np.uint64)
    up[0] = down[0] = 1
    np.multiply.accumulate(up, out=up)
    np.multiply.accumulate(down, out=down)
    total = np.zeros(len(numbers) + 1, np.uint64)
    np.cumsum(mix(numbers) * up[:-1], out=total[1:])
    return total, down


def text_runs(column: pa.Array, window: int) -> Iterator[tuple[np.ndarray, ...]]:
    """``(row, anchor, content, first window, windows)`` of the runs of a string
    column, as arrays; ``content`` is a hash of the run's words."""
    gram = min(GRAM, window)
    for first, offsets, numbers in hashed_texts(column, lower=False):
        if len(numbers) < window:
            continue
        anchors = _sliding_min(sequence_hashes(numbers, gram), window - gram + 1)
        row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(anchors)]
        inside = np.arange(len(anchors)) + window <= offsets[1:][row]
        edge = np.ones(len(anchors), bool)
        edge[1:] = (anchors[1:] != anchors[:-1]) | (row[1:] != row[:-1])
        starts = np.flatnonzero(edge & inside)
        if not len(starts):
            continue
        run = np.cumsum(edge) - 1
        counts = np.bincount(run[inside], minlength=run[-1] + 1)[run[starts]]
        total, down = _prefix_numbers(numbers)
        ends = starts + counts + window - 1
        content = mix((total[ends] - total[starts]) * down[starts] + counts.astype(np.uint64))
        rows = row[starts]
        yield first + rows, anchors[starts], content, starts - offsets[rows], counts


def window_runs(docs: DataFrame, window: int) -> DataFrame:
    """``(doc_id, version, anchor, content, first, windows)`` of ``docs (doc_id, text, version)``."""

    @giving_back
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("substring")
        for batch in batches:
            for rows, anchor, content, first, windows in text_runs(batch.column(1), window):
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(rows)), batch.column(2).take(pa.array(rows)),
                        pa.array(anchor.view(np.int64)), pa.array(content.view(np.int64)),
                        pa.array(first.astype(np.int32)), pa.array(windows.astype(np.int32)),
                    ],
                    ["doc_id", "version", "anchor", "content", "first", "windows"],
                )

    return docs.mapInArrow(find, "doc_id long, version long, anchor long, content long, first int, windows int")


class SuffixAutomaton:
    """Suffix automaton of several sequences of word numbers; every state has the
    smallest number among the sequences in which its words occur.

    States are rows of flat arrays.  Most states have one transition, which is in
    ``word`` and ``to``; further ones are in ``more``."""

    def __init__(self):
        self.word, self.to, self.more = array("i", [-1]), array("i", [-1]), {}
        self.link, self.length, self.least = array("i", [-1]), array("i", [0]), array("q", [NOBODY])

    def _after(self, state: int, word: int) -> int:
        """The state that ``word`` leads to; -1: there is none."""
        if self.word[state] == word:
            return self.to[state]
        more = self.more.get(state)
        return more.get(word, -1) if more else -1

    def _lead(self, state: int, word: int, target: int) -> None:
        if self.word[state] == word or self.word[state] < 0:
            self.word[state], self.to[state] = word, target
        else:
            self.more.setdefault(state, {})[word] = target

    def _state(self, length: int, link: int) -> int:
        for values, new in ((self.word, -1), (self.to, -1), (self.link, link), (self.length, length), (self.least, NOBODY)):
            values.append(new)
        return len(self.link) - 1

    def _split(self, state: int, target: int, word: int) -> int:
        """The part of ``target`` that is as long as ``state`` and one word."""
        part = self._state(self.length[state] + 1, self.link[target])
        self.word[part], self.to[part], self.least[part] = self.word[target], self.to[target], self.least[target]
        if target in self.more:
            self.more[part] = dict(self.more[target])
        self.link[target] = part
        while state >= 0 and self._after(state, word) == target:
            self._lead(state, word, part)
            state = self.link[state]
        return part

    def add(self, words: array, number: int) -> None:
        last = 0
        for word in words:
            target = self._after(last, word)
            if target >= 0:
                if self.length[target] != self.length[last] + 1:
                    target = self._split(last, target, word)
                last = target
            else:
                state, last = last, self._state(self.length[last] + 1, 0)
                while state >= 0 and (target := self._after(state, word)) < 0:
                    self._lead(state, word, last)
                    state = self.link[state]
                if state >= 0:
                    if self.length[target] != self.length[state] + 1:
                        target = self._split(state, target, word)
                    self.link[last] = target
            if number < self.least[last]:
                self.least[last] = number

    def finish(self) -> None:
        """Pass the smallest numbers on to the states of shorter words."""
        least, link = self.least, self.link
        for state in np.argsort(-np.array(self.length), kind="stable").tolist():
            if state and least[state] < least[link[state]]:
                least[link[state]] = least[state]

    def firsts(self, words: array, window: int) -> Iterator[tuple[int, int]]:
        """``(start, smallest number)`` of every window of ``words`` that occurs."""
        state = matched = 0
        link, length = self.link, self.length
        for i, word in enumerate(words):
            after = self._after(state, word)
            while state and after < 0:
                state = link[state]
                matched = length[state]
                after = self._after(state, word)
            if after >= 0:
                state, matched = after, matched + 1
            if matched >= window:
                while length[link[state]] >= window:
                    state = link[state]
                    matched = length[state]
                yield i + 1 - window, self.least[state]


def _contents_with_words(docs: DataFrame, contents: DataFrame, window: int) -> DataFrame:
    """``(anchor, content, first_doc, words, frequent)`` of ``contents (anchor, content,
    first_doc, first, frequent)``; ``words`` are joined by a blank."""

    @giving_back
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("substring")
        for batch in batches:
            wanted = batch.column(2).to_pylist()
            asked = [{(w["content"], w["first"]): w["frequent"] for w in some} for some in wanted]
            out = {"anchor": [], "content": [], "first_doc": [], "words": [], "frequent": []}
            texts: dict[int, list[str]] = {}
            for rows, anchors, found, firsts, windows in text_runs(batch.column(1), window):
                values = zip(rows.tolist(), anchors.view(np.int64).tolist(), found.view(np.int64).tolist(), firsts.tolist(), windows.tolist())
                for row, anchor, content, first, n in values:
                    if (content, first) in asked[row]:
                        if row not in texts:
                            texts = {row: batch.column(1)[row].as_py().encode().split()}
                        out["anchor"].append(anchor)
                        out["content"].append(content)
                        out["first_doc"].append(batch.column(0)[row].as_py())
                        out["words"].append(b" ".join(texts[row][first : first + n + window - 1]).decode())
                        out["frequent"].append(asked[row][content, first])
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds)], list(out))

    wanted = F.collect_list(F.struct("content", "first", "frequent")).alias("wanted")
    lists = contents.groupBy(F.col("first_doc").alias("doc_id")).agg(wanted)
    joined = docs.join(lists, "doc_id").select("doc_id", "text", "wanted")
    return joined.mapInArrow(cut, "anchor long, content long, first_doc long, words string, frequent boolean")


def first_documents(contents: DataFrame, window: int) -> DataFrame:
    """``(content, firsts)``: for every window of ``contents (anchor, content,
    first_doc, words)`` the smallest first_doc of a content that has it too."""
    total = contents.select(F.sum(F.length("words") / 6)).first()[0] or 0
    shards = 1 + int(total) // SHARD_WORDS

    def match(pdf: pd.DataFrame) -> pd.DataFrame:
        codes: dict[bytes, int] = {}
        rows = [
            (c, d, array("i", [codes.setdefault(x, len(codes)) for x in w.encode().split()]))
            for c, d, w in zip(pdf["content"], pdf["first_doc"], pdf["words"])
        ]
        automaton = SuffixAutomaton()
        for _, first_doc, words in rows:
            automaton.add(words, first_doc)
        automaton.finish()
        found = []
        for _, _, words in rows:
            firsts = np.zeros(len(words) - window + 1, np.int64)
            for start, least in automaton.firsts(words, window):
                firsts[start] = least
            found.append(firsts)
        return pd.DataFrame({"content": [r[0] for r in rows], "firsts": found})

    shard = F.pmod(F.xxhash64("anchor"), F.lit(shards)).alias("shard")
    dealt = contents.select(shard, "content", "first_doc", "words")
    return dealt.groupBy("shard").applyInPandas(match, "content long, firsts array<long>")


def first_documents_by_window(contents: DataFrame, window: int) -> DataFrame:
    """What ``first_documents`` finds, from the digests of single windows."""

    @giving_back
    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("substring")
        names = ["content", "first_doc", "start", "digest"]

        def rows(content: list, first_doc: list, start: list, digest: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(content, pa.int64()), pa.array(first_doc, pa.int64()), pa.array(start, pa.int32()), pa.array(digest, pa.binary())], names)

        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [])
            for content, first_doc, words in zip(*(batch.column(i).to_pylist() for i in range(3))):
                words = words.encode().split()
                for start in range(len(words) - window + 1):
                    row = content, first_doc, start, hashlib.md5(b" ".join(words[start : start + window])).digest()
                    for values, value in zip(out, row):
                        values.append(value)
                    if len(out[0]) >= 100_000:
                        yield rows(*out)
                        out = ([], [], [], [])
            if out[0]:
                yield rows(*out)

    @giving_back
    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("substring")
        for batch in batches:
            found = []
            for first_doc, n, some in zip(*(batch.column(i).to_pylist() for i in range(1, 4))):
                firsts = np.full(n, first_doc, np.int64)
                for s in some or []:
                    firsts[s["start"]] = s["least"]
                found.append(firsts)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], ["content", "firsts"])

    windows = contents.select("content", "first_doc", "words").mapInArrow(digests, "content long, first_doc long, start int, digest binary")
    least = windows.groupBy("digest").agg(F.min("first_doc").alias("least"), F.max("first_doc").alias("most"))
    earlier = windows.join(least.filter("least < most").select("digest", "least"), "digest").filter("least < first_doc")
    lists = earlier.groupBy("content").agg(F.collect_set(F.struct("start", "least")).alias("earlier"))
    count = (F.size(F.split("words", " ")) - (window - 1)).alias("windows")
    whole = contents.select("content", "first_doc", count).join(lists, "content", "left")
    return whole.mapInArrow(fill, "content long, firsts array<long>")


def repeated_spans(docs: DataFrame, window: int = 50) -> DataFrame:
    """``(doc_id, version, spans)``: the word ranges ``(low, high)`` of each text
    that windows cover which an earlier document has; ``version`` is the hash of
    the text.  Texts without any are left out, and rows without doc_id, which
    neither have nor cause spans."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("version"))
    docs = docs.filter("doc_id is not null")
    runs = save(window_runs(docs, window), "runs")
    shared = runs.groupBy("anchor").agg(F.min("doc_id").alias("one"), F.max("doc_id").alias("other")).filter("one < other")
    live = save(runs.join(shared.select("anchor"), "anchor", "left_semi"), "live-runs")
    # the smallest document of a content, and where it has it
    contents = live.groupBy("anchor", "content").agg(
        F.min(F.struct("doc_id", "first")).alias("at"), F.max("doc_id").alias("last"), F.max("windows").alias("windows")
    )
    contents = save(contents.select("anchor", "content", "at.doc_id", "at.first", "last", "windows"), "contents")
    size = F.sum(F.col("windows") + (window - 1))  # words of all contents of an anchor
    several = contents.groupBy("anchor").agg(F.count("*").alias("n"), (size > SHARD_WORDS).alias("frequent")).filter("n > 1")
    mixed = contents.join(several.select("anchor", "frequent"), "anchor")
    mixed = mixed.select("anchor", "content", F.col("doc_id").alias("first_doc"), "first", "frequent")
    words = save(_contents_with_words(docs, mixed, window), "contents")
    alone = contents.join(several.select("anchor"), "anchor", "left_anti").filter("doc_id < last")
    alone = alone.select("content", F.array_repeat("doc_id", F.col("windows")).alias("firsts"))
    by_shard = first_documents(words.filter("not frequent"), window)
    by_window = first_documents_by_window(words.filter("frequent"), window)
    firsts = save(by_shard.unionByName(by_window).unionByName(alone), "firsts")

    @giving_back
    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("substring")
        for batch in batches:
            docs_, first = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            lists, version = batch.column(2), batch.column(3)
            values, lengths = lists.flatten().to_numpy(), np.diff(lists.offsets.to_numpy())
            owner = np.repeat(np.arange(batch.num_rows), lengths)
            start = np.arange(len(owner)) - np.repeat(np.cumsum(lengths) - lengths, lengths) + first[owner]
            hit = values < docs_[owner]
            owner, start = owner[hit], start[hit]
            new = np.ones(len(owner), bool)
            new[1:] = (owner[1:] != owner[:-1]) | (start[1:] != start[:-1] + 1)
            at = np.flatnonzero(new)
            last = np.append(at[1:], len(owner)) - 1 if len(at) else at
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(docs_[owner[at]]), version.take(pa.array(owner[at])),
                    pa.array(start[at].astype(np.int64)), pa.array((start[last] + window).astype(np.int64)),
                ],
                ["doc_id", "version", "low", "high"],
            )

    told = live.join(firsts, "content").select("doc_id", "first", "firsts", "version")
    found = told.mapInArrow(spans, "doc_id long, version long, low long, high long")
    return found.groupBy("doc_id", "version").agg(F.collect_set(F.struct("low", "high")).alias("spans"))


def without_repeats(docs: DataFrame, window: int = 50) -> DataFrame:
    """``docs`` with ``kept_text`` (kept words joined by one blank), ``n_words``
    and ``n_removed``; all columns are kept, and columns of these names replaced.

    Words are ``[^\\x20\\x09-\\x0D]+``, unchanged.  A word goes if a window of 50
    words covers it whose words also start in a document with a smaller doc_id,
    judged on the input.  Texts of fewer words lose nothing; a null or empty text
    has no words.  A row without doc_id is kept whole.  Rows that repeat a
    doc_id don't take words from each other.
    """
    added = ["kept_text", "n_words", "n_removed"]
    columns = [c for c in docs.columns if c not in added]
    spans = save(repeated_spans(docs, window), "spans").toDF("_doc", "_version", "_spans")

    @giving_back
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("substring")
        for batch in batches:
            texts, counts, removed = [], [], []
            for text, some in zip(batch.column(1), batch.column(2)):
                words = (text.as_py() or "").encode().split()
                counts.append(len(words))
                gone = np.zeros(len(words) + 1, np.int32)
                for s in some.as_py() or []:
                    gone[s["low"]] += 1
                    gone[s["high"]] -= 1
                covered = np.cumsum(gone[:-1]) > 0
                removed.append(int(covered.sum()))
                texts.append(b" ".join(w for w, c in zip(words, covered.tolist()) if not c).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string()), pa.array(counts, pa.int64()), pa.array(removed, pa.int64())],
                ["_row", *added],
            )

    row = F.struct(*columns).alias("_row")
    plain = docs.select(row, F.col("text").alias("_text"), F.col("doc_id").cast("long").alias("_id"), F.xxhash64("text").alias("_key"))
    same = (F.col("_id") == F.col("_doc")) & (F.col("_key") == F.col("_version"))
    joined = plain.join(spans, same, "left").select("_row", "_text", "_spans")
    kind = joined.schema["_row"].dataType.simpleString()
    kept = joined.mapInArrow(keep, f"_row {kind}, kept_text string, n_words long, n_removed long")
    return kept.select("_row.*", *added)
