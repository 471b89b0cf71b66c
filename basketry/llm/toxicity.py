"""Toxicity scores from a learned lexicon, misspellings and context.

The lexicon is learned from labelled documents: words, and beginnings of words
(``stem*``), that toxic documents have far more often than others, among ever other neighbours.
Its entries
form a trie.  A word is read by the Levenshtein automaton of the word, whose
states are walked along the trie, so all entries within one edit are found in
one walk; words that cannot be that near are told apart by their halves first.
Each hit is judged by what is around it: between an opening mark and the closing
mark that belongs to it, it counts as quoted, and the words of a window around it
count for use or for report as they were learned to from the labelled documents.
A logistic model of the hits by kind gives the score.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.shared import fold, save
from basketry.llm.worker import claim, giving_back

LABELLED = 20_000  # labelled documents that are learned from, at most (by hash of the id)
ENTRIES = 5_000  # of the lexicon, at most: those with the most evidence
STEMS = range(4, 9)  # lengths of word beginnings
FUZZY_LENGTH = 5  # shorter entries are matched exactly
EVIDENCE = 12.0  # n * divergence from the base rate, in nats, that an entry needs
WINDOW = 6  # words before and after a hit
QUOTED = 40  # words between two marks that belong together, at most
CONTEXT = 2_000  # words around hits with a weight, at most: those with the most evidence
SURE = 6.0  # evidence, in nats, that a word around hits needs
REMEMBERED = 300_000  # words a worker remembers

# Opening marks of quotation with the marks that close them.
CLOSED_BY = {'"': '"', "'": "'", "«": "»", "“": "”", "„": "“", "‘": "’", "‹": "›"}
STOPS = ".,;:!?()[]{}<>*…-"
EDGES = STOPS + "\"'«“„‘‹»”’›"


@dataclass
class Trie:
    """Lexicon entries; ``end`` marks a whole word, ``stem`` a beginning."""

    after: list[dict[str, int]] = field(default_factory=lambda: [{}])
    end: list[bool] = field(default_factory=lambda: [False])
    stem: list[bool] = field(default_factory=lambda: [False])
    fuzzy: list[bool] = field(default_factory=lambda: [False])

    def add(self, entry: str) -> None:
        word, node = entry.removesuffix("*"), 0
        for ch in word:
            if ch not in self.after[node]:
                self.after[node][ch] = len(self.after)
                self.after.append({})
                for flags in (self.end, self.stem, self.fuzzy):
                    flags.append(False)
            node = self.after[node][ch]
        (self.stem if entry.endswith("*") else self.end)[node] = True
        self.fuzzy[node] = len(word) >= FUZZY_LENGTH

    def distance(self, word: str, most: int) -> int | None:
        """The fewest edits, up to ``most``, from an entry to the word (to a
        beginning of the word, for a stem); None: there is no such entry."""
        best = None
        size = len(word)
        # a state of the word's automaton: the edits at each place of the word
        stack = [(0, list(range(size + 1)))]
        while stack:
            node, row = stack.pop()
            found = []
            if self.end[node]:
                found.append(row[size])
            if self.stem[node]:
                found.append(min(row))
            for edits in found:
                if edits <= (most if self.fuzzy[node] else 0) and (best is None or edits < best):
                    best = edits
            if best == 0:
                return 0
            for ch, child in self.after[node].items():
                new = [row[0] + 1]
                for j in range(size):
                    new.append(min(row[j] + (word[j] != ch), row[j + 1] + 1, new[j] + 1))
                if min(new) <= most:
                    stack.append((child, new))
        return best


def _deletions(word: str) -> list[str]:
    return [word, *(word[:i] + word[i + 1 :] for i in range(len(word)))]


class Matcher:
    """Edits from a word to the lexicon, with a memory.  Words that share no
    deletion with an entry are more than one edit away and are not walked."""

    def __init__(self, entries: list[str]):
        self.trie = Trie()
        self.words: set[str] = set()
        self.stems: dict[int, set[str]] = {}
        self.heads: set[str] = set()
        self.middles: dict[int, set[str]] = {}
        for entry in entries:
            self.trie.add(entry)
            word = entry.removesuffix("*")
            some = _deletions(word) if len(word) >= FUZZY_LENGTH else [word]
            (self.stems.setdefault(len(word), set()) if entry.endswith("*") else self.words).update(some)
            # one edit leaves the first half at its place or the second half within one of it
            half = len(word) // 2
            self.heads.add(word[:2])
            for at in (half - 1, half, half + 1):
                self.middles.setdefault(at, set()).add(word[half : half + 3])
        self.lengths = range(min(map(len, self.words), default=0), max(map(len, self.words), default=-2) + 2)
        self.known: dict[str, int | None] = {}

    def _possible(self, word: str) -> bool:
        if word[:2] not in self.heads and not any(word[at : at + 3] in some for at, some in self.middles.items()):
            return False
        if len(word) in self.lengths and not self.words.isdisjoint(_deletions(word)):
            return True
        for length, some in self.stems.items():
            if len(word) >= length - 1:
                for n in (length, length - 1, length + 1):
                    if not some.isdisjoint(_deletions(word[:n])):
                        return True
        return False

    def edits(self, token: str) -> int | None:
        word = token.strip(EDGES)
        return self.trie.distance(word, 1) if word and self._possible(word) else None

    def hits(self, tokens: list[str]) -> list[tuple[int, int]]:
        """``(place, edits)`` of the tokens near an entry."""
        distinct, known = set(tokens), self.known
        if len(known) > REMEMBERED:
            known.clear()
        for token in [t for t in distinct if t not in known]:
            known[token] = self.edits(token)
        near = {t: known[t] for t in distinct if known[t] is not None}
        return [(i, near[t]) for i, t in enumerate(tokens) if t in near] if near else []


def quoted_places(tokens: list[str]) -> set[int]:
    """Places of the words between an opening mark and the mark that closes it, at
    most ``QUOTED`` words on.  A mark opens at the beginning of a word and closes
    at the end of one; a mark by itself closes what it can and opens otherwise.
    An apostrophe after a word closes nothing unless one was opened."""
    out: set[int] = set()
    opened: dict[str, int] = {}  # closing mark: where the opening one is
    for i, token in enumerate(tokens):
        if token.isalnum():
            continue
        core = token.strip(STOPS)
        if not core:
            continue
        first, last = core[0], core[-1]
        alone = len(core) == 1
        opens = first in CLOSED_BY and not (alone and first in opened)
        if opens:
            opened[CLOSED_BY[first]] = i
        if last in opened and not (alone and opens):
            start = opened.pop(last)
            if i - start <= QUOTED:
                out.update(range(start, i + 1))
    return out


def around(tokens: list[str], place: int) -> Iterator[str]:
    """The words of the window around a place: ``word>`` before it, ``>word`` after."""
    for token in tokens[max(0, place - WINDOW) : place]:
        yield f"{token.strip(EDGES)}>"
    for token in tokens[place + 1 : place + WINDOW + 1]:
        yield f">{token.strip(EDGES)}"


def hit_features(tokens: list[str], hits: list[tuple[int, int]], context: dict[str, float]) -> list[float]:
    """Logarithms of the hits by kind: exact or misspelled, used or quoted; the
    mean weight of the words around a hit; and the share of used ones in the text.

    A hit whose surroundings weigh against use is neither added to nor taken
    from its kind: the weight is a feature of its own."""
    if not hits:
        return [0.0] * FEATURES
    used, quoted, told = [0, 0], [0, 0], 0.0
    inside = quoted_places(tokens)
    for i, edits in hits:
        (quoted if i in inside else used)[edits > 0] += 1
        told += max(-4.0, min(4.0, sum(context.get(w, 0.0) for w in set(around(tokens, i)))))
    share = 100 * sum(used) / max(20, len(tokens))
    return [*(float(np.log1p(x)) for x in (*used, *quoted)), told / len(hits), float(np.log1p(share))]


FEATURES = 6


def _terms(words: list[str]) -> Iterator[tuple[str, str]]:
    """``(term, its neighbours)`` of the words and beginnings of words of a text."""
    edged = ["", *words, ""]
    for i, word in enumerate(words):
        around = f"{edged[i]} {edged[i + 2]}"
        if 2 < len(word) <= 40:
            yield word, around
        for n in STEMS:
            if len(word) > n:
                yield f"{word[:n]}*", around


def term_counts(labelled: DataFrame, least: float) -> DataFrame:
    """``(term, toxic, clean)`` of ``labelled (text, toxic)``: how many toxic
    documents have each term, or in how many different pairs of neighbours if
    that is less, and how many other documents have it outside quotation.  So what
    copies of one toxic text share is evidence once, and a term that others quote is
    none the weaker.  Terms below ``least`` are left out."""

    def words_of(text: str | None) -> list[str]:
        return [w for t in (text or "").lower().split() if (w := t.strip(EDGES))]

    @giving_back
    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("toxicity")
        for batch in batches:
            for text in batch.column(0).to_pylist():
                found = sorted(set(_terms(words_of(text))))
                first = [i == 0 or found[i - 1][0] != t for i, (t, _) in enumerate(found)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([t for t, _ in found], pa.string()), pa.array([a for _, a in found], pa.string()),
                        pa.array(np.array(first, np.int64)),
                    ],
                    ["term", "around", "first"],
                )

    toxic = labelled.filter("toxic > 0").select("text").mapInArrow(places, "term string, around string, first long")
    toxic = toxic.groupBy("term", "around").agg(F.sum("first").alias("texts"))
    toxic = toxic.groupBy("term").agg(F.least(F.count("*"), F.sum("texts")).alias("toxic")).filter(F.col("toxic") >= least)
    toxic = save(toxic, "terms")
    # the sample is bounded, and so are the terms that several of its toxic documents have
    candidates = labelled.sparkSession.sparkContext.broadcast(frozenset(toxic.toArrow()["term"].to_pylist()))

    @giving_back
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("toxicity")
        total, asked = Counter(), candidates.value
        for batch in batches:
            for text in batch.column(0).to_pylist():
                tokens = (text or "").lower().split()
                words = {t.strip(EDGES) for t in set(tokens)}
                if (words & asked) or any(f"{w[:n]}*" in asked for w in words for n in STEMS if len(w) > n):
                    inside = quoted_places(tokens)
                    words = {t.strip(EDGES) for i, t in enumerate(tokens) if i not in inside}
                found = words & asked
                for n in STEMS:
                    found |= {f"{w[:n]}*" for w in words if len(w) > n} & asked
                total.update(found)
        terms = list(total)
        yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array([total[t] for t in terms], pa.int64())], ["term", "clean"])

    clean = labelled.filter("toxic <= 0").select("text").mapInArrow(count, "term string, clean long")
    clean = clean.groupBy("term").agg(F.sum("clean").alias("clean"))
    return toxic.join(clean, "term", "left").fillna(0, ["clean"])


def chosen_entries(counts: dict[str, int]) -> list[str]:
    """Terms by their evidence, longer ones first; without those that begin with
    a chosen one and those that add little to a longer chosen one."""
    out: list[str] = []
    begun: dict[str, int] = {}  # the most evidence of a chosen entry with this beginning
    for term in sorted(counts, key=lambda t: (-counts[t], -len(t.removesuffix("*")), t)):
        word = term.removesuffix("*")
        if any(f"{word[:n]}*" in out for n in range(1, len(word) + 1)):
            continue
        if term.endswith("*") and begun.get(word, 0) >= 0.95 * counts[term]:
            continue
        out.append(term)
        for n in range(1, len(word) + 1):
            begun[word[:n]] = max(begun.get(word[:n], 0), counts[term])
    return out


@dataclass
class ToxicityModel:
    entries: list[str]
    context: dict[str, float]  # weights of words around hits
    weights: list[float]  # of the features, the last one constant


def logistic_weights(x: np.ndarray, y: np.ndarray, penalty: float = 1e-2, rounds: int = 60) -> np.ndarray:
    """Newton's method with a small ridge penalty; the constant is last."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    ridge = np.diag([penalty] * (x.shape[1] - 1) + [1e-6])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return w


def context_weights(rows: DataFrame, entries: list[str]) -> dict[str, float]:
    """Words around hits, with the logarithm of the odds of toxic documents there
    against the odds that the hit words alone let expect (so a word is not made
    suspect by the language or the entry it goes with); ``rows (text, toxic)`` is
    the bounded sample.  A word counts once a document and hit word."""

    @giving_back
    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("toxicity")
        matcher = Matcher(entries)
        counts: dict[tuple[str, str], list[int]] = {}
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                tokens = (text or "").lower().split()
                found = {(tokens[i].strip(EDGES), w) for i, _ in matcher.hits(tokens) for w in ("", *around(tokens, i))}
                for key in found:  # the empty word stands for every hit
                    counts.setdefault(key, [0, 0])[toxic > 0] += 1
        keys = list(counts)
        columns = [pa.array([k[j] for k in keys], pa.string()) for j in (0, 1)]
        columns += [pa.array([counts[k][j] for k in keys], pa.int64()) for j in (1, 0)]
        yield pa.RecordBatch.from_arrays(columns, ["hit", "word", "toxic", "clean"])

    found = rows.select("text", "toxic").mapInArrow(collect, "hit string, word string, toxic long, clean long")
    found = save(found.groupBy("hit", "word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")), "context")
    expected = found.filter("word = ''").select("hit", (F.col("toxic") / (F.col("toxic") + F.col("clean"))).alias("rate"))
    n = F.col("toxic") + F.col("clean")
    sums = found.filter("word <> ''").join(expected, "hit").groupBy("word")
    sums = sums.agg(F.sum(n).alias("n"), F.sum("toxic").alias("o"), F.sum(n * F.col("rate")).alias("e"))
    n, o, e = F.col("n"), F.col("o"), F.col("e")
    part = lambda x, y: F.when((x > 0) & (y > 0), x * F.log(x / y)).otherwise(0.0)
    evidence = part(o, e) + part(n - o, n - e)
    weight = F.log((o + 1) / (n - o + 1)) - F.log((e + 1) / (n - e + 1))
    best = sums.select("word", weight.alias("weight"), evidence.alias("evidence")).filter(F.col("evidence") >= SURE)
    return {r.word: r.weight for r in best.orderBy(F.desc("evidence"), "word").limit(CONTEXT).collect()}


def _features(rows: DataFrame, entries: list[str], context: dict[str, float]) -> DataFrame:
    @giving_back
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("toxicity")
        matcher = Matcher(entries)
        for batch in batches:
            values = []
            for text in batch.column(0).to_pylist():
                tokens = (text or "").lower().split()
                values.append(hit_features(tokens, matcher.hits(tokens), context))
            yield pa.RecordBatch.from_arrays([pa.array(values, pa.list_(pa.float64())), batch.column(1)], ["features", "toxic"])

    return rows.select("text", "toxic").mapInArrow(measure, "features array<double>, toxic int")


def train_toxicity(docs: DataFrame, labels: DataFrame, most: int = LABELLED) -> ToxicityModel:
    """Learn from the labelled documents whose crc32(doc_id) modulo 5 is not 0.

    At most ``most`` of them, the first by a hash of the id, are read: a stated
    bound.  A null label is none; a document labelled twice is toxic if either
    says so.  Without toxic or without other documents the score is constant.
    """
    usable = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (fold("doc_id", 5) != 0))
    usable = usable.groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    sample = usable.orderBy(F.xxhash64("_id"), "_id").limit(most)  # bounded, so it is broadcast
    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), "text")
    labelled = texts.join(F.broadcast(sample), "_id")
    by_label = {r.toxic > 0: r["count"] for r in sample.groupBy((F.col("toxic") > 0).cast("int").alias("toxic")).count().collect()}
    toxic, clean = by_label.get(True, 0), by_label.get(False, 0)
    if not toxic or not clean:
        return ToxicityModel([], {}, [0.0] * FEATURES + [30.0 if toxic else -30.0])
    base = toxic / (toxic + clean)
    flagged = labelled.withColumn("toxic", (F.col("toxic") > 0).cast("int"))
    counts = term_counts(flagged, EVIDENCE / float(np.log(1 / base)))
    n = F.col("toxic") + F.col("clean")
    rate = F.col("toxic") / n
    other = F.when(rate < 1, (1 - rate) * F.log((1 - rate) / (1 - base))).otherwise(0.0)
    evidence = n * (rate * F.log(rate / base) + other)
    strong = counts.filter("toxic > 0").filter((rate >= max(0.8, base)) & (evidence >= EVIDENCE))
    best = strong.orderBy(F.desc(evidence), "term").limit(ENTRIES).collect()
    entries = chosen_entries({r.term: r.toxic for r in best})
    context = context_weights(flagged, entries)
    rows = _features(labelled, entries, context).toArrow()
    x = np.array(rows["features"].to_pylist(), float).reshape(-1, FEATURES)
    y = (rows["toxic"].to_numpy() > 0).astype(float)
    return ToxicityModel(entries, context, logistic_weights(x, y).tolist())


def with_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on).

    The score depends on the text alone.  Null, empty and blank texts have the
    score of a text without hits.  All columns are kept; columns of these two
    names are replaced.
    """
    columns = [c for c in docs.columns if c not in ("score", "predicted")]
    place = columns.index("text")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @giving_back
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("toxicity")
        model = shared.value
        matcher, weights = Matcher(model.entries), np.array(model.weights)
        for batch in batches:
            scores = np.zeros(batch.num_rows)
            for i, text in enumerate(batch.column(place).to_pylist()):
                tokens = (text or "").lower().split()
                x = np.array([*hit_features(tokens, matcher.hits(tokens), model.context), 1.0])
                scores[i] = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
            predicted = pa.array((scores >= 0.5).astype(np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores), predicted], [*columns, "score", "predicted"])

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns)
    return docs.select(*columns).mapInArrow(score, f"{kinds}, score double, predicted int")
