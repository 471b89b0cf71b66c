"""Katz back-off language model over words.

Tokens are the words of a text and one end.  ``c(h, w)`` counts in the training
documents that ``w`` follows ``h``; the first word follows a start.  With
Good-Turing discounts ``d`` (of counts up to 5) and an escape count ``e``

    P(w | h) = d(c(h, w)) c(h, w) / (c(h) + e)             if c(h, w) > 0
    P(w | h) = a(h) P(w)                                   else
    P(w)     = d1(c(w)) c(w) / (N + 1)                     if c(w) > 0
    P(?)     = what the words of the training documents leave, for any other word
    a(h)     = (1 - sum of P(w | h) over w seen after h) / (1 - sum of their P(w))

so all probabilities after any ``h`` add up to one exactly (``a(h) = 1`` for an
``h`` that was never seen).  The escape keeps ``a(h)`` positive where all counts
are too large to be discounted.

Tokens travel as 64-bit word numbers in packed arrays.  A dictionary of the heavy
words of all documents and frequent words of a bounded sample (these only shorten
the arrays) has 16-bit codes and exact counts over all training documents.  Pairs
whose second word is in it are dealt out by the pair, so a frequent word is not
one task's work; all others by the second word.  Heavy pairs have exact counts
too, and their tokens are dealt out by pair and flush, so a frequent pair is not
one task's work either: a pair or word that is not heavy has fewer than ``HEAVY``
tokens (beyond 60,000 heavy words, the rarer ones are dealt out like others), and
a heavy pair's tokens of one flush go to one group, drawn anew for each flush.  The task of a pair knows its
counts, writes its part of the n-gram tables, and returns its tokens by these
counts; a document's sums follow from them and from the discounts.  A token of a
document that no training document supports looks up ``a(h)`` in the tables by a
join.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.shared import fold, release, save
from basketry.llm.words import hashed_texts, mix
from basketry.llm.worker import claim, give_back

SAMPLE = 2_000  # documents whose words make the dictionary
CODES = 60_000  # words of the dictionary, at most
NONE = 0xFFFF  # code of a word that is not in it
FLUSH = 750_000  # tokens a task holds before it sends them on
BUCKET = 1_000_000  # tokens of one reduce group, about
HEAVY = BUCKET // 4  # tokens from which a word or pair is heavy
HIGHEST = 5  # counts up to this are discounted
ESCAPE = 0.1
START, END = (int(x) for x in mix(np.array([1, 2], np.uint64)))


def _tokens(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first row, offsets, numbers)``: the words and the end of every text."""
    for first, offsets, numbers in hashed_texts(column, lower=True):
        ends = offsets[1:]
        yield first, offsets + np.arange(len(offsets)), np.insert(numbers, ends, np.uint64(END))


def _coded(numbers: np.ndarray, dictionary: np.ndarray) -> np.ndarray:
    """16-bit codes of word numbers; NONE where the dictionary has none."""
    if not len(dictionary):
        return np.full(len(numbers), NONE, np.uint16)
    at = np.minimum(np.searchsorted(dictionary, numbers), len(dictionary) - 1)
    return np.where(dictionary[at] == numbers, at, NONE).astype(np.uint16)


def _squeezed(values: np.ndarray) -> bytes:
    """Numbers of one type, compressed byte place by byte place."""
    places = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize)
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(places.T).tobytes())


def _expanded(data: bytes, kind: str) -> np.ndarray:
    """What ``_squeezed`` was given."""
    places = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(places.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _bundle(*parts: np.ndarray) -> bytes:
    """Several arrays, each squeezed and after its length."""
    return b"".join(len(x).to_bytes(4, "little") + x for x in map(_squeezed, parts))


def _unbundled(data: bytes, *kinds: str) -> list[np.ndarray]:
    """The first arrays of a bundle."""
    parts, at = [], 0
    for kind in kinds:
        first = at + 4
        at = first + int.from_bytes(data[at:first], "little")
        parts.append(_expanded(data[first:at], kind))
    return parts


def _pair_numbers(words: np.ndarray, before: np.ndarray) -> np.ndarray:
    return mix(words * np.uint64(0x9E3779B97F4A7C15) + mix(before))


def _before(flat: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The upper 48 bits of the word before each token of texts laid end to end."""
    before = np.empty_like(flat)
    before[1:] = flat[:-1]
    before[np.cumsum(lengths) - lengths] = START
    before &= ~np.uint64(0xFFFF)
    return before


def _among(numbers: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each number is among the ascending ``known``, and its place there."""
    if not len(known):
        return np.zeros(len(numbers), bool), np.zeros(len(numbers), np.int64)
    at = np.minimum(np.searchsorted(known, numbers), len(known) - 1)
    return known[at] == numbers, at


def _pack_words(numbers: np.ndarray, codes: np.ndarray, size: int) -> bytes:
    """The numbers of uncoded words, ``size`` upper bytes each."""
    rest = numbers[codes == NONE]
    return np.ascontiguousarray(rest.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 8 - size :]).tobytes()


def _unpack_words(codes: np.ndarray, data: bytes, size: int, dictionary: np.ndarray) -> np.ndarray:
    out = np.zeros(len(codes), np.uint64)
    known = codes != NONE
    keep = ~np.uint64((1 << (64 - 8 * size)) - 1)
    out[known] = dictionary[codes[known]] & keep
    rest = np.zeros((int((~known).sum()), 8), np.uint8)
    rest[:, 8 - size :] = np.frombuffer(data, np.uint8).reshape(-1, size)
    out[~known] = rest.view("<u8").ravel()
    return out


def learned_from(docs: DataFrame) -> F.Column:
    """Whether a row is a training document: crc32(doc_id as text) modulo 7 is
    not 2; a row without doc_id is none."""
    return F.coalesce(fold("doc_id", 7) != 2, F.lit(False))


def frequent_words(docs: DataFrame) -> np.ndarray:
    """Numbers of the most frequent words of the first documents by hash of their id."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, numbers in _tokens(batch.column(0)):
                words, n = np.unique(numbers, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n)], ["word", "n"])

    ids = docs.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE).distinct()
    sample = docs.join(F.broadcast(ids), "doc_id").select("text")
    counts = sample.mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    words = counts.orderBy(F.desc("n"), "word").limit(CODES).toArrow()["word"].to_numpy()
    return np.sort(words.view(np.uint64))


@dataclass
class HeavyPairs:
    pairs: np.ndarray  # their numbers, ascending
    words: np.ndarray
    before: np.ndarray
    counts: np.ndarray  # in the training documents


CANDIDATE = "kind int, key long, word long, before long, n long"


def _most_frequent(parts: list[tuple], most: int) -> tuple:
    """Parts ``(key, word, before, n)`` as one of at most ``most`` keys.  What is
    taken from every ``n`` adds up to less than the tokens / (most + 1)."""
    key, word, before, n = (np.concatenate(c) for c in zip(*parts))
    keys, first, at = np.unique(key, return_index=True, return_inverse=True)
    total = np.zeros(len(keys), np.int64)
    np.add.at(total, at, n)
    if len(keys) > most:
        total -= np.partition(total, -most - 1)[-most - 1]
    some = total > 0
    return keys[some], word[first[some]], before[first[some]], total[some]


def heavy(docs: DataFrame, least: int) -> tuple[np.ndarray, HeavyPairs]:
    """Words and pairs of all documents: every one of ``least`` tokens or more,
    none of less than half as many; the pairs have no counts yet."""
    size = docs.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    most = max(1, 2 * ((size[0] or 0) // 2 + 2 * size[1]) // least)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("katz")
        kept: list[list[tuple]] = [[], []]
        new: list[tuple[np.ndarray, np.ndarray]] = []
        held = 0

        def merge() -> None:
            flat, before = (np.concatenate(c) for c in zip(*new))
            for kind, key in enumerate((flat, _pair_numbers(flat, before))):
                keys, first, n = np.unique(key, return_index=True, return_counts=True)
                kept[kind] = [_most_frequent([*kept[kind], (keys, flat[first], before[first], n)], most)]

        for batch in batches:
            for _, offsets, flat in _tokens(batch.column(0)):
                new.append((flat, _before(flat, np.diff(offsets))))
                held += len(flat)
                if held >= FLUSH:
                    merge()
                    new, held = [], 0
        if new:
            merge()
            new.clear()
            give_back()
        for kind, parts in enumerate(kept):
            for key, word, before, n in parts:
                columns = [pa.array(np.full(len(key), kind, np.int32)), *(pa.array(c.view(np.int64)) for c in (key, word, before)), pa.array(n)]
                yield pa.RecordBatch.from_arrays(columns, ["kind", "key", "word", "before", "n"])

    found = docs.select("text").mapInArrow(find, CANDIDATE).groupBy("kind", "key")
    found = found.agg(F.min("word").alias("word"), F.min("before").alias("before"), F.sum("n").alias("n"))
    got = found.filter(F.col("n") >= least / 2).orderBy(F.desc("n"), "key").toArrow()
    kind = got["kind"].to_numpy()
    key, word, before = (got[c].to_numpy().view(np.uint64) for c in ("key", "word", "before"))
    order = np.argsort(key[kind == 1])
    pairs, words, before = (c[kind == 1][order] for c in (key, word, before))
    return word[kind == 0], HeavyPairs(pairs, words, before, np.zeros(len(pairs), np.int64))


def with_heavy(dictionary: np.ndarray, words: np.ndarray, pairs: HeavyPairs) -> tuple[np.ndarray, HeavyPairs]:
    """The dictionary with the heavy words in it, and the pairs whose second word it has."""
    words = words[:CODES]
    others = np.setdiff1d(dictionary, words)[: NONE - len(words)]
    dictionary = np.sort(np.concatenate([words, others]))
    has = _coded(pairs.words, dictionary) != NONE
    return dictionary, HeavyPairs(pairs.pairs[has], pairs.words[has], pairs.before[has], pairs.counts[has])


def exact_counts(docs: DataFrame, dictionary: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact counts of the dictionary's words and of heavy pairs in the training documents."""
    shared = docs.sparkSession.sparkContext.broadcast((dictionary, pairs))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("katz")
        dictionary, pairs = shared.value
        total = np.zeros((1 << 16) + len(pairs), np.int64)
        for batch in batches:
            for _, offsets, flat in _tokens(batch.column(0)):
                total[: 1 << 16] += np.bincount(_coded(flat, dictionary), minlength=1 << 16)
                if len(pairs):
                    has, at = _among(_pair_numbers(flat, _before(flat, np.diff(offsets))), pairs)
                    total[1 << 16 :] += np.bincount(at[has], minlength=len(pairs))
        total[NONE] = 0
        some = np.flatnonzero(total)
        give_back()
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["code", "n"])

    found = docs.filter("learned").select("text").mapInArrow(count, "code int, n long")
    got = found.groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros((1 << 16) + len(pairs), np.int64)
    counts[got["code"].to_numpy()] = got["n"].to_numpy()
    return counts[: 1 << 16], counts[1 << 16 :]


DEALT = "bucket int, flush long, docs binary, words binary, word_rest binary, before binary, before_rest binary, owners binary"


def _deal(docs: DataFrame, dictionary: np.ndarray, pairs: np.ndarray, bits: int) -> DataFrame:
    """Token pairs by bucket, and the documents of each flush (bucket -1 and below).

    A flush is named by its partition and its place there, so a task that runs
    again for lost map outputs gives the rows it gave before."""
    shared = docs.sparkSession.sparkContext.broadcast((dictionary, pairs))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("katz")
        words, pairs = shared.value
        numbers: list[np.ndarray] = []
        sizes: list[int] = []
        names: list[tuple[int, int, int]] = []
        held = 0
        name = TaskContext.get().partitionId() << 32

        def flush() -> pa.RecordBatch:
            flat = np.concatenate(numbers)
            lengths = np.array(sizes)
            owner = np.repeat(np.arange(len(sizes)), lengths).astype(np.uint16)
            before = _before(flat, lengths)
            code, code_before = _coded(flat, words), _coded_upper(before, words)
            pair = _pair_numbers(flat, before)
            key = np.where(code != NONE, pair, flat)
            spread = _among(pair, pairs)[0]
            key[spread] = mix(pair[spread] ^ mix(np.array([name + 1], np.uint64)))
            bucket = (key >> np.uint64(64 - bits)).astype(np.int32)
            order = np.lexsort((code, bucket))
            bucket, code, code_before = bucket[order], code[order], code_before[order]
            flat, before, owner = flat[order], before[order], owner[order]
            del pair, key, order
            learned = np.array([n[1] for n in names], bool)
            home = int(mix(np.array([name], np.uint64))[0] >> np.uint64(64 - bits))
            rows = [[-1 - home, name, np.array(names, "<i8").tobytes(), *[b""] * 5]]
            cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
            for low, high in zip(cuts, [*cuts[1:], len(bucket)]):
                at = slice(low, high)
                rows.append(
                    [
                        int(bucket[low]), name, np.packbits(learned).tobytes(),
                        _squeezed(np.diff(code[at], prepend=np.uint16(0)).astype("<u2")), _pack_words(flat[at], code[at], 8),
                        _squeezed(code_before[at]), _pack_words(before[at], code_before[at], 6), _squeezed(owner[at]),
                    ]
                )
            columns = list(zip(*rows))
            kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 6]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [f.split()[0] for f in DEALT.split(", ")])

        for batch in batches:
            ids, learned = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for first, offsets, flat in _tokens(batch.column(1)):
                for i in range(len(offsets) - 1):
                    part = flat[offsets[i] : offsets[i + 1]]
                    numbers.append(part)
                    sizes.append(len(part))
                    # doc_id, learned, tokens, whether there is a doc_id
                    row = first + i
                    names.append((ids[row] or 0, int(learned[row]), len(part), int(ids[row] is not None)))
                    held += len(part)
                    if held >= FLUSH or len(names) == NONE:
                        yield flush()
                        numbers, sizes, names, held = [], [], [], 0
                        name += 1
                        give_back()
        if names:
            yield flush()
            numbers.clear()
            give_back()

    return docs.select("doc_id", "text", "learned").mapInArrow(deal, DEALT)


def _coded_upper(numbers: np.ndarray, dictionary: np.ndarray) -> np.ndarray:
    """Codes by the upper 48 bits."""
    return _coded(numbers, dictionary & ~np.uint64(0xFFFF))


FOUND = "kind int, flush long, owner int, doc_id long, learned int, n long, words binary, before binary, rest binary, counts binary, least array<long>"
#: Numbers of tokens per document: known words, pairs by count 1 to 5, words after
#: an unseen pair by count 1 to 5, unknown words and known words after an unseen pair.
TALLIES = 1 + HIGHEST + HIGHEST + 2


_LONGS = pa.list_(pa.field("element", pa.int64()))
_FOUND = pa.schema(
    [("kind", pa.int32()), ("flush", pa.int64()), ("owner", pa.int32()), ("doc_id", pa.int64()), ("learned", pa.int32()),
     ("n", pa.int64()), ("words", pa.binary()), ("before", pa.binary()), ("rest", pa.binary()), ("counts", pa.binary()), ("least", _LONGS)]
)


def _runs(data: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """The bytes of the rows of ``data`` from each cut to the next, as binary values."""
    width = data.nbytes // len(data)
    starts = np.append(cuts, len(data)).astype(np.int32) * np.int32(width)
    return pa.Array.from_buffers(pa.binary(), len(cuts), [None, pa.py_buffer(starts), pa.py_buffer(np.ascontiguousarray(data))])


def _classes(c: np.ndarray, c_pair: np.ndarray, last: np.ndarray, at: np.ndarray, owner: np.ndarray, edges: np.ndarray) -> list[bytes]:
    """The tokens of each flush, classed by all that decides what they add to their
    document: ``c(w)``, ``c(h, w)`` and whether the word is the end.  ``at``: the
    pair of each token, to which the first three belong.

    Sums per document would be as many as buckets times documents; a token is
    two bytes for its document and a share of its class, however many buckets
    there are."""
    _, of_c = np.unique(c, return_inverse=True)
    often, of_pair = np.unique(c_pair, return_inverse=True)
    _, first, kind = np.unique((of_c * len(often) + of_pair) * 2 + last, return_index=True, return_inverse=True)
    c, c_pair, last = c[first], c_pair[first], last[first]
    out = []
    for low, high in zip(edges[:-1], edges[1:]):
        key = kind[at[low:high]] << 16 | owner[low:high]
        key.sort()
        of = key >> 16
        cuts = np.flatnonzero(np.diff(of, prepend=-1))
        sizes = np.diff(cuts, append=len(of)).astype("<u4")
        of = of[cuts]
        parts = (np.diff(c[of], prepend=0).astype("<i8"), c_pair[of].astype("<i8"), sizes << 1 | last[of], (key & NONE).astype("<u2"))
        planes = b"".join(np.ascontiguousarray(p.view(np.uint8).reshape(len(p), -1).T).tobytes() for p in parts)
        out.append(len(of).to_bytes(4, "little") + zstandard.ZstdCompressor(level=1).compress(planes))
    return out


def _of_classes(data: bytes) -> list[np.ndarray]:
    """``c``, ``c_pair``, ``2 * tokens + last`` of each class, and the tokens' documents."""
    n = int.from_bytes(data[:4], "little")
    planes, parts, low = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[4:]), np.uint8), [], 0
    for kind, size in (("<i8", 8 * n), ("<i8", 8 * n), ("<u4", 4 * n), ("<u2", len(planes) - 20 * n)):
        part = planes[low : low + size].reshape(np.dtype(kind).itemsize, -1)
        parts.append(np.ascontiguousarray(part.T).view(kind).ravel())
        low += size
    return [np.cumsum(parts[0]), *parts[1:]]


def _count(shared, bits: int):
    """Counts of one bucket, as rows of several kinds: 0 a document, 1 the tokens
    of a flush by their counts, 2 its tokens in pairs that were never seen, as owners and
    what is before them, 3 the tables of the bucket, 4 numbers of counts."""

    def count(group: pa.Table) -> pa.Table:
        dictionary, dictionary_counts, spread = shared.value
        out: list[pa.RecordBatch] = []

        def put(kind: int, **values) -> None:
            n = len(next(iter(values.values())))
            values["kind"] = np.full(n, kind, np.int32)
            columns = [pa.nulls(n, f.type) if f.name not in values else pa.array(values[f.name], f.type) for f in _FOUND]
            out.append(pa.RecordBatch.from_arrays(columns, schema=_FOUND))

        if group["bucket"][0].as_py() < 0:
            for flush, docs in zip(group["flush"].to_pylist(), group["docs"].to_pylist()):
                names = np.frombuffer(docs, "<i8").reshape(-1, 4)
                ids = pa.array(names[:, 0], mask=names[:, 3] == 0)
                put(
                    0, flush=np.full(len(names), flush), owner=np.arange(len(names), dtype=np.int32), doc_id=ids,
                    learned=names[:, 1].astype(np.int32), n=names[:, 2],
                )
            return pa.Table.from_batches(out, _FOUND)
        words, before, owners, learned, flushes = [], [], [], [], []
        for r in group.to_pylist():
            codes = np.cumsum(_expanded(r["words"], "<u2"), dtype=np.uint16)
            words.append(_unpack_words(codes, r["word_rest"], 8, dictionary))
            before.append(_unpack_words(_expanded(r["before"], "<u2"), r["before_rest"], 6, dictionary))
            owner = _expanded(r["owners"], "<u2")
            flags = np.unpackbits(np.frombuffer(r["docs"], np.uint8)).astype(bool)
            learned.append(flags[owner])
            owners.append(owner)
            flushes.append(r["flush"])
        edges = np.cumsum([0, *map(len, owners)])  # the tokens of each flush
        word, context, owner, train = map(np.concatenate, (words, before, owners, learned))
        del words, before, owners, learned
        kinds, kind = np.unique(word, return_inverse=True)
        distinct, where, at = np.unique(_pair_numbers(word, context), return_index=True, return_inverse=True)
        pairs = np.bincount(at[train], minlength=len(where))
        counted, place = _among(distinct, spread.pairs)  # elsewhere, over all groups
        pairs[counted] = spread.counts[place[counted]]
        singles = np.bincount(kind[train], minlength=len(kinds))
        codes = _coded(kinds, dictionary)
        singles = np.where(codes != NONE, dictionary_counts[codes], singles)
        put(1, flush=flushes, counts=_classes(singles[kind[where]], pairs, word[where] == np.uint64(END), at, owner, edges))
        # tokens in unseen pairs, by flush
        unseen = pairs[at] == 0
        if unseen.any():
            which = np.flatnonzero(unseen)
            row = np.searchsorted(edges, which, "right") - 1
            order = which[np.lexsort((owner[which], row))]
            who, what = owner[order], context[order]
            code = _coded_upper(what, dictionary)
            cuts = np.searchsorted(which, edges)
            some = [(f, i, j) for f, i, j in zip(flushes, cuts[:-1], cuts[1:]) if i < j]
            put(
                2, flush=[f for f, _, _ in some], counts=[_squeezed(who[i:j]) for _, i, j in some],
                before=[_squeezed(code[i:j]) for _, i, j in some], rest=[_pack_words(what[i:j], code[i:j], 6) for _, i, j in some],
            )
        # the tables: for each word its count, what it follows and how often
        tabled = np.flatnonzero((pairs > 0) & ~counted)
        if len(tabled):
            first = where[tabled]
            of, what, often = kind[first], context[first], pairs[tabled].astype("<u4")
            order = np.argsort(of, kind="stable")
            of, what, often = of[order], what[order], often[order]
            some, sizes = np.unique(of, return_counts=True)
            code = _coded_upper(what, dictionary)
            put(
                3, words=[_bundle(kinds[some], singles[some].astype("<i8"), sizes.astype("<u4"))], before=[_squeezed(code)],
                rest=[_pack_words(what, code, 6)], counts=[_squeezed(often)],
            )
        # words, tokens and numbers of counts; the dictionary's words and heavy pairs are counted elsewhere
        own = singles[(codes == NONE) & (singles > 0)]
        ones = [int((own == r).sum()) for r in range(1, HIGHEST + 2)]
        twos = [int((pairs[~counted] == r).sum()) for r in range(1, HIGHEST + 2)]
        put(4, least=[[len(own), int(own.sum()), *ones, *twos]])
        del word, context, owner, train, kind, distinct, where, at, unseen
        give_back()
        return pa.Table.from_batches(out, _FOUND)

    return count


def discounts(numbers: list[int]) -> np.ndarray:
    """Good-Turing discounts of the counts 1 to 5 from the numbers of counts 1 to
    6; where these do not give discounts between 0 and 1, the absolute discount
    n1 / (n1 + 2 n2) (one half without any n1)."""
    n = np.array([0, *numbers], float)
    r = np.arange(1, HIGHEST + 1)
    if n[1 : HIGHEST + 2].all():
        top = (HIGHEST + 1) * n[HIGHEST + 1] / n[1]
        d = ((r + 1) * n[r + 1] / (r * n[r]) - top) / (1 - top) if top != 1 else np.zeros(HIGHEST)
        if ((d > 0) & (d < 1)).all():
            return d
    step = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
    return (r - step) / r if step < 1 else (r - 0.75) / r


@dataclass
class KatzModel:
    tokens: int  # N
    words: int  # V
    documents: int  # training documents: how often something follows the start
    single: np.ndarray  # discounts of words
    pair: np.ndarray  # discounts of pairs
    numbers: list[int]  # numbers of counts 1 to 6 of words

    def discounted(self, counts: np.ndarray) -> np.ndarray:
        """``d1(c) c`` of words."""
        return counts * np.append(np.append(1.0, self.single), 1.0)[np.minimum(counts, HIGHEST + 1)]

    def discounted_pair(self, counts: np.ndarray) -> np.ndarray:
        return counts * np.append(np.append(1.0, self.pair), 1.0)[np.minimum(counts, HIGHEST + 1)]

    @property
    def unknown(self) -> float:
        """P(?): what the discounts and the one of ``N + 1`` leave."""
        left = sum(n * r * (1 - d) for r, (n, d) in enumerate(zip(self.numbers, self.single), 1))
        return (1 + left) / (self.tokens + 1)


def _model(totals: list, dictionary: np.ndarray, counts: np.ndarray, pairs: HeavyPairs, documents: int) -> KatzModel:
    own = counts[: len(dictionary)]
    own = own[own > 0]
    words, tokens = len(own) + totals[0], int(own.sum()) + totals[1]
    ones = [totals[1 + r] + int((own == r).sum()) for r in range(1, HIGHEST + 2)]
    twos = [totals[2 + HIGHEST + r] + int((pairs.counts == r).sum()) for r in range(1, HIGHEST + 2)]
    return KatzModel(tokens, words, documents, discounts(ones), discounts(twos), ones)


def backoff_masses(table: DataFrame, model: KatzModel, dictionary: np.ndarray, pairs: HeavyPairs, singles: np.ndarray) -> DataFrame:
    """``(context, total, kept, lower)`` from ``table (words, before, rest, counts)``
    and the heavy pairs, whose words have the counts ``singles``: c(h), the sum
    of d c(h, w), and the sum of P(w), over the words seen after h."""
    shared = table.sparkSession.sparkContext.broadcast((model, dictionary))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("katz")
        m, dictionary = shared.value

        def merged(parts: list[tuple]) -> tuple:
            context, *values = (np.concatenate(c) for c in zip(*parts))
            keys, at = np.unique(context, return_inverse=True)
            return (keys, *(np.bincount(at, v, minlength=len(keys)) for v in values))

        parts, held = [], 0
        for batch in batches:
            for words, before, rest, counts in zip(*(c.to_pylist() for c in batch.columns)):
                _, n, sizes = _unbundled(words, "<u8", "<i8", "<u4")
                context = _unpack_words(_expanded(before, "<u2"), rest, 6, dictionary).view(np.int64)
                often = _expanded(counts, "<u4").astype(np.int64)
                lower = np.repeat(m.discounted(n) / (m.tokens + 1), sizes)
                parts.append((context, often.astype(float), m.discounted_pair(often), lower))
                held += len(often)
            if held > FLUSH:
                parts = [merged(parts)]
                held = len(parts[0][0])
                if held > FLUSH:
                    yield rows(parts[0])
                    parts, held = [], 0
        if held:
            yield rows(merged(parts))

    def rows(found: tuple) -> pa.RecordBatch:
        names = ["context", "total", "kept", "lower"]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in found], names)

    found = table.select("words", "before", "rest", "counts").mapInArrow(add, "context long, total double, kept double, lower double")
    seen = pairs.counts > 0
    if seen.any():
        often, lower = pairs.counts[seen], model.discounted(singles[seen]) / (model.tokens + 1)
        more = zip(pairs.before[seen].view(np.int64).tolist(), often.astype(float).tolist(), model.discounted_pair(often).tolist(), lower.tolist())
        found = found.union(table.sparkSession.createDataFrame(list(more), found.schema))
    return found.groupBy("context").agg(*[F.sum(c).alias(c) for c in ("total", "kept", "lower")])


def _requests(shared):
    """The contexts that one flush asks for, each with the documents that ask."""

    def requests(group: pa.Table) -> pa.Table:
        dictionary, owners, contexts = shared.value[0], [], []
        for before, rest, asking in zip(*(group[c].to_pylist() for c in ("before", "rest", "counts"))):
            owners.append(_expanded(asking, "<u2"))
            contexts.append(_unpack_words(_expanded(before, "<u2"), rest, 6, dictionary))
        owner, context = np.concatenate(owners), np.concatenate(contexts)
        order = np.argsort(context, kind="stable")
        owner, context = owner[order], context[order]
        cuts = np.flatnonzero(np.append(True, context[1:] != context[:-1]))
        flush = np.full(len(cuts), group["flush"][0].as_py())
        columns = [pa.array(flush), pa.array(context[cuts].view(np.int64)), _runs(owner, cuts)]
        return pa.Table.from_arrays(columns, ["flush", "context", "owners"])

    return requests


def _replies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of ``weight`` over the documents in ``owners``, by flush."""
    parts: list[tuple] = []
    held = 0

    def packed() -> pa.RecordBatch:
        flush, owner, weight = (np.concatenate(c) for c in zip(*parts))
        flushes, of = np.unique(flush, return_inverse=True)
        keys, at = np.unique((of << 16) | owner, return_inverse=True)
        total, owner = np.bincount(at, weight), (keys & NONE).astype("<u2")
        edges = np.searchsorted(keys >> 16, np.arange(len(flushes) + 1))
        cuts = list(zip(edges[:-1], edges[1:]))
        columns = [pa.array(flushes), pa.array([_squeezed(owner[i:j]) for i, j in cuts]), pa.array([_bundle(total[i:j]) for i, j in cuts])]
        return pa.RecordBatch.from_arrays(columns, ["flush", "before", "counts"])

    for batch in batches:
        if not batch.num_rows:
            continue
        flush, weight = (batch.column(i).to_numpy() for i in (0, 2))
        asking = batch.column(1).to_pylist()
        times = [len(x) // 2 for x in asking]
        owner = np.frombuffer(b"".join(asking), "<u2").astype(np.int64)
        parts.append((np.repeat(flush, times), owner, np.repeat(weight, times)))
        held += len(owner)
        if held > FLUSH:
            yield packed()
            parts, held = [], 0
    if parts:
        yield packed()


SUMS = f"flush long, owner int, plain double, own double, {', '.join(f't{k} long' for k in range(TALLIES))}"


def _document_sums(group: pa.Table) -> pa.Table:
    """The sums of the documents of one flush from the tokens of all buckets and the replies."""
    replied, parts = np.zeros(NONE), []
    for kind, owners, packed in zip(*(group[c].to_pylist() for c in ("kind", "before", "counts"))):
        if kind == 2:
            replied[_expanded(owners, "<u2")] += _unbundled(packed, "<f8")[0]  # each once
        else:
            parts.append(_of_classes(packed))
    c, c_pair, marks, owner = (np.concatenate(p) for p in zip(*parts))
    n, last = marks >> 1, (marks & 1).astype(bool)
    known, seen = c > 0, c_pair > 0
    # what no discount changes: pair counts, words after an unseen pair, c(h) + escape of the pair that follows
    own = np.where(seen, np.log10(np.maximum(c_pair, 1)), np.log10(np.maximum(c, 1)))
    own -= np.where(known & ~last, np.log10(c + ESCAPE), 0.0)
    # the tally of each class; 0 has none, TALLIES - 2 is the unknown words and TALLIES - 1 the frequent words after an unseen pair
    alone = np.where(known, np.where(c <= HIGHEST, HIGHEST + c, TALLIES - 1), TALLIES - 2)
    tally = np.where(seen, np.where(c_pair <= HIGHEST, c_pair, 0), alone)
    tokens = np.bincount(owner.astype(np.int64) * TALLIES + np.repeat(tally, n), minlength=NONE * TALLIES).reshape(NONE, TALLIES).T
    total = tokens.sum(0)
    some = np.flatnonzero(total)
    tokens[-1] += tokens[HIGHEST + 1 : 2 * HIGHEST + 1].sum(0)
    tokens[0] = total - tokens[-2]
    plain = np.bincount(owner, np.repeat(np.log10(c + 1.0), n), minlength=NONE)
    own = np.bincount(owner, np.repeat(own, n), minlength=NONE) + replied
    flush = np.full(len(some), group["flush"][0].as_py())
    columns = [flush, some.astype(np.int32), plain[some], own[some], *tokens[:, some]]
    return pa.Table.from_arrays([pa.array(c) for c in columns], [f.split()[0] for f in SUMS.split(", ")])


def katz_scores(docs: DataFrame) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)``,
    one row per row of ``docs``; ``score`` is the model's log10 probability of the
    text with its end, ``base_score`` that of add-one counts of single words.

    Texts are lower-cased (A-Z).  A null or empty text is the end alone.  A row
    without doc_id is scored, not learned from, and not held out.  Rows that
    repeat a doc_id count as documents of their own.  Without training documents
    N is 0 and every text has probability one.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    docs = docs.withColumn("learned", learned_from(docs))
    dictionary, pairs = with_heavy(frequent_words(docs), *heavy(docs, HEAVY))
    counts, pairs.counts = exact_counts(docs, dictionary, pairs.pairs)
    size = docs.agg(F.sum(F.octet_length("text")), F.sum(F.col("learned").cast("int"))).first()
    bits = max(4, ((size[0] or 0) // 6 // BUCKET).bit_length())
    shared = spark.sparkContext.broadcast((dictionary, counts, pairs))
    found = save(_deal(docs, dictionary, pairs.pairs, bits).groupBy("bucket").applyInArrow(_count(shared, bits), FOUND), "ngrams")
    release(spark)  # the dealt tokens: while ``save`` runs, its plan is still referenced
    totals = found.filter("kind = 4").select(*[F.sum(F.col("least")[k]) for k in range(2 + 2 * (HIGHEST + 1))]).first()
    model = _model([t or 0 for t in totals], dictionary, counts, pairs, size[1] or 0)

    masses = backoff_masses(found.filter("kind = 3"), model, dictionary, pairs, counts[_coded(pairs.words, dictionary)])
    weight = F.log10((F.col("total") + ESCAPE - F.col("kept")) / (F.lit(1.0) - F.col("lower")))
    asked = found.filter("kind = 2").select("flush", "before", "rest", "counts").groupBy("flush")
    asked = asked.applyInArrow(_requests(shared), "flush long, context long, owners binary")
    replies = asked.join(masses, "context").select("flush", "owners", weight.alias("weight"))
    replies = replies.mapInArrow(_replies, "flush long, before binary, counts binary").withColumn("kind", F.lit(2))
    sums = found.filter("kind = 1").select("kind", "flush", "before", "counts").unionByName(replies)
    sums = sums.groupBy("flush").applyInArrow(_document_sums, SUMS)
    names = found.filter("kind = 0").select("flush", "owner", "doc_id", "learned", F.col("n").alias("n_tokens"))
    rows = names.join(sums, ["flush", "owner"])
    logs = np.log10([*model.pair, *model.single, model.unknown, 1 / (model.tokens + 1)])
    discounted = sum((F.col(f"t{k}") * float(log) for k, log in enumerate(logs, 1)), F.col("own"))
    start = float(np.log10(model.documents + ESCAPE)) if model.documents else 0.0
    score = discounted - start
    base = F.col("plain") - F.col("n_tokens") * float(np.log10(model.tokens + model.words + 1))
    held_out = F.col("doc_id").isNotNull() & (F.col("learned") == 0)
    return rows.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", F.col("t0").alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"), base.alias("base_score"), score.alias("score"),
    )
