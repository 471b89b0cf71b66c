"""Whole texts as token ids of a public tokenizer, word by word.

The tokenizers library encodes the distinct words; a text is the joined ids of its
words; words of Latin letters go to its model alone, where that gives the same ids.
That equals the library's result for the whole text, because texts are only cut
where both tokenizers always start a new piece: before a run of blanks and line
ends, and between a Latin letter or digit and an ASCII punctuation mark.  A
text with any other white space, or with the string of an added token in any
case of its letters, is encoded whole.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from basketry.llm.worker import cache, claim

#: Bytes of words and ids that a worker remembers, about; twice as many at most are held.
REMEMBERED = 64 << 20
_ENTRY = 200  # bytes of a word and its ids in the table, besides their own
# a run of Latin letters and digits up to a blank, a mark or the end, or what lies between blanks
_RUN = r"(?:[0-9A-Za-zÀ-ÖØ-öø-ÿ]++(?![^ \n!-/:-@\[-`{-~])|[^ \n]+)"
_PIECE = re.compile(rf"[ \n]*+{_RUN}|[ \n]+")
_BARE_PIECE = re.compile(_RUN)
_OTHER_SPACE = re.compile(r"[^\S \n]")
_LETTERS = re.compile(r"[ \n]?[A-Za-zÀ-ÖØ-öø-ÿ]+").fullmatch
# the characters by which byte-level models write bytes
_SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTES = {b: b for b in _SHOWN} | {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in set(_SHOWN))}
_PROBES = 2000  # words by which the model's merges are held against the whole library
_open: dict[str, WordEncoder] = {}
cache("tokens", _open.clear)


class Remembered(dict):
    """The ids of words; a word that is not there yet is looked up in ``older`` or made."""

    def __init__(self, make: Callable[[str], bytes], older: dict[str, bytes]):
        super().__init__()
        self.make, self.older, self.held = make, older, 0

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word) or self.make(word)
        self.held += _ENTRY + len(word) + len(ids)
        self[word] = ids
        return ids


class WordEncoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # a tokenizer that drops blanks or case needs fewer words remembered
        self.drops_blanks = self._ids([" a", "\na"]) == self._ids(["a", "a"])
        self.drops_case = self._ids(["Ab", "zQ"]) == self._ids(["ab", "zq"])
        added = {k: t.content for k, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.added = [string.lower() for string in added.values()]
        self.find = (_BARE_PIECE if self.drops_blanks else _PIECE).findall
        self.merges, self.line_end = self.tokenizer.model.tokenize, self._ids(["\n"])[0]
        self.merges_letters = self._merges_letters()
        self.recent = Remembered(self.ids_of_word, {})

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def _merged(self, word: str) -> bytes:
        """Ids of a word of letters from the library's model alone, without what normalises and splits texts."""
        before = b""
        if word[0] == "\n":
            before, word = self.line_end, word[1:]
        if self.drops_case:
            word = word.lower()
        word = word.replace(" ", chr(_BYTES[32])) if word.isascii() else word.encode().decode("latin-1").translate(_BYTES)
        return before + array("I", [t.id for t in self.merges(word)]).tobytes()

    def _merges_letters(self) -> bool:
        """Whether the model alone gives the ids of words of Latin letters, with a
        blank or line end before them where these count: held against the library
        over the vocabulary's first words, joined to longer ones."""
        bare = sorted((k, re.sub("^Ġ|</w>$", "", w)) for w, k in self.tokenizer.get_vocab().items())
        parts = [w for _, w in bare if w.isascii() and w.isalpha()][:_PROBES]
        parts += map(chr, [*range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)])
        words = [x for w, after in zip(parts, [*parts[7:], *parts[:7]]) for x in (w, w.title(), w + after)]
        words = [w for w in words if _LETTERS(w)]
        if not self.drops_blanks:
            words += [f" {w}" for w in words] + [f"\n{w}" for w in words]
        return list(map(self._merged, words)) == self._ids(words)

    def ids_of_word(self, word: str) -> bytes:
        return self._merged(word) if self.merges_letters and _LETTERS(word) else self._ids([word])[0]

    def needs_whole(self, text: str) -> bool:
        if _OTHER_SPACE.search(text):
            return True
        lowered = text.lower()
        return any(string in lowered for string in self.added)

    def _joined(self, texts: list[bytes]) -> list[bytes]:
        """The ids of texts from those of their words; each distinct word is looked up once."""
        flat = np.frombuffer(b"".join(texts), np.uint8)
        if not len(flat):
            return [b""] * len(texts)
        edges = np.cumsum([0, *map(len, texts)])
        space = (flat == 32) | (flat == 10)
        first = space.copy()
        first[1:] &= ~space[:-1]
        first[edges[edges < len(flat)]] = True
        cuts = np.append(np.flatnonzero(first), len(flat))
        words = pa.Array.from_buffers(pa.large_string(), len(cuts) - 1, [None, pa.py_buffer(cuts), pa.py_buffer(flat)]).dictionary_encode()
        known = self.recent.__getitem__
        ids = pa.array([b"".join(map(known, self.find(w))) for w in words.dictionary.to_pylist()], pa.large_binary())
        joined = ids.take(words.indices)
        ends = np.frombuffer(joined.buffers()[1], np.int64)[np.searchsorted(cuts, edges)].tolist()
        data = memoryview(joined.buffers()[2] or b"")
        return [bytes(data[i:j]) for i, j in pairwise(ends)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        whole = [i for i, t in enumerate(texts) if self.needs_whole(t)]
        plain = ["" if i in set(whole) else t for i, t in enumerate(texts)] if whole else texts
        out = self._joined([t.encode().lower() if self.drops_case else t.encode() for t in plain])  # A-Z alone
        for i in whole:
            out[i] = self._ids([texts[i]])[0]
        if self.recent.held > REMEMBERED:
            self.recent.older = {}
            self.recent = Remembered(self.ids_of_word, self.recent)
        return out


def encoder(path: str) -> WordEncoder:
    """The worker's encoder of a tokenizer file."""
    if path not in _open:
        _open[path] = WordEncoder(path)
    return _open[path]


def encoded_rows(column: pa.Array, path: str, end_id: int, limit: int = 6 << 20) -> Iterator[tuple[int, bytes]]:
    """``(row, ids and the end id)`` for every row; a null text has the end id alone.
    Texts are encoded together up to ``limit`` bytes; a longer one is alone."""
    claim("tokens")
    end = np.array([end_id], "<u4").tobytes()
    worker = encoder(path)
    size = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    low = 0
    while low < len(column):
        before = int(size[low - 1]) if low else 0
        high = max(low + 1, int(np.searchsorted(size, before + limit, "right")))
        texts = [t or "" for t in column.slice(low, high - low).to_pylist()]
        for i, ids in enumerate(worker.encode(texts)):
            yield low + i, ids + end
        low = high


def by_bytes(rows: Iterator[tuple], limit: int = 16 << 20) -> Iterator[list[tuple]]:
    """Rows in lists of at most about ``limit`` bytes; the last field counts."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[-1])
        if size >= limit:
            yield held
            held, size = [], 0
    if held:
        yield held
