"""Plain, slow versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text, lower=False):
    data = (text or "").encode()
    if lower:
        data = bytes(b + 32 if 65 <= b <= 90 else b for b in data)
    return WORD.findall(data)


def components(nodes, links):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def shingles(text):
    w = words(text, lower=True)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def jaccard(rows):
    """Sorted (doc_id, n_shingles, component_id) of (doc_id, text) rows."""
    sets = [(i, shingles(t)) for i, t in rows]
    known = [(i, s) for i, s in sets if i is not None and s]
    links = [
        (a, b)
        for k, (a, s) in enumerate(known)
        for b, t in known[k + 1 :]
        if 100 * len(s & t) >= 80 * len(s | t)
    ]
    found = components({i for i, _ in rows if i is not None}, links)
    return [(i, len(s), found.get(i)) for i, s in sets]


def without_repeats(rows, window=50):
    """(doc_id, n_words, n_removed, sha256 of the kept words) of (doc_id, text) rows."""
    first = {}
    for i, t in rows:
        w = words(t)
        for k in range(len(w) - window + 1):
            if i is not None:
                key = tuple(w[k : k + window])
                first[key] = min(i, first.get(key, i))
    out = []
    for i, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if i is not None and first[tuple(w[k : k + window])] < i:
                gone[k : k + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def katz(rows, discounts, escape):
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), and
    the model's probabilities after a context as a function."""
    texts = [(i, [*words(t, lower=True), "end"]) for i, t in rows]
    learned = [i is not None and zlib.crc32(str(i).encode()) % 7 != 2 for i, _ in texts]
    single, pair, context = Counter(), Counter(), Counter()
    for (_, w), use in zip(texts, learned):
        for h, x in zip(["start", *w], w):
            if use:
                single[x] += 1
                pair[h, x] += 1
                context[h] += 1
    n, v = sum(single.values()), len(single)

    def discounted(counts):
        d = discounts([sum(c == r for c in counts.values()) for r in range(1, 7)])
        return {k: c * (d[c - 1] if c <= 5 else 1.0) for k, c in counts.items()}

    one, two = discounted(single), discounted(pair)
    unknown = 1 - sum(one.values()) / (n + 1)
    after = defaultdict(list)
    for h, x in pair:
        after[h].append(x)

    def lower(x):
        return one[x] / (n + 1) if x in one else unknown

    def probability(h, x):
        if (h, x) in two:
            return two[h, x] / (context[h] + escape)
        if h not in after:
            return lower(x)
        kept = sum(two[h, y] for y in after[h]) / (context[h] + escape)
        return (1 - kept) / (1 - sum(lower(y) for y in after[h])) * lower(x)

    out = []
    for (i, w), use in zip(texts, learned):
        base = sum(math.log10((single[x] + 1) / (n + v + 1)) for x in w)
        score = sum(math.log10(probability(h, x)) for h, x in zip(["start", *w], w))
        out.append((i, i is not None and not use, len(w), sum(x in single for x in w), n, base, score))
    return out, probability, list(single)


def usable(vector):
    return bool(vector) and all(x is not None and math.isfinite(x) for x in vector) and any(vector)


def vector_links(rows, threshold=0.98):
    """(vec_id, n_links, component_id, kept) of (vec_id, vector, label) rows."""
    links, counts = [], [0] * len(rows)
    for k, (a, v, x) in enumerate(rows):
        for m, (b, w, y) in enumerate(rows):
            if m == k or None in (a, b, x, y) or x != y or not usable(v) or not usable(w) or len(v) != len(w):
                continue
            v_, w_ = np.array(v, float), np.array(w, float)
            if v_ @ w_ / np.linalg.norm(v_) / np.linalg.norm(w_) >= threshold:
                counts[k] += 1
                links.append((a, b))
    found = components({a for a, _, _ in rows if a is not None}, links)
    return [(a, n, found.get(a), a is not None and found[a] == a) for (a, _, _), n in zip(rows, counts)]


def nearest(rows, k=10):
    """{query id: [(vec_id, distance)]} of (vec_id, vector) rows with distinct ids."""
    rows = [(i, np.array(v, float)) for i, v in rows if i is not None and usable(v)]
    out = {}
    for q, v in rows:
        if q % 100 == 0:
            near = [(float(np.sqrt(((v - w) ** 2).sum())), i) for i, w in rows if i != q and len(w) == len(v)]
            out[q] = [(i, d) for d, i in sorted(near)[:k]]
    return out


def trie(rows):
    """Sorted nodes of (conv_id, turn, role, text) rows, as the query returns them."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            whole = f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()
            own[c].append((turn is not None, turn or 0, hashlib.sha256(whole).digest()[:16], role or "", text or ""))
    for c in own:
        own[c] = [x[3:] for x in sorted(own[c])]
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 4
        turns = tuple(own.get(c - int(math.fmod(c, 20)), [])[:h] + own[c][h:])
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
        ends[turns].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        gain = (len(m) - 1) * len(words(p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += gain
    return sorted(
        (m[0], len(p), members[p[:-1]][0] if p else None, len(m), children[p], leaves[p], saved[p],
         hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest())
        for p, m in members.items()
    )


def ranked(docs, items, k=20):
    """Sorted (item_id, rank, doc_id, score) of (doc_id, text) and distinct (item_id, text) rows."""
    term = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

    def terms(text):
        return term.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))

    held = [(i, Counter(w)) for i, w in ((i, terms(t)) for i, t in docs) if w]
    all_documents, all_terms = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in held:
            m = 75 + 25 * sum(c.values()) * all_documents // all_terms
            score = sum(
                math.floor(1000 * math.log((2 * all_documents + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                for t in terms(text) if c[t]
            )
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)
