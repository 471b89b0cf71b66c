"""Prefix trie, url filters and ranked search against plain versions, on odd rows,
and with shards and slices so small that everything is divided."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from basketry.llm import lexical_search, prefix_trie, url_filters
from basketry.llm.queries import QUERIES
from tests.llm import plain

SMALL = "/root/testdata/sf0.001"
LONG = " ".join(f"w{i % 97}" for i in range(20_000))


def sort(rows):
    return sorted(map(tuple, rows), key=repr)


# -- prefix trie -------------------------------------------------------------------

TURNS = [
    *[(c, t, "user", f"hot {t}") for c in range(200, 260) for t in range(3)],  # copies
    *[(c, t, "user", "same" if t < 6 else f"{c} {t}") for c in range(300, 340) for t in range(9)],  # long shared prefixes
    *[(400, t, None, None) for t in range(130)], *[(401, t, "", "") for t in range(140)],  # null is empty
    (500, None, "user", "null first"), (500, 0, "user", "then"), (500, 0, "user", "then"), (500, 0, "a", "tie"), (500, 7, "user", LONG),
    (None, 1, "user", "no conversation"), (-3, 0, "user", "negative"), (-23, 0, "user", "negative base"),
    (605, 0, "user", "short"), (606, 0, "user", "short"), (607, 0, "user", "short"), (608, 0, "user", "short"), (609, 0, "user", "a\x0bb\tc"),
    (2**40, 0, "us", "er one"), (2**40 + 1, 0, "use", "r one"), (2**40 + 2, 1, "user", ""),
]


@pytest.fixture(scope="module")
def turns(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("turns"))
    given_ = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows = given_ + TURNS
    wide = [(*r, "x", 1) for r in rows]
    kind = "conv_id long, turn long, role string, text string, node string, depth int"
    spark.createDataFrame(wide, kind).repartition(5).write.parquet(f"{folder}/conversations.parquet")
    return folder, rows


def test_trie(spark, turns):
    assert sort(QUERIES["op11_prefix_trie"](spark, turns[0]).collect()) == sort(plain.trie(turns[1]))


@pytest.mark.parametrize("nodes, paths", [(1, 2), (40, 3)])
def test_trie_in_many_shards_and_levels(spark, turns, monkeypatch, nodes, paths):
    monkeypatch.setattr(prefix_trie, "SHARD_NODES", nodes)
    monkeypatch.setattr(prefix_trie, "MIN_PATHS", paths)
    monkeypatch.setattr(prefix_trie, "HASH_CHUNK", 9)
    monkeypatch.setattr(prefix_trie, "save", (lambda f: lambda df, label: levels.append(label) or f(df, label))(prefix_trie.save))
    levels = []
    table = spark.read.parquet(f"{turns[0]}/conversations.parquet")
    assert sort(prefix_trie.prefix_trie(table).collect()) == sort(plain.trie(turns[1]))
    assert levels.count("trie") >= 2


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 40), max_size=400), st.integers(2, 100))
def test_parentheses(depths, block):
    """find_close against a stack, for tries of any shape."""
    signs, level = [1], 1
    for d in depths:  # close down to a level, open one
        signs += [-1] * max(0, level - 1 - d) + [1]
        level = max(0, min(level, d + 1)) + 1 if d + 1 < level else level + 1
    excess = np.cumsum(signs)
    if (excess <= 0).any():
        return
    signs += [-1] * int(excess[-1])
    stack, close = [], {}
    for i, s in enumerate(signs):
        if s > 0:
            stack.append(i)
        else:
            close[stack.pop()] = i
    before, prefix_trie.BLOCK = prefix_trie.BLOCK, block
    try:
        opens = np.flatnonzero(np.array(signs) > 0)
        got = prefix_trie.find_close(np.cumsum(signs).astype(np.int32), opens)
    finally:
        prefix_trie.BLOCK = before
    assert dict(zip(opens.tolist(), got.tolist())) == close


def test_least_in_ranges():
    rng = np.random.default_rng(1)
    values = rng.integers(-50, 50, 300)
    low = rng.integers(0, 299, 500)
    high = low + 1 + (rng.random(500) * (300 - low - 1)).astype(int)
    want = [values[a:b].min() for a, b in zip(low, high)]
    assert prefix_trie.least_in_ranges(values, low, high).tolist() == want


# -- url filters -------------------------------------------------------------------

def link(url):
    return f'<html><head><link REL="canonical" href="{url}"></head>'


PAGES = [
    (1, "http://A.b.NET/x?q#f", None), (2, "http://example.net/en/1", ""), (3, "http://sub.example.net/en", None), (4, "http://net", None),
    (5, "http://xnet/", None), (6, None, link("http://bad.net/")), (7, "no scheme", link("http://bad.net/")), (8, "http://example.com/de/a", None),
    (9, "http://a.org/fr/", None), (10, "http://a.org/f", None), (11, "x://net/y://example.net/en/", None), (12, "", ""),
    # an alias of a blocked page, by canonical link and by redirect, and a chain
    (20, "http://clean.com/a", link("http://bad.net/z")), (21, "http://clean.com/b", "<META content='0; URL=/a' HTTP-EQUIV='refresh'>"),
    (22, "https://Other.com#top", link("http://clean.com/b#part")), (23, "https://other.com/", None),
    # one of the class is explicitly allowed: that decides for those without a rule
    (30, "http://mixed.com/a", link("//bad.net/y")), (31, "http://mixed.com/b", link("a")), (32, "http://w.org/fr/1", link("http://mixed.com/b")),
    (33, "http://bad.net/y", None),
    # no links: comments, scripts, other relations, other schemes
    (40, "http://safe.com/1", "<!-- <link rel=canonical href=http://bad.net/> -->"), (41, "http://safe.com/2", "<script>'<link rel=canonical href=http://bad.net/>'</script>"),
    (42, "http://safe.com/3", '<link rel="stylesheet" href="http://bad.net/canonical">'), (43, "http://safe.com/4", link("mailto:a@bad.net")),
    (44, "http://safe.com/5", '<link href="http://bad.net/?a=1&amp;b=2" rel=canonical>'), (45, "http://safe.com/6", link("http://bad.net/?a=1&b=2")),
    (46, "http://safe.com/dir/7", link("8")), (47, "http://safe.com/dir/8", link("?q")), (48, "http://safe.com/dir/8?q", link("http://bad.net/")),
    (49, "http://safe.com/9", link("http://bad.net/" + "x" * 50_000)), (50, "http://safe.com/9", None), (50, "http://safe.com/9", None),
    (None, "http://bad.net/", None), (None, None, None),
    *[(100 + i, "http://hub.com/", link("http://hub.com/home") if i % 2 else None) for i in range(60)], (99, "http://hub.com/home", link("http://bad.net/hub")),
]
CARRIED = {20, 21, 22, 23, 44, 45, 46, 47, 48, 49, 50, 99, *range(100, 160)}  # blocked without a rule


def test_urls(spark, tmp_path):
    kind = "page_id long, url string, html string, rule string, key string"
    spark.createDataFrame([(*r, "x", "y") for r in PAGES], kind).repartition(3).write.parquet(f"{tmp_path}/pages.parquet")
    rows = QUERIES["op12_url_filters"](spark, str(tmp_path)).collect()
    assert len(rows) == len(PAGES)
    want = {
        1: ("a.b.net", "/x", "net/", "block"), 2: ("example.net", "/en/1", "example.net/en/", "allow"),
        3: ("sub.example.net", "/en", "net/", "block"), 4: ("net", "", None, "allow"), 5: ("xnet", "/", None, "allow"),
        6: ("", "", None, "allow"), 7: ("", "", None, "allow"), 8: ("example.com", "/de/a", "example.com/de/", "block"),
        9: ("a.org", "/fr/", "org/fr/", "allow"), 10: ("a.org", "/f", None, "allow"),
        11: ("net", "/y://example.net/en/", "net/", "block"), 12: ("", "", None, "allow"),
        30: ("mixed.com", "/a", None, "allow"), 31: ("mixed.com", "/b", None, "allow"), 32: ("w.org", "/fr/1", "org/fr/", "allow"),
        33: ("bad.net", "/y", "net/", "block"),
    }
    for r in rows:
        if r.page_id in want:
            assert (r.host, r.path, r.rule, r.verdict) == want[r.page_id], r
        elif r.page_id is not None:
            assert r.rule is None and r.verdict == ("block" if r.page_id in CARRIED else "allow"), r
    assert sort((r.rule, r.verdict) for r in rows if r.page_id is None) == sort([("net/", "block"), (None, "allow")])


def test_urls_equal_sql(spark, tmp_path):
    import duckdb

    spark.createDataFrame(PAGES, "page_id long, url string, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    from basketry.llm.oracle import URL_FILTERS

    cur = con.execute(URL_FILTERS)
    names = [d[0] for d in cur.description]
    assert sort(QUERIES["op12_url_filters"](spark, str(tmp_path)).select(*names).collect()) == sort(cur.fetchall())


def test_urls_with_a_log_of_redirects(spark):
    pages = spark.createDataFrame([(1, "http://a.com/", None), (2, "http://b.com/", None)], "page_id long, url string, html string")
    log = spark.createDataFrame([("http://A.com", "http://bad.net/"), (None, "http://b.com/"), ("x", "http://b.com/")], "a string, b string")
    rows = url_filters.judged(pages, url_filters.RULES, log).collect()
    assert {r.page_id: r.verdict for r in rows} == {1: "block", 2: "allow"}


# -- ranked search -----------------------------------------------------------------

DOCS = [
    (1000, None), (1001, ""), (1002, " .,! \x00"), (1003, "one two"), (1004, "One TWO"), (1004, "one two"), (None, "one two"), (None, "null ids tie"),
    (1005, "ÉCOLE école Ünder_score a1b2"), (1006, LONG), (1007, LONG + " one"), (-5, "one two three"),
    *[(2000 + i, "copied words one w5 w6") for i in range(50)],
]
ITEMS = [
    (1000, "one two one"), (1001, None), (1002, ""), (1003, "never seen term zzzz"), (1004, "w1 W2 w3 copied words"), (1004, "w1 W2 w3 copied words"),
    (1005, "École ÉCOLE a1b2 score"), (None, "copied words"), (1006, LONG), (1007, "null one"),
]


@pytest.fixture(scope="module")
def texts(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("texts"))
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()] + DOCS
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()] + ITEMS
    spark.createDataFrame([(*r, "x", 1) for r in docs], "doc_id long, text string, term string, slice long").repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, term string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, docs, sorted(set(items), key=repr)


def test_search(spark, texts):
    assert sort(QUERIES["op13_lexical_search"](spark, texts[0]).collect()) == plain.ranked(*texts[1:])


def test_search_in_small_slices_and_blocks(spark, texts, monkeypatch):
    for name, value in (("SLICE_PAIRS", 300), ("BLOCK_ITEMS", 5), ("FIRST_DEPTH", 1)):
        monkeypatch.setattr(lexical_search, name, value)
    docs, items = (spark.read.parquet(f"{texts[0]}/{t}.parquet") for t in ("documents", "benchmark"))
    index, documents = lexical_search.build_index(docs)
    assert index.select("slice").distinct().count() > 20
    assert sort(lexical_search.search(index, documents, items).collect()) == plain.ranked(*texts[1:])


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 60), st.integers(1, 12), st.integers(0, 2**32 - 1), st.integers(1, 25))
def test_nra(documents, terms, seed, k):
    rng, lists, score = np.random.default_rng(seed), [], np.zeros(documents, np.int64)
    for _ in range(terms):
        places = rng.permutation(documents)[: rng.integers(1, documents + 1)]
        impacts = np.sort(rng.integers(1, 6, len(places)))[::-1].astype("<i4")
        weight = int(rng.integers(1, 4))
        lists.append((places.astype("<u2"), impacts, weight))
        score[places] += impacts.astype(np.int64) * weight
    want = sorted(((int(-s), p) for p, s in enumerate(score) if s))[:k]
    before, lexical_search.FIRST_DEPTH = lexical_search.FIRST_DEPTH, 1
    try:
        assert lexical_search.nra(lists, documents, k) == [(p, -s) for s, p in want]
    finally:
        lexical_search.FIRST_DEPTH = before
