"""The queries of the training-data operators against plain versions, on the
smallest tables with odd rows added: nulls, empty, blank and very long texts,
repeated rows, groups of copies, and columns with clashing names."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import types as T
from tokenizers import Tokenizer

from basketry.llm import katz
from basketry.llm.queries import QUERIES, tokenizer_path
from basketry.llm.words import hashed_texts
from tests.llm import plain

SMALL = "/root/testdata/sf0.001"
LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(30_000))
PASSAGE = " ".join(f"p{i}" for i in range(60))
ODD = [
    (1000, None, "en", "src1", 0), (1001, "", "en", None, 0), (1002, " \t\n", None, "src0", None),
    (1003, "one two three", "en", "src0", 13), (1004, "One two THREE", "en", "src0", 13), (1005, "one", "en", "src2", 3),
    (1006, LONG, "en", "src3", len(LONG)), (1007, LONG + " tail", "en", "src3", 0),
    (1008, f"head {PASSAGE} mid {PASSAGE}", "en", "src4", 0), (1009, f"{PASSAGE} other words here", "en", "src4", 0),
    (1010, "a b  c\x0bd\x1ce <|endoftext|> é́", "fr", "src4", 0), (1011, "a b  c\x0bd\x1ce", "fr", "", 0),
    (1013, "hello <|endoftext|> world", "en", "src4", 0), (1014, "<|ENDOFTEXT|> Hello<|startoftext|>.", "en", "src4", 0), (1015, "<|endoftext|", "en", "src4", 0),
    (1012, "same row", "en", "src5", 8), (1012, "same row", "en", "src5", 8), (1012, "same id other text", "en", "src5", 0),
    (None, "no id at all", "en", "src5", 0), (None, None, None, None, None), (-5, "negative id", "en", "src0", 11),
    *[(2000 + i, f"{PASSAGE} copies", "en", "hot", 0) for i in range(60)],
    *[(2100 + i, " ".join(f"n{j}" if j != 3 * i else "edit" for j in range(120)), "en", "hot", 0) for i in range(40)],
]
CLASHING = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("score", "component_id", "part", "_size", "row", "mix_pass", "kept_text", "digest", "n")]
)


def write(spark, folder, docs):
    kind = T.StructType(
        [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
         T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), *CLASHING.fields]
    )
    rows = [(*r, *["x"] * len(CLASHING)) for r in docs]
    spark.createDataFrame(rows, kind).repartition(3).write.parquet(f"{folder}/documents.parquet")


def vectors(spark, folder, empty=False):
    rng = np.random.default_rng(3)
    rows = []
    if not empty:
        base = rng.normal(size=(400, 16))
        base[40:80] = base[5] + 0.02 * rng.normal(size=(40, 16))  # near copies
        rows = [(i, [float(x) for x in v], int(i % 3 if not 40 <= i < 80 else 1)) for i, v in enumerate(base)]
        rows += [(1000 + i, rows[7][1], 1) for i in range(30)]  # copies
        rows += [(500, None, 1), (600, [0.0] * 16, 1), (700, [1.0, None], 1), (800, [float("nan")] * 16, 1), (900, [], 2)]
        rows += [(2000, [1.0, 2.0], 1), (2100, [2.0, 4.0], 1), (2200, [float("inf")] * 16, 0), (2300, rows[7][1], None), (None, rows[7][1], 1)]
    spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(2).write.parquet(f"{folder}/embeddings.parquet")
    return rows


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("odd"))
    given = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    docs = given[:120] + ODD
    write(spark, folder, docs)
    spark.read.parquet(f"{SMALL}/labels.parquet").union(
        spark.createDataFrame([(None, 1, 1), (1003, 1, None), (5, 0, 0), (5, 0, 0)], "doc_id long, quality int, toxic int")
    ).write.parquet(f"{folder}/labels.parquet")
    return folder, [(i, t) for i, t, *_ in docs], vectors(spark, folder), docs


@pytest.fixture(scope="module")
def nothing(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("nothing"))
    write(spark, folder, [])
    vectors(spark, folder, empty=True)
    for name, kind in (
        ("labels", "doc_id long, quality int, toxic int"), ("pages", "page_id long, url string, html string"),
        ("benchmark", "item_id long, text string"), ("conversations", "conv_id long, turn long, role string, text string"),
    ):
        spark.createDataFrame([], kind).write.parquet(f"{folder}/{name}.parquet")
    return folder


def sort(rows):
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, nothing, name):
    assert QUERIES[name](spark, nothing).collect() == []


def test_toxicity_scores(spark, odd):
    rows = QUERIES["op1_toxicity"](spark, odd[0]).collect()
    assert sort([r.doc_id] for r in rows) == sort([i] for i, _ in odd[1])
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert all(r.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)


def test_toxicity_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op1_toxicity"](spark, folder).collect() if r.held_out and r.doc_id in labels]
    toxic = [r for r in rows if labels[r.doc_id]]
    clean = [r for r in rows if not labels[r.doc_id]]
    assert sum(r.predicted for r in toxic) >= 0.9 * len(toxic)
    assert sum(r.predicted for r in clean) <= 0.01 * len(clean)


def test_katz_scores(spark, odd):
    rows = QUERIES["op2_katz_scores"](spark, odd[0]).collect()
    want, probability, known = plain.katz(odd[1], katz.discounts, katz.ESCAPE)
    got = sort((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5), round(r.score, 5)) for r in rows)
    assert got == sort((*w[:5], round(w[5], 5), round(w[6], 5)) for w in want)
    for context in ["start", known[0], known[-1], b"never seen"]:
        assert abs(sum(probability(context, w) for w in known) + probability(context, b"?") - 1) < 1e-9


def _ids(tokenizer, text, end):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [end]


def _tokenizer(name):
    return Tokenizer.from_file(tokenizer_path(name))


def _crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_packing(spark, odd):
    rows = QUERIES["op3_best_fit_packing"](spark, odd[0]).collect()
    tokenizer, want = _tokenizer("word_bpe_49k.json"), []
    for i, t in odd[1]:
        ids = _ids(tokenizer, t, 1)
        want += [(i, k // 4096, k, len(ids[k : k + 4096]), _crc(ids[k : k + 4096])) for k in range(0, len(ids), 4096)]
    assert sort((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sort(want)
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(by) <= 1.02 * -(-sum(w[3] for w in want) // 4096) + 1


def _thue_morse(letters):
    word = "a"
    while len(word) < letters:
        word += word.translate({97: 98, 98: 97})
    return word


@pytest.mark.parametrize("letters", [64, 1024, 2048, 4096])
def test_long_words_of_a_pattern_differ(letters):
    one = _thue_morse(letters)
    two = one.translate({97: 98, 98: 97})
    texts = pa.array([f"{one} {two}", None, "", f" {two}\t{one}", one[:-1]])
    numbers = [n for first, offsets, found in hashed_texts(texts, False) for n in found.tolist()]
    assert numbers[0] == numbers[3] and numbers[1] == numbers[2] and len(set(numbers)) == 3


def test_jaccard_components(spark, odd):
    rows = QUERIES["op4_jaccard_join"](spark, odd[0]).collect()
    assert sort(rows) == sort(plain.jaccard(odd[1]))


def test_substring_dedup(spark, odd):
    rows = QUERIES["op5_substring_dedup"](spark, odd[0]).collect()
    assert sort(rows) == sort(plain.without_repeats(odd[1]))


def test_near_duplicate_vectors(spark, odd):
    rows = QUERIES["op6_pq_near_duplicates"](spark, odd[0]).collect()
    assert sort(rows) == sort(plain.vector_links(odd[2]))


def test_shards(spark, odd):
    rows = QUERIES["op7_virtual_slots"](spark, odd[0]).collect()
    want = [(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in odd[1]]
    assert sort((r.doc_id, r.size, r.text_crc32) for r in rows) == sort(want)
    assert {(r.law, r.grown_shard, r.map_version) for r in rows} == {("bytes", None, 1)}
    for shard in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sum(r.shard == shard for r in rows)))
    bytes_ = Counter()
    for r in rows:
        bytes_[r.shard] += r.size
    # no shard can be smaller than the rest allows beside the two very long texts
    long = max(r.size for r in rows)
    assert set(bytes_) == set(range(8)) and max(bytes_.values()) <= max(long, sum(bytes_.values()) / 8) * 1.05 + 1000


def test_mix(spark, odd):
    rows = QUERIES["op8_pfair_mixing"](spark, odd[0]).collect()
    assert sort({(r.doc_id,) for r in rows}) == sort({(i,) for i, _ in odd[1]})
    first = Counter((r.doc_id, r.source) for r in rows if r.mix_pass == 0)
    assert first == Counter((i, s) for i, _, _, s, _ in odd[3])


def test_token_files(spark, odd):
    rows = QUERIES["op9_token_files"](spark, odd[0]).collect()
    tokenizer = _tokenizer("byte_bpe_50k.json")
    want = sort((i, len(ids), _crc(ids)) for i, t in odd[1] for ids in [_ids(tokenizer, t, 0)])
    assert sort((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == want
    ordered = sorted(rows, key=lambda r: r.start)
    assert [r.start for r in ordered] == [sum(x.n_tokens for x in ordered[:k]) for k in range(len(ordered))]
    keys = [(r.doc_id is not None, r.doc_id or 0) for r in ordered]
    assert keys == sorted(keys)


def test_nearest_neighbours(spark, odd):
    rows = QUERIES["op10_nn_descent_search"](spark, odd[0]).collect()
    distinct = [(i, v) for i, v, _ in odd[2]]
    want, got = plain.nearest(distinct), defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        got[r.query_id].append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
    assert {q for q, w in want.items() if w} == set(got)
    for q, near in got.items():
        assert len(near) == len(want[q]) and near == sorted(near, key=lambda x: (x[1], x[0]))
        assert all(abs(d - dict_distance(distinct, q, i)) == 0 for i, d in near)
    found = sum(len({i for i, _ in near} & {i for i, _ in want[q]}) for q, near in got.items())
    assert found >= 0.9 * sum(map(len, want.values()))


def dict_distance(rows, a, b):
    by = dict(rows)
    return float(np.sqrt(((np.array(by[a], float) - np.array(by[b], float)) ** 2).sum()))


def test_recall_on_given_vectors(spark):
    folder = "/root/testdata/sf0.01"
    table = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    want = plain.nearest([(r.vec_id, r.embedding) for r in table])
    rows = QUERIES["op10_nn_descent_search"](spark, folder).collect()
    hits = sum(r.vec_id in {i for i, _ in want[r.query_id]} for r in rows)
    assert hits >= 0.9 * sum(map(len, want.values()))
