"""Every stage of the pipeline on odd rows against a plain version."""

from collections import Counter, defaultdict

import numpy as np
import pytest
import corpus_pipeline as p
from tests.llm import plain
from tests.llm.test_llm_queries import _crc, _ids, _tokenizer, odd, sort  # noqa: F401


def table(docs):
    return sort(tuple(r) for r in docs.collect())


@pytest.fixture(scope="module")
def docs(spark, odd):  # noqa: F811
    return spark.read.parquet(f"{odd[0]}/documents.parquet")


def test_toxicity_stage_keeps_odd_rows_as_they_are(spark, odd, docs):  # noqa: F811
    """Too few labels to learn from: nothing goes, and nothing is changed."""
    kept = p.toxicity(spark, docs, odd[0])
    assert kept.columns == docs.columns and table(kept) == table(docs)


def test_toxicity_stage_takes_what_it_rejects(spark):
    folder = "/root/testdata/sf0.1"
    given = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {r.doc_id for r in p.toxicity(spark, given, folder).select("doc_id").collect()}
    labels = spark.read.parquet(f"{folder}/labels.parquet").collect()
    toxic, clean = ([r.doc_id for r in labels if r.toxic == x] for x in (1, 0))
    assert sum(i in kept for i in toxic) <= 0.1 * len(toxic)
    assert sum(i in kept for i in clean) >= 0.99 * len(clean)


def test_near_duplicates_leave_one_of_a_group(spark, docs):
    kept = p.near_duplicates(spark, docs, "")
    rows = docs.collect()
    groups = {i: c for i, _, c in plain.jaccard([(r.doc_id, r.text) for r in rows])}
    assert kept.columns == docs.columns
    assert table(kept) == sort(tuple(r) for r in rows if r.doc_id is None or groups[r.doc_id] == r.doc_id)


def test_repeated_passages_go(spark, docs):
    kept = p.repeated_passages(spark, docs, "")
    assert kept.columns == docs.columns
    rows = docs.collect()
    digests = plain.without_repeats([(r.doc_id, r.text) for r in rows])
    changed = Counter((i, sha) for i, _, gone, sha in digests if gone)
    got = [tuple(r) for r in kept.collect()]
    same = Counter(got) & Counter(map(tuple, rows))
    assert sum(same.values()) == len(rows) - sum(changed.values())
    import hashlib

    new = Counter(got) - same
    assert Counter((r[0], hashlib.sha256(r[1].encode()).hexdigest()) for r in new.elements()) == changed
    assert all(r[4] == len(r[1]) for r in new)


def test_the_mix_repeats_nothing_and_keeps_its_order(spark, docs):
    mixed = p.source_mix(spark, docs, "")
    assert mixed.columns == docs.columns and table(mixed) == table(docs)


def test_packing_follows_the_files(spark, tmp_path):
    """Documents of one length, written in an order that is not that of their ids."""
    rows = [(i * 7919 % 300, "one two three") for i in range(300)]
    frame = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "k int, doc_id long, text string")
    frame.repartitionByRange(3, "k").sortWithinPartitions("k").drop("k").write.parquet(str(tmp_path / "docs"))
    packed = p.packing(spark, spark.read.parquet(str(tmp_path / "docs")), "").collect()
    by_place = [r.doc_id for r in sorted(packed, key=lambda r: (r.sequence_id, r.offset))]
    assert by_place == [i for i, _ in rows]


def test_packing_stage_has_all_ids(spark, docs):
    tokenizer, want = _tokenizer("word_bpe_49k.json"), []
    for r in docs.collect():
        ids = _ids(tokenizer, r.text, 1)
        want += [(r.doc_id, k // 4096, k, len(ids[k : k + 4096]), _crc(ids[k : k + 4096])) for k in range(0, len(ids), 4096)]
    for given in (docs, spark.createDataFrame(docs.collect(), docs.schema)):  # files or not
        rows = p.packing(spark, given, "").collect()
        assert sort((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sort(want)
        by = defaultdict(list)
        for r in rows:
            by[r.sequence_id].append((r.offset, r.length))
        for places in by.values():
            assert [o for o, _ in sorted(places)] == np.cumsum([0, *[n for _, n in sorted(places)][:-1]]).tolist()
            assert sum(n for _, n in places) <= 4096


def test_all_stages_in_a_row(spark, odd):  # noqa: F811
    rows = p.run(spark, odd[0]).collect()
    times = Counter((r.doc_id, r.piece, r.start) for r in rows if r.doc_id is not None)
    assert rows and {i for (i, _, _), n in times.items() if n > 1} <= {1012}  # the row that the input repeats


def test_stages_take_an_empty_table(spark, docs):
    nothing = docs.limit(0)
    for _, stage in p.STAGES[1:]:
        out = stage(spark, nothing, "")
        assert out.collect() == []
