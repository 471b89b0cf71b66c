"""Texts that share less than would count are not compared."""

import pyarrow as pa
from pyspark.sql import functions as F

from basketry.llm import jaccard_join, substring
from basketry.llm.shared import possible
from basketry.llm.worker import give_back, giving_back
from tests.llm import plain


def _docs(spark, path, rows):
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(str(path))
    return spark.read.parquet(str(path))


def test_contents_are_not_joined_with_the_frequent_anchors(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(substring, "SHARD_WORDS", 1000)
    phrase = " ".join(f"c{i}" for i in range(40))
    rows = [(i, " ".join(f"l{i}x{j}" for j in range(45)) + f" {phrase} " + " ".join(f"r{i}x{j}" for j in range(45))) for i in range(60)]
    rows += [(100, rows[5][1] + " end"), (101, rows[7][1])]
    find, plans, sizes = substring.first_documents_by_window, [], []

    def watched(contents, window):
        plans.append(contents._jdf.queryExecution().toString())
        sizes.append(contents.count())
        return find(contents, window)

    monkeypatch.setattr(substring, "first_documents_by_window", watched)
    got = substring.without_repeats(_docs(spark, tmp_path / "d", rows)).select("doc_id", "n_words", "n_removed").collect()
    assert "Join" not in plans[0] and sizes[0] > 30
    want = {r[0]: r[1:3] for r in plain.without_repeats(rows)}
    assert {r.doc_id: (r.n_words, r.n_removed) for r in got} == want
    assert want[100][1] == 130


def test_points_that_meet_by_chance_are_not_measured(spark, tmp_path, monkeypatch):
    common = " ".join(f"c{i}" for i in range(86))
    rows = [(i, common + " " + " ".join(f"u{i}x{j}" for j in range(18))) for i in range(30)]
    rows.append((50, rows[3][1] + " end"))
    measure, asked = jaccard_join._distances, []

    def watched(pairs, points):
        asked.extend({r.doc, r.pivot} for r in pairs.collect())
        return measure(pairs, points)

    monkeypatch.setattr(jaccard_join, "_distances", watched)
    got = jaccard_join.jaccard_components(_docs(spark, tmp_path / "d", rows)).collect()
    assert sorted(map(tuple, got)) == sorted(plain.jaccard(rows))
    assert {3, 50} in asked and len(asked) < 15


def test_names_of_dealt_sets_are_short(spark, tmp_path):
    docs = _docs(spark, tmp_path / "d", [(i, "a b c d e f g h " + "x" * (i % 3)) for i in range(9)])
    found = jaccard_join.repeated_shingles(docs, 5, 100).collect()
    assert len(found) == 3 and {len(r.name) for r in found} == {8}


def test_freed_memory_goes_back():
    def held():
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * 4096

    kept = [bytes(50_000) for _ in range(6000)]
    full, last = held(), kept[-1]
    del kept
    give_back()
    assert full - held() > 200_000_000 and len(last)


def test_only_what_may_be_linked_is_sent(spark, tmp_path, monkeypatch):
    rows = [(i, " ".join(f"u{i}x{j}" for j in range(40))) for i in range(80)]
    rows += [(200 + i, rows[i][1] + " end") for i in range(3)] + [(None, rows[9][1])]
    kept, choose = [], jaccard_join.possible

    def watched(df, column, ids):
        found = choose(df, column, ids)
        kept.append((found.count(), df.count()))
        return found

    monkeypatch.setattr(jaccard_join, "possible", watched)
    got = jaccard_join.jaccard_components(_docs(spark, tmp_path / "d", rows)).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, plain.jaccard(rows)))
    assert kept[0][0] <= 8 and kept[0][1] == 84  # of the texts


def test_possible_keeps_all_that_are_there(spark):
    ids = spark.range(0, 3000, 3).toDF("a").union(spark.createDataFrame([(None,), (3,)], "a long"))
    rows = spark.range(20_000).withColumn("x", F.lit("y"))
    kept = possible(rows, "id", ids)
    assert kept.columns == ["id", "x"]
    got = {r.id for r in kept.collect()}
    assert set(range(0, 3000, 3)) <= got and len(got) < 1100 and kept.count() == len(got)


def test_a_worker_gives_back_after_its_last_batch():
    def held():
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * 4096

    full = []

    @giving_back
    def work(batches):
        kept = [bytes(50_000) for _ in range(6000)]
        yield from batches
        full.append(held() + 0 * len(kept))

    batches = list(work(iter([pa.RecordBatch.from_pylist([{"a": 1}])])))
    assert [b.num_rows for b in batches] == [1, 0] and batches[0].schema == batches[1].schema
    assert full[0] - held() > 200_000_000 and not list(work(iter([])))
