"""The groups of the language model's token pairs."""

import numpy as np
import pytest

from basketry.llm import katz
from tests.llm import plain


def _dealt(spark, docs, *more):
    docs = docs.withColumn("learned", katz.learned_from(docs))
    return katz._deal(docs, katz.frequent_words(docs), *more, 4).collect()


def _sort(rows):
    return sorted(map(repr, rows))


HOT = [(i, ("of the " * 60 if i % 3 else f"new{i} x{i} " * 20) + f"a{i % 7} the b{i % 11}") for i in range(300)]
HOT += [(400 + i, "") for i in range(40)]


def test_a_map_task_that_runs_again_gives_the_same_rows(spark, tmp_path):
    texts = [(i, f"a{i % 7} b{i % 11} of the c{i}") for i in range(300)]
    spark.createDataFrame(texts, "doc_id long, text string").repartition(3).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    none = np.zeros(0, np.uint64)
    first, again = _dealt(spark, docs, none), _dealt(spark, docs, none)
    assert _sort(first) == _sort(again)
    flushes = [r.flush for r in first if r.bucket < 0]
    assert len(flushes) == len(set(flushes)) == docs.rdd.getNumPartitions()


@pytest.mark.parametrize("dictionary_sample", [katz.SAMPLE, 3])
def test_heavy_words_and_pairs_are_not_one_groups_work(spark, tmp_path, monkeypatch, dictionary_sample):
    monkeypatch.setattr(katz, "SAMPLE", dictionary_sample)
    monkeypatch.setattr(katz, "HEAVY", 400)
    spark.createDataFrame(HOT, "doc_id long, text string").repartition(24).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    groups, deal = [], katz._deal

    def watched(*given):
        dealt = deal(*given)
        sizes = {}
        for r in dealt.filter("bucket >= 0").collect():
            sizes[r.bucket] = sizes.get(r.bucket, 0) + len(r.owners) // 2
        groups.append(sizes)
        return dealt

    monkeypatch.setattr(katz, "_deal", watched)
    rows = katz.katz_scores(docs).collect()
    assert max(groups[0].values()) < sum(groups[0].values()) / 4  # 'of the' is two fifths of all tokens
    want, *_ = plain.katz(HOT, katz.discounts, katz.ESCAPE)
    got = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5), round(r.score, 5)) for r in rows]
    assert _sort(got) == _sort((*w[:5], round(w[5], 5), round(w[6], 5)) for w in want)


def test_what_groups_return_does_not_grow_with_their_number(spark):
    texts = [(i, " ".join(f"w{(i * 7919 + j * j * 31 + i * j) % 4001}" for j in range(300))) for i in range(200)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    docs = docs.withColumn("learned", katz.learned_from(docs))
    dictionary, none = katz.frequent_words(docs), katz.HeavyPairs(*[np.zeros(0, np.uint64)] * 3, np.zeros(0, np.int64))
    shared = spark.sparkContext.broadcast((dictionary, np.random.default_rng(1).integers(1, 900, 1 << 16), none))
    found = katz._deal(docs, dictionary, none.pairs, 8).groupBy("bucket").applyInArrow(katz._count(shared, 8), katz.FOUND)
    rows = found.filter("kind = 1").collect()
    assert sum(len(r.counts) + len(r.before or b"") for r in rows) < 4 * 200 * 301  # a few bytes of each token
