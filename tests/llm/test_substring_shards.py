"""The shards of the passage removal."""

from basketry.llm import substring
from basketry.llm.queries import QUERIES
from tests.llm import plain

PHRASE = " ".join(f"notice{i}" for i in range(40))
DOCS = [(i, " ".join(f"l{i}x{j}" for j in range(60)) + f" {PHRASE} " + " ".join(f"r{i % 90}x{j}" for j in range(60))) for i in range(120)]
DOCS += [(500, DOCS[3][1] + " end"), (501, "x " + DOCS[3][1]), (501, f"{PHRASE} {PHRASE} {PHRASE}"), (None, DOCS[3][1])]


def test_a_phrase_inside_different_texts_is_not_one_shards_work(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(substring, "SHARD_WORDS", 1000)
    spark.createDataFrame(DOCS, "doc_id long, text string").repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    words, automata = [], substring.first_documents

    def watched(contents, window):
        words.extend((r.anchor, len(r.words.split())) for r in contents.collect())
        return automata(contents, window)

    monkeypatch.setattr(substring, "first_documents", watched)
    rows = QUERIES["op5_substring_dedup"](spark, str(tmp_path)).collect()
    by_anchor = {a: sum(n for b, n in words if a == b) for a, _ in words}
    assert max(by_anchor.values(), default=0) <= 1500
    assert sorted(map(tuple, rows), key=repr) == sorted(map(tuple, plain.without_repeats(DOCS)), key=repr)
    assert sum(r.n_removed for r in rows) > 30 * 60
