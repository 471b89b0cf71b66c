"""The queries of this package: (session, table directory) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm import oracle
from basketry.llm.jaccard_join import jaccard_components
from basketry.llm.katz import katz_scores
from basketry.llm.lexical_search import build_index, search
from basketry.llm.mixing import mixed
from basketry.llm.nn_descent import nearest
from basketry.llm.packing import packed_documents
from basketry.llm.pq_dedup import near_duplicates
from basketry.llm.prefix_trie import prefix_trie
from basketry.llm.shared import fold, read_table, ship_package
from basketry.llm.sharding import sharded
from basketry.llm.substring import without_repeats
from basketry.llm.token_files import token_digests
from basketry.llm.toxicity import train_toxicity, with_toxicity
from basketry.llm.url_filters import RULES, judged

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path(name: str) -> str:
    """The place of an installed public tokenizer; another one may be given to the operators."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return read_table(spark, sf_dir, "documents")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``held_out`` is true for a row without doc_id: nothing is learned from it."""
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    scored = with_toxicity(docs, train_toxicity(docs, read_table(spark, sf_dir, "labels")))
    held_out = F.coalesce(fold("doc_id", 5) == 0, F.lit(True))
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op2_katz_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz_scores(_documents(spark, sf_dir))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(_documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"))[1]


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(_documents(spark, sf_dir))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = without_repeats(_documents(spark, sf_dir).select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op6_pq_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op7_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharded(_documents(spark, sf_dir))


def op8_pfair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix as ``(doc_id, source, mix_pass, mix_block, mix_slot, mix_start)``."""
    docs = _documents(spark, sf_dir).select("doc_id", "source", "text")
    return mixed(docs).drop("text")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(_documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"))


def op10_nn_descent_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    table = read_table(spark, sf_dir, "embeddings")
    return nearest(table, table.filter(F.col("vec_id") % 100 == 0))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return prefix_trie(read_table(spark, sf_dir, "conversations"))


def op12_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(read_table(spark, sf_dir, "pages"), RULES)


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index, documents = build_index(_documents(spark, sf_dir))
    return search(index, documents, read_table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Query] = {
    "op1_toxicity": op1_toxicity,
    "op2_katz_scores": op2_katz_scores,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_pq_near_duplicates": op6_pq_near_duplicates,
    "op7_virtual_slots": op7_virtual_slots,
    "op8_pfair_mixing": op8_pfair_mixing,
    "op9_token_files": op9_token_files,
    "op10_nn_descent_search": op10_nn_descent_search,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_url_filters": op12_url_filters,
    "op13_lexical_search": op13_lexical_search,
}
ORACLE: dict[str, str] = {
    "op11_prefix_trie": oracle.PREFIX_TRIE,
    "op12_url_filters": oracle.URL_FILTERS,
    "op13_lexical_search": oracle.LEXICAL_SEARCH,
}
