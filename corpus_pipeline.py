"""A training corpus from raw documents, stage by stage.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; its result is written as
Parquet and read again as the next stage's ``docs``.  All stages but the last
return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.jaccard_join import jaccard_components
from basketry.llm.mixing import mixed
from basketry.llm.packing import packed_documents
from basketry.llm.queries import tokenizer_path
from basketry.llm.shared import read_table, save, ship_package
from basketry.llm.substring import without_repeats
from basketry.llm.toxicity import train_toxicity, with_toxicity


def beside_text(docs: DataFrame, *needed: str) -> DataFrame:
    """The text, the ``needed`` columns, and all others as ``row``, whatever their
    names; a text travels once."""
    others = [F.col(c) for c in docs.columns if c != "text"] or [F.lit(None).cast("string").alias("none")]
    return docs.select(F.struct(*others).alias("row"), *needed, "text")


def unpacked(rows: DataFrame, docs: DataFrame, **new: Column) -> DataFrame:
    """The columns of ``docs`` from ``beside_text`` rows, some of them new."""
    plain = {c: F.col("text") if c == "text" else F.col("row")[c] for c in docs.columns} | new
    return rows.select(*[plain[c].alias(c) for c in docs.columns])


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below 0.5; labels are read from ``sf_dir``."""
    ship_package(spark)
    model = train_toxicity(docs, read_table(spark, sf_dir, "labels"))
    kept = with_toxicity(beside_text(docs), model).filter("predicted = 0")
    return unpacked(kept, docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the smallest
    doc_id.  Documents without doc_id stay, and so do rows that repeat the one
    that stays."""
    ship_package(spark)
    groups = jaccard_components(docs)
    gone = groups.filter("doc_id != component_id").select("doc_id").distinct()
    return docs.join(gone, docs["doc_id"].cast("long") == gone["doc_id"], "left_anti")


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 50 words that an earlier one has.  A
    text that loses words becomes its other words, joined by one blank, and
    ``n_chars`` follows; all other texts stay as they are."""
    ship_package(spark)
    kept = without_repeats(beside_text(docs, "doc_id"))
    changed = F.col("n_removed") > 0
    new = {"text": F.when(changed, F.col("kept_text")).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        size = F.length("kept_text").cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.when(changed, size).otherwise(F.col("row.n_chars"))
    return unpacked(kept, docs, **new)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target weights (the default: shares of bytes to the power
    0.7), every document once: the rows are those of ``docs`` in the order of the mix,
    from the first file to the last."""
    ship_package(spark)
    order = ["mix_slot", "mix_start", "doc_id"]
    rows = mixed(beside_text(docs, "doc_id", "source"), once=True)
    return unpacked(rows.repartitionByRange(*order).sortWithinPartitions(*order), docs)


def file_order(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_place``, the order in which its files hold the rows.  A table
    that doesn't come from files has no such order, and the column is 0."""
    try:
        file, row = F.col("_metadata.file_name"), F.col("_metadata.row_index")
        number = F.regexp_extract(file, r"part-(\d+)", 1).try_cast("long")
        return docs.select("doc_id", "text", (F.shiftleft(F.coalesce(number, F.lit(0)), 33) + row).alias("_place"))
    except AnalysisException:
        return docs.select("doc_id", "text", F.lit(0).cast("long").alias("_place"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids in sequences of 4096; pieces of one length keep the
    order of the mix."""
    ship_package(spark)
    return packed_documents(file_order(docs), tokenizer_path("word_bpe_49k.json"), place="_place")[1]


STAGES = [
    ("toxicity", toxicity),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", repeated_passages),
    ("mixing sources", source_mix),
    ("best-fit packing", packing),
]

#: Tokenising, learned scores and hashed orders have no SQL; tests hold the stages
#: against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), "pipeline")
    return STAGES[-1][1](spark, docs, sf_dir)
