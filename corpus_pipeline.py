"""The corpus pipeline: stages over documents, each written and read again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deliverylens.llm import decontaminate, line_dedup, near_dup, packing, quality_rules
from deliverylens.llm.session import scratch
from deliverylens.llm.tokens import vocabulary

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base conditions or a learned rule go."""
    judged, _ = quality_rules.judge(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judged.where("kept").select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of three-line windows are cut; a document of which no word is left goes.

    Rows with a null id or text stay as they are; repeated ids are told apart by their texts.
    """
    cut = line_dedup.dedup_lines(docs)
    left = cut.where((F.col("n_removed_lines") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return left.withColumn("n_chars", F.when(F.col("n_removed_lines") > 0, F.length("text")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def _row() -> Column:
    """What names a document: its id and a hash of its text, so that namesakes with other texts are judged apart."""
    return F.struct("doc_id", F.xxhash64("text").alias("t"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays.

    SimHash fingerprints (the operator of op4) propose pairs, whole sets of shingles decide, and
    pairs that fingerprints miss are found by an exact join.
    Rows with a null id stay. Rows that share an id but not a text are documents of
    their own; rows equal in both are one document and stay or go together. Null texts and texts
    without words are one group; an empty table stays empty.
    """
    groups = near_dup.groups(docs.where("doc_id IS NOT NULL").select(_row().alias("row"), "text"), id_col="row")
    gone = groups.where("row != group_id").select("row").distinct()
    return docs.join(gone, _row() == gone["row"], "left_anti").select(*COLUMNS)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a copy of a test item go, whatever their id; one with a clean text stays though its namesake goes.

    Null texts and an empty table on either side lose nothing.
    """
    rows = docs.select(_row().alias("doc_id"), "text")
    gone = decontaminate.contaminated(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(F.col("doc_id").alias("row")).distinct()
    return docs.join(gone, _row().eqNullSafe(gone["row"]), "left_anti").select(*COLUMNS)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training sequences: one row a piece."""
    return packing.pack(docs, vocabulary("word_bpe_49k.json"))


STAGES = [("quality rules", quality), ("line dedup", lines), ("near copies", near_copies), ("decontamination", leaks), ("packing", sequences)]

#: Learned rules, set joins and alignments have no SQL form; tests hold each
#: stage against a brute-force version (near copies in tests/llm/test_near_dup.py).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            out = scratch(spark, f"stage{k + 1}")
            docs.write.parquet(out)
            docs = spark.read.parquet(out)
    return docs
