"""The queries of this subpackage, by name, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import arc, conversations, decontaminate, fill_middle, html_labeller, line_dedup, packing, quality_rules, sentence_pieces, simhash, substring_rlz, token_store, url_filter
from .tokens import vocabulary


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf_dir, "pages"), url_filter.OP1_RULES)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(_table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_removed_lines")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, _ = quality_rules.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.groups(_table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return out.select("doc_id", simhash.hex_of("fp").alias("fingerprint"), "component_id")


def op5_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.round_trip(spark, _table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op6_html_labeller(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_labeller.extract(_table(spark, sf_dir, "pages"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = arc.round_trip(spark, _table(spark, sf_dir, "pages"))
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op9_substring_rlz(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_rlz.factors(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.op11(_table(spark, sf_dir, "conversations"))


def op12_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_pieces.op12(_table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.op13(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_url_filter": op1_url_filter,
        "op2_line_dedup": op2_line_dedup,
        "op3_quality_rules": op3_quality_rules,
        "op4_simhash": op4_simhash,
        "op5_token_store": op5_token_store,
        "op6_html_labeller": op6_html_labeller,
        "op7_warc": op7_warc,
        "op8_packing": op8_packing,
        "op9_substring_rlz": op9_substring_rlz,
        "op10_decontaminate": op10_decontaminate,
        "op11_conversation_repair": op11_conversation_repair,
        "op12_sentence_pieces": op12_sentence_pieces,
        "op13_fill_middle": op13_fill_middle,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_url_filter": url_filter.ORACLE_SQL,
        "op2_line_dedup": line_dedup.ORACLE_SQL,
        "op13_fill_middle": fill_middle.ORACLE_SQL,
    }
