"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from plinth.llm.chat import ORACLE_SQL as CHAT_SQL
from plinth.llm.chat import canonical_turns, raw_records
from plinth.llm.dartminhash import near_duplicates
from plinth.llm.embedding_dedup import embedding_near_duplicates
from plinth.llm.licenses import license_scan
from plinth.llm.mixing import ORACLE_SQL as MIXING_SQL
from plinth.llm.mixing import mix_schedule
from plinth.llm.pieces import sample_pieces
from plinth.llm.repetition import repetition_scores
from plinth.llm.site_style import site_text
from plinth.llm.suffix_dedup import repeated_passages
from plinth.llm.warc import warc_bundles

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_near_duplicates(_table(spark, sf_dir, "embeddings"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that the repetition rules keep, with their figures; the limits hold at every length."""
    return repetition_scores(_table(spark, sf_dir, "documents"), min_repeated=0).where("kept").drop("kept")


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_pieces(_table(spark, sf_dir, "documents"))


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_schedule(_table(spark, sf_dir, "documents"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(_table(spark, sf_dir, "documents"))


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(_table(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_bundles(_table(spark, sf_dir, "pages"))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_text(_table(spark, sf_dir, "pages"))


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversations, brought into ten layouts and back into canonical turns."""
    return canonical_turns(raw_records(_table(spark, sf_dir, "conversations")))


QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_embedding_near_dedup, op2_quality_rules, op3_sentencepiece, op4_mix_sources, op5_license_scan, op6_minhash_near_dedup, op7_suffix_array_dedup, op8_warc, op9_html_extraction, op10_chat_formatting)}
ORACLE_SQL: dict[str, str] = {"op4_mix_sources": MIXING_SQL, "op10_chat_formatting": CHAT_SQL}
