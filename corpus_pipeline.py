"""The corpus pipeline: quality rules, near-dedup, suffix-array dedup, mixing, encoding.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. All but the last return the
columns of documents; the last returns the sampled pieces of each document in the mix, in the order of the mix.

Defined cases, stage by stage as their operators define them: null and empty texts pass all stages (they have no repeats,
no words to compare and no pieces, and are lossless); rows without doc_id are never removed as copies; rows that share
a doc_id are judged each by its own text; very long texts are worked on whole; further columns, whatever their names, go
through to the last stage; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plinth.llm.components import cut, discard
from plinth.llm.dartminhash import drop_near_duplicates
from plinth.llm.mixing import mixed_documents
from plinth.llm.pieces import sample_pieces
from plinth.llm.repetition import drop_repetitive
from plinth.llm.suffix_dedup import drop_repeated_passages


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_repetitive(docs, min_repeated=0)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_repeated_passages(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sample_pieces(docs)


STAGES = [("quality rules", quality_rules), ("near dedup", near_dedup), ("suffix dedup", suffix_dedup), ("mix sources", mix_sources), ("encode", encode)]
#: SQL can't express suffix sorts, darts or sampled segmentations; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut(docs, f"stage{k}")
            if before is not None:
                discard(before)
            before = docs
    return docs
