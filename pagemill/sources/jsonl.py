"""JSON lines written by a run, read back with the defaults of missing fields. Blank lines are skipped."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.schemas import CHUNKS, PAGE_BLOCKS


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.schema(CHUNKS).json(path)
    defaults = {"token_count": 0, "char_count": 0, "rule_score": 1.0, "llm_confidence": 0.0, "llm_reason": ""}
    return df.filter("chunk_id is not null").fillna(defaults)


def read_rejected(spark: SparkSession, path: str) -> DataFrame:
    """(chunk_id, reason, content): the reason or "unknown", and the first 100 characters."""
    df = spark.read.schema(CHUNKS).json(path).filter("chunk_id is not null")
    return df.select("chunk_id", F.coalesce(F.col("metadata")["reject_reason"], F.lit("unknown")).alias("reason"), F.substring("content", 1, 100).alias("content"))


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PAGE_BLOCKS).json(path).fillna({"confidence": 1.0})
