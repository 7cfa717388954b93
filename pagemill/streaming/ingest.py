"""Streaming ingestion: files of page blocks that arrive are validated and appended; a restart resumes where it stopped.

The checkpoint location takes the place of a progress file. A batch is written under its number, so one that is repeated
after a failure overwrites itself and counts once. A source's pages must arrive in one file, as its windows need them all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.config import Config
from pagemill.plans.pipeline import to_chunks
from pagemill.schemas import PAGE_BLOCKS


def read_stream(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    return spark.readStream.schema(PAGE_BLOCKS).format(fmt).load(path)


def ingest(spark: SparkSession, path: str, out_dir: str, checkpoint: str, c: Config = Config(), fmt: str = "json"):
    """Process what is there and stop; call again for what arrives later."""

    def write(batch: DataFrame, n: int) -> None:
        to_chunks(batch, c).withColumn("batch", F.lit(n)).write.mode("overwrite").parquet(f"{out_dir}/batch={n}")

    q = read_stream(spark, path, fmt).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def block_counts_stream(blocks: DataFrame, watermark: str = "1 hour", window: str = "10 minutes") -> DataFrame:
    """Blocks per type and event-time window; deliveries repeated within the watermark count once."""
    return (
        blocks.withWatermark("ingested_at", watermark)
        .dropDuplicatesWithinWatermark(["source", "block_id"])
        .groupBy(F.window("ingested_at", window), "type")
        .agg(F.count("*").alias("n"))
    )
