"""Statistics of runs and chunk sets. Every one is a single pass with map-side aggregation; empty input gives zeros."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Lower bounds of the token histogram.
TOKEN_BUCKETS = [("<200", 0, 200), ("200-499", 200, 500), ("500-799", 500, 800), ("800-1199", 800, 1200), (">=1200", 1200, None)]
COST_PER_CALL = 0.001


def token_histogram(chunks: DataFrame) -> DataFrame:
    """(bucket, n), empty buckets included: one row of conditional counts, turned into rows."""
    n = F.col("token_count")
    counts = [F.count_if((n >= a) & (n < b) if b else n >= a).alias(name) for name, a, b in TOKEN_BUCKETS]
    row = chunks.agg(*counts)
    return row.select(F.inline(F.array(*[F.struct(F.lit(name).alias("bucket"), F.col(f"`{name}`").alias("n")) for name, *_ in TOKEN_BUCKETS])))


def quality_distribution(chunks: DataFrame) -> DataFrame:
    """(llm_quality, n, percent) with null as not_evaluated; the window runs over a handful of groups."""
    by = chunks.groupBy(F.coalesce("llm_quality", F.lit("not_evaluated")).alias("llm_quality")).agg(F.count("*").alias("n"))
    return by.withColumn("percent", F.round(F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy(F.lit(1))), 4))


def rejection_reasons(rejected: DataFrame, reason: str = "reason") -> DataFrame:
    return rejected.groupBy(F.coalesce(reason, F.lit("unknown")).alias("reason")).agg(F.count("*").alias("n"))


def report_summary(chunks: DataFrame) -> DataFrame:
    """Averages of accepted chunks, 0 when there is none, and recommendations, null when there is none."""
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    row = chunks.agg(
        F.count("*").alias("n_chunks"),
        F.coalesce(F.sum("token_count"), F.lit(0)).alias("total_tokens"),
        F.round(zero(F.avg("token_count")), 6).alias("avg_tokens"),
        F.round(zero(F.avg("rule_score")), 6).alias("avg_rule_score"),
        F.round(zero(F.avg("llm_confidence")), 6).alias("avg_llm_confidence"),
    )
    avg = F.col("avg_tokens")
    return row.withColumns(
        {
            "top_k": F.when(avg > 0, F.greatest(F.lit(3), F.least(F.lit(10), F.floor(F.lit(1000) / avg))).cast("int")),
            "chunk_size": F.when(avg > 0, F.floor(avg * 0.8).cast("int")),
        }
    )


def run_stats(blocks: DataFrame, chunks: DataFrame) -> DataFrame:
    """Per source: pages, blocks by type, chunks accepted and rejected, and their averages."""
    b = blocks.groupBy("source").agg(
        F.count_distinct("page").alias("processed_pages"),
        F.count("*").alias("total_blocks"),
        *[F.count_if(F.col("type") == k).alias(f"{k}_blocks") for k in ("text", "table", "image")],
    )
    c = chunks.groupBy("source").agg(
        F.count("*").alias("total_chunks"),
        F.count_if(F.col("quality") != "reject").alias("accepted_chunks"),
        F.count_if(F.col("quality") == "reject").alias("rejected_chunks"),
        F.round(F.avg("char_count"), 6).alias("avg_chunk_length"),
        F.round(F.avg("rule_score"), 6).alias("avg_rule_score"),
    )
    c = c.withColumnRenamed("source", "_s")
    out = b.join(c, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s").fillna(0)
    return out.withColumn("acceptance_rate", F.round(F.col("accepted_chunks") * 100.0 / F.greatest("total_chunks", F.lit(1)), 6))


def stored_rates(runs: DataFrame) -> DataFrame:
    """Of stored runs: chunks accepted in percent, and the cost of the reviews."""
    rate = F.round(F.col("accepted_chunks") * 100.0 / F.greatest("total_chunks", F.lit(1)), 6)
    cost = F.round(F.col("llm_calls") * COST_PER_CALL, 6)
    return runs.select("source_file", "total_pages", "total_chunks", rate.alias("acceptance_rate"), cost.alias("llm_cost"))
