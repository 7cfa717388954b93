"""The whole way from page blocks to routed chunks, and its outputs."""

from __future__ import annotations

import json
import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.config import Config
from pagemill.operators import chunking, graph, normalize, validation
from pagemill.operators.aggregates import run_stats
from pagemill.session import checkpointed, small_side
from pagemill.sinks import exports, report


def to_chunks(blocks: DataFrame, c: Config = Config()) -> DataFrame:
    """Normalized, windowed, chunked, numbered and validated chunks.

    Windows rank the pages of the blocks as given, so a page whose blocks all vanish still counts. Texts are shuffled by
    page and by window and nowhere else. Blocks without a source are one source; those without a page are left out.
    """
    blocks = blocks.withColumn("source", F.coalesce("source", F.lit(""))).filter("page is not null")
    clean = normalize.normalize_blocks(blocks, c.normalization)
    windows = chunking.window_texts(clean, c.runtime.batch_size, blocks)
    return validation.validated(chunking.numbered(chunking.chunk_windows(windows, c.chunk)), c.quality)


def run(blocks: DataFrame, out_dir: str, c: Config = Config(), ask: Callable[[str], str | None] | None = None, strategy: str = "balanced") -> dict:
    """Write pages, chunks, rejects, exports, report and statistics to any file system; gives the totals.

    Chunks are computed and validated once; reviews are asked for once. Nothing but aggregates reaches the driver.
    """
    spark, began = blocks.sparkSession, time.time()
    chunks = checkpointed(to_chunks(blocks, c).withColumn("metadata", F.create_map().cast("map<string,string>")))
    if ask is not None:
        chunks = checkpointed(validation.reviewed(chunks, ask, c))
    else:
        chunks = chunks.withColumns({"llm_quality": F.lit(None).cast("string"), "llm_confidence": F.lit(0.0), "llm_reason": F.lit("")})
    accepted, rejected = validation.routed(chunks)
    exports.write_jsonl(normalize.normalize_blocks(blocks, c.normalization), f"{out_dir}/pages")
    exports.write_jsonl(accepted, f"{out_dir}/chunks")
    exports.write_jsonl(rejected, f"{out_dir}/rejected")
    exports.write_csv(accepted, f"{out_dir}/csv")
    exports.write_markdown(accepted, f"{out_dir}/markdown")
    exports.write_jsonl(exports.dify_rows(accepted), f"{out_dir}/dify")
    exports.write_jsonl(exports.milvus_rows(accepted), f"{out_dir}/milvus")
    exports.vector_rows(accepted).write.mode("overwrite").parquet(f"{out_dir}/vectors")
    stats = run_stats(blocks, chunks)
    exports.write_jsonl(stats.withColumns({"duration_seconds": F.lit(round(time.time() - began, 3)), "failed_pages": F.lit(0)}), f"{out_dir}/stats")
    asked = chunks.filter(F.col("llm_quality").isNotNull()).count() if ask is not None else 0
    exports.write_text(spark, json.dumps(exports.chunk_schema(accepted), ensure_ascii=False, indent=2), f"{out_dir}/schema")
    exports.write_text(spark, report.html(accepted, rejected, asked, strategy), f"{out_dir}/report")
    return chunks.agg(F.count("*").alias("total_chunks"), F.count_if(F.col("quality") != "reject").alias("accepted_chunks")).first().asDict()


def extract_graph(chunks: DataFrame, ask: Callable[[str], str | None], out_dir: str, skip: int = 0, limit: int = 0, template: str = graph.TEMPLATE) -> DataFrame:
    """Ask for the entities and relations of each selected chunk and write the merged graph and its counts.

    A reply that is no JSON, or none at all, adds nothing. Replies are written before they are merged, so that each chunk
    is asked about once. Returns the counts.
    """

    @F.pandas_udf("string")
    def replies(prompts):
        return prompts.map(ask)

    picked = graph.selected(chunks.select("chunk_id", "content"), skip, limit).repartition(chunks.sparkSession.sparkContext.defaultParallelism)
    said = picked.select(F.col("chunk_id").alias("ord"), graph.parsed(replies.asNondeterministic()(graph.prompt(template, "content"))).alias("graph"))
    said = checkpointed(said.filter("graph is not null"))
    ents, rels = graph.entities(said), graph.relations(said)
    counts = small_side(graph.counts(ents, rels))
    for name, df in (("entities", ents), ("relations", rels), ("statistics", counts)):
        exports.write_jsonl(df, f"{out_dir}/{name}")
    return counts
