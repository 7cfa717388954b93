"""Page blocks from other tables, and page ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.schemas import PAGE_BLOCKS
from pagemill.session import ranked


def from_documents(docs: DataFrame) -> DataFrame:
    """One text block a page, one page a document, pages of a source by doc_id; documents without source are one source.

    Only (source, doc_id) is ranked, a large source in ranges; the text follows by a join on the id.
    """
    pages = ranked(docs.select("doc_id", F.coalesce("source", F.lit("")).alias("source")), ["source"], ["doc_id"], "page")
    types = dict(f.strip().split(" ", 1) for f in ["content_table struct<rows:array<array<string>>,row_count:int,col_count:int>", "bbox array<double>", "block_id string"])
    meta = PAGE_BLOCKS.split("metadata ")[1]
    return docs.select("doc_id", F.col("text").alias("content_text")).join(pages, "doc_id").select(
        "source", "page", F.lit(0).alias("ord"), F.lit("text").alias("type"), "content_text",
        F.lit(None).cast(types["content_table"]).alias("content_table"), F.lit(1.0).alias("confidence"),
        F.lit(None).cast(types["bbox"]).alias("bbox"), F.format_string("block_%04d_%04d", "page", F.col("page") + 1).alias("block_id"),
        F.lit(None).cast(meta).alias("metadata"),
    )


def page_range(blocks: DataFrame, start: int = 0, end: int | None = None) -> DataFrame:
    """Pages from start up to but without end, which reach the scan as a pushed filter."""
    out = blocks.filter(F.col("page") >= start)
    return out if end is None else out.filter(F.col("page") < end)
