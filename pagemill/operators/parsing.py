"""What follows the page reader: text and fonts of page dictionaries, block ids, table text, block counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.functions.text import col, strip
from pagemill.session import ranked


def block_text(lines: Column | str) -> Column:
    """Spans joined within a line, lines joined by line feeds; lines are array<struct<spans:array<struct<text,...>>>>."""
    return F.array_join(F.transform(col(lines), lambda l: F.array_join(F.transform(l["spans"], lambda s: s["text"]), "")), "\n")


def font_info(lines: Column | str) -> Column:
    """Sorted distinct fonts, mean and largest size, 0 without spans."""
    spans = F.flatten(F.transform(col(lines), lambda l: l["spans"]))
    sizes = F.transform(spans, lambda s: s["size"].cast("double"))
    n = F.size(sizes)
    mean = F.when(n > 0, F.aggregate(sizes, F.lit(0.0), lambda a, x: a + x) / n).otherwise(0.0)
    return F.struct(
        F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["font"]))).alias("fonts"),
        mean.alias("avg_size"), F.coalesce(F.array_max(sizes), F.lit(0.0)).alias("max_size"),
    )


def image_placeholder(xref: Column | str, index: Column | str) -> Column:
    return F.format_string("[IMAGE: xref=%d, index=%d]", col(xref), col(index))


def with_block_ids(blocks: DataFrame) -> DataFrame:
    """Number the blocks of a source in page order, one counter for all types; (source, page, ord) is a key.

    Keys alone are ranked, a large source in ranges; contents follow by a join on the key.
    """
    key = ["source", "page", "ord"]
    n = ranked(blocks.select(*key), ["source"], ["page", "ord"], "_n")
    prefix = F.when(F.col("type") == "text", "block").otherwise(F.col("type"))
    return blocks.join(n, key).withColumn("block_id", F.format_string("%s_%04d_%04d", prefix, F.col("page"), F.col("_n") + 1)).drop("_n")


def table_text(rows: Column | str) -> Column:
    """Cells joined by " | ", rows by line feeds; empty cells are kept and null ones are empty."""
    cells = lambda r: F.transform(r, lambda x: F.coalesce(x, F.lit("")))
    return F.array_join(F.transform(col(rows), lambda r: F.array_join(cells(r), " | ")), "\n")


def table_text_compact(rows: Column | str) -> Column:
    """Stripped cells joined by " | ", empty cells and rows dropped; the form that is chunked."""
    cells = F.transform(col(rows), lambda r: F.array_join(F.transform(F.filter(r, lambda x: F.coalesce(x, F.lit("")) != ""), strip), " | "))
    return F.array_join(F.filter(cells, lambda r: r != ""), "\n")


def block_counts(blocks: DataFrame) -> DataFrame:
    kinds = [F.count_if(F.col("type") == k).alias(f"{k}_blocks") for k in ("text", "table", "image")]
    return blocks.groupBy("source").agg(F.count("*").alias("total_blocks"), *kinds)
