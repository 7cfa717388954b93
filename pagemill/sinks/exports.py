"""Exports of chunks. Rows are projected natively and written by the tasks; nothing is gathered on the driver.

Forms that are one JSON document by their nature (Milvus, text list, graph) are written as JSON lines of the same
records, which is what bulk loaders read; milvus_document assembles the document only within a bound.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CSV_COLUMNS = ["chunk_id", "source", "page_start", "page_end", "token_count", "char_count", "rule_score", "llm_quality", "llm_confidence", "content"]
#: Most rows of an export that is one document on the driver.
ONE_DOCUMENT = 100_000


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def _three(c: str) -> Column:
    """Three decimals, empty for null and 0."""
    v = F.coalesce(F.col(c), F.lit(0.0))
    return F.when(v == 0, F.lit("")).otherwise(F.replace(F.format_number(v, 3), F.lit(","), F.lit("")))


def csv_rows(chunks: DataFrame) -> DataFrame:
    """Ten columns; content is cut to 200 characters and marked where it was longer."""
    cut = F.when(F.length("content") > 200, F.concat(F.substring("content", 1, 200), F.lit("..."))).otherwise(F.col("content"))
    new = {"rule_score": _three("rule_score"), "llm_confidence": _three("llm_confidence"), "content": cut, "llm_quality": F.coalesce("llm_quality", F.lit(""))}
    return chunks.withColumns(new).select(*CSV_COLUMNS)


def write_csv(chunks: DataFrame, path: str) -> None:
    csv_rows(chunks).write.mode("overwrite").options(header=True, escape='"', lineSep="\n", emptyValue="").csv(path)


def markdown_sections(chunks: DataFrame) -> DataFrame:
    """(chunk_id, section): a heading, its origin, its sizes, its scores where there are any, and the content."""
    score = F.when(F.coalesce(F.col("rule_score"), F.lit(0.0)) != 0, F.concat(F.lit("**Rule Score:** "), _three("rule_score"), F.lit("\n\n"))).otherwise("")
    quality = F.when(F.length("llm_quality") > 0, F.concat(F.lit("**LLM Quality:** "), F.col("llm_quality"), F.lit("\n\n"))).otherwise("")
    section = F.concat(
        F.lit("## "), F.col("chunk_id"), F.lit("\n\n**Source:** "), F.coalesce("source", F.lit("")), F.lit(" (Pages "), F.col("page_start").cast("string"), F.lit("-"),
        F.col("page_end").cast("string"), F.lit(")\n\n**Stats:** "), F.col("token_count").cast("string"), F.lit(" tokens, "), F.col("char_count").cast("string"),
        F.lit(" chars\n\n"), score, quality, F.coalesce("content", F.lit("")), F.lit("\n\n---\n"),
    )
    return chunks.select("chunk_id", section.alias("section"))


def write_markdown(chunks: DataFrame, path: str) -> None:
    markdown_sections(chunks).orderBy("chunk_id").select("section").write.mode("overwrite").text(path)


def dify_rows(chunks: DataFrame) -> DataFrame:
    return chunks.select("content", F.struct("source", "page_start", "page_end", "chunk_id", "token_count").alias("meta"))


def vector_rows(chunks: DataFrame) -> DataFrame:
    """(text, metadata as JSON): what a vector index is loaded from."""
    meta = F.to_json(F.struct("chunk_id", "source", "page_start", "page_end", "token_count"))
    return chunks.select(F.col("content").alias("text"), meta.alias("metadata"))


def milvus_rows(chunks: DataFrame) -> DataFrame:
    return chunks.select(F.col("chunk_id").alias("id"), F.col("content").alias("text"), "source", "page_start", "page_end", "token_count", "rule_score")


def milvus_document(chunks: DataFrame, path: str, collection: str = "rag_chunks") -> None:
    """One JSON document of all rows; refused beyond ONE_DOCUMENT rows."""
    rows = [r.asDict() for r in milvus_rows(chunks).limit(ONE_DOCUMENT + 1).collect()]
    if len(rows) > ONE_DOCUMENT:
        raise ValueError(f"more than {ONE_DOCUMENT} rows: write milvus_rows as JSON lines")
    write_text(chunks.sparkSession, json.dumps({"collection_name": collection, "data": rows}, ensure_ascii=False, indent=2), path)


def write_text(spark: SparkSession, text: str, path: str) -> None:
    """A small document as a text file in the folder `path`, on whatever file system it names."""
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def text_rows(chunks: DataFrame) -> DataFrame:
    return chunks.filter(F.length("content") > 0).select("chunk_id", "content")


def chunk_schema(df: DataFrame) -> dict:
    """The fields of the chunk records, with the values that llm_quality takes and 0-based pages."""
    out = json.loads(df.schema.json())
    notes = {"llm_quality": "good, low, reject or null", "page_start": "0-based", "page_end": "0-based"}
    for f in out["fields"]:
        if f["name"] in notes:
            f["metadata"] = {"note": notes[f["name"]]}
    return out


def file_summary(spark, path: str) -> DataFrame:
    """(file, kib, lines) of the text files under a path."""
    lines = spark.read.text(path).select(F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_size").alias("size"))
    return lines.groupBy("file", "size").agg(F.count("*").alias("lines")).select("file", F.round(F.col("size") / 1024, 2).alias("kib"), "lines")
