"""Block normalization, all native expressions: filters before projections, no Python between scan and shuffle.

Null text stays null and is dropped by the validity filter; a block without a box is judged by its text alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.config import Normalization
from pagemill.functions.text import WS, ZH, col, strip
from pagemill.operators.validation import computed
from pagemill.session import small_side

# What noise is.
CONTROL = "[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f]"
ZERO_WIDTH = "[\\x{feff}\\x{200b}-\\x{200f}]"
ORNAMENT = "[■□▪▫●○◆◇★☆]+"
# Full-width marks and their plain forms.
PUNCTUATION = {
    "，": ",", "！": "!", "？": "?", "；": ";", "：": ":", "【": "[", "】": "]", "（": "(", "）": ")", "《": "<", "》": ">", "、": ",",
}


def is_page_number(c: Column | str) -> Column:
    w = f"[{WS}]*"
    return (
        col(c).rlike(f"^{w}[-—]?{w}\\p{{Nd}}+{w}[-—]?{w}$")
        | col(c).rlike(f"^{w}第{w}\\p{{Nd}}+{w}页{w}$")
        | col(c).rlike(f"(?i)^{w}page{w}\\p{{Nd}}+{w}$")
    )


def is_header_footer(content: Column | str, bbox: Column | str, max_lines: int = 3) -> Column:
    """Page numbers; short lines with a digit; short text in the margins of the page."""
    c, box = strip(content), col(bbox)
    few = (F.size(F.split(c, "\n")) <= max_lines) & c.rlike("\\p{Nd}") & (F.length(c) < 50)
    margin = F.coalesce(((F.get(box, F.lit(1)) < 50) | (F.get(box, F.lit(3)) > 750)) & (F.length(c) < 100), F.lit(False))
    return F.coalesce(is_page_number(c) | few | margin, F.lit(False))


def strip_noise(c: Column | str) -> Column:
    return F.regexp_replace(col(c), f"{CONTROL}|{ZERO_WIDTH}|{ORNAMENT}", "")


def merge_lines(c: Column | str, min_line_length: int = 5) -> Column:
    """Join wrapped lines: first where it is plain, then by a fold over the lines that merges or flushes.

    The fold's state is two strings, what is done and the buffer, so it stays linear in the number of lines.
    """
    text = F.regexp_replace(col(c), f"(?<=[{ZH}])\n(?=[{ZH}])", "")
    text = F.regexp_replace(text, r"(?<=[\p{L}\p{N}_])-\n(?=[\p{L}\p{N}_])", "")
    lines = F.transform(F.split(text, "\n"), strip)

    def step(s: Column, line: Column) -> Column:
        done, buf = s["done"], s["buf"]
        stops = (
            F.right(buf, F.lit(1)).rlike("[。！？.!?：:]")
            | line.rlike(r"^[\p{Nd}一二三四五六七八九十①②③④⑤•·\-]")
            | (F.length(buf) < min_line_length)
        )
        flushed = F.when(buf == "", done).otherwise(F.concat(done, F.lit("\n"), buf))
        kept = F.when(line == "", F.struct(flushed.alias("done"), F.lit("").alias("buf")))
        kept = kept.when(buf == "", F.struct(done.alias("done"), line.alias("buf")))
        kept = kept.when(stops, F.struct(flushed.alias("done"), line.alias("buf")))
        return kept.otherwise(F.struct(done.alias("done"), F.concat(buf, line).alias("buf")))

    start = F.struct(F.lit("").alias("done"), F.lit("").alias("buf"))
    end = lambda s: F.when(s["buf"] == "", s["done"]).otherwise(F.concat(s["done"], F.lit("\n"), s["buf"]))
    return F.regexp_replace(F.aggregate(lines, start, step, end), "^\n", "")


def squeeze_whitespace(c: Column | str) -> Column:
    text = F.regexp_replace(F.regexp_replace(col(c), "[ \t]+", " "), "\n{3,}", "\n\n")
    return strip(F.array_join(F.transform(F.split(text, "\n"), strip), "\n"))


def plain_punctuation(c: Column | str) -> Column:
    return F.replace(F.translate(col(c), "".join(PUNCTUATION), "".join(PUNCTUATION.values())), F.lit("…"), F.lit("..."))


def is_valid(c: Column | str, min_line_length: int = 5) -> Column:
    n = F.length(strip(c))
    return F.coalesce((n > 0) & (n >= min_line_length), F.lit(False))


def ocr_confidence(confidence: Column | str, is_ocr: Column | str) -> Column:
    return F.when(col(is_ocr), F.least(col(confidence), F.lit(0.7))).otherwise(col(confidence))


# Why the confidence of a text block from character recognition is low.
OCR_REASON = "OCR extracted"


def ocr_reason(metadata: Column | str, is_text: Column) -> Column:
    """metadata with the reason of low confidence, for text blocks from character recognition."""
    m = col(metadata)
    return F.when(is_text & m["is_ocr"], m.withField("low_confidence_reason", F.lit(OCR_REASON))).otherwise(m)


def clean_rows(rows: Column | str) -> Column:
    """Every cell of a table without noise and with single spaces; rows are kept."""
    return F.transform(col(rows), lambda r: F.transform(r, lambda x: squeeze_whitespace(strip_noise(x))))


def text_of(content: Column | str, n: Normalization = Normalization()) -> Column:
    out = strip_noise(content)
    if n.merge_broken_lines:
        out = merge_lines(out, n.min_line_length)
    if n.normalize_whitespace:
        out = squeeze_whitespace(out)
    return plain_punctuation(out) if n.normalize_punctuation else out


def normalize_blocks(blocks: DataFrame, n: Normalization = Normalization()) -> DataFrame:
    """page_blocks after normalization: headers and invalid text blocks gone, tables cleaned, images untouched."""
    is_text = F.col("type") == "text"
    if n.remove_headers_footers:
        blocks = blocks.filter(~is_text | ~is_header_footer("content_text", "bbox", n.header_footer_max_lines))
    table = F.col("content_table")
    # computed once a row: the filter that follows would else repeat the fold over the lines
    out = computed(
        blocks,
        {
            "content_text": F.when(is_text, text_of("content_text", n)).otherwise(F.col("content_text")),
            "content_table": F.when(table.isNotNull(), table.withField("rows", clean_rows(table["rows"]))),
            "confidence": F.when(is_text, ocr_confidence("confidence", "metadata.is_ocr")).otherwise(F.col("confidence")),
            "metadata": ocr_reason("metadata", is_text),
        },
    )
    return out.filter(~is_text | is_valid("content_text", n.min_line_length)).select(*blocks.columns)


def header_patterns(blocks: DataFrame, share: float = 0.5) -> DataFrame:
    """(source, pattern, n): short texts, digits as N, that occur on at least that share of a source's pages."""
    text = blocks.filter("type = 'text'").withColumn("t", strip("content_text")).filter((F.length("t") > 0) & (F.length("t") < 100))
    found = text.groupBy("source", F.regexp_replace("t", r"\p{Nd}+", "N").alias("pattern")).agg(F.count("*").alias("n"))
    pages = blocks.groupBy("source").agg(F.count_distinct("page").alias("pages"))
    return found.join(pages, "source").filter(F.col("n") >= share * F.col("pages")).select("source", "pattern", "n")


def first_deliveries(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key of a table, read from files, with repeated deliveries: the earliest by ingested_at (nulls last).

    Only keys, times and places in the files are grouped; of that the few keys that come again are joined back, so rows
    are not shuffled with their contents. Rows of equal time are told apart by their place. Null keys are keys.
    """
    place = F.struct(F.col("ingested_at").isNull().alias("late"), "ingested_at", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    placed = df.select("*", place.alias("_at"))
    again = placed.groupBy(*keys).agg(F.min("_at").alias("_first"), F.count("*").alias("_n")).filter("_n > 1")
    again = small_side(again.select(*[F.col(k).alias(f"_{k}") for k in keys], "_first"))
    same = F.lit(True)
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_{k}"))
    return placed.join(again, same, "left").filter(F.col("_first").isNull() | (F.col("_at") == F.col("_first"))).select(*df.columns)
