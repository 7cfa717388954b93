"""Scalar text measures as Column builders; every one is a built-in expression, so scans stay in the JVM.

Null text gives null; empty text gives 0 for every measure and an empty array for sentences.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Python's str.strip and \s see it (a Java character class body).
WS = r"\x1c-\x1f\p{IsWhite_Space}"
#: Ideographs that weigh 1.5 tokens.
ZH = "一-鿿"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    return F.regexp_replace(col(c), f"^[{WS}]+|[{WS}]+$", "")


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole == 0, F.lit(0.0)).otherwise(part / whole)


def zh_count(c: Column | str) -> Column:
    return F.length(F.regexp_replace(col(c), f"[^{ZH}]", ""))


def count_tokens(c: Column | str, method: str = "simple") -> Column:
    """int(1.5 per ideograph + 0.25 per other character); any other method: a third of the length."""
    n = F.length(col(c))
    if method != "simple":
        return F.floor(n / 3).cast("int")
    zh = zh_count(c)
    return (zh * F.lit(1.5) + (n - zh) / F.lit(4.0)).cast("int")


def garble_ratio(c: Column | str) -> Column:
    """Share of characters of category C (but line feed, carriage return, tab) and U+FFFD."""
    return _ratio(F.length(F.regexp_replace(col(c), "[^\\p{C}�]|[\n\r\t]", "")), F.length(col(c)))


def info_density(c: Column | str) -> Column:
    """Share of letters and digits."""
    return _ratio(F.length(F.regexp_replace(col(c), r"[^\p{L}\p{N}]", "")), F.length(col(c)))


def noise_ratio(c: Column | str) -> Column:
    """Runs of three or more symbols, and the excess of white space runs of four or more, over the length."""
    n = F.length(col(c))
    symbols = n - F.length(F.regexp_replace(col(c), rf"[^\p{{L}}\p{{N}}_{WS}]{{3,}}", ""))
    spaces = n - F.length(F.regexp_replace(col(c), f"[{WS}]{{4,}}", " "))
    ratio = _ratio(symbols + spaces, n)
    return F.when(ratio > 1, F.lit(1.0)).otherwise(ratio)


def repetition_ratio(c: Column | str, k: int = 5) -> Column:
    """1 - distinct k-character shingles / shingles; 0 for texts shorter than 2k."""
    n = F.length(col(c))
    total = n - (k - 1)

    def distinct(chars: Column) -> Column:
        at = F.sequence(F.lit(0), n - k)
        return F.size(F.array_distinct(F.transform(at, lambda i: F.concat(*[F.get(chars, i + j) for j in range(k)]))))

    # the outer lambda binds the split text, which the inner one would otherwise split anew for every shingle
    found = F.get(F.transform(F.array(F.split(col(c), "")), distinct), F.lit(0))
    return F.when(n < 2 * k, F.lit(0.0)).otherwise((total - found) / total)


def split_sentences(c: Column | str) -> Column:
    """Cut after runs of sentence-end marks; the run stays with its sentence; blanks are dropped."""
    parts = F.regexp_extract_all(col(c), F.lit("([^。！？.!?]*[。！？.!?]+|[^。！？.!?]+)"), F.lit(0))
    return F.filter(F.transform(parts, strip), lambda x: x != "")


def chunk_id(source: Column | str, page_start: Column | str, page_end: Column | str, index: Column | str) -> Column:
    s, a, b, i = (col(x) for x in (source, page_start, page_end, index))
    key = F.concat_ws("_", s, a.cast("string"), b.cast("string"), i.cast("string"))
    return F.concat(F.format_string("chunk_%04d_%04d_%04d_", a, b, i), F.left(F.md5(key.cast("binary")), F.lit(8)))


def clean_text(c: Column | str) -> Column:
    """Drop zero-width and format characters, compose to NFKC, drop control characters."""

    @F.pandas_udf("string")
    def nfkc(s: pd.Series) -> pd.Series:
        import unicodedata

        return s.map(lambda x: x if x is None or x.isascii() else unicodedata.normalize("NFKC", x))

    visible = F.regexp_replace(col(c), "[\\x{200b}-\\x{200f}\\x{2028}-\\x{202f}\\x{205f}-\\x{206f}]", "")
    return F.regexp_replace(nfkc(visible), "[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f]", "")
