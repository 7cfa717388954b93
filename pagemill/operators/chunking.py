"""Chunking of page windows: merged page texts, cut by tokens, sentences or characters, with ids.

The fold over sentences is sequential, so it runs in an Arrow function, one (source, window) per row; everything around
it is native. Text that is null or blank gives no chunk.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.config import Chunking
from pagemill.functions.text import chunk_id, strip
from pagemill.operators.parsing import table_text_compact
from pagemill.operators.windows import page_windows
from pagemill.session import checkpointed, ranked

_SENTENCE = re.compile("[^。！？.!?]*[。！？.!?]+|[^。！？.!?]+")
_ZH = re.compile("[一-鿿]")
PIECES = "array<struct<pos:int,content:string,token_count:int,char_count:int,page_start:int,page_end:int>>"


def tokens(text: str) -> int:
    zh = len(_ZH.findall(text))
    return int(zh * 1.5 + (len(text) - zh) / 4)


def sentences(text: str) -> list[str]:
    return [s for m in _SENTENCE.findall(text) if (s := m.strip())]


def tail_sentences(text: str, overlap: int) -> str:
    """The last whole sentences of at most `overlap` tokens together."""
    kept, total = [], 0
    for s in reversed(sentences(text)):
        total += tokens(s)
        if total > overlap:
            break
        kept.append(s)
    return " ".join(reversed(kept)).strip()


def force_split(text: str, size: int, overlap: int) -> list[str]:
    """Cut by ideographs: each is a token, other characters are none, so text without ideographs stays whole."""
    out, now, weight = [], "", 0
    for c in text:
        w = int("一" <= c <= "鿿")
        if weight + w > size and now:
            out.append(now)
            keep = int(len(now) * overlap / size) if overlap > 0 else 0
            now = now[len(now) - keep :] if keep else ""
            weight = tokens(now)
        now += c
        weight += w
    return [*out, now] if now else out


def by_tokens(text: str, c: Chunking) -> list[str]:
    if not c.respect_sentence_boundary:
        return force_split(text, c.size, c.overlap)
    out, now, n = [], "", 0
    for s in sentences(text):
        k = tokens(s)
        if k > c.size:
            if now:
                out.append(now)
            *first, now = force_split(s, c.size, c.overlap)
            out += first
            n = tokens(now)
        elif n + k > c.size:
            if now:
                out.append(now)
            now = (tail_sentences(now, c.overlap) if c.overlap > 0 else "") + s
            n = tokens(now)
        else:
            now += (" " if now else "") + s
            n += k
    return [*out, now] if now and tokens(now) >= c.min_chunk_size else out


def by_sentences(text: str, c: Chunking) -> list[str]:
    out, now = [], ""
    for s in sentences(text):
        if now and len(now) + len(s) > c.size * 4:
            out.append(now)
            now = s
        else:
            now += (" " if now else "") + s
    return [*out, now] if now else out


def by_chars(text: str, c: Chunking) -> list[str]:
    """Windows of 4 x size characters, blank ones left out; the next starts 4 x overlap before the end and always moves on.

    With boundaries, a window ends after the last mark in its second half or just behind it.
    """
    width, back, out, start = c.size * 4, c.overlap * 4, [], 0
    while start < len(text):
        end = min(start + width, len(text))
        if c.respect_sentence_boundary and end < len(text):
            cut = max(text.rfind(m, start + width // 2 + 1, end + 1) for m in "。！？.!?\n")
            end = cut + 1 if cut >= 0 else end
        if text[start:end].strip():
            out.append(text[start:end])
        if end == len(text):
            break
        start = max(end - back, start + 1) if back and end - back > 0 else end
    return out


def split(text: str, c: Chunking) -> list[str]:
    return {"token": by_tokens, "sentence": by_sentences}.get(c.split_by, by_chars)(text, c)


def pieces(items: list[tuple[int, str]], c: Chunking) -> list[dict]:
    """Chunks of the (page, text) items of a window with the pages they span.

    Items are joined by blank lines, which belong to no page. A piece is looked for from where the one before ended,
    less the overlap; where it is not found, as its sentences were joined by spaces, it is taken to start there.
    """
    text, ends = "", []
    for page, t in items:
        if text and not text.endswith("\n"):
            text += "\n\n"
        ends.append((len(text), len(text) + len(t), page))
        text += t

    def page_at(i: int, default: int) -> int:
        return next((p for a, b, p in ends if a <= i < b), default)

    out, at = [], 0
    for p in split(text, c):
        if not p.strip():
            continue
        found = text.find(p, at)
        start = found if found != -1 else at
        end = start + len(p)
        first = page_at(start, 0)
        last = page_at(min(end - 1, len(text) - 1), first)
        at = end - c.overlap
        out.append({"pos": len(out), "content": p.strip(), "token_count": tokens(p), "char_count": len(p), "page_start": first, "page_end": last})
    return out


def merged_text() -> Column:
    """What a block adds to its page: stripped text, or a table's compact form; images add nothing."""
    return F.when(F.col("type") == "text", strip("content_text")).when(F.col("type") == "table", table_text_compact("content_table.rows"))


def block_texts(blocks: DataFrame) -> DataFrame:
    """(source, page, ord, text) of the blocks that hold any."""
    return blocks.withColumn("text", merged_text()).filter(F.length("text") > 0).select("source", "page", "ord", "text")


def page_texts(blocks: DataFrame) -> DataFrame:
    """(source, page, text): the texts of each page in order, parted by blank lines."""
    items = F.array_sort(F.collect_list(F.struct("ord", "text")))
    return block_texts(blocks).groupBy("source", "page").agg(F.array_join(F.transform(items, lambda i: i["text"]), "\n\n").alias("text"))


def window_texts(blocks: DataFrame, batch_size: int = 10, pages: DataFrame | None = None) -> DataFrame:
    """(source, win, items): the texts of each window's pages in order, images left out.

    pages: (source, page) of the blocks before normalization, if `blocks` are those after it.
    """
    return (
        block_texts(blocks)
        .join(page_windows(blocks if pages is None else pages, batch_size), ["source", "page"])
        .groupBy("source", "win")
        .agg(F.array_sort(F.collect_list(F.struct("page", "ord", "text"))).alias("items"))
    )


def chunk_windows(windows: DataFrame, c: Chunking = Chunking()) -> DataFrame:
    """(source, win, chunks): the chunks of each window as an array of (pos, content, sizes, pages)."""

    @F.pandas_udf(PIECES)
    def cut(items: pd.Series) -> pd.Series:
        return items.map(lambda x: pieces([(i["page"], i["text"]) for i in x], c))

    return windows.select("source", "win", cut("items").alias("chunks"))


def numbered(windows: DataFrame) -> DataFrame:
    """The chunks of windows as rows, numbered within their source and named.

    What is ranked is one number a window: the chunks in those before it. The chunks are computed and written once.
    """
    kept = checkpointed(windows)
    sizes = kept.select("source", "win", F.size("chunks").alias("n"))
    before = ranked(sizes, ["source"], ["win"], "before", "n")
    rows = kept.join(before, ["source", "win"]).select("source", "win", "before", F.inline("chunks"))
    return rows.withColumn("chunk_id", chunk_id("source", "page_start", "page_end", F.col("before") + F.col("pos") + 1)).drop("before")


def split_texts(df: DataFrame, key: str, text: str, c: Chunking) -> DataFrame:
    """(key, pos, piece) of texts cut each on its own."""

    @F.pandas_udf("array<string>")
    def cut(t: pd.Series) -> pd.Series:
        return t.map(lambda x: split(x, c) if x else [])

    return df.select(key, F.posexplode(cut(text)).alias("pos", "piece"))
