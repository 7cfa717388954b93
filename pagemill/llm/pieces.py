"""p7: cut items above a token limit into overlapping pieces at natural boundaries.

Method: recursive separator hierarchy (section, paragraph, line, sentence, word, character), then greedy packing
with a trailing overlap. Sizes are decided natively in the JVM; only oversized rows reach Python.

Null and empty items are not oversized and give no piece. Repeated rows of a key count once. A text of any length is
processed whole in time linear in its length. Pieces tile the text: each starts at or before the end of the one
before it, so the text can be rebuilt exactly from the positions.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.functions.text import count_tokens
from pagemill.session import table

LIMIT, OVERLAP = 800, 150

_CLOSERS = "[\"'”’»」』）)\\]】]*"
#: Coarse to fine; a match ends where the next part begins.
SEPARATORS = [
    re.compile(r"\n\s*\n(?=[ \t]*(?:\d+(?:\.\d+)*[.)]?\s+\S|第.{1,6}[章节]|#{1,6} )[^\n]{0,80}(?:\n|$))"),
    re.compile(r"\n\s*\n"),
    re.compile(r"\n"),
    re.compile(f"[.!?…؟।]+{_CLOSERS}\\s+|[。！？．]+{_CLOSERS}|(?<=[\\u0e00-\\u0e7f]) +(?=[\\u0e00-\\u0e7f])"),
    re.compile(r"\s+|[，、；,;](?=[^\d\s])"),
]
PIECE_TYPE = "array<struct<piece_no:int,start_pos:int,end_pos:int,tokens:int,overlap_tokens:int,piece:string>>"


def quarter_units(text: str) -> np.ndarray:
    """Running total of quarter tokens: 6 for an ideograph, 1 for any other character."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return np.concatenate([[0], np.cumsum(np.where((points >= 0x4E00) & (points <= 0x9FFF), 6, 1))])


def atoms(text: str, total: np.ndarray, limit: int) -> list[int]:
    """Ends of parts of at most `limit` tokens, cut by the coarsest separator that makes them fit."""
    most = 4 * limit + 3
    ends: list[int] = []
    todo = [(0, len(text), 0)]
    while todo:
        a, b, level = todo.pop()
        if total[b] - total[a] <= most:
            ends.append(b)
            continue
        if level < len(SEPARATORS):
            cuts = [m.end() for m in SEPARATORS[level].finditer(text, a, b) if a < m.end() < b]
        else:  # characters: as many as fit, not before a combining mark or joiner
            cuts, at = [], a
            while total[b] - total[at] > most:
                cut = int(np.searchsorted(total, total[at] + most, side="right")) - 1
                back = cut
                while back > at + 1 and cut - back < 16 and re.match("[\\u0300-\\u036f\\u0900-\\u0903\\u093a-\\u094f\\u200c\\u200d\\ufe0f\\u0e31\\u0e34-\\u0e3a\\u0e47-\\u0e4e]", text[back]):
                    back -= 1
                at = back if back > at else cut
                cuts.append(at)
            ends += [*cuts, b]
            continue
        edges = [a, *cuts, b]
        todo += [(x, y, level + 1) for x, y in zip(edges[-2::-1], edges[:0:-1])]
    return ends


def starts_for_overlap(text: str, total: np.ndarray, start: int, end: int, room: int) -> int:
    """Earliest natural start inside the piece whose tail of at most `room` quarter tokens is shared; `end` if none."""
    first = max(start + 1, int(np.searchsorted(total, total[end] - room, side="left")))
    for separator in SEPARATORS[1:]:
        for m in separator.finditer(text, max(start, first - 200), end):
            if first <= m.end() < end:
                return m.end()
    return end


def cut(text: str | None, limit: int = LIMIT, overlap: int = OVERLAP) -> list[dict]:
    """Pieces of one text; a text within the limit is one piece, an empty or null one is none."""
    if not text:
        return []
    total = quarter_units(text)
    ends = atoms(text, total, limit)
    most, out, start, shared, i = 4 * limit + 3, [], 0, 0, 0
    while i < len(ends):
        j = i
        while j + 1 < len(ends) and total[ends[j + 1]] - total[start] <= most:
            j += 1
        end = ends[j]
        out.append(
            {"piece_no": len(out), "start_pos": start, "end_pos": end, "tokens": int(total[end] - total[start]) // 4,
             "overlap_tokens": shared, "piece": text[start:end]}
        )
        i = j + 1
        if i < len(ends):
            room = min(4 * overlap + 3, most - int(total[ends[i]] - total[end]))
            begin = starts_for_overlap(text, total, start, end, room) if room > 0 else end
            start, shared = begin, int(total[end] - total[begin]) // 4
    return out


def with_pieces(df: DataFrame, text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """Explode rows above the limit into their pieces; other columns are kept, `text` itself is not.

    A column of the input named like an output column (piece_no, start_pos, ...) is replaced.
    """
    if not 0 <= overlap < limit:
        raise ValueError("the overlap must be at least 0 and below the limit")

    @F.pandas_udf(PIECE_TYPE)
    def pieces(texts: pd.Series) -> pd.Series:
        return texts.map(lambda x: cut(x, limit, overlap))

    names = ["piece_no", "start_pos", "end_pos", "tokens", "overlap_tokens", "piece"]
    keep = [c for c in df.columns if c not in {*names, text}]
    return (
        df.filter(count_tokens(text) > limit)
        .select(*keep, F.explode(pieces(F.col(text))).alias("_p"))
        .select(*keep, *[F.col(f"_p.{n}") for n in names])
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """chunks.content and the text blocks of page_blocks as (table_name, source, record_id, text)."""
    chunks = table(spark, sf_dir, "chunks").select(
        F.lit("chunks").alias("table_name"), "source", F.col("chunk_id").alias("record_id"), F.col("content").alias("text")
    )
    blocks = table(spark, sf_dir, "page_blocks").filter(F.col("type") == "text").select(
        F.lit("page_blocks").alias("table_name"), "source", F.col("block_id").alias("record_id"), F.col("content_text").alias("text")
    )
    return chunks.unionByName(blocks)


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of more than 800 tokens: those that the splitter cuts into two pieces or more."""
    return p7_pieces(spark, sf_dir).filter("piece_no = 1").select("table_name", "source", "record_id")


def p7_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered pieces of every oversized record. Only oversized rows are shuffled, to drop repeated deliveries."""
    over = items(spark, sf_dir).filter(count_tokens("text") > LIMIT).dropDuplicates(["table_name", "source", "record_id"])
    return with_pieces(over, "text")


P7_FOUND_SQL = """
WITH items AS (
  SELECT 'chunks' AS table_name, source, chunk_id AS record_id, content AS text FROM chunks
  UNION ALL SELECT 'page_blocks', source, block_id, content_text FROM page_blocks WHERE type = 'text'),
z AS (SELECT *, length(text) AS n, length(regexp_replace(text, '[^一-鿿]', '', 'g')) AS zh FROM items)
SELECT DISTINCT table_name, source, record_id FROM z WHERE trunc(zh * 1.5 + (n - zh) / 4.0)::INT > 800
"""
