"""Page windows: the groups of pages that are chunked together, overlapping by one page."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagemill.session import ranked


def page_windows(blocks: DataFrame, size: int = 10) -> DataFrame:
    """(source, page, win): each page with the one or two windows it belongs to.

    Pages are ranked within their source. With size B > 1 rank r is in window r div (B-1), and where r is a multiple of
    B-1 also in the one before; with B = 1 a page shares a window with the next one. Give it the blocks as they were
    read: a page whose blocks all vanish later still counts. Only (source, page) is shuffled, a large source in ranges.
    """
    pages = ranked(blocks.select("source", "page").distinct(), ["source"], ["page"], "r")
    if size <= 1:
        # {0}, {0,1}, {1,2}, ..., {n-1}: a page is in the window of its rank and in the next
        wins = F.array(F.col("r"), F.col("r") + 1).cast("array<int>")
    else:
        q, m = F.floor(F.col("r") / (size - 1)), F.col("r") % (size - 1)
        wins = F.array_compact(F.array(q, F.when((m == 0) & (F.col("r") > 0), q - 1))).cast("array<int>")
    return pages.select("source", "page", F.explode(wins).alias("win"))


def held_back(chunks: DataFrame) -> DataFrame:
    """All but the last chunk of each window that a later window follows; chunks are (source, win, pos, ...)."""
    last = F.row_number().over(Window.partitionBy("source", "win").orderBy(F.desc("pos")))
    final = F.max("win").over(Window.partitionBy("source"))
    return chunks.withColumns({"_last": last, "_final": final}).filter("_last > 1 or win = _final").drop("_last", "_final")
