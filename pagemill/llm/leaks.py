"""p8: evaluation passages inside a training corpus.

Method: a broadcast hash set of normalised test n-grams; every training token window is looked up in it, hits are
verified token by token, and spans or whole documents can be removed.

Text is compared in NFKC and lower case. A token is an unbroken run of letters and digits; items in Chinese and
Japanese are compared by single letters and digits, whatever stands between them. Positions are those of the text as it
is. Null and empty texts hold no passage; an item shorter than a window can't leak by it. Repeated rows count once.

The corpus is read once whatever the size of the item set. Up to ITEM_CHARS characters of items, the set itself and the
items' tokens are broadcast. Beyond that, what is broadcast is a filter of bits of fixed size over the hashes of all
n-grams; windows that pass it are joined with the n-grams by hash and text, and runs are put together from the matches.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagemill.llm.tables import code_points
from pagemill.session import checkpointed, spread, table

WORDS, CHARS = 14, 20
#: Most characters of item text that are broadcast as a set (about 40 MB of hashes and tokens).
ITEM_CHARS = 2_000_000
#: Bits of the filter for larger sets: 2 to this power.
BITS = 27
CHAR_LANGS = ("zh", "ja")

_WORD = re.compile(r"[^\W_]+")
_MULT = np.uint64(0x9E3779B97F4A7C15)
_ALNUM: np.ndarray | None = None


def normal(text: str) -> str:
    return text.lower() if text.isascii() else unicodedata.normalize("NFKC", text).lower()


def alnum() -> np.ndarray:
    """Which code points are letters or digits, as a table."""
    global _ALNUM
    if _ALNUM is None:
        _ALNUM = code_points(str.isalnum)
    return _ALNUM


def letters(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the letters and digits, and their positions."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    at = np.flatnonzero(alnum()[points])
    return points[at], at


def window_hashes(ids: np.ndarray, n: int) -> np.ndarray:
    """A hash of each window of n ids."""
    with np.errstate(over="ignore"):
        mixed = (ids.astype(np.uint64) + np.uint64(1)) * _MULT
        mixed ^= mixed >> np.uint64(29)
        out, m = np.zeros(len(ids) - n + 1, dtype=np.uint64), len(ids) - n + 1
        for k in range(n):
            out = out * np.uint64(0x100000001B3) + mixed[k : k + m]
    return out


class Items:
    """The n-grams of a block of items: by words for most languages, by letters for the rest."""

    def __init__(self, rows: list[tuple[int, str, str]], words: int = WORDS, chars: int = CHARS):
        self.n = {"words": words, "chars": chars}
        self.ids: dict[str, int] = {}
        grams: dict[str, list[tuple[int, int, np.ndarray]]] = defaultdict(list)
        self.tokens: dict[int, np.ndarray] = {}
        for item, lang, text in rows:
            kind = "chars" if lang in CHAR_LANGS else "words"
            seq = self.encode(normal(text), kind, grow=True)
            if len(seq) >= self.n[kind]:
                self.tokens[item] = seq
                grams[kind].append((item, len(seq), window_hashes(seq, self.n[kind])))
        self.keys, self.where = {}, {}
        for kind, found in grams.items():
            hashes = np.concatenate([h for _, _, h in found])
            owner = np.concatenate([np.full(len(h), i) for i, _, h in found])
            offset = np.concatenate([np.arange(len(h)) for _, _, h in found])
            order = np.argsort(hashes, kind="stable")
            self.keys[kind], self.where[kind] = hashes[order], np.stack([owner[order], offset[order]])

    def encode(self, text: str, kind: str, grow: bool = False) -> np.ndarray:
        if kind == "chars":
            return letters(text)[0].astype(np.int64)
        found = _WORD.findall(text)
        if grow:
            return np.array([self.ids.setdefault(w, len(self.ids)) for w in found], dtype=np.int64)
        get = self.ids.get
        return np.array([get(w, -1) for w in found], dtype=np.int64)

    def hits(self, text: str) -> Iterator[tuple[int, int, int]]:
        """(item, start, end) of each maximal shared run, in positions of the normalised text."""
        text = normal(text)
        for kind, keys in self.keys.items():
            n = self.n[kind]
            if kind == "chars":
                seq, at = letters(text)
                seq, ends = seq.astype(np.int64), at + 1
            else:
                seq, at, ends = self.encode(text, kind), None, None
                # windows with a word that no item has can't match: skip texts without a long enough known run
                if len(seq) < n or not (np.convolve(seq >= 0, np.ones(n, dtype=np.int64), "valid") == n).any():
                    continue
            if len(seq) < n:
                continue
            hashes = window_hashes(seq, n)
            left = np.searchsorted(keys, hashes, side="left")
            hit = np.flatnonzero(keys[np.minimum(left, len(keys) - 1)] == hashes)
            if not len(hit):
                continue
            if at is None:
                spans = [m.span() for m in _WORD.finditer(text)]
                at, ends = np.array([s for s, _ in spans]), np.array([e for _, e in spans])
            right = np.searchsorted(keys, hashes[hit], side="right")
            runs: dict[tuple[int, int], list[int]] = defaultdict(list)
            for pos, lo, hi in zip(hit, left[hit], right):
                for k in range(lo, hi):
                    item, offset = (int(x) for x in self.where[kind][:, k])
                    if np.array_equal(self.tokens[item][offset : offset + n], seq[pos : pos + n]):  # verified
                        runs[item, int(pos) - offset].append(int(pos))
            for (item, _), starts in runs.items():
                first = prev = starts[0]
                for p in [*starts[1:], None]:
                    if p is not None and p == prev + 1:
                        prev = p
                        continue
                    yield item, int(at[first]), int(ends[prev + n - 1])
                    first = prev = p


_CLUSTER = regex.compile(r"[^\p{M}ﾞﾟᅠ-ᇿ][\p{M}ﾞﾟᅠ-ᇿ]*|[\p{M}ﾞﾟᅠ-ᇿ]+")


def origins(text: str) -> np.ndarray | None:
    """Where each character of the normalised text comes from, and the end of the text; None if it is the same places."""
    if text.isascii():
        return None
    at = [m.start() for m in _CLUSTER.finditer(text) for _ in normal(m[0])]
    return np.array([*at, len(text)])


def placed(text: str, hits: Iterator[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The hits with their positions in the text as it is; a run ends with the character that its last letter is part of."""
    found = list(hits)
    where = origins(text) if found else None
    if where is None:
        return found
    last = len(where) - 1
    out = []
    for item, a, b in found:
        end = min(b, last)
        while end < last and where[end] == where[end - 1]:
            end += 1
        out.append((item, int(where[min(a, last)]), int(where[end])))
    return out


SPANS = "doc_id bigint, item_id bigint, start_pos int, end_pos int"


def known_items(items: DataFrame) -> DataFrame:
    return items.select("item_id", "lang", "text").filter("text is not null").dropDuplicates(["item_id"])


def leaks_of_few(docs: DataFrame, items: DataFrame, words: int, chars: int) -> DataFrame:
    rows = [(r["item_id"], r["lang"], r["text"]) for r in items.collect()]
    shared = docs.sparkSession.sparkContext.broadcast(Items(rows, words, chars))

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for b in batches:
            out = [(d, *h) for d, t in zip(b["doc_id"], b["text"]) for h in placed(t, known.hits(t))]
            yield pd.DataFrame(out, columns=[c.split()[0] for c in SPANS.split(", ")])

    return docs.mapInPandas(scan, SPANS)


def windows_of(text: str, kind: str, n: int) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray] | None:
    """(hash of each window, tokens, start and end of each token) of a normalised text."""
    if kind == "chars":
        points, at = letters(text)
        if len(points) < n:
            return None
        return window_hashes(points.astype(np.int64), n), [chr(p) for p in points.tolist()], at, at + 1
    found = list(_WORD.finditer(text))
    if len(found) < n:
        return None
    ids = np.array([zlib.crc32(m[0].encode("utf-8", "replace")) for m in found], dtype=np.int64)
    return window_hashes(ids, n), [m[0] for m in found], np.array([m.start() for m in found]), np.array([m.end() for m in found])


GRAMS = "kind string, h bigint, gram string"


def leaks_of_many(docs: DataFrame, items: DataFrame, words: int, chars: int) -> DataFrame:
    """As leaks_of_few for item sets of any size."""
    sizes = {"words": words, "chars": chars}
    spark = docs.sparkSession

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for item, lang, text in zip(b["item_id"], b["lang"], b["text"]):
                kind = "chars" if lang in CHAR_LANGS else "words"
                w = windows_of(normal(text), kind, n := sizes[kind])
                if w is not None:
                    rows += [(kind, h, " ".join(w[1][i : i + n]), item, i) for i, h in enumerate(w[0].view(np.int64).tolist())]
            yield pd.DataFrame(rows, columns=["kind", "h", "gram", "item_id", "at"])

    grams = checkpointed(items.mapInPandas(cut, f"{GRAMS}, item_id bigint, at int"))
    bit = F.pmod("h", F.lit(1 << BITS)) + 1
    parts = grams.groupBy(F.bitmap_bucket_number(bit).alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("m")).collect()
    bits = np.zeros(1 << BITS - 3, dtype=np.uint8)
    for r in parts:
        bits[(r["b"] - 1) * 4096 : r["b"] * 4096] = np.frombuffer(r["m"], dtype=np.uint8)
    shared = spark.sparkContext.broadcast(bits)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for b in batches:
            rows = []
            for doc, text in zip(b["doc_id"], b["text"]):
                for kind, n in sizes.items():
                    w = windows_of(normal(text), kind, n)
                    if w is None:
                        continue
                    h = w[0] & np.uint64((1 << BITS) - 1)
                    hit = np.flatnonzero(known[h >> np.uint64(3)] >> (h & np.uint64(7)).astype(np.uint8) & 1)
                    spans = placed(text, ((int(i), int(w[2][i]), int(w[3][i + n - 1])) for i in hit))
                    rows += [(doc, kind, int(w[0].view(np.int64)[i]), " ".join(w[1][i : i + n]), i, a, e) for i, a, e in spans]
            yield pd.DataFrame(rows, columns=["doc_id", "kind", "h", "gram", "pos", "start_pos", "end_pos"])

    met = docs.mapInPandas(scan, f"doc_id bigint, {GRAMS}, pos int, start_pos int, end_pos int").join(grams, ["kind", "h", "gram"]).distinct()
    run = Window.partitionBy("doc_id", "item_id", "kind", "line").orderBy("pos")
    met = met.withColumn("line", F.col("pos") - F.col("at"))
    met = met.withColumn("island", F.col("pos") - F.row_number().over(run))
    return met.groupBy("doc_id", "item_id", "kind", "line", "island").agg(F.min("start_pos").alias("start_pos"), F.max("end_pos").alias("end_pos")).select("doc_id", "item_id", "start_pos", "end_pos")


def leaks(docs: DataFrame, items: DataFrame, words: int = WORDS, chars: int = CHARS, most: int = ITEM_CHARS) -> DataFrame:
    """(doc_id, item_id, start_pos, end_pos) of every shared run, positions in the text as it is."""
    docs = spread(docs.select("doc_id", "text").filter("text is not null"))
    items = checkpointed(known_items(items))
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    return (leaks_of_few if size <= most else leaks_of_many)(docs, items, words, chars)


def without_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents without those that leak: only ids are shuffled."""
    return docs.join(leaks(docs, items).select("doc_id").distinct(), "doc_id", "left_anti")


def without_spans(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents with every leaking span cut out of the text, and n_removed, the characters that went."""
    spans = leaks(docs, items).groupBy("doc_id").agg(F.sort_array(F.collect_set(F.struct("start_pos", "end_pos"))).alias("_spans"))

    @F.pandas_udf("string")
    def cut(text: pd.Series, spans: pd.Series) -> pd.Series:
        def one(t: str | None, found) -> str | None:
            if t is None or found is None:
                return t
            out, at = [], 0
            for s in found:
                out.append(t[at : max(at, s["start_pos"])])
                at = max(at, s["end_pos"])
            return "".join([*out, t[at:]])

        return pd.Series([one(t, f) for t, f in zip(text, spans)], dtype="object")

    left = docs.join(spans, "doc_id", "left").withColumn("_cut", cut("text", "_spans"))
    n = F.coalesce(F.length("text") - F.length("_cut"), F.lit(0))
    return left.withColumn("n_removed", n).withColumn("text", F.col("_cut")).select(*docs.columns, "n_removed")


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p8_spans(spark, sf_dir).select("doc_id", "item_id").distinct()


def p8_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p8_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that leaks, with its text after the leaking spans are cut out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return without_spans(docs, table(spark, sf_dir, "eval_items")).filter("n_removed > 0")


def p8_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every item with the number of documents that hold it, 0 included."""
    n = p8_found(spark, sf_dir).groupBy("item_id").agg(F.count("*").alias("n_docs"))
    items = table(spark, sf_dir, "eval_items").select("item_id", "suite", "lang").distinct()
    return items.join(n, "item_id", "left").select("item_id", "suite", "lang", F.coalesce("n_docs", F.lit(0)).alias("n_docs"))


_PLAIN = "lower(translate(nfc_normalize(text), '０１２３４５６７８９ＡＢＣＤＥＦＧＨＩＪＫＬＭＮＯＰＱＲＳＴＵＶＷＸＹＺａｂｃｄｅｆｇｈｉｊｋｌｍｎｏｐｑｒｓｔｕｖｗｘｙｚ', '0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz'))"
P8_FOUND_SQL = f"""
WITH d AS (SELECT doc_id, {_PLAIN} AS t FROM documents WHERE text IS NOT NULL), i AS (SELECT item_id, lang IN ('zh', 'ja') AS by_char, {_PLAIN} AS t FROM eval_items WHERE text IS NOT NULL),
dw AS (SELECT doc_id, regexp_extract_all(t, '[\\p{{L}}\\p{{N}}]+') AS w FROM d), iw AS (SELECT item_id, regexp_extract_all(t, '[\\p{{L}}\\p{{N}}]+') AS w FROM i WHERE NOT by_char),
dc AS (SELECT doc_id, array_to_string(w, '') AS c FROM dw), ic AS (SELECT item_id, regexp_replace(t, '[^\\p{{L}}\\p{{N}}]', '', 'g') AS c FROM i WHERE by_char),
a AS (SELECT doc_id, array_to_string(w[k : k + {WORDS - 1}], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - {WORDS - 2})) AS k FROM dw)
  UNION ALL SELECT doc_id, substr(c, k, {CHARS}) FROM (SELECT doc_id, c, unnest(range(1, length(c) - {CHARS - 2})) AS k FROM dc)),
b AS (SELECT item_id, array_to_string(w[k : k + {WORDS - 1}], ' ') AS g FROM (SELECT item_id, w, unnest(range(1, len(w) - {WORDS - 2})) AS k FROM iw)
  UNION ALL SELECT item_id, substr(c, k, {CHARS}) FROM (SELECT item_id, c, unnest(range(1, length(c) - {CHARS - 2})) AS k FROM ic))
SELECT DISTINCT doc_id, item_id FROM a JOIN b USING (g)"""
