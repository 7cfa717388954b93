"""p3: text statistics of every document, and what is a list, a table or junk rather than prose.

Method: tables and lists show in how delimiters line up vertically, in the periodicity of indentation and markers, and in
the autocorrelation of line lengths, combined with word, symbol and punctuation ratios. Lines with a marker or delimiter
are candidates; each run of candidates is decided as a whole by its evidence, the sum of alignment or periodicity and
autocorrelation less what speaks for prose, sentence ends and function words. Runs without either are judged by the same
ratios whether they are prose, and by the recurrence of digits, indentation and lengths whether they are a list or a
table. Junk shows in symbol and letter ratios. A text is of a kind if more than half of it, by characters, is no prose.

Null and empty texts have zero statistics and no kind. A text of one line can be junk or a list, but needs MIN_RUN lines
that line up to be a table. Texts of any length are read whole. Repeated rows of a key count once.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.llm.tables import code_points
from pagemill.session import spread, table

#: Neighbouring lines that must agree for a table; for a list one less.
MIN_RUN = 3
#: Least evidence of a run of lines with markers or delimiters.
EVIDENCE = 0.1
#: A run without markers and delimiters: fewest lines, longest line, most columns of a table with a cell per line.
MIN_PLAIN, MAX_PLAIN, MAX_COLUMNS = 4, 60, 8
#: Most function words, which are broadcast; more are refused.
MAX_COMMON = 1_000_000

_SYMBOL = regex.compile(r"[^\p{L}\p{M}\p{N}\s.,;:!?'\"()。，、；：！？…“”‘’「」（）\-]")
_END = re.compile("[.!?…。！？．؟।:：;；][\"'”’»」』）)\\]]*$")
_STOP = re.compile("[.!?,;:](?:[\"'”’»)]*$| )|[…。！？．؟।，、；：،؛]")
_MARKER = re.compile(
    "[ \t]*(?:[-–—•*·▪◦‣●○■□►>+]|\\(?\\d{1,3}[.)、．]|\\(?[A-Za-z][.)]|\\[[ xX✓]?\\]|[☐☑☒✓✗]|[①-⑳㈠-㈩]|\\(?[ivxlIVX]{1,5}[.)]|[一二三四五六七八九十]{1,3}、)"
    "(?=[ \t　 ]|[^\x00-\x7f])"
)
_CONTENTS = re.compile("(?:\\.[ .]{2,}|…{2,}|·{3,}|_{3,}|\t)\\s*(?:\\d{1,4}|[ivxl]{1,6})\\s*$")
_INDEX = re.compile("^[^,;.]{1,80}(?:[,;] ?\\d{1,4}(?:[-–]\\d{1,4})?){2,}\\s*$")
_KEY_VALUE = re.compile("^[^:：.!?。！？]{1,50}[:：][ \t　]*\\S.{0,80}$")
_GAP = re.compile("(?<=\\S)(?: {2,}|　{2,})(?=\\S)")
_CELL = re.compile("\\s*[\\t|;:：,]\\s*|(?<=\\S)(?: {2,}|　{2,})|[.…·_]{3,}\\s*|^[ \\t]*\\S{1,4}[ \\t]")
_BOX = re.compile("[─-▟]")
_PDF = re.compile("(?:endobj|endstream|stream|xref|obj|/Length|/Font|/Type|/Page|\\[IMAGE|<<|>>|0 R)\\d*")
_BLOB = re.compile("[A-Za-z0-9+/=_-]{25,}")
_HEX = re.compile(r"\b(?=[a-f]*\d)(?=\d*[a-f])[0-9a-f]{4,64}\b")
_LATIN_WORD = re.compile("[A-Za-z]{2,}")
_VOWEL = re.compile("[aeiouyAEIOUYà-ÿÀ-ß]")


FLAGS = ("solid", "letter", "digit", "mark", "odd", "box", "latin", "vowel", "symbol")
_FLAG: np.ndarray | None = None


def flag_table() -> np.ndarray:
    """A bit for each of FLAGS, by code point."""
    global _FLAG
    if _FLAG is None:
        bit = {f: 1 << i for i, f in enumerate(FLAGS)}
        t = code_points(
            lambda c: (not c.isspace()) * bit["solid"] + c.isalpha() * bit["letter"] + c.isdigit() * bit["digit"]
            + bool(_SYMBOL.match(c)) * bit["symbol"],
            np.uint16,
        )
        t[0x2500:0x25A0] |= bit["box"]
        for chars, f in (("!#$%&*+/<=>@[\\]^_`{|}~'\"-.,:;()", "mark"), ("#$&*+<=>@[\\]^_`{|}~", "odd")):
            t[[ord(c) for c in chars]] |= bit[f]
        for c in "abcdefghijklmnopqrstuvwxyz":
            for x in (c, c.upper()):
                t[ord(x)] |= bit["latin"] + (c in "aeiouy") * bit["vowel"]
        _FLAG = t
    return _FLAG


#: Bits of a number that each of three flags has for its sum over a line.
LANE = 21


@lru_cache(1)
def lanes() -> list[np.ndarray]:
    """The bits of each three of FLAGS by code point, apart, so that they are summed together."""
    t = flag_table().astype(np.int64)
    return [sum((t >> i & 1) << LANE * (i % 3) for i in range(at, at + 3)) for at in range(0, len(FLAGS), 3)]


_LETTERS = regex.compile(r"[\p{L}\p{M}]")
_RUN = regex.compile(r"[\p{L}\p{M}\p{N}]")
_SINGLE = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}]")


@lru_cache(1)
def word_table() -> np.ndarray:
    """By code point: 1 a word by itself, 2 a number, 3 a letter or mark, 4 an apostrophe, 0 all else."""
    t = code_points(lambda c: 1 if _SINGLE.match(c) else 3 if _LETTERS.match(c) else 2 if _RUN.match(c) else 0, np.uint8)
    t[[ord("'"), ord("’")]] = 4
    return t


def words_of(text: str) -> tuple[str, list[str]]:
    """(ideographs and kana, each a word, runs of letters, marks and digits with apostrophes within)."""
    kind = word_table()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
    run = np.zeros(len(kind) + 2, dtype=bool)
    run[1:-1] = (kind == 2) | (kind == 3)
    inside = np.flatnonzero(kind == 4)
    if len(inside):
        inside = inside[(inside > 0) & (inside < len(kind) - 1)]
        run[inside[run[inside] & (kind[np.minimum(inside + 1, len(kind) - 1)] == 3)] + 1] = True
    edges = np.flatnonzero(run[1:] != run[:-1]).tolist()
    alone = np.flatnonzero(kind == 1)
    singles = "".join(map(text.__getitem__, alone.tolist())) if len(alone) else ""
    return singles, [text[i:j] for i, j in zip(edges[::2], edges[1::2])]


def usual(text: str, common: set[str]) -> tuple[int, int, int]:
    """(words, their characters, how many are common words)."""
    singles, runs = words_of(text.lower())
    known = sum(map(common.__contains__, singles)) + sum(map(common.__contains__, runs))
    return len(singles) + len(runs), len(singles) + sum(map(len, runs)), known


def ends_in_number(text: str) -> bool:
    c = text.rstrip()[-1:]
    return c.isdigit() or c in "ivxlIVXL"


def is_contents(text: str) -> bool:
    return ends_in_number(text) and bool(_CONTENTS.search(text))


def counted(lines: list[str]) -> list[dict[str, int]]:
    """How many characters of each line have each flag."""
    points = np.frombuffer("\n".join([*lines, ""]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    sizes = [len(x) + 1 for x in lines]
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(int)
    if max(sizes) < 1 << LANE:
        three = [np.add.reduceat(t[points], starts) for t in lanes()]
        sums = [(x >> LANE * i & (1 << LANE) - 1).tolist() for x in three for i in range(3)]
    else:
        bits = flag_table()[points]
        sums = [np.add.reduceat((bits >> i & 1).astype(np.int64), starts).tolist() for i in range(len(FLAGS))]
    return [dict(zip(FLAGS, x)) for x in zip(*sums)]


def is_junk(text: str, k: dict[str, int]) -> bool:
    """Whether a line, or a whole text, is no language at all; k counts its characters by flag."""
    n = k["solid"]
    if n < 4:
        return False
    if k["box"] > 0.2 * n and len(set(re.findall(r"[^\W_]", text))) <= 10:
        return True
    if k["digit"] > 0.06 * n:
        found = [sum(len(m) for m in p.findall(text)) for p in (_PDF, _HEX, _BLOB)]
        if found[0] > 0.25 * n or found[1] > 0.6 * n or found[2] > 0.5 * n:
            return True
    if k["mark"] > 0.35 * n and k["letter"] < 0.55 * n and "\t" not in text and not is_contents(text):
        if k["odd"] > 0.18 * n or k["letter"] < 0.15 * n and k["mark"] > 0.6 * n and k["odd"] > 0.05 * n:
            return True
    if k["latin"] > 0.5 * n and k["vowel"] < 0.2 * k["latin"]:
        words = _LATIN_WORD.findall(text)
        dumb = sum(len(w) for w in words if len(w) >= 3 and not w.isupper() and len(_VOWEL.findall(w)) < 0.15 * len(w))
        if len(words) >= 3 and dumb > 0.5 * sum(map(len, words)):
            return True
    # most texts have more than five characters among their first ones
    return n >= 12 and len(set(text[:40])) <= 5 and len(set(text)) <= 5 and not is_contents(text)


def alignment(lines: list[str]) -> list[str]:
    """The delimiter that lines up through each line and its neighbours, or ''."""
    counts = {d: [x.count(d) for x in lines] for d in ("\t", "|", ";")}
    gaps = [len(_GAP.findall(x)) if "  " in x or "　" in x else 0 for x in lines]
    # a full cell leaves no gap: such a line counts with its neighbours
    for i, x in enumerate(lines[1:-1], 1):
        if not gaps[i] and gaps[i - 1] and gaps[i + 1] and not _END.search(x) and 0.5 < len(x) / len(lines[i - 1]) < 2:
            gaps[i] = 1
    counts["  "] = gaps
    counts[":"] = [int((":" in x or "：" in x) and len(x) < 110 and bool(_KEY_VALUE.match(x)) and not _END.search(x)) for x in lines]
    out = [""] * len(lines)
    for d, c in counts.items():
        a = 0
        while a < len(lines):
            b = a
            while b < len(lines) and c[b] and (c[b] == c[a] or d == "  "):
                b += 1
            if b - a >= MIN_RUN and not (d == ":" and spread_of(lines[a:b]) > 0.6):
                for k in range(a, b):
                    out[k] = out[k] or d
            a = max(b, a + 1)
    return out


def spread_of(lines: list[str]) -> float:
    n = [len(x) for x in lines]
    return float(np.std(n) / max(np.mean(n), 1))


def autocorrelation(n: list[int], lag: int = 1) -> float:
    """Of line lengths with those of the line `lag` further; 0 for too few lines."""
    x = np.array(n, dtype=float)
    x -= x.mean() if len(x) else 0
    v = float(x @ x)
    return float(x[:-lag] @ x[lag:]) / v if len(x) > lag + 1 and v else 0.0


def periodicity(lines: list[str]) -> float:
    """Share of lines whose marker or indentation recurs within the next two lines."""
    marks = [("m" if _MARKER.match(x) else "") + str(len(x) - len(x.lstrip())) for x in lines]
    again = [bool(m != "0") and m in marks[i + 1 : i + 3] for i, m in enumerate(marks)]
    return sum(again) / len(lines) if lines else 0.0


def recurs(values: list, lag: int) -> bool:
    """Whether values that differ among themselves come again after `lag` lines, but for one in ten."""
    same = sum(a == b for a, b in zip(values, values[lag:]))
    return len(set(values[:lag])) > 1 and same >= 0.9 * (len(values) - lag)


def plain_kind(lines: list[str], counts: list[dict[str, int]], common: set[str]) -> str:
    """'list', 'table' or 'prose' for a run of lines without markers and delimiters."""
    n = len(lines)
    sizes = [len(x.strip()) for x in lines]
    if n < MIN_PLAIN or max(sizes) > MAX_PLAIN:
        return "prose"
    solid = sum(k["solid"] for k in counts)
    if sum(k["symbol"] for k in counts) > 0.08 * solid or 4 * sum(bool(_STOP.search(x)) for x in lines) > n:
        return "prose"
    words, _, known = usual("\n".join(lines), common)
    if not words or known > 0.2 * words:
        return "prose"
    # wrapped text fills all its lines but the last; items are short or differ in length
    full = 20 if sum(k["latin"] for k in counts) > 0.5 * solid else 12
    if np.mean(sizes[:-1]) > full and spread_of([x.strip() for x in lines[:-1]]) < 0.2:
        return "prose"
    digits = [k["digit"] > 0.4 * k["solid"] for k in counts]
    indents = [len(x) - len(x.lstrip()) for x in lines]
    for lag in range(2, min(MAX_COLUMNS, n // MIN_RUN) + 1):
        if recurs(digits, lag) or recurs(indents, lag) and lag > 2:
            return "table"
        if len(set(indents)) == 1 and autocorrelation(sizes, lag) > 0.75 * (n - lag) / n:
            return "table"
    return "table" if all(digits) else "list"


def columns(line: str) -> list[int]:
    """Where the cells of a line begin: behind its delimiters, leaders and gaps, and behind its marker."""
    return [m.end() for m in _CELL.finditer(line)]


def aligned_share(lines: list[str]) -> float:
    """Share of neighbouring lines whose delimiters line up: as many of them, or most of them at the same places."""
    where = [columns(x) for x in lines]
    same = 0
    for a, b in zip(where, where[1:]):
        near = sum(any(abs(x - y) <= 2 for y in b) for x in a)
        same += bool(a) and (len(a) == len(b) or 2 * near > max(len(a), len(b)))
    return same / (len(lines) - 1)


def evidence(lines: list[str], kind: str, common: set[str]) -> float:
    """What speaks for a list or table in a run of candidate lines, less what speaks for prose."""
    n, _, known = usual("\n".join(lines), common)
    ends = sum(bool(_END.search(x.rstrip())) for x in lines) / len(lines)
    shape = max(aligned_share(lines), periodicity(lines) if kind == "list" else 0.0)
    return shape + 0.3 * max(autocorrelation([len(x) for x in lines]), 0.0) - ends - 0.5 * max(known / max(n, 1) - 0.2, 0.0)


def line_kinds(lines: list[str], counts: list[dict[str, int]], common: set[str] = frozenset()) -> list[str]:
    """'list', 'table', 'junk' or 'prose' for each line."""
    if len(lines) > 1 and is_junk("\n".join(lines), dict(zip(FLAGS, map(sum, zip(*(k.values() for k in counts)))))):
        return ["junk"] * len(lines)
    aligned = alignment(lines)
    marked = [bool(_MARKER.match(x)) and len(x) < 160 for x in lines]
    listed = [ends_in_number(x) and bool(_CONTENTS.search(x) and "\t" not in x or _INDEX.match(x)) for x in lines]
    out = []
    for i, x in enumerate(lines):
        near = marked[max(0, i - 1) : i] + marked[i + 1 : i + 2]
        if is_junk(x, counts[i]):
            out.append("junk")
        elif listed[i]:
            out.append("list")
        elif marked[i] and (any(near) or len(lines) == 1) and not re.search(r"[.!?] [A-ZÀ-Þ]", x[6:]):
            out.append("list")
        elif aligned[i] and (aligned[i] in "\t|;" or not _END.search(x) or len(x) < 60):
            out.append("table")
        else:
            out.append("prose")
    a = 0
    while a < len(out):
        b = a
        while b < len(out) and out[b] == out[a]:
            b += 1
        if b - a > 1 and out[a] in ("list", "table") and evidence(lines[a:b], out[a], common) < EVIDENCE:
            out[a:b] = ["prose"] * (b - a)
        a = b
    a = 0
    while a < len(out):
        b = a
        while b < len(out) and out[b] == "prose" and len(lines[b]) <= 2 * MAX_PLAIN:
            b += 1
        if b - a >= MIN_PLAIN:
            out[a:b] = [plain_kind(lines[a:b], counts[a:b], common)] * (b - a)
        a = max(b, a + 1)
    return out


def kind_of(lines: list[str], counts: list[dict[str, int]], common: set[str]) -> tuple[str, float]:
    """(what a text of these lines is, '' for prose, its share of no prose)."""
    kinds = line_kinds(lines, counts, common)
    solid = [k["solid"] for k in counts]
    share = Counter()
    for k, s in zip(kinds, solid):
        share[k] += s
    total = sum(solid)
    other = {k: share[k] / total for k in ("list", "table", "junk") if total and share[k]}
    return max(other, key=other.get) if sum(other.values()) > 0.5 else "", sum(other.values())


def lines_of(text: str | None) -> tuple[list[str], list[dict[str, int]]]:
    """The lines that aren't blank and the counts of their flags."""
    lines = [x for x in (text or "").split("\n") if x.strip()]
    return lines, counted(lines) if lines else []


def statistics(text: str | None, common: set[str]) -> dict:
    """All statistics of one text; `kind` is empty for prose."""
    text = text or ""
    words, chars, known = usual(text, common)
    n = len(text)
    lines, counts = lines_of(text)
    kind, share = kind_of(lines, counts, common)
    return {
        "word_count": words,
        "mean_word_length": round(chars / words, 4) if words else 0.0,
        "symbol_ratio": round(sum(k["symbol"] for k in counts) / n, 4) if n else 0.0,
        "line_end_punctuation": round(sum(bool(_END.search(x.rstrip())) for x in lines) / len(lines), 4) if lines else 0.0,
        "common_word_share": round(known / words, 4) if words else 0.0,
        "length_autocorrelation": round(autocorrelation([len(x) for x in lines]), 4),
        "marker_periodicity": round(periodicity(lines), 4),
        "no_prose_share": round(share, 4),
        "kind": kind,
    }


SCHEMA = (
    "word_count int, mean_word_length double, symbol_ratio double, line_end_punctuation double, common_word_share double, "
    "length_autocorrelation double, marker_periodicity double, no_prose_share double, kind string"
)


def function_words(common: DataFrame):
    """The function words, sent to all tasks."""
    rows = common.filter("word is not null").select("word").distinct()
    if (n := rows.count()) > MAX_COMMON:
        raise ValueError(f"{n} function words, more than {MAX_COMMON}")
    return common.sparkSession.sparkContext.broadcast({r["word"].lower() for r in rows.collect()})


def measured(df: DataFrame, key: str, text: str, common: DataFrame) -> DataFrame:
    """(key, statistics) of every row."""
    shared = function_words(common)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w = shared.value
        for b in batches:
            yield pd.DataFrame([{key: k} | statistics(t, w) for k, t in zip(b[key], b[text])], columns=[key, *[c.split()[0] for c in SCHEMA.split(", ")]])

    return spread(df.select(key, text)).mapInPandas(scan, f"{key} string, {SCHEMA}")


def kinds(df: DataFrame, key: str, text: str, common: DataFrame) -> DataFrame:
    """(key, kind) of the rows that are a list, a table or junk, without the statistics that the kind doesn't depend on."""
    shared = function_words(common)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w = shared.value
        for b in batches:
            found = [(k, kind) for k, t in zip(b[key], b[text]) if (kind := kind_of(*lines_of(t), w)[0])]
            yield pd.DataFrame(found, columns=[key, "kind"])

    return spread(df.select(key, text)).mapInPandas(scan, f"{key} string, kind string")


def ratios(validation: DataFrame) -> DataFrame:
    """One row per chunk of the rule's ratios: null ones are passed over, those scaled to percent set right."""
    fixed = [F.max(F.when(F.col(c) > 1, F.col(c) / 100).otherwise(F.col(c))).alias(c) for c in ("info_density", "noise_ratio")]
    return validation.filter("source = 'rule'").groupBy("chunk_id").agg(*fixed)


def p3_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The statistics of every chunk beside the ratios of its validation, if there is one."""
    chunks = table(spark, sf_dir, "chunks")
    stats = measured(chunks, "chunk_id", "content", table(spark, sf_dir, "common_words")).distinct()
    return stats.join(ratios(table(spark, sf_dir, "validation_results")), "chunk_id", "left")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kinds(table(spark, sf_dir, "chunks"), "chunk_id", "content", table(spark, sf_dir, "common_words")).distinct()
