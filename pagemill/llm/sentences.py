"""p1: sentence units of a text in any of its languages.

Method: every sentence-end mark is a candidate boundary, classified by a maximum-entropy model over the neighbouring
tokens, their case, length, digits and script, and the state of quotes and brackets. It is trained on reliable
boundaries: marks at line ends, whose next token is that of the following line, against marks that a lower-case letter,
digit or comma follows, that stand within a quotation that goes on, or after a known abbreviation.

A line break always ends a unit; headings, list lines and table lines are one unit; in Thai a space between two Thai
letters ends a sentence. Null, empty and blank texts have no units. Units don't overlap, keep reading order and hold
every character but surrounding white space. Repeated rows of a key count once. Without training rows every mark that
white space or an ideograph follows is a boundary.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.session import bounded_sample, small_side, spread, table

#: Texts that the model is trained on, the lowest by hash, and the longest of them: longer ones are no sample.
TRAIN_ROWS, TRAIN_CHARS = 4000, 4000
BUCKETS = 1 << 14
#: Longest cell of a line that is taken for a table line; prose with two semicolons has longer parts.
CELL = 100

MARKS = ".!?…。！？．｡؟।॥"
CLOSERS = "\"'”’“»›」』）)\\]】》"
# Abbreviations that names, numbers or more text follow, without their last full stop.
ABBREVIATIONS = set(
    """dr mr mrs ms prof ee st sr sra dra jr hr herr frau dhr mevr ing inż dipl m mme mlle sig sigra dott prof gen col sgt rev hon
    no nr n nº num núm núms art arts fig figs tab abb abs kap cap chap sect sec secc par vol vgl vg cf cfr zie hfst blz pag pág p pp s
    approx aprox env ca circa max min máx mín usw bzw z b d h u a o ä i e g ex al etc enz bijv ecc
    inc ltd co corp bros gmbh cia cía ltda
    jan feb mar apr jun jul aug sep sept oct nov dec ene abr ago dic janv févr avr juil déc
    т д п е г гг им ул рис гл стр ст см ср инж проф напр др тыс млн руб
    د م أ ص""".split()
)
# Abbreviations that may also end a sentence.
MAY_END = set("etc enz usw ecc p.m a.m pm am г гг д др".split())
# Months that follow the day's number and full stop.
MONTHS = set(
    """januar februar märz april mai juni juli august september oktober november dezember jänner
    januari februari maart mei augustus""".split()
)
# Words that go on after a quotation in scripts without capital letters.
GOES_ON = ("と", "って", "が", "は", "を", "も", "の", "に", "这", "這", "然后", "然後", "라고", "라는", "고 ", "하고", "이라고", "ثم", "और", "कहकर", "लिखा", "แล้ว", "ก่อน")

_CANDIDATE = re.compile(f"([{MARKS}]+)([{CLOSERS}]*(?:[   ]»)?)([ \t  -  　]*)")
_THAI = re.compile("(?<=[฀-๿])[   -  　]+(?=[฀-๿])")
_QUOTED = re.compile(
    "\"[^\"\n]*\"|“[^”\n]*”|„[^“”\n]*[“”]|«[^»\n]*»|‘[^’\n]*’(?![^\\W\\d_])|「[^」\n]*」|『[^』\n]*』|（[^）\n]*）|\\([^)\n]*\\)|《[^》\n]*》"
)
_TOKEN = regex.compile(r"[\p{L}\p{M}\p{N}._'’°%/\-]*$")
_NEXT = regex.compile(r"[\p{L}\p{M}\p{N}]*")
_LIST = re.compile("[ \t]*(?:[-–—*•·▪◦‣>+]|\\(?\\d{1,3}[.)、．]|\\(?[a-z][.)]|[A-Z]\\)|\\[[ xX]?\\]|[①-⑳㈠-㈩]|[ivx]{1,5}[.)])(?=[ \t　 ]|[^\x00-\x7f])")
_HEADING = re.compile("[ \t]*(?:\\d{1,3}(?:\\.\\d{1,3})+|\\d{1,3}\\.)[ \t]+\\S|[ \t]*第[^\n]{1,6}[章节節条]")
_CJK = re.compile("[぀-ヿ㐀-鿿豈-﫿]")
_TABLE_LINE = re.compile("\t|\\||[ 　]{3,}\\S|(?:;[^;\n]*){2,}|\\.{4,}")
_CELLS = re.compile("[;|\t]|\\s{3,}|[.…]{4,}")


def shape(token: str) -> str:
    if not token:
        return "-"
    if token.isdigit():
        return f"d{min(len(token), 5)}"
    if any(c.isdigit() for c in token):
        return "mix"
    if _CJK.match(token[-1]):
        return "cjk"
    if token[0].isupper():
        return "U1" if len(token) == 1 else "UP" if token.isupper() else "Up"
    return "lo1" if len(token) == 1 and token[0].islower() else "lo" if token[0].islower() else "caseless"


def features(mark: str, closers: str, gap: bool, token: str, after: str, quoted: str) -> tuple:
    """What the model sees of a candidate: a small tuple, so that its decision can be kept."""
    low = token.lower().strip("'’.-")
    nxt = _NEXT.match(after)[0]
    known = len(low) == 1 and token[-1:].isupper() or low in ABBREVIATIONS or low.replace(".", "") in ABBREVIATIONS or ("." in low and len(low.rpartition(".")[2]) <= 2 and not low[-1:].isdigit())
    return (
        mark[-1] if len(mark) == 1 else "..." if set(mark) <= {".", "…"} else "many",
        closers[-1:] or "-", gap, quoted, known, low in MAY_END or low.replace(".", "") in MAY_END,
        shape(token.rpartition(".")[2]), "." in token, min(len(low), 6), shape(nxt), after[:1] if after[:1] and not after[:1].isalnum() else "",
        nxt.lower() in MONTHS, after.startswith(GOES_ON) if closers else False, low if len(low) <= 6 and low.isalpha() and not _CJK.match(low[-1:] or "a") else "",
    )


NAMES = ("mark", "closer", "gap", "quoted", "known", "may", "shape", "dotted", "length", "next", "sign", "month", "goes", "word")


def active(f: tuple) -> np.ndarray:
    """Buckets of single features and of the pairs that carry most of the decision."""
    v = dict(zip(NAMES, f))
    parts = [f"{k}={x}" for k, x in v.items()]
    for a, b in (("mark", "next"), ("mark", "closer"), ("closer", "next"), ("known", "next"), ("known", "may"), ("may", "next"), ("gap", "next"), ("shape", "next"), ("quoted", "closer"), ("mark", "quoted"), ("shape", "month"), ("mark", "gap"), ("closer", "goes")):
        parts.append(f"{a}={v[a]}&{b}={v[b]}")
    parts.append(f"m={v['mark']}&c={v['closer']}&n={v['next']}")
    parts.append(f"k={v['known']}&m={v['may']}&n={v['next']}&g={v['gap']}")
    return np.array([zlib.crc32(p.encode()) % BUCKETS for p in parts])


class MaxEnt:
    """Logistic regression on hashed features with a quadratic penalty, fitted by full-batch Adam steps."""

    def __init__(self, rows: list[np.ndarray], y: list[bool], weight: list[float], steps: int = 250, penalty: float = 1e-5):
        self.w = np.zeros(BUCKETS)
        self.trained = len(set(y)) == 2
        if not self.trained:
            return
        at, t, u = np.stack(rows), np.array(y, dtype=float), np.array(weight) / np.sum(weight)
        m, v = np.zeros(BUCKETS), np.zeros(BUCKETS)
        for k in range(1, steps + 1):
            p = 1 / (1 + np.exp(-self.w[at].sum(1)))
            g = np.bincount(at.ravel(), np.repeat((p - t) * u, at.shape[1]), minlength=BUCKETS) + penalty * self.w
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            self.w -= 0.1 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-8)

    def score(self, f: tuple) -> float:
        if not self.trained:
            return 1.0 if f[2] or f[6] == "cjk" else -1.0
        return float(self.w[active(f)].sum())


def candidates(line: str) -> Iterator[tuple[int, tuple, str]]:
    """(end of the unit, features, text after) of each candidate within a line, what ends the line aside."""
    spans, bullet = None, _LIST.match(line)
    for m in _CANDIDATE.finditer(line):
        mark, closers, gap = m.groups()
        end, after = m.end(2), line[m.end() : m.end() + 24]
        if not after or len(mark) > 3 and set(mark) == {"."}:
            continue
        before = line[: m.start()]
        if not before.strip() or bullet and m.end(1) <= bullet.end() or (not gap and mark == "." and (after[0].isdigit() or after[0].isascii())):
            continue
        if spans is None:
            spans = [s.span() for s in _QUOTED.finditer(line)]
        quoted = "no"
        for a, b in spans:
            if a < m.start() < b:
                quoted = "within" if b > end else "ends" if b == end else "no"
                if b > m.end(1) and b <= end:
                    quoted = "ends"
                break
        # a closing mark that opens the next quotation belongs to that
        if closers and quoted != "ends" and not any(a < m.start() and b == m.end(1) + 1 for a, b in spans):
            opens = next((k for k, c in enumerate(closers) if c in "“\"'‘"), None)
            if opens is not None and any(a == m.end(1) + opens for a, _ in spans):
                end, after = m.end(1) + opens, line[m.end(1) + opens : m.end(1) + opens + 24]
                closers, gap = closers[:opens], ""
        token = _TOKEN.search(line[max(0, m.start() - 24) : m.start()])[0]
        yield end, features(mark, closers, bool(gap), token, after, quoted), after


def one_unit(line: str) -> bool:
    """List lines, table lines, whose cells are short or no prose, and numbered headings."""
    if _LIST.match(line) and len(line) < 80:
        return True
    if _TABLE_LINE.search(line) and (max(map(len, _CELLS.split(line))) <= CELL or sum(map(str.isalpha, line)) < 0.6 * len(line)):
        return True
    return bool(_HEADING.match(line)) and len(line) < 100 and line.rstrip()[-1:] not in MARKS


def units(text: str | None, model: MaxEnt, kept: dict | None = None) -> list[tuple[int, int]]:
    """(start, end) of each sentence unit, without surrounding white space."""
    out: list[tuple[int, int]] = []
    if not text:
        return out
    kept = {} if kept is None else kept
    at = 0
    for line in re.split("(?<=[\n\r  \x0b\x0c\x85])", text):
        cuts = [0]
        body = line.rstrip()
        if body and not one_unit(body):
            for end, f, _ in candidates(body):
                go = kept.get(f)
                if go is None:
                    if len(kept) > 200_000:
                        kept.clear()
                    go = kept[f] = model.score(f) > 0
                if go:
                    cuts.append(end)
            if "฀" <= max(body, default="") or any("฀" <= c <= "๿" for c in body[:200]):
                cuts += [m.start() for m in _THAI.finditer(body)]
        for a, b in zip(sorted(set(cuts)), [*sorted(set(cuts))[1:], len(body)]):
            piece = body[a:b]
            left = len(piece) - len(piece.lstrip())
            if left < len(piece):
                out.append((at + a + left, at + a + len(piece.rstrip())))
        at += len(line)
    return out


def labelled(texts: list[str]) -> tuple[list[np.ndarray], list[bool], list[float]]:
    """Reliable boundaries and non-boundaries of raw texts."""
    rows, y, weight = [], [], []

    def add(f: tuple, label: bool, w: float = 1.0) -> None:
        rows.append(active(f))
        y.append(label)
        weight.append(w)

    for text in texts:
        lines = [x.strip() for x in text.split("\n") if x.strip()]
        for line, following in zip(lines, lines[1:]):
            if len(line) < 25 or one_unit(line) or one_unit(following) or len(following) < 25:
                continue
            m = re.search(f"([{MARKS}]+)([{CLOSERS}]*)$", line)
            if m and len(m[1]) <= 3:
                # as it would stand in running text
                glue = "" if _CJK.match(line[m.start() - 1 : m.start()]) and _CJK.match(following) else " "
                spliced = line + glue + following
                for end, f, _ in candidates(spliced):
                    if end == len(line):
                        add(f, True)
        for line in lines:
            if one_unit(line):
                continue
            for _, f, after in candidates(line):
                v = dict(zip(NAMES, f))
                if v["quoted"] == "within":
                    add(f, False)
                elif after[0].islower() or after[0].isdigit() and v["known"] or after[0] in ",;:，；：、)）":
                    add(f, False)
                elif v["closer"] != "-" and v["goes"]:
                    add(f, False)
                elif v["closer"] != "-" and v["mark"] in "!?！？؟" and v["next"] in ("cjk", "caseless"):
                    add(f, False)
                elif v["mark"] == "..." and v["next"] in ("cjk", "caseless") and not v["gap"]:
                    add(f, False)
                elif v["may"] and v["gap"] and v["next"] in ("Up", "UP") and v["quoted"] == "no":
                    add(f, True)
                elif v["known"] and not v["may"] and v["mark"] == ".":
                    add(f, False)
                elif v["month"] and v["shape"] in ("d1", "d2"):
                    add(f, False, 5.0)
                elif v["closer"] != "-" and v["mark"] in ".。।" and v["quoted"] == "ends" and v["next"] in ("cjk", "caseless", "Up"):
                    add(f, True)
                elif v["mark"] in "。！？।؟" and v["closer"] == "-" and v["quoted"] == "no":
                    add(f, True)
    return rows, y, weight


def trained(df: DataFrame, text: str) -> MaxEnt:
    x = F.col(text)
    rows = bounded_sample(df.filter(F.length(x).between(61, TRAIN_CHARS)).select(x.alias("t")), "t", TRAIN_ROWS).collect()
    return MaxEnt(*labelled([r["t"] for r in rows]))


def with_units(df: DataFrame, key: str, text: str, model: MaxEnt) -> DataFrame:
    """(key, start_pos, end_pos) of every unit of every row."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m, kept = shared.value, {}
        for b in batches:
            rows = [(k, *u) for k, t in zip(b[key], b[text]) for u in units(t, m, kept)]
            yield pd.DataFrame(rows, columns=[key, "start_pos", "end_pos"])

    return spread(df.select(key, text)).mapInPandas(scan, f"{key} string, start_pos int, end_pos int")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The units of the chunks in sentence_sample."""
    chunks = table(spark, sf_dir, "chunks")
    sample = small_side(table(spark, sf_dir, "sentence_sample").select("chunk_id").distinct())
    return with_units(chunks.join(sample, "chunk_id", "left_semi"), "chunk_id", "content", trained(chunks, "content")).distinct()


def p1_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The units of every chunk."""
    chunks = table(spark, sf_dir, "chunks")
    return with_units(chunks, "chunk_id", "content", trained(chunks, "content")).distinct()
