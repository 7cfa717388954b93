"""p2: text of scanned pages as continuous paragraphs: furniture out, broken words joined, misread characters set right.

Method: correction candidates come from character q-gram inverted joins between unknown tokens and the lexicon of the
sources that were not scanned; gradient-boosted trees rank them and choose replacements, and boosted classifiers of line
pairs (a line and the one beside it, and lines of other pages that read the same) decide on joins and on furniture.

Words of alphabets and syllables are looked up by their rarest bigrams, numbers by the digits that their letters may be;
in Chinese and Japanese, which have no spaces, an unknown character is looked up by the pair of its neighbours. Thai is
not searched: it has neither spaces nor characters rare enough. Pages are read twice: first for the distinct tokens, line
pairs and recurring lines, then for the places of those that were decided on, which a filter of bits finds.

A source is scanned if any of its blocks says so. Null and empty blocks have no issue; a block without a box is judged by
its text and its order on the page; without any unscanned source there is no lexicon and nothing is corrected. Repeated
rows count once. Training samples are bounded by TRAIN rows each; lexicon, running headers and candidates cover all blocks.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.llm.boosting import Boosted
from pagemill.llm.tables import code_points
from pagemill.session import bounded_sample, checkpointed, small_side, spread, table

#: Rows of each sample that a classifier is trained on, and how many candidates of them.
TRAIN, TRAIN_CANDIDATES = 2500, 20_000
#: Bits of the filter that finds places; more keys than it has bits make it slower, never wrong.
BITS = 26
#: Words in a lexicon where one that occurs once is rare; in a larger one, names and pieces of words come several times too.
USUAL = 360_000
#: Share of the blocks of several lines of a source that may reach into a margin.
BEYOND = 0.001
#: How sure the ranker must be of an ideograph: most unknown ones among known neighbours are right.
SURE_GAP = 0.5
#: Most bigrams whose frequency is known to the order of prefixes; it bears on speed alone.
FREQUENT = 2000

# Pairs of what stands on the page and what character recognition makes of it.
CONFUSIONS = [
    ("rn", "m"), ("m", "rn"), ("cl", "d"), ("d", "cl"), ("vv", "w"), ("w", "vv"), ("l", "1"), ("i", "1"), ("l", "i"), ("i", "l"), ("i", "j"), ("j", "i"),
    ("o", "0"), ("e", "c"), ("c", "e"), ("h", "b"), ("b", "h"), ("t", "f"), ("f", "t"), ("g", "9"), ("g", "q"), ("s", "5"), ("b", "6"), ("b", "8"), ("z", "2"),
    ("in", "m"), ("m", "in"), ("ni", "m"), ("ri", "n"), ("u", "ii"), ("ii", "u"), ("h", "li"), ("k", "lc"), ("é", "6"), ("y", "v"), ("v", "y"),
    ("a", "o"), ("u", "v"), ("n", "u"), ("u", "n"), ("n", "ri"), ("r", "n"), ("li", "h"), ("t", "l"), ("l", "t"), ("ü", "u"), ("é", "e"),
    ("о", "0"), ("з", "3"), ("б", "6"), ("н", "и"), ("и", "н"), ("п", "л"), ("л", "п"), ("ш", "щ"), ("щ", "ш"), ("е", "с"), ("с", "е"), ("ц", "п"), ("т", "г"),
]

#: Marks that belong to the letter before them, in words of Latin, Arabic and Devanagari.
_MARKS = "\u0300-\u036f\u064b-\u065f\u0670\u0900-\u0903\u093a-\u094f\u0955-\u0957\u0962\u0963"
_WORD = re.compile(f"(?:[^\\W_]|[{_MARKS}])+(?:['’][^\\W_]+)*")
_ALPHABETIC = regex.compile(r"^[\p{Latin}\p{Cyrillic}\p{Greek}\p{Hangul}\p{Arabic}\p{Devanagari}0-9'’]+$")
_LETTER = regex.compile(r"[\p{Latin}\p{Cyrillic}\p{Greek}\p{Hangul}\p{Arabic}\p{Devanagari}]")
_DIGIT = str.maketrans("lIO", "110")
_CODE = re.compile(r"(?:[A-Za-z]{0,4}-?\d[\d.,-]*[A-Za-z]{0,2}|\d+[A-Za-zµ°%]{1,4})$")
_NUMBER = re.compile(r"(?=[lIO0-9]*[lIO])(?=[lIO]*[0-9]|lO|IO|Ol|ll)[lIO0-9]{2,}$")
_DIGITS, _RADICAL = re.compile(r"\d"), re.compile("[⺀-⿕]")
_HAN = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}]")
_BREAK = re.compile("([^\\W_]+(?:['’][^\\W_]+)*)([-¬­‐‑])[ \t]*$")
# what makes a word part of a code, a path or a formula
_GLUE, _GLUE_BEFORE = frozenset("-/_=+"), frozenset("-/_.=+")
# words and numbers that are no such part: pieces of codes, of which long texts have any of a few letters, are no words of a lexicon
_WHOLE = re.compile(f"(?<![\\w{_MARKS}/.=+-]){_WORD.pattern}(?!['’][^\\W_]|[\\w{_MARKS}/=+-])")
_DIGITLIKE = re.compile(f"(?<![\\w{_MARKS}'’/=+])[lIO0-9]{{2,}}(?!['’][^\\W_]|[\\w{_MARKS}/=+])")
_BREAKS = tuple("-¬­‐‑")
_START = re.compile("[ \t]*([^\\W\\d_]+)")
_COMPOUND = regex.compile(r"[^\W\d_]+-[^\W\d_]+")
_NUM = "[\\dlIOo|]{1,4}"
_PAGE = re.compile(
    f"^\\W*(?:(?:pag[ec]|p|pg|seite|página|pagina|pág|стр|страница|第|صفحة|หน้า|पृष्ठ|페이지|쪽|ページ)\\W*)?{_NUM}\\W*"
    f"(?:(?:of|von|de|di|van|из|sur|из|共|中)?\\W*{_NUM}\\W*)?(?:页|頁|ページ|쪽|페이지|面)?\\W*$|^\\W*[ivxl]{{1,6}}\\W*$",
    re.I,
)
_SPLIT = re.compile("\\s*[·|]\\s*|\\s{2,}|\t")
_SECTION = re.compile("^[\\dlI]+(?:\\.[\\dlI]+)*\\s+")
_FOLD = str.maketrans("01ij|!e6hf7589", "ollll" + "lcbbttsbg")
_HEAD_NUM, _TAIL_NUM = re.compile(r"\W*[\dlIO]{1,4}\b"), re.compile(r"\b[\dlIO]{1,4}$")
_ENDS = ".!?…。！？।؟：:;；,，、"


def skeleton(part: str) -> str:
    """A key that misreadings of a running header share."""
    part = _SECTION.sub("", part.strip()).lower().replace("rn", "m").replace("vv", "w").translate(_FOLD)
    return re.sub(r"[\W\d_]", "", part)


def parts_of(line: str) -> list[str]:
    return [s for p in _SPLIT.split(line) if len(s := skeleton(p)) >= 2 and not _PAGE.match(p)]


def part_key(part: str) -> int:
    return zlib.crc32(part.encode()) | len(part) << 32


def is_code(w: str) -> bool:
    """Whether it is a number with letters or a code; a lower-case word of some length with one digit may be a misread word."""
    return bool(_CODE.match(w)) and not (w.islower() and len(w) > 4 and sum(map(str.isdigit, w)) == 1)


def line_features(line: str, beside: str, parts: int) -> list[float]:
    """What tells furniture by itself and against the line beside it."""
    end = len(line)
    while end and not (line[end - 1].isalnum() or line[end - 1] == "_"):
        end -= 1
    return [
        float(bool(_PAGE.match(line))), float(bool(_HEAD_NUM.match(line)) or bool(_TAIL_NUM.search(line[max(end - 6, 0) : end]))),
        parts, len(line), sum(map(str.isupper, line)) / max(sum(map(str.isalpha, line)), 1), float(line[end : end + 1] in _ENDS and end < len(line)),
        float("·" in line or "|" in line), len(beside) / (len(line) + len(beside)), float(beside[:1].islower()), float(line[:1].islower()),
        float(line[-1:] in _BREAKS),
    ]


@lru_cache(1 << 17)
def is_word(w: str) -> bool:
    """Whether it is a word of a script with spaces."""
    return bool(_ALPHABETIC.match(w) and _LETTER.search(w))


@lru_cache(1)
def han_table() -> np.ndarray:
    return code_points(lambda c: bool(_HAN.match(c)))


def points_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def trigrams(text: str) -> tuple[list[int], list[str]]:
    """(places, three characters) around each ideograph or kana, white space left out, digits as one, radicals as ideographs.

    The places are those among the characters that are no white space.
    """
    t = _DIGITS.sub("0", "".join(text.split()))
    if _RADICAL.search(t):
        t = "".join(unicodedata.normalize("NFKC", c)[:1] if "⺀" <= c <= "⿕" else c for c in t)
    at = np.flatnonzero(han_table()[points_of(t)])
    at = at[(at > 0) & (at < len(t) - 1)].tolist()
    return at, [t[i - 1 : i + 2] for i in at]


def count_lexicon(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(kind, a, n) of words, compounds, mixtures of letters and digits, and trigrams, added up within each batch."""
    for b in batches:
        n, words, numbers, compounds, tri = Counter(), Counter(), Counter(), Counter(), Counter()
        for text in b["content_text"]:
            words.update(_WHOLE.findall(text))
            numbers.update(_DIGITLIKE.findall(text))
            if "-" in text:
                compounds.update(m[0].lower() for m in _COMPOUND.finditer(text))
            if not text.isascii():
                tri.update(trigrams(text)[1])
        for w, k in words.items():
            if is_word(w):
                n["w", w.lower()] += k
        for w, k in numbers.items():
            if _NUMBER.match(w):
                n["n", w] += k
        rows = [(*k, v) for k, v in n.items()] + [("h", k, v) for k, v in compounds.items()] + [("t", k, v) for k, v in tri.items()]
        yield pd.DataFrame(rows, columns=["kind", "a", "n"])


def lines_of(text: str) -> list[str]:
    return [x for x in text.split("\n") if x.strip()]


def broken_lines(lines: list[str]) -> Iterator[tuple[int, tuple[re.Match, re.Match]]]:
    """(line, (its broken end, the start of the next)) of the line pairs that may break a word."""
    for i, line in enumerate(lines[:-1]):
        if line.rstrip(" \t")[-1:] in _BREAKS and (broken := _BREAK.search(line)) and (start := _START.match(lines[i + 1])):
            yield i, (broken, start)


def looked_at(lines: list[str], let: Callable[[str, str], bool], wanted: Callable[[str], bool]) -> Iterator[tuple[str, int, int, str, str, str]]:
    """(kind, line, start, key, as written, other) of what `let` lets through by kind and key; `wanted` does so for a word.

    Kinds are h line pairs, w words, n numbers, t trigrams. Of h, the key is the left part, the mark is `as written` and the
    right part is `other`; a word that a mark breaks is looked at joined, under its first line and with a start of -1.
    """
    breaks = dict(broken_lines(lines))
    for i, (broken, start) in breaks.items():
        if let("h", "\x1f".join((broken[1], broken[2], start[1]))):
            yield "h", i, -1, broken[1], broken[2], start[1]
        joined = broken[1] + start[1]
        if is_word(joined) and let("w", joined.lower()):
            yield "w", i, -1, joined.lower(), joined, ""
    for i, line in enumerate(lines):
        some = set(filter(wanted, _WORD.findall(line)))
        if not some:
            continue
        end = breaks[i][0].start() if i in breaks else len(line)
        carried = breaks[i - 1][1][0] if i - 1 in breaks else ""
        for m in _WORD.finditer(line, len(carried), end):
            w, before, after = m[0], line[m.start() - 1 : m.start()], line[m.end() : m.end() + 1]
            if w not in some:
                continue
            if _NUMBER.match(w):
                yield "n", i, m.start(), w, w, ""
            elif before not in _GLUE_BEFORE and after not in _GLUE and not is_code(w):
                yield "w", i, m.start(), w.lower(), w, ""
    whole = "\n".join(lines)
    if not whole.isascii():
        at, found = trigrams(whole)
        picked = [k for k, t in enumerate(found) if let("t", t)]
        if picked:
            places = np.array([i for i, c in enumerate(whole) if not c.isspace()])[[at[k] for k in picked]]
            starts = np.cumsum([0] + [len(x) + 1 for x in lines])
            rows = np.searchsorted(starts, places, side="right") - 1
            for k, r, at_line, w in zip(picked, rows.tolist(), (places - starts[rows]).tolist(), places.tolist()):
                yield "t", r, at_line, found[k], whole[w], ""


SEEN = "kind string, a string, b string, c string, source string, page int, part bigint, alone int"


def observe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """What occurs, once a batch: tokens (some that locate passes over), line pairs that may break a word, and P the parts
    of lines on each page."""
    for b in batches:
        words: set[str] = set()
        tri: set[str] = set()
        pairs: set[tuple] = set()
        parts: dict[tuple, int] = {}
        for source, page, zone, text in zip(b["source"], b["page"], b["zone"], b["content_text"]):
            lines = lines_of(text)
            words.update(_WORD.findall(text))
            if not text.isascii():
                tri.update(trigrams(text)[1])
            for _, (broken, start) in broken_lines(lines):
                pairs.add((broken[1], broken[2], start[1]))
                words.add(broken[1] + start[1])
            for line in lines:
                for part in parts_of(line):
                    k = (source, int(page), part_key(part))
                    parts[k] = max(parts.get(k, 0), int(zone == 1 and len(lines) == 1))
        tokens = {("w", w.lower(), None, None) for w in words if len(w) > 1 and is_word(w)} | {("n", w, None, None) for w in words if _NUMBER.match(w)}
        tokens |= {("t", t, None, None) for t in tri} | {("h", *p) for p in pairs}
        rows = [(*t, None, None, None, None) for t in tokens] + [("P", None, None, None, *k, v) for k, v in parts.items()]
        yield pd.DataFrame(rows, columns=[c.split()[0] for c in SEEN.split(", ")]).astype({"page": "Int32", "part": "Int64", "alone": "Int32"})


def filter_bits(keys: DataFrame) -> bytes:
    """A bit for the CRC of each of the keys `k`, in 2**BITS bits; built by the tasks, of fixed size on the driver."""
    at = F.pmod(F.crc32(F.col("k").cast("binary")), F.lit(1 << BITS)) + 1
    rows = keys.groupBy(F.bitmap_bucket_number(at).alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("m")).collect()
    out = bytearray(1 << BITS - 3)
    for r in rows:
        out[(r["b"] - 1) * 4096 : r["b"] * 4096] = r["m"]
    return bytes(out)


PLACES = (
    "source string, block_id string, page int, ord int, kind string, line int, start int, n_lines int, a string, b string, c string, "
    "zone int, x array<float>, parts array<bigint>"
)


def found_in(known: bytes) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        mask = (1 << BITS) - 1

        @lru_cache(1 << 17)
        def let(kind: str, key: str) -> bool:
            h = zlib.crc32(f"{kind}\x1f{key}".encode("utf-8", "replace")) & mask
            return bool(known[h >> 3] >> (h & 7) & 1)

        @lru_cache(1 << 17)
        def wanted(w: str) -> bool:
            return let("n", w) if _NUMBER.match(w) else len(w) > 1 and is_word(w) and let("w", w.lower())

        for b in batches:
            rows = []
            for source, block, page, ord_, zone, text in b.itertuples(index=False, name=None):
                lines = lines_of(text)
                head = (source, block, page, ord_)
                rows += [(*head, kind, i, at, len(lines), key, w, other, zone, None, None) for kind, i, at, key, w, other in looked_at(lines, let, wanted)]
                for i, line in enumerate(lines):
                    keys = [part_key(p) for p in parts_of(line)]
                    if i in (0, len(lines) - 1) or _PAGE.match(line) or any(let("P", f"{source}\x1f{k}") for k in keys):
                        beside = lines[1] if i == 0 and len(lines) > 1 else lines[i - 1] if i else ""
                        rows.append((*head, "F", i, 0, len(lines), None, None, None, zone, line_features(line.strip(), beside.strip(), len(keys)), keys))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in PLACES.split(", ")])

    return find


def locate(spark: SparkSession, blocks: DataFrame, bits: bytes) -> DataFrame:
    """The places of what the filter lets through, and F: lines that may be furniture, at the ends of a block or recurring."""
    shared = spark.sparkContext.broadcast(bits)
    return blocks.mapInPandas(lambda batches: found_in(shared.value)(batches), PLACES)


def sample_of(df: DataFrame, columns: list[str], rows: int = TRAIN) -> pd.DataFrame:
    """The rows lowest by hash: a bounded sample that doesn't depend on partitions."""
    keyed = df.select(*columns).withColumn("_k", F.xxhash64(*columns).cast("string"))
    return bounded_sample(keyed, "_k", rows).select(*columns).toPandas()


def times(lexicon: DataFrame) -> float:
    """How often a rare word occurs in a lexicon of that size, at least once."""
    total = lexicon.filter("kind = 'w'").agg(F.sum("n")).first()[0] or 0
    return max(total / USUAL, 1.0)


def recurring(seen: DataFrame) -> DataFrame:
    """(source, part, pages, alone): parts of lines that stand on several pages, and on how many in a block of one line."""
    by_page = seen.filter("kind = 'P'").groupBy("source", "part", "page").agg(F.max("alone").alias("alone"))
    return by_page.groupBy("source", "part").agg(F.count("*").alias("pages"), F.sum("alone").alias("alone")).filter("pages > 1")


def furniture(places: DataFrame, again: DataFrame) -> DataFrame:
    """(source, block_id, line) of the lines that are running headers, footers or page numbers.

    The classifier sees a line, the one beside it, on how many pages its parts recur, how often in a margin, and the place
    of its block. It is trained on one-line blocks in margins against lines off the edges of pages or of their own kind; as furniture may be
    glued to a block or have no box, each sample also counts with other places, which then say nothing. Without blocks in
    margins there is nothing to learn from and no furniture.
    """
    lines = places.filter("kind = 'F'").select("source", "block_id", "page", "ord", "line", "n_lines", "zone", "x", "parts")
    key = ["source", "block_id", "line"]
    met = (
        lines.select(*key, F.explode("parts").alias("part")).join(again, ["source", "part"]).groupBy(*key)
        .agg(F.max("pages").alias("most"), F.min("pages").alias("least"), F.max("alone").alias("margin"), F.min("alone").alias("margin_least"), F.count("*").alias("met"))
    )
    ends = lines.groupBy("source", "page").agg(F.min("ord").alias("lo"), F.max("ord").alias("hi"))
    every = F.col("met") >= F.col("x")[2]
    counts = [F.when(F.lit(c in ("most", "margin")) | every, F.col(c)).otherwise(0).cast("float") for c in ("most", "least", "margin", "margin_least")]
    known = (
        lines.join(met, key, "left").fillna(0, ["most", "least", "margin", "margin_least", "met"]).join(ends, ["source", "page"])
        .select(*key, "n_lines", "zone", ((F.col("ord") == F.col("lo")) | (F.col("ord") == F.col("hi"))).alias("edge"), F.concat("x", F.array(*counts)).alias("x"))
    )
    known = checkpointed(known.dropDuplicates(key))
    columns = ["n_lines", "zone", "edge", "x"]
    good = sample_of(known.filter("n_lines = 1 and zone = 1"), columns)
    plain = (F.col("x")[0] == 0) & (F.col("x")[11] <= 1)
    bad = sample_of(known.filter((F.col("zone") == 0) & (~F.col("edge") | plain)), columns)
    if not len(good) or not len(bad):
        return known.select(*key).filter("false")  # nothing to learn from

    def x(d: pd.DataFrame) -> np.ndarray:
        own = np.array([list(v) for v in d["x"]], dtype=float).reshape(len(d), 15)
        return np.column_stack([own, d["n_lines"] == 1, d["zone"], d["edge"]]).astype(float)

    def moved(d: pd.DataFrame, place: dict) -> np.ndarray:
        """The samples in another place; glued to a block, they get the neighbours that other lines have."""
        out = x(d.assign(**place))
        there = x(bad[bad["n_lines"] > 1])
        if place["n_lines"] == 1 or not len(there):
            out[:, 7:9] = 0
        else:
            out[:, 7:9] = there[np.arange(len(d)) % len(there), 7:9]
        return out

    elsewhere = [{"n_lines": n, "zone": z, "edge": e} for n in (1, 5) for z in (-1, 0) for e in (True, False)]
    yes = [x(good), *[moved(good, k) for k in elsewhere if k["n_lines"] == 5 or k["zone"] < 0 and k["edge"]]]
    no = [x(bad), *[moved(bad, k) for k in elsewhere]]
    model = Boosted(np.vstack([*yes, *no]), np.array([1.0] * len(yes) * len(good) + [0.0] * len(no) * len(bad)))

    @F.pandas_udf("double")
    def likely(n_lines: pd.Series, zone: pd.Series, edge: pd.Series, own: pd.Series) -> pd.Series:
        return pd.Series(model.probability(x(pd.DataFrame(dict(zip(columns, (n_lines, zone, edge, own)))))))

    return known.filter(likely(*columns) > 0.5).select(*key)


def break_features(left: str, right: str, mark: str, joined: int, compound: int, l: int, r: int) -> list[float]:
    return [np.log1p(joined), np.log1p(compound), np.log1p(l), np.log1p(r), len(left), len(right), float(right[:1].islower()), float(left[-1:].isupper()), float(mark == "-")]


def broken_words(seen: DataFrame, lexicon: DataFrame, rare: float = 1.0) -> DataFrame:
    """(a, b, c): left part, mark and right part of the line pairs that break a word by a mark that is no part of it."""
    whole = sample_of(lexicon.filter("kind = 'w' and length(a) >= 6 and not a rlike '[0-9]'").filter(F.col("n") >= 3 * rare), ["a"])["a"].tolist()
    cut = {(w[:k], "-", w[k:]) for w in whole if (k := 2 + zlib.crc32(w.encode()) % (len(w) - 3))}
    apart = {(w.partition("-")[0], "-", w.partition("-")[2]) for w in sample_of(lexicon.filter("kind = 'h'"), ["a"])["a"]}
    # the pairs that the classifier is trained on are counted in the same join as those of the pages
    made = seen.sparkSession.createDataFrame([*cut, *apart] or [("", "", "")], "left string, mark string, right string")
    pairs = seen.filter("kind = 'h'").select(F.col("a").alias("left"), F.col("b").alias("mark"), F.col("c").alias("right"), F.lit(True).alias("real"))
    pairs = pairs.union(made.withColumn("real", F.lit(False))).groupBy("left", "mark", "right").agg(F.max("real").alias("real"))
    counts = lexicon.filter("kind in ('w', 'h')").select("kind", F.col("a").alias("k"), "n")
    asked = F.array(
        *[F.struct(F.lit(i).alias("i"), F.lit(kind).alias("kind"), F.lower(k).alias("k")) for i, (kind, k) in enumerate(
            [("w", F.concat("left", "right")), ("h", F.concat("left", F.lit("-"), "right")), ("w", F.col("left")), ("w", F.col("right"))]
        )]
    )
    of = lambda i: F.coalesce(F.max(F.when(F.col("i") == i, F.col("n"))), F.lit(0))
    pairs = checkpointed(
        pairs.select("left", "mark", "right", "real", F.inline(asked)).join(counts, ["kind", "k"], "left").groupBy("left", "mark", "right", "real")
        .agg(of(0).alias("joined"), of(1).alias("compound"), of(2).alias("l"), of(3).alias("r"))
    )
    rows, y = [], []
    for i, (left, mark, right, joined, compound, l, r) in enumerate(pairs.join(F.broadcast(made), ["left", "mark", "right"], "left_semi").drop("real").orderBy("left", "right").collect()):
        if (left, mark, right) in cut:
            # as for a word that is misread as well, and for other marks than the hyphen, which stand at line ends only
            rows.append(break_features(left, right, mark if i % 4 else "¬", joined if i % 3 else 0, compound, l, r))
            y.append(1.0)
        if (left, mark, right) in apart:
            for k in (compound, 0):
                rows.append(break_features(left, right, mark, joined, k, l, r))
                y.append(0.0)
    model = Boosted(np.array(rows, dtype=float).reshape(len(rows), 9), np.array(y))

    @F.pandas_udf("double")
    def likely(left: pd.Series, right: pd.Series, mark: pd.Series, joined: pd.Series, compound: pd.Series, l: pd.Series, r: pd.Series) -> pd.Series:
        x = [break_features(*t) for t in zip(left, right, mark, joined, compound, l, r)]
        return pd.Series(model.probability(np.array(x, dtype=float).reshape(len(x), 9)))

    p = likely("left", "right", "mark", "joined", "compound", "l", "r")
    return pairs.filter("real").filter(p > 0.5).select(F.col("left").alias("a"), F.col("mark").alias("b"), F.col("right").alias("c"))


def corrupt(word: str) -> str | None:
    """One misreading of a word, the same each time."""
    options = [(i, a, b) for a, b in CONFUSIONS for i in range(len(word)) if word.startswith(a, i)]
    if not options:
        return None
    i, a, b = options[zlib.crc32(word.encode()) % len(options)]
    return word[:i] + b + word[i + len(a) :]


def fold(word: str) -> str:
    return word.replace("rn", "m").replace("cl", "d").replace("vv", "w").translate(_FOLD)


def explained(token: str, word: str) -> float:
    """1 if a single confusion makes the token of the word, 0.5 if their skeletons agree."""
    for a, b in CONFUSIONS:
        if a not in word or b not in token or len(word) - len(a) != len(token) - len(b):
            continue
        i = word.find(a)
        while i >= 0:
            if token[:i] == word[:i] and token.startswith(b, i) and token[i + len(b) :] == word[i + len(a) :]:
                return 1.0
            i = word.find(a, i + 1)
    return 0.5 if fold(token) == fold(word) else 0.0


def word_features(token: str, word: str, n: int, shared: int, distance: int, rivals: int) -> list[float]:
    e = explained(token, word)
    return [e, distance, np.log1p(n), len(token), shared / (len(token) + 1), rivals, float(any(c.isdigit() for c in token)), float(token[:1] == word[:1]), len(word) - len(token)]


def reach(n: int) -> int:
    """Most edits between a token of that length and its correction."""
    return 1 if n <= 3 else 2


def prefixes(df: DataFrame, frequent: dict[str, int], rank_all: bool) -> DataFrame:
    """(word, size, gram, place) of the bigrams that suffice to meet every word within reach: the 2 k + 1 rarest.

    An edit destroys at most two bigrams, so two words within k edits share one of the 2 k + 1 first of each in any order
    of all bigrams; rare ones come first here. A word of the lexicon may be asked for with the reach of a longer token.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for w in b["word"]:
                p = f"#{w}#"
                grams = sorted((frequent.get(p[i : i + 2], 0), p[i : i + 2], i) for i in range(len(p) - 1))
                rows += [(w, len(w), g, i) for _, g, i in grams[: 2 * reach(len(w) + rank_all) + 1]]
            yield pd.DataFrame(rows, columns=["word", "size", "gram", "place"])

    return df.select("word").mapInPandas(cut, "word string, size int, gram string, place int")


def candidates(tokens: DataFrame, lexicon: DataFrame) -> DataFrame:
    """(token, word, n, shared, distance, rivals) by an inverted join on the rarest bigrams, then verified.

    tokens: (token), distinct. shared is the number of rare bigrams in common.
    """
    words = lexicon.filter("kind = 'w' and length(a) > 1 and not a rlike '[0-9]'").select(F.col("a").alias("word"), "n")
    grams = words.select(F.explode(F.transform(F.sequence(F.lit(1), F.length("word") + 1), lambda i: F.substring(F.concat(F.lit("#"), "word", F.lit("#")), i, F.lit(2)))).alias("g"))
    top = grams.groupBy("g").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "g").limit(FREQUENT).collect()
    frequent = {r["g"]: r["n"] for r in top}
    left = prefixes(tokens.select(F.col("token").alias("word")), frequent, False).select(F.col("word").alias("token"), F.col("size").alias("size_t"), "gram", F.col("place").alias("place_t"))
    right = prefixes(words, frequent, True)
    most = F.when(F.col("size_t") <= 3, 1).otherwise(2)
    near = (
        left.join(right, "gram")
        .filter((F.abs(F.col("size") - F.col("size_t")) <= most) & (F.abs(F.col("place") - F.col("place_t")) <= most) & (F.col("token") != F.col("word")))
        .groupBy("token", "word", "size_t").agg(F.count("*").alias("shared"))
        .withColumn("distance", F.levenshtein("token", "word", 2))
        .filter((F.col("distance") > 0) & (F.col("distance") <= most))
        .join(words, "word")
    )
    rivals = near.groupBy("token").agg(F.count("*").alias("rivals"))
    return near.join(rivals, "token").select("token", "word", "n", "shared", "distance", "rivals")


WORD = ["token", "word", "n", "shared", "distance", "rivals"]


def unknown_tokens(seen: DataFrame, lexicon: DataFrame, kind: str) -> DataFrame:
    """(token) of that kind that the lexicon has not."""
    known = lexicon.filter(F.col("kind") == kind).select(F.col("a").alias("token"))
    return seen.filter(F.col("kind") == kind).select(F.col("a").alias("token")).distinct().join(known, "token", "left_anti")


def word_corrections(seen: DataFrame, lexicon: DataFrame, rare: float = 1.0) -> DataFrame:
    """(kind, a, new): the replacement of each unknown word or number that has one, the best-ranked.

    The words that the ranker is trained on go through the same join as the unknown ones.
    """
    spark = seen.sparkSession
    words = lexicon.filter("kind = 'w'")
    sample = sample_of(words.filter("length(a) > 1 and not a rlike '[0-9]'").filter(F.col("n") >= 3 * rare), ["a"])["a"].tolist()
    truth = {t: w for i, w in enumerate(sample) if i % 3 < 2 and (t := corrupt(w)) and t != w}
    valid = set(sample[2::3])  # words that happen to be unknown: no candidate of theirs is right
    made = spark.createDataFrame([(t,) for t in {*truth, *valid}] or [("",)], "token string")
    both = unknown_tokens(seen, lexicon, "w").withColumn("real", F.lit(True)).union(made.withColumn("real", F.lit(False)))
    asked = checkpointed(both.groupBy("token").agg(F.max("real").alias("real"), F.min("real").alias("only")))
    found = checkpointed(candidates(asked.select("token"), lexicon))
    t = sample_of(found.join(F.broadcast(made), "token", "left_semi"), WORD, TRAIN_CANDIDATES)
    x = lambda d: np.array([word_features(*r) for r in zip(*(d[c] for c in WORD))], dtype=float).reshape(len(d), 9)
    # numbers: letters for digits, as the unscanned sources write hardly any
    digits = [str(10 + zlib.crc32(w.encode()) % 10 ** (2 + len(w) % 4)) for w in sample[: TRAIN // 8]]
    numbers = [(d.replace("1", "l").replace("0", "O"), d) for d in digits if "1" in d or "0" in d]
    names = [(w, w.translate(_DIGIT)) for w in sample if w.translate(_DIGIT) != w]
    own = pd.DataFrame([(a, b, 0, 0, sum(p != q for p, q in zip(a, b)), 1) for a, b in [*numbers, *names]], columns=WORD)
    y = [float(truth.get(k) == w) for k, w in zip(t["token"], t["word"])] + [1.0] * len(numbers) + [0.0] * len(names)
    model = Boosted(np.vstack([x(t), x(own)]), np.array(y))

    @F.pandas_udf("double")
    def likely(token: pd.Series, word: pd.Series, n: pd.Series, shared: pd.Series, distance: pd.Series, rivals: pd.Series) -> pd.Series:
        return pd.Series(model.probability(x(pd.DataFrame(dict(zip(WORD, (token, word, n, shared, distance, rivals)))))))

    real = found.join(asked.filter("real").select("token"), "token", "left_semi").withColumn("kind", F.lit("w"))
    mixed = unknown_tokens(seen, lexicon, "n").withColumn("word", F.translate("token", "lIO", "110"))
    mixed = mixed.withColumn("distance", F.levenshtein("token", "word")).select("token", "word", *[F.lit(0).cast("bigint").alias(c) for c in ("n", "shared")], "distance", F.lit(1).cast("bigint").alias("rivals"), F.lit("n").alias("kind"))
    ranked = real.select(*WORD, "kind").union(mixed).withColumn("p", likely(*WORD)).filter("p > 0.5")
    return ranked.groupBy("kind", F.col("token").alias("a")).agg(F.max(F.struct("p", "n", "word")).alias("m")).select("kind", "a", F.col("m.word").alias("new"))


GAP = ["token", "char", "n_tri", "n_old", "n_new", "n_left", "n_right", "rivals"]


def gap_candidates(tokens: DataFrame, tri: DataFrame) -> DataFrame:
    """Characters known between the neighbours of an unknown one, by an inverted join on the pair of neighbours."""
    mid = lambda c: F.substring(c, 2, 1)
    uni = small_side(tri.groupBy(mid("a").alias("u")).agg(F.sum("n").alias("k")))  # at most one row a character
    two = tri.groupBy(F.substring("a", 1, 2).alias("u")).agg(F.sum("n").alias("k"))
    two_r = tri.groupBy(F.substring("a", 2, 2).alias("u")).agg(F.sum("n").alias("k"))
    sides = lambda c: F.concat(F.substring(c, 1, 1), F.substring(c, 3, 1))
    asked = tokens
    for name, key, side in (("n_left", F.substring("token", 1, 2), two), ("n_right", F.substring("token", 2, 2), two_r), ("n_old", mid("token"), uni)):
        asked = asked.join(side.select(F.col("u").alias("_u"), F.col("k").alias(name)), key == F.col("_u"), "left").drop("_u").fillna(0, [name])
    near = asked.withColumn("s", sides("token")).join(tri.select(sides("a").alias("s"), mid("a").alias("char"), F.col("n").alias("n_tri")), "s").filter(mid("token") != F.col("char"))
    near = near.join(uni.select(F.col("u").alias("char"), F.col("k").alias("n_new")), "char", "left").fillna(0, ["n_new"])
    rivals = near.groupBy("token").agg(F.count("*").alias("rivals"))
    return near.join(rivals, "token").select(*GAP)


def gap_corrections(seen: DataFrame, lexicon: DataFrame) -> DataFrame:
    """(kind, a, new): the replacement of the middle character of each unknown trigram that has one."""
    spark = seen.sparkSession
    tri = lexicon.filter("kind = 't'").select("a", "n")
    least = tri.agg(F.min("n")).first()[0] or 1  # more than 1 where all texts are repeated under other keys
    common = sample_of(tri.filter(F.col("n") >= 5 * least), ["a"])["a"].tolist()
    rare = sample_of(tri.filter(F.col("n") == least), ["a"])["a"].tolist()
    others = [t[1] for t in rare] or ["一"]
    truth = {}
    for i, t in enumerate(common):
        h = zlib.crc32(t.encode())
        c = chr(0x4E00 + h % 0x51A6) if i % 2 else others[h % len(others)]
        if _HAN.match(t[1]) and c != t[1]:
            truth[t[0] + c + t[2]] = t[1]
    made = spark.createDataFrame([(t,) for t in {*truth, *rare}] or [("   ",)], "token string")
    both = unknown_tokens(seen, lexicon, "t").withColumn("real", F.lit(True)).union(made.withColumn("real", F.lit(False)))
    asked = checkpointed(both.groupBy("token").agg(F.max("real").alias("real")))
    found = checkpointed(gap_candidates(asked.select("token"), tri))
    x = lambda d: np.log1p(np.maximum(np.array(d[GAP[2:]], dtype=float), 0)).reshape(len(d), len(GAP) - 2)
    t = sample_of(found.join(F.broadcast(made), "token", "left_semi"), GAP, TRAIN_CANDIDATES)
    left_out = ["n_old", "n_left", "n_right"]
    t.loc[~t["token"].isin(list(truth)), left_out] -= least  # a rare trigram counts as if it weren't in the lexicon
    model = Boosted(x(t), np.array([float(truth.get(k) == c) for k, c in zip(t["token"], t["char"])]))

    @F.pandas_udf("double")
    def likely(n_tri: pd.Series, n_old: pd.Series, n_new: pd.Series, n_left: pd.Series, n_right: pd.Series, rivals: pd.Series) -> pd.Series:
        return pd.Series(model.probability(x(pd.DataFrame(dict(zip(GAP[2:], (n_tri, n_old, n_new, n_left, n_right, rivals)))))))

    real = found.join(asked.filter("real").select("token"), "token", "left_semi")
    ranked = real.withColumn("p", likely(*GAP[2:])).filter(F.col("p") > SURE_GAP)
    return ranked.groupBy(F.col("token").alias("a")).agg(F.max(F.struct("p", "n_tri", "char")).alias("m")).select(F.lit("t").alias("kind"), "a", F.col("m.char").alias("new"))


def scanned_text(blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(text blocks of scanned sources, of the others)."""
    scanned = small_side(blocks.filter("metadata.is_ocr").select("source").distinct())
    text = spread(blocks.filter("type = 'text' and content_text is not null"))
    return text.join(scanned, "source", "left_semi"), text.join(scanned, "source", "left_anti")


def issues(blocks: DataFrame) -> dict[str, DataFrame]:
    """Furniture lines, broken words and misread characters of the scanned blocks, each with its place."""
    spark = blocks.sparkSession
    ours, others = scanned_text(blocks)
    y0, y1 = F.get("bbox", F.lit(1)), F.get("bbox", F.lit(3))
    # a margin is what lies beyond the blocks of several lines, in each source, but for a few of very many
    body = small_side(ours.filter(F.size(F.split("content_text", "\n")) >= 3).groupBy("source").agg(F.percentile_approx(y0, BEYOND).alias("top"), F.percentile_approx(y1, 1 - BEYOND).alias("bottom")))
    zone = F.when(y0.isNull() | y1.isNull(), -1).when((y1 <= F.col("top")) | (y0 >= F.col("bottom")), 1).otherwise(0)
    ours = ours.join(body, "source", "left").select("source", "block_id", "page", "ord", zone.alias("zone"), "content_text").filter("page is not null")
    seen = checkpointed(ours.select("source", "page", "zone", "content_text").mapInPandas(observe, SEEN))
    lexicon = checkpointed(others.select("content_text").mapInPandas(count_lexicon, "kind string, a string, n bigint").groupBy("kind", "a").agg(F.sum("n").alias("n")))
    again = checkpointed(recurring(seen))
    rare = times(lexicon)
    breaks = checkpointed(broken_words(seen, lexicon, rare))
    fixes = checkpointed(word_corrections(seen, lexicon, rare).union(gap_corrections(seen, lexicon)))
    keys = (
        breaks.select(F.concat_ws("\x1f", F.lit("h"), "a", "b", "c").alias("k"))
        .union(fixes.select(F.concat_ws("\x1f", "kind", "a")))
        .union(again.select(F.concat_ws("\x1f", F.lit("P"), "source", F.col("part").cast("string"))))
    )
    places = checkpointed(locate(spark, ours, filter_bits(keys)).distinct())
    head = checkpointed(furniture(places, again))
    inside = lambda df: df.join(head, ["source", "block_id", "line"], "left_anti")
    at = ["source", "block_id", "line"]
    hyphens = places.filter("kind = 'h'").join(breaks, ["a", "b", "c"], "left_semi").select(*at, F.col("a").alias("left"), F.col("c").alias("right"))
    chars = places.filter("kind in ('w', 'n', 't')").join(fixes, ["kind", "a"]).select(*at, "kind", "start", F.col("b").alias("old"), "new")
    return {"furniture": head, "hyphen": inside(hyphens), "chars": inside(chars)}


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each scanned block and issue."""
    found = issues(table(spark, sf_dir, "page_blocks"))
    parts = [df.select("source", "block_id", F.lit(name).alias("issue")) for name, df in found.items()]
    return parts[0].union(parts[1]).union(parts[2]).distinct()


def cased(new: str, old: str) -> str:
    """A lower-case word in the case of what it replaces."""
    if old.isupper() and len(old) > 1:
        return new.upper()
    return new[:1].upper() + new[1:] if old[:1].isupper() else new


def repair(text: str, out: list, breaks: list, changes: list) -> str:
    """A block without its furniture lines, its broken words joined and misread characters replaced, as paragraphs.

    Each change is made at its own line and place; one with a start of -1 is of a word that a line end breaks.
    """
    lines, skip = lines_of(text), set(out or ())
    joins = {(b["line"], b["left"], b["right"]) for b in breaks or ()}
    broken: dict[int, tuple[str, str]] = {}
    for c in sorted(changes or (), key=lambda c: -c["start"]):
        i, at, old = c["line"], c["start"], c["old"]
        new = cased(c["new"], old) if c["kind"] == "w" else c["new"]
        if at < 0:
            broken[i] = old, new
        elif lines[i][at : at + len(old)] == old:
            lines[i] = lines[i][:at] + new + lines[i][at + len(old) :]
    whole, before = "", -1
    for i, line in enumerate(lines):
        if i in skip:
            continue
        line = line.strip()
        m = _BREAK.search(whole)
        start = _START.match(line)
        if m and start and any(k == before and l == m[1] and r == start[1] for k, l, r in joins):
            old, new = broken.get(before, ("", ""))
            joined = m[1] + start[1]
            whole = whole[: m.start(1)] + (new if joined == old else joined) + line[start.end() :]
        elif whole and _HAN.match(whole[-1]) and _HAN.match(line):
            whole += line
        else:
            whole += (" " if whole else "") + line
        before = i
    return whole


def p2_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text block of a scanned source with its repaired text; empty where it was all furniture."""
    blocks = table(spark, sf_dir, "page_blocks")
    found = issues(blocks)
    key = ["source", "block_id"]
    fixes = (
        found["furniture"].groupBy(*key).agg(F.sort_array(F.collect_set("line")).alias("furniture"))
        .join(found["hyphen"].groupBy(*key).agg(F.collect_set(F.struct("line", "left", "right")).alias("breaks")), key, "full")
        .join(found["chars"].groupBy(*key).agg(F.sort_array(F.collect_set(F.struct("line", "start", "kind", "old", "new"))).alias("changes")), key, "full")
    )

    @F.pandas_udf("string")
    def repaired(t: pd.Series, f: pd.Series, b: pd.Series, c: pd.Series) -> pd.Series:
        none = lambda v: [] if v is None else list(v)
        return pd.Series([repair(x, none(y), none(z), none(w)) for x, y, z, w in zip(t, f, b, c)])

    ours = scanned_text(blocks)[0].select(*key, "content_text").dropDuplicates(key)
    return ours.join(fixes, key, "left").select(*key, repaired("content_text", "furniture", "breaks", "changes").alias("repaired"))
