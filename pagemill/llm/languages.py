"""p10: a language with a confidence for every document and for every passage in another language.

Method: hierarchical discrimination. The script and its letters predict the language family first; within a family that
holds several languages, one-versus-one linear support vector machines over character n-grams tell them apart. A family
of one known language has no machine: its confidence falls with the share of letters that the language's texts lack, so
that Ukrainian, Persian or traditional ideographs come out as doubtful Russian, Arabic or Chinese.

Machines and alphabets are trained on a bounded sample of documents whose label names the language (SAMPLE per spelling
of the label, of at most SAMPLE_CHARS characters: longer ones are no sample, no text is cut); passages whose function
words contradict the label are left out. Documents are cut into lines and sentences;
neighbouring passages of one language are joined. Null, empty and letterless documents have the language "und" with
confidence 0. Texts are scored whole, whatever their length.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagemill.llm.tables import code_points
from pagemill.session import spread, table

#: Documents per language label that the machines are trained on, the lowest by hash, and the length of the longest.
SAMPLE, SAMPLE_CHARS = 40, 20_000
#: How fast the confidence of a family's only language falls with the share of letters that it lacks.
STRANGE = 8.0
#: Most function words; more are refused.
MAX_COMMON = 1_000_000
BUCKETS = 1 << 15
#: A language counts from so many characters and so large a share of the document, white space left out.
MIN_CHARS, MIN_SHARE = 100, 0.05

# Languages of each family that this operator knows, by ISO 639-1 code.
FAMILIES = {
    "latin": ["en", "de", "fr", "es", "pt", "it", "nl"],
    "cyrillic": ["ru"],
    "han": ["zh"],
    "kana": ["ja"],
    "hangul": ["ko"],
    "arabic": ["ar"],
    "devanagari": ["hi"],
    "thai": ["th"],
}
# Other spellings of the codes (ISO 639-2 and English names).
NAMES = {
    "en": ["eng", "english"], "de": ["deu", "ger", "german"], "fr": ["fra", "fre", "french"], "es": ["spa", "spanish", "castilian"],
    "pt": ["por", "portuguese"], "it": ["ita", "italian"], "nl": ["nld", "dut", "dutch"], "ru": ["rus", "russian"],
    "zh": ["zho", "chi", "cmn", "chinese", "mandarin"], "ja": ["jpn", "japanese"], "ko": ["kor", "korean"], "ar": ["ara", "arabic"],
    "hi": ["hin", "hindi"], "th": ["tha", "thai"],
}
CODE_OF = {n: code for code, names in NAMES.items() for n in [code, *names]}

SCRIPTS = [
    ("kana", regex.compile(r"[\p{Hiragana}\p{Katakana}ー]")),
    ("han", regex.compile(r"\p{Han}")),
    ("hangul", regex.compile(r"\p{Hangul}")),
    ("thai", regex.compile(r"\p{Thai}")),
    ("arabic", regex.compile(r"\p{Arabic}")),
    ("devanagari", regex.compile(r"\p{Devanagari}")),
    ("cyrillic", regex.compile(r"\p{Cyrillic}")),
    ("latin", regex.compile(r"\p{Latin}")),
]
_LETTER = np.zeros(0x110000, dtype=np.uint8)  # index of the script from 1, 0 for all else; filled on first use
_END = re.compile(r"[.!?…؟।][\"'”’»)\]]*(?=\s)|[。！？][”’」』）]*|\n")
_LOWER = np.full(0x110000, 32, dtype=np.uint32)
_SOLID = np.ones(0x110000, dtype=bool)
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?")


def script_table() -> np.ndarray:
    if not _LETTER[ord("a")]:
        _LETTER[:] = code_points(lambda c: next((k for k, (_, p) in enumerate(SCRIPTS, 1) if c != "・" and p.match(c)), 0), np.uint8)
        _LOWER[:] = code_points(lambda c: ord(c.lower()[0]) if c.isalpha() else 32, np.uint32)
        _SOLID[:] = code_points(lambda c: not c.isspace())
    return _LETTER


def code(label: str | None) -> str | None:
    """The ISO 639-1 code that a label names, or None: case, region and other spellings don't matter."""
    return CODE_OF.get(re.split(r"[-_]", label.strip().lower())[0]) if label else None


def letters_only(points: np.ndarray) -> np.ndarray:
    """Lower-case code points with a space for whatever is no letter."""
    return _LOWER[points]


def grams(p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the two and of the three characters that end at each place; the first places have none of them."""
    p = p.astype(np.uint32)
    with np.errstate(over="ignore"):
        two = p[:-1] * np.uint32(0x9E3779B1) + p[1:]
        three = two[:-1] * np.uint32(0x85EBCA6B) + p[2:]
        mix = lambda h: ((h * np.uint32(0xC2B2AE35)) >> np.uint32(17)).astype(np.int64)
        return mix(two), mix(three)


def vector(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values of the unit vector of a passage."""
    two, three = grams(letters_only(points_of(" " + text + " ")))
    at, n = np.unique(np.concatenate([two, three]), return_counts=True)
    return at, n / np.linalg.norm(n)


def points_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def svm(x: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, epochs: int = 4, reg: float = 1e-4, seed: int = 0) -> np.ndarray:
    """Weights of a linear support vector machine by averaged subgradient steps on the hinge loss."""
    u, scale, total, t, order = np.zeros(BUCKETS), 1.0, np.zeros(BUCKETS), 0, np.random.default_rng(seed)
    for _ in range(epochs):
        for i in order.permutation(len(x)):
            t += 1
            at, v = x[i]
            rate = 1 / (reg * (t + 1 / reg / 2))
            margin = y[i] * scale * (u[at] @ v)
            scale *= 1 - rate * reg
            if margin < 1:
                u[at] += rate * y[i] / scale * v
        total += scale * u
    return (total / epochs).astype(np.float32)


class Model:
    """One machine for each pair of languages within a family."""

    def __init__(self, samples: dict[str, list[str]], common: dict[str, set[str]]):
        script_table()
        self.common = common
        self.machines: dict[str, tuple[list[tuple[str, str]], np.ndarray]] = {}
        self.alphabets: dict[str, np.ndarray] = {}
        for name, family in FAMILIES.items():
            if len(family) == 1:
                used = np.zeros(0x110000, dtype=bool)
                for t in samples.get(family[0], []):
                    used[_LOWER[points_of(t)]] = True
                if used.any():
                    self.alphabets[name] = used
                continue
            x = {c: [vector(p) for t in samples.get(c, []) for p in self.sure_passages(t, c)] for c in family}
            pairs = [(a, b) for a, b in combinations(family, 2) if x[a] and x[b]]
            if pairs:
                w = [svm([*x[a], *x[b]], np.array([1.0] * len(x[a]) + [-1.0] * len(x[b]))) for a, b in pairs]
                self.machines[name] = pairs, np.ascontiguousarray(np.stack(w, axis=1))

    def sure_passages(self, text: str, language: str) -> Iterator[str]:
        """The passages of a labelled text that no other language's function words claim."""
        rivals = [c for family in FAMILIES.values() if language in family for c in family]
        at = 0
        for m in [*_END.finditer(text), None]:
            end = m.end() if m else len(text)
            words, passage, at = _WORD.findall(text[at:end].lower()), text[at:end], end
            votes = {c: sum(w in self.common.get(c, ()) for w in words) for c in rivals}
            if len(words) >= 5 and votes[language] > 1 and votes[language] >= max(votes.values()):
                yield passage

    def within(self, family: str, sums: np.ndarray, n: np.ndarray) -> list[tuple[str, float]]:
        """The language with most pairwise wins for each row of summed margins, ties by margin, and a confidence."""
        languages = FAMILIES[family]
        a = np.array([[c == p[0] for c in languages] for p in self.machines[family][0]], dtype=np.float32)
        b = np.array([[c == p[1] for c in languages] for p in self.machines[family][0]], dtype=np.float32)
        m = sums / np.sqrt(np.maximum(n, 1))[:, None]
        wins = (m > 0) @ a + (m <= 0) @ b + np.clip(m, -1, 1) @ (a - b) / 100
        least = np.where((a + b)[None] > 0, m[:, :, None] * (a - b)[None], np.inf).min(1)
        best = wins.argmax(1)
        sure = 1 / (1 + np.exp(-2 * np.clip(least[np.arange(len(n)), best], -20, 20)))
        return [(languages[c], s) for c, s in zip(best.tolist(), sure.tolist())]


def families_of(counts: np.ndarray) -> list[str | None]:
    """The family of each passage from its letters by script: a few kana among ideographs make it Japanese."""
    names = [name for name, _ in SCRIPTS]
    kana, han = names.index("kana"), names.index("han")
    by = counts[:, 1:].astype(np.int64)
    east = by[:, kana] + by[:, han]
    japanese = (by[:, kana] * 8 >= east) & (east > 0)
    by[:, kana], by[:, han] = np.where(japanese, east, 0), np.where(japanese, 0, east)
    # an ideograph or syllable says as much as three letters
    by *= np.array([3 if n in ("kana", "han", "hangul") else 1 for n in names])
    best, some = by.argmax(1).tolist(), by.any(1).tolist()
    return [names[k] if s else None for k, s in zip(best, some)]


def passages(text: str, model: Model) -> list[list]:
    """[start, end, language, confidence, characters]: passages of one language, in order, covering all letters."""
    points = points_of(text)
    scripts = script_table()[points]
    solid = np.zeros(len(points) + 1, dtype=np.int64)
    np.cumsum(_SOLID[points], out=solid[1:])
    width = len(SCRIPTS) + 1
    ends = np.array([m.end() for m in _END.finditer(text)] + [len(text)])
    ends = ends[np.concatenate([[True], np.diff(ends) > 0])]

    def counted(ends: np.ndarray) -> np.ndarray:
        which = np.repeat(np.arange(0, len(ends) * width, width), np.diff(ends, prepend=0))
        which += scripts
        return np.bincount(which, minlength=len(ends) * width).reshape(-1, width)

    counts = counted(ends)
    mixed = np.flatnonzero((counts[:, -1] >= 40) & (counts[:, 1:-1].sum(1) >= 12))
    if len(mixed):
        cuts = [e for k in mixed for _, e in by_script(scripts, int(ends[k - 1]) if k else 0, int(ends[k]))]
        ends = np.unique(np.concatenate([ends, np.array(cuts, dtype=ends.dtype)]))
        counts = counted(ends)
    families = families_of(counts)
    found: dict[int, tuple[str, float]] = {}
    for family, (pairs, w) in model.machines.items():
        rows = [k for k, f in enumerate(families) if f == family]
        if rows:
            two, three = grams(letters_only(points))
            starts = np.concatenate([[0], ends[:-1]])
            if len(three):
                scores = np.take(w, two, axis=0)
                scores[1:] += np.take(w, three, axis=0)
                sums = np.add.reduceat(scores, np.minimum(starts, len(scores) - 1), axis=0)[rows]
            else:
                sums = np.zeros((len(rows), len(pairs)), dtype=np.float32)
            found |= dict(zip(rows, model.within(family, sums, (ends - starts)[rows])))
    for family in {f for f in families if f in model.alphabets}:
        rows = np.array([k for k, f in enumerate(families) if f == family])
        letters = scripts > 0
        sums = np.zeros((2, len(points) + 1), dtype=np.int64)
        np.cumsum(letters, out=sums[0, 1:])
        np.cumsum(letters & ~model.alphabets[family][_LOWER[points]], out=sums[1, 1:])
        starts = np.concatenate([[0], ends[:-1]])
        n, odd = sums[:, ends[rows]] - sums[:, starts[rows]]
        sure = 0.99 * np.exp(-STRANGE * odd / np.maximum(n, 1))
        found |= {k: (FAMILIES[family][0], s) for k, s in zip(rows.tolist(), sure.tolist())}
    out: list[list] = []
    start = 0
    for k, (end, family) in enumerate(zip(ends.tolist(), families)):
        size = int(solid[end] - solid[start])
        last = out[-1] if out else None
        language, sure = (None, 0.0) if family is None else found.get(k) or (FAMILIES[family][0], 0.5 if len(FAMILIES[family]) == 1 else 0.3)
        if last and (
            language is None
            or len(FAMILIES[family]) > 1 and last[2] in FAMILIES[family] and (size < 45 and sure < 0.97 or size < 80 and sure < 0.8)
            or family == "han" and size < 16 and last[2] == "ja"
        ):
            language, sure = last[2], last[3]
        if last and last[2] == language:
            total = last[4] + size
            last[1], last[3], last[4] = end, (last[3] * last[4] + sure * size) / max(total, 1), total
        elif language is not None:
            out.append([start, end, language, sure, size])
        start = end
    return out


def by_script(scripts: np.ndarray, a: int, b: int) -> list[tuple[int, int]]:
    """Parts of a passage whose letters change between Latin and another script for at least MIN_RUN letters."""
    at = a + np.flatnonzero(scripts[a:b])
    if not len(at):
        return [(a, b)] if b > a else []
    latin = scripts[at] == len(SCRIPTS)
    if latin.all() or not latin.any():
        return [(a, b)]
    edges = np.flatnonzero(np.diff(latin)) + 1
    runs = np.split(np.arange(len(at)), edges)
    cuts, last = [], None
    for r in runs:
        long = len(r) >= (40 if latin[r[0]] else 12)
        if long and last is not None and latin[r[0]] != last:
            cuts.append(int(at[r[0]]))
        if long:
            last = latin[r[0]]
    edges = [a, *cuts, b]
    return list(zip(edges, edges[1:]))


def samples(docs: DataFrame) -> dict[str, list[str]]:
    """A bounded sample of documents by the language that their label names.

    The rank limit is applied before the shuffle, so a label on a third of all rows moves no more than any other.
    """
    wanted = [n for family in FAMILIES.values() for c in family for n in [c, *NAMES[c]]]
    label = F.lower(F.trim(F.split("lang", "[-_]")[0]))
    rank = F.row_number().over(Window.partitionBy("label").orderBy("h", "doc_id"))
    rows = (
        docs.select("doc_id", label.alias("label"), F.xxhash64("doc_id", "text").alias("h"), F.col("text").alias("t"))
        .filter(F.col("label").isin(wanted) & (F.length("t") <= SAMPLE_CHARS))
        .withColumn("rank", rank)
        .filter(F.col("rank") <= SAMPLE)
        .select("label", "t")
    )
    out: dict[str, list[str]] = defaultdict(list)
    for r in rows.collect():
        out[CODE_OF[r["label"]]].append(r["t"])
    return {c: sorted(t)[: 2 * SAMPLE] for c, t in out.items()}


def trained(spark: SparkSession, sf_dir: str) -> Model:
    common: dict[str, set[str]] = defaultdict(set)
    words = table(spark, sf_dir, "common_words").filter("word is not null").select("lang", "word").distinct()
    if (n := words.count()) > MAX_COMMON:
        raise ValueError(f"{n} function words, more than {MAX_COMMON}")
    for r in words.collect():
        common[r["lang"]].add(r["word"].lower())
    return Model(samples(table(spark, sf_dir, "documents")), common)


PASSAGES = "array<struct<start_pos:int,end_pos:int,lang:string,confidence:double,n_chars:int>>"


def identified(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang, main, confidence, n_chars, sizes, passages) of every document; lang is the label it came with and
    sizes are the characters of each language."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for b in batches:
            rows = []
            for doc_id, label, text in zip(b["doc_id"], b["lang"], b["text"]):
                found = passages(text, m) if text else []
                sizes: dict[str, float] = defaultdict(int)
                sure: dict[str, float] = defaultdict(float)
                for _, _, c, s, n in found:
                    sizes[c] += n
                    sure[c] += s * n
                main = max(sorted(sizes), key=sizes.get) if sizes else "und"
                total = sum(sizes.values())
                parts = [dict(zip(("start_pos", "end_pos", "lang", "confidence", "n_chars"), p)) for p in found]
                rows.append((doc_id, label, main, sure[main] / max(sizes[main], 1) if sizes else 0.0, total, [{"lang": c, "n": n} for c, n in sizes.items()], parts))
            yield pd.DataFrame(rows, columns=["doc_id", "lang", "main", "confidence", "n_chars", "sizes", "passages"])

    schema = f"doc_id bigint, lang string, main string, confidence double, n_chars int, sizes array<struct<lang:string,n:int>>, passages {PASSAGES}"
    return spread(docs.select("doc_id", "lang", "text")).mapInPandas(scan, schema)


def p10_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its language and confidence."""
    found = identified(table(spark, sf_dir, "documents"), trained(spark, sf_dir))
    return found.select("doc_id", F.col("main").alias("lang"), F.round("confidence", 4).alias("confidence"), "n_chars")


def p10_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every passage of every document with its language and confidence."""
    found = identified(table(spark, sf_dir, "documents"), trained(spark, sf_dir))
    return found.select("doc_id", F.inline("passages"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose label is missing or wrong, and the languages of those in several."""
    found = identified(table(spark, sf_dir, "documents"), trained(spark, sf_dir))
    named = F.create_map([F.lit(x) for pair in CODE_OF.items() for x in pair])
    label = named[F.lower(F.trim(F.split("lang", "[-_]")[0]))]
    wrong = (F.col("main") != "und") & (label.isNull() | (label != F.col("main")))
    large = F.filter("sizes", lambda x: (x["n"] >= MIN_CHARS) & (x["n"] >= MIN_SHARE * F.col("n_chars")))
    issue = lambda name, lang: F.struct(F.lit(name).alias("issue"), lang.alias("lang"))
    # both kinds from one pass over the texts
    each = F.concat(
        F.when(wrong, F.array(issue("label", F.col("main")))).otherwise(F.array().cast("array<struct<issue:string,lang:string>>")),
        F.when(F.size(large) > 1, F.transform(large, lambda x: issue("mixed", x["lang"]))).otherwise(F.array().cast("array<struct<issue:string,lang:string>>")),
    )
    return found.select("doc_id", F.inline(each)).distinct()
