"""p6: one consistent form for text that looks the same.

Method: tries of the vocabulary are traversed with a weighted edit automaton in which look-alikes of any script, case,
compatibility forms and ignorable characters cost nothing and every other edit 1; a suspect token that reaches a word at
no more than MAX_COST takes that canonical spelling, letter by letter in its own case. What no trie has is normalised by
table. Words compete by the script of the text around the token first and by how often they occur second.

The vocabulary is that of all texts of both tables. It is cut into shards by the first letters, look-alikes as one; each
shard with suspect tokens gets a trie in a task of its own, so neither the driver nor any task holds the vocabulary. The
distinct tokens with their new spellings are broadcast up to a measured size and joined with their rows beyond it.

Null and empty texts stay as they are. An ideographic space beside ideographs, kana or their punctuation is the space of
that writing and is kept; between other letters it is a look-alike. Full-width punctuation, typographic quotes and dashes, circled numbers,
superscripts, formula letters, and joiners that an emoji or an Indic spelling needs are kept.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.llm import encoding
from pagemill.llm.tables import code_points
from pagemill.session import checkpointed, small_side, spread, table

#: Cost up to which a spelling counts as the same: look-alikes and ignorables only.
MAX_COST = 0
#: First letters, look-alikes as one, by which vocabulary and tokens are cut into shards.
SHARD_LETTERS = 2
#: Bytes up to which the spellings of tokens are broadcast.
BROADCAST_BYTES = 32 << 20

# Letters of Cyrillic and Greek that look like Latin ones.
CYRILLIC = dict(zip("АВЕЅІЈКМНОРСТХҮаеѕіјорсухһԁԛԝӏ", "ABESIJKMHOPCTXYaesijopcyxhdqwl"))
GREEK = dict(zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧοινρυκαχγ", "ABEZHIKMNOPTYXoivpukaxy"))
LATIN_OF = CYRILLIC | GREEK
CYRILLIC_OF = {b: a for a, b in CYRILLIC.items() if a not in "Үһԁԛԝӏ"}
#: Invisible characters that no spelling needs, and the joiners that some do.
INVISIBLE = "­͏؜ᅟᅠ឴឵᠎​‎‏‪-‮⁠-⁤⁦-⁯﻿ㅤﾠ"
JOINERS = "‌‍"
SPACES = "   -   　"
HYPHENS = "‐‑‒–−﹣－­⁃"
WIDE = "０-９Ａ-Ｚａ-ｚ"
HALF_KANA = "ｦ-ﾟ"
LIGATURES = "ﬀ-ﬆﬓ-ﬗĲĳǄ-ǌǱ-ǳ"
RADICALS = "⺀-⺙⺛-⻳⼀-⿕"
JAMO = "ᄀ-ᇿꥠ-꥿ힰ-퟿"

#: What a text must hold for there to be anything to do.
SUSPECT = regex.compile(f"[{INVISIBLE}{JOINERS}{SPACES}{HYPHENS}{WIDE}{HALF_KANA}{LIGATURES}{RADICALS}{JAMO}\\p{{M}}\\p{{Greek}}\\p{{Cyrillic}}]")
_SUSPECT: np.ndarray | None = None

_TABLE = re.compile(f"[{WIDE}{HALF_KANA}{LIGATURES}{RADICALS}]+")
_INVISIBLE = re.compile(f"[{INVISIBLE}]")
_JOINER = re.compile(f"[{JOINERS}]")
_EAST = "\u2e80-\u2fff\u3001-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff00-\uffef\u201c\u201d"
_SPACE = re.compile(f"[{SPACES[:-1]}]|(?<![{_EAST}\u3000])\u3000+(?![{_EAST}\u3000])")
_CODE = re.compile(f"(?<![^\\W_])([A-ZＡ-Ｚ]{{1,5}})[{HYPHENS}](?=[0-9０-９]{{2,}})")
_MARKED = regex.compile(r"[^\W\d_]\p{M}+|[\u1100-\u11ff]{2,}")
#: Ranges of code points without Latin, Cyrillic and Greek.
OTHER_SCRIPTS = [("\u0590", "\u1c7f"), ("\u2e80", "\ua63f"), ("\uac00", "\ufaff")]
#: Runs of letters of the scripts that share shapes, with what may be hidden in them.
_TOKEN = regex.compile(rf"[\p{{Latin}}\p{{Cyrillic}}\p{{Greek}}\p{{M}}{INVISIBLE}{JOINERS}]+")
_GREEK, _CYRILLIC, _LATIN = (regex.compile(rf"\p{{{x}}}") for x in ("Greek", "Cyrillic", "Latin"))
_FOREIGN = regex.compile(r"[\p{Greek}\p{Cyrillic}]")
_PLAIN = regex.compile(r"\p{Latin}+|\p{Cyrillic}+|\p{Greek}+")
_EMOJI = regex.compile(r"\p{Extended_Pictographic}|[\U0001f3fb-\U0001f3ff\ufe0f]")


def options(c: str) -> set[str]:
    """The lower-case letters that a character of a token may stand for at no cost."""
    out = {c, LATIN_OF.get(c, c)} | {k for k, v in LATIN_OF.items() if v in (c, LATIN_OF.get(c))}
    return {x.lower() for x in out if len(x.lower()) == 1}


def prototypes() -> tuple[str, str]:
    """(letters, one letter for each): lower-case look-alikes, however they are linked, have the same."""
    root: dict[str, str] = {}

    def find(c: str) -> str:
        while root.get(c, c) != c:
            c = root[c]
        return c

    for a, b in LATIN_OF.items():
        x, y = find(a.lower()), find(b.lower())
        root[max(x, y)] = root.setdefault(min(x, y), min(x, y))
    letters = sorted(root)
    return "".join(letters), "".join(find(c) for c in letters)


_LETTERS, _PROTOTYPE = prototypes()
_FOLD = str.maketrans(_LETTERS, _PROTOTYPE)


def bare(token: str) -> str:
    """The token in compatibility form without ignorable characters."""
    return unicodedata.normalize("NFKC", _JOINER.sub("", _INVISIBLE.sub("", token)))


def shard_of(token: str) -> str:
    return bare(token).lower()[:SHARD_LETTERS].translate(_FOLD)


class Trie:
    """Words with their counts as nested dictionaries; the empty key ends a word."""

    def __init__(self, words: list[tuple[str, int]]):
        self.root: dict = {}
        for w, n in words:
            node = self.root
            for c in w:
                node = node.setdefault(c, {})
            node[""] = (w, n)

    def find(self, token: str, limit: int = MAX_COST) -> list[tuple[int, str, int]]:
        """(cost, word, count) of the words that the token spells at no more than the limit."""
        states: dict[int, tuple[dict, int]] = {id(self.root): (self.root, 0)}

        def put(new: dict, node: dict, cost: int) -> None:
            if cost <= limit and new.get(id(node), (None, limit + 1))[1] > cost:
                new[id(node)] = (node, cost)
                for c, child in node.items():  # a letter that the token lacks
                    if c:
                        put(new, child, cost + 1)

        if limit:
            start: dict = {}
            put(start, self.root, 0)
            states = start
        for c in bare(token):
            free, new = options(c), {}
            for node, cost in states.values():
                for x, child in node.items() if limit else ((x, node[x]) for x in free if x in node):
                    if x:
                        put(new, child, cost + (x not in free))
                put(new, node, cost + 1)  # a letter too many
            states = new
            if not states:
                return []
        return sorted((cost, *node[""]) for node, cost in states.values() if "" in node)


def suspect(text: str) -> bool:
    """Whether the text holds a suspect character, by a table over its code points."""
    global _SUSPECT
    if text.isascii():
        return False
    if _SUSPECT is None:
        _SUSPECT = code_points(lambda c: bool(SUSPECT.match(c)))
    return bool(_SUSPECT[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)].any())


def joiner_needed(text: str, i: int) -> bool:
    """Whether the joiner at i is part of an emoji sequence or of an Indic or Arabic spelling."""
    before, after = text[i - 1 : i], text[i + 1 : i + 2]
    if not before or not after:
        return False
    if text[i] == "‍" and _EMOJI.match(before) and _EMOJI.match(after):
        return True
    # after a virama, between letters of one Indic script
    if unicodedata.combining(before) == 9 and "ऀ" <= after <= "෿":
        return True
    return text[i] == "‌" and "؀" <= before <= "ۿ" and "؀" <= after <= "ۿ"


def letters(text: str) -> tuple[int, int, int]:
    """How many letters are Latin, Cyrillic and Greek."""
    return len(_LATIN.findall(text)), len(_CYRILLIC.findall(text)), len(_GREEK.findall(text))


def script(text: str, less: tuple[int, int, int] = (0, 0, 0), own: tuple[int, int, int] | None = None) -> str:
    """L, C or G: the script with most letters, of the three that share shapes; '' for none.

    own: the letters of the text where they are known; less: those that don't count.
    """
    n = [x - y for x, y in zip(own or letters(text), less)]
    best = max(range(3), key=n.__getitem__)
    return "LCG"[best] if n[best] else ""


@lru_cache(1 << 16)
def doubtful(token: str) -> tuple[int, int, int] | None:
    """The letters of a token that mixes scripts, hides characters or is all look-alikes; None for any other."""
    hidden = not _PLAIN.fullmatch(token) or _TABLE.search(token)
    return letters(token) if hidden or _FOREIGN.search(token) and all(c in LATIN_OF for c in token) else None


def suspect_tokens(text: str) -> Iterator[tuple[int, int, str, str]]:
    """(start, end, token, script of its line) of the tokens that mix scripts, hide characters or are all look-alikes."""
    at = 0
    for line in text.split("\n"):
        if not line.isascii() and suspect(line):
            whole = None
            for m in _TOKEN.finditer(line):
                t = m[0]
                if t.isascii() or len(t) < 2:
                    continue
                own = doubtful(t)
                if own is not None:
                    whole = whole or letters(line)
                    yield at + m.start(), at + m.end(), t, script(line, own, whole)
        at += len(line) + 1


def in_case(word: str, token: str) -> str:
    """The word with the case of the token's letters; they are as many."""
    return "".join(w.upper() if c.isupper() and len(w.upper()) == 1 else w for w, c in zip(word, bare(token)))


def by_table(token: str) -> str:
    """A token of several scripts in one, if all letters of the other have look-alikes in it."""
    latin, other = _LATIN.search(token), _FOREIGN.search(token)
    if not latin or not other or len(token) < 2:
        return token
    letters = [c for c in token if c.isalpha()]
    if all(c in LATIN_OF for c in letters if _FOREIGN.match(c)) and not (_GREEK.search(token) and len(letters) < 4):
        return "".join(LATIN_OF.get(c, c) for c in token)
    if _CYRILLIC.search(token) and not _GREEK.search(token) and all(c in CYRILLIC_OF for c in letters if _LATIN.match(c)):
        return "".join(CYRILLIC_OF.get(c, c) for c in token)
    return token


def canonical(text: str | None, spelled: Callable[[str, str], str | None]) -> tuple[str, int] | None:
    """(text in one form, how many places were changed); None where nothing is to be changed.

    spelled: the canonical spelling of a suspect token in a line of a script, or None.
    """
    if not text or not suspect(text):
        return None
    n = 0

    def put(new: str):
        def f(m):
            nonlocal n
            n += 1
            return new
        return f

    def compatible(m) -> str:
        nonlocal n
        new = unicodedata.normalize("NFKC", m[0])
        n += new != m[0]
        return new

    def joiner(m) -> str:
        nonlocal n
        if joiner_needed(m.string, m.start()):
            return m[0]
        n += 1
        return ""

    def marked(m) -> str:
        nonlocal n
        new = unicodedata.normalize("NFC", m[0])
        if new == m[0] or len(new) >= len(m[0]):
            return m[0]
        n += 1
        return new

    out, at = [], 0
    for a, b, token, around in suspect_tokens(text):
        new = spelled(token, around) or by_table(token)
        if new != token:
            n += 1
            out += [text[at:a], new]
            at = b
    text = "".join([*out, text[at:]])
    text = _TABLE.sub(compatible, text)
    text = _INVISIBLE.sub(put(""), text)
    text = _JOINER.sub(joiner, text)
    text = _SPACE.sub(lambda m: put(" " * len(m[0]))(m), text)
    text = _CODE.sub(lambda m: put(m[1] + "-")(m), text)
    text = _MARKED.sub(marked, text)
    return (text, n) if n else None


def tokens_of(texts: DataFrame) -> DataFrame:
    """(token, around, shard): the distinct suspect tokens of `text`."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = {(t, around) for x in b["text"] if suspect(x) for _, _, t, around in suspect_tokens(x)}
            yield pd.DataFrame([(*f, shard_of(f[0])) for f in found], columns=["token", "around", "shard"])

    return texts.mapInPandas(scan, "token string, around string, shard string").distinct()


def vocabulary(texts: DataFrame) -> DataFrame:
    """(word, n, shard): the words of `text` in one script, in lower case, and how often they occur."""
    words = texts.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"([\p{L}\p{M}]{2,})"), F.lit(1))).alias("word"))
    # cheap comparisons first, for the blocks of other scripts
    for a, b in OTHER_SCRIPTS:
        words = words.filter((F.col("word") < a) | (F.col("word") > b + "\U0010ffff"))
    plain = F.col("word").rlike(r"^(\p{IsLatin}+|\p{IsCyrillic}+|\p{IsGreek}+)$") & ~F.col("word").rlike(f"[{WIDE}{LIGATURES}]")
    first = F.translate(F.substring("word", 1, SHARD_LETTERS), _LETTERS, _PROTOTYPE)
    # each distinct word is looked at once: a condition on the count keeps the filter behind the aggregate
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.when(F.col("n") > 0, plain)).withColumn("shard", first)


def choose(found: list[tuple[int, str, int]], around: str) -> str | None:
    """The word to write: in the script of the line if there is one, then the least cost, then the most frequent."""
    if not found:
        return None
    return min(found, key=lambda f: (script(f[1]) != around, f[0], -f[2], f[1]))[1]


def spellings(tokens: DataFrame, words: DataFrame) -> DataFrame:
    """(token, around, spelling) of the tokens that a word of their shard's trie spells; one trie a shard, in one task."""
    asked = small_side(tokens.select("shard").distinct())
    own = words.join(asked, "shard", "left_semi").select("shard", F.col("word").alias("w"), "n", F.lit("").alias("around"))
    both = own.union(tokens.select("shard", F.col("token").alias("w"), F.lit(0).cast("bigint").alias("n"), "around"))

    def traverse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, held, trie = None, [], None
        for b in batches:
            rows = []
            for shard, w, n, around in b.itertuples(index=False, name=None):
                if shard != now:
                    now, held, trie = shard, [], None
                if n:
                    held.append((w, n))
                    continue
                if trie is None:
                    trie = Trie(held)
                word = choose(trie.find(w), around)
                new = None if word is None or len(word) != len(bare(w)) else in_case(word, w)
                if new is not None and new != w:
                    rows.append((w, around, new))
            yield pd.DataFrame(rows, columns=["token", "around", "spelling"])

    sharded = both.repartition("shard").sortWithinPartitions("shard", F.col("n").desc())
    return sharded.mapInPandas(traverse, "token string, around string, spelling string")


def unified(df: DataFrame, keys: list[str], text: str, known: DataFrame, model: encoding.Model | None = None) -> DataFrame:
    """(keys, n_changes, canonical) of the rows whose text changes. ASCII rows stay in the JVM.

    known: (token, around, spelling). With a model of wrong encodings, garbled rows are left out: they are to be restored.
    """
    rows = spread(df.filter(F.col(text).rlike(r"[^\x00-\x7f]")).select(*keys, text))
    size = known.agg(F.sum(F.octet_length("token") + F.octet_length("spelling") + 64)).first()[0] or 0
    table_of = None
    if size <= BROADCAST_BYTES:
        table_of = {(r["token"], r["around"]): r["spelling"] for r in known.collect()}
        rows = rows.withColumn("fixes", F.lit(None).cast("map<string,string>"))
    else:
        rows = with_spellings(rows, keys, text, known)
    shared = df.sparkSession.sparkContext.broadcast((table_of, model))

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t, m = shared.value
        for b in batches:
            out = []
            for *k, x, fixes in b.itertuples(index=False, name=None):
                own = dict(fixes) if fixes is not None else {}
                r = canonical(x, (lambda token, around: t.get((token, around))) if t is not None else lambda token, around, own=own: own.get(f"{around}{token}"))
                if r is not None and (m is None or encoding.examine(m, x) is None):
                    out.append((*k, r[1], r[0]))
            yield pd.DataFrame(out, columns=[*keys, "n_changes", "canonical"])

    return rows.mapInPandas(scan, ", ".join(f"{k} string" for k in keys) + ", n_changes int, canonical string")


def with_spellings(rows: DataFrame, keys: list[str], text: str, known: DataFrame) -> DataFrame:
    """The rows with `fixes`, the spellings of their own tokens by script and token: a join for what is too large to send."""

    @F.pandas_udf("array<struct<token:string,around:string>>")
    def own(t: pd.Series) -> pd.Series:
        return t.map(lambda x: [{"token": k, "around": s} for k, s in {(k, s) for _, _, k, s in suspect_tokens(x)}])

    each = rows.select(*keys, F.inline(own(text))).join(known, ["token", "around"]).groupBy(*keys)
    fixes = each.agg(F.map_from_entries(F.collect_set(F.struct(F.concat("around", "token"), "spelling"))).alias("fixes"))
    return rows.join(fixes, keys, "left")


def p6_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every chunk and text block whose text changes, with its canonical form; garbled chunks are p4's."""
    blocks = table(spark, sf_dir, "page_blocks").filter("type = 'text'")
    chunks = table(spark, sf_dir, "chunks")
    texts = blocks.select(F.col("content_text").alias("text")).union(chunks.select("content")).filter("text is not null")
    tokens = checkpointed(tokens_of(texts.filter(F.col("text").rlike(r"[^\x00-\x7f]"))))
    known = checkpointed(spellings(tokens, vocabulary(texts)))
    a = unified(chunks, ["source", "chunk_id"], "content", known, encoding.trained(spark, sf_dir))
    b = unified(blocks, ["source", "block_id"], "content_text", known)
    return (
        a.withColumnRenamed("chunk_id", "record_id")
        .withColumn("table_name", F.lit("chunks"))
        .unionByName(b.withColumnRenamed("block_id", "record_id").withColumn("table_name", F.lit("page_blocks")))
        .dropDuplicates(["table_name", "source", "record_id"])
        .select("table_name", "source", "record_id", "n_changes", "canonical")
    )


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p6_canonical(spark, sf_dir).select("table_name", "source", "record_id")
