"""p4: text decoded with the wrong character encoding.

Method: a multinomial classifier on hashed byte bigrams, trained on synthetically garbled records, predicts the exact
chain of encodings; the chain is inverted and counts as restored only if every character decodes strictly.

The stretches to classify are found by the same bigram odds (garbled against sound): the highest-scoring stretch of a
text is taken, then those left and right of it, down to MIN_SCORE. A short stretch that stands alone in quotation marks
quotes a garbled sample and is no case. Null, empty and ASCII texts are sound. Texts of any length are scored whole.
Repeated rows count once. The training sample is bounded by TRAIN_ROWS; with no sound rows at all nothing is found.
"""

from __future__ import annotations

import codecs
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.session import bounded_sample, spread, table

#: Rows of each of chunks and page blocks, the lowest by hash, on which the classifier is trained.
TRAIN_ROWS = 2500
#: Longest text of the sample: longer ones are no sample, none is cut.
LONGEST = 20_000
BUCKETS = 1 << 16
MIN_SCORE = 14.0
FLOOR = 2e-6
#: Weight of sound text in the odds, and the count below which a bigram says nothing.
PRIOR, RARE = 30.0, 0.5
#: Cost of a change of chains within a stretch, as a logarithm, and the odds from which a stretch is looked at for such.
SWITCH, STRONG = 25.0, 60.0
#: Likeness to any chain's output from which changes of chains are looked for; what no chain yields lies at -13.
LIKE = -10.0
#: What sound text has in its favour there, as a logarithm, at each byte.
LEAN = 0.3
#: Of the ranked chains, those that are also tried with the edges of a stretch moved by up to two characters.
EDGED = 12
#: ASCII bytes that separate two stretches, which may come from different chains.
GAP = 24

# Pairs of (encoding of the bytes, encoding they were read in); "x2" applies the pair twice.
LOSSLESS = [
    ("utf-8", "cp1252"), ("utf-8", "latin-1"), ("utf-8", "cp850"), ("utf-8", "cp437"), ("utf-8", "mac_roman"),
    ("utf-8", "cp1251"), ("utf-8", "koi8-r"), ("utf-8", "cp866"), ("utf-8", "cp1250"), ("utf-8", "cp1254"),
    ("utf-8", "gbk"), ("utf-8", "big5"), ("utf-8", "shift_jis"), ("utf-8", "euc_kr"), ("utf-8", "cp874"),
    ("gbk", "cp1252"), ("gbk", "latin-1"), ("gbk", "cp1251"), ("gbk", "big5"), ("big5", "latin-1"), ("big5", "gbk"),
    ("shift_jis", "latin-1"), ("shift_jis", "cp1252"), ("shift_jis", "gbk"), ("euc_jp", "latin-1"), ("euc_jp", "cp1252"),
    ("euc_jp", "gbk"), ("euc_jp", "shift_jis"), ("euc_kr", "latin-1"), ("euc_kr", "cp1252"), ("euc_kr", "gbk"),
    ("cp1251", "cp1252"), ("cp1251", "latin-1"), ("cp1251", "koi8-r"), ("koi8-r", "cp1251"), ("koi8-r", "cp1252"),
    ("cp866", "cp1251"), ("cp866", "cp1252"), ("cp1251", "cp866"), ("cp1251", "mac_roman"), ("iso8859-5", "cp1251"),
    ("cp1252", "cp1251"), ("cp1252", "cp850"), ("cp1252", "cp437"), ("cp1252", "mac_roman"), ("cp1252", "koi8-r"),
    ("cp850", "cp1252"), ("mac_roman", "cp1252"), ("cp1256", "cp1252"), ("cp874", "cp1252"),
]
TWICE = [("utf-8", "cp1252"), ("utf-8", "latin-1"), ("utf-8", "cp850"), ("utf-8", "mac_roman"), ("utf-8", "cp437"), ("utf-8", "cp1251")]
LOSSY = ["gbk", "big5", "shift_jis", "euc_jp", "euc_kr", "cp1251", "koi8-r", "cp1252", "cp850", "mac_roman", "cp1256", "cp874"]
#: Marks that open and close a quoted sample.
QUOTES = {'"': '"', "“": "”", "„": "“", "«": "»", "‘": "’", "「": "」", "『": "』", "`": "`", "»": "«"}

MULTI = {"utf-8", "gbk", "big5", "shift_jis", "euc_jp", "euc_kr"}


@lru_cache(None)
def single(codec: str) -> tuple[str, object]:
    """Decoding and encoding of a single-byte codec; bytes that it leaves undefined stand for themselves."""
    chars = []
    for b in range(256):
        try:
            chars.append(bytes([b]).decode(codec))
        except UnicodeDecodeError:
            chars.append(chr(b))
    return "".join(chars), codecs.charmap_build("".join(chars))


def misread(raw: bytes, codec: str, errors: str = "replace") -> str:
    if codec in MULTI:
        return raw.decode(codec, errors)
    return codecs.charmap_decode(raw, errors, single(codec)[0])[0]


def reread(text: str, codec: str) -> bytes | None:
    """The bytes that were misread as `text`, or None where it holds a character that codec has not."""
    try:
        if codec in MULTI:
            return text.encode(codec)
        return codecs.charmap_encode(text, "strict", single(codec)[1])[0]
    except UnicodeEncodeError:
        return None


def chains() -> list[tuple[str, ...]]:
    return [*LOSSLESS, *[(a, b, "x2") for a, b in TWICE], *[(a, "utf-8") for a in LOSSY]]


def garble(text: str, chain: tuple[str, ...]) -> str | None:
    """Apply a chain; None where the text can't be written in its first encoding."""
    for _ in range(2 if "x2" in chain else 1):
        try:
            raw = text.encode(chain[0])
        except UnicodeEncodeError:
            return None
        text = misread(raw, chain[1])
    return text


def buckets(raw: bytes) -> np.ndarray:
    """Hashed bigrams of the bytes; the last byte is paired with a line feed."""
    b = np.frombuffer(raw + b"\n", dtype=np.uint8).astype(np.uint32)
    return (((b[:-1] << 8) | b[1:]) * np.uint32(40503)) & np.uint32(BUCKETS - 1)


class Model:
    """Log probabilities by chain, and the odds of garbled against sound text for each bucket."""

    def __init__(self, texts: list[str], prior: float = PRIOR, least: float = MIN_SCORE):
        self.least = least
        self.chains = chains()
        texts = [t if i % 8 else t.upper() for i, t in enumerate(texts) if not t.isascii()]  # capitals are rare in running text
        plain = np.zeros(BUCKETS, dtype=bool)
        plain[np.unique(buckets(bytes(x for a in range(128) for b in range(128) for x in (a, b))))] = True

        def count(some: list[str]) -> np.ndarray:
            c = np.bincount(buckets("\n".join(some).encode("utf-8", "replace")), minlength=BUCKETS).astype(float)
            c[plain] = 0
            return c

        sound = count(texts)
        counts = np.zeros((len(self.chains), BUCKETS))
        for k, chain in enumerate(self.chains):
            counts[k] = count([g for t in texts if (g := garble(t, chain)) and g != t])
        used = counts.sum(1) > 200
        self.chains, counts = [c for c, u in zip(self.chains, used) if u], counts[used]
        p = counts / np.maximum(counts.sum(1, keepdims=True), 1)
        self.log_p = np.log(p + FLOOR).astype(np.float32)
        # both counts come from the same texts, so what a chain leaves as it is has no odds in its favour
        best = counts.max(0) if len(counts) else sound
        self.odds = np.clip(np.log((best + RARE) / (prior * sound + RARE)), -6, 6).astype(np.float32)
        self.odds[plain] = -0.1
        self.log_q = np.log(sound / max(sound.sum(), 1) + FLOOR)
        self.plain = plain
        self.known: dict[str, float] = {}

    def scores(self, raw: bytes) -> np.ndarray:
        return self.odds[buckets(raw)]

    def soundness(self, text: str) -> float:
        """Mean log probability of a text's bigrams, those of ASCII left out, as sound text; 0 if it has no others."""
        at = buckets(text.encode("utf-8", "replace"))
        at = at[~self.plain[at]]
        return float(self.log_q[at].mean()) if len(at) else 0.0

    def rank(self, raw: bytes) -> list[tuple[str, ...]]:
        total = self.log_p[:, buckets(raw)].sum(1)
        return [self.chains[k] for k in np.argsort(-total)]

    def oddness(self, run: str) -> float:
        """The odds of a run of characters; the chains that are tried meet the same runs."""
        if run not in self.known:
            if len(self.known) > 20_000:
                self.known.clear()
            self.known[run] = float(self.scores(run.encode("utf-8", "replace")).sum())
        return self.known[run]

    def likeness(self, raw: bytes) -> float:
        """Mean log probability of the bigrams beyond ASCII, each by the chain that explains it best."""
        at = buckets(raw)
        at = at[~self.plain[at]]
        return float(self.log_p[:, at].max(0).mean()) if len(at) else 0.0

    def segments(self, raw: bytes) -> list[tuple[int, int]]:
        """Byte ranges between which the likeliest chain changes, those of sound text left out.

        The likeliest sequence of chains and of sound text, where each change costs SWITCH.
        """
        at = buckets(raw)
        p = np.vstack([self.log_p[:, at], self.log_q[None, at] + LEAN]).T.astype(np.float64)
        best, back = p[0].copy(), np.zeros(p.shape, dtype=np.int16)
        states = np.arange(p.shape[1])
        for i in range(1, len(p)):
            k = int(best.argmax())
            stay = best >= best[k] - SWITCH
            back[i] = np.where(stay, states, k)
            best = np.where(stay, best, best[k] - SWITCH) + p[i]
        path = np.empty(len(p), dtype=np.int64)
        path[-1] = best.argmax()
        for i in range(len(p) - 1, 0, -1):
            path[i - 1] = back[i, path[i]]
        edges = [0, *(np.flatnonzero(np.diff(path)) + 1).tolist(), len(p)]
        return [(a, b) for a, b in zip(edges, edges[1:]) if path[a] < len(self.chains)]

    def stretches(self, raw: bytes) -> list[tuple[int, int, float]]:
        """Byte ranges of the highest-scoring stretches, from left to right, cut where ASCII stands between."""
        s, out = self.scores(raw), []
        todo = [(0, len(s))]
        while todo:
            a, b = todo.pop()
            if b - a < 2:
                continue
            run = np.concatenate([[0.0], np.cumsum(s[a:b], dtype=np.float64)])
            low = np.minimum.accumulate(run)
            end = int(np.argmax(run - low))
            score = run[end] - low[end]
            if score < self.least:
                continue
            start = int(np.argmin(run[: end + 1]))
            odd = a + start + np.flatnonzero(s[a + start : a + end] != self.odds[0])
            for part in np.split(odd, np.flatnonzero(np.diff(odd) > GAP) + 1):
                total = float(s[part[0] : part[-1] + 1].sum())
                if total >= self.least:
                    out.append((int(part[0]), int(part[-1]) + 1, total))
            todo += [(a, a + start), (a + end, b)]
        return sorted(out)


#: How much likelier, in mean log probability, the restored text must be than what it was restored from.
GAIN = 1.0
#: The same for stretches with fewer than eight odd characters together.
FEW = 2.5


@lru_cache(None)
def group(codec: str) -> re.Pattern:
    """Runs of characters beyond ASCII that a single-byte codec can yield."""
    return re.compile("[" + re.escape("".join(sorted({c for c in single(codec)[0] if c > "\x7f"}))) + "]+")


def undo(text: str, chain: tuple[str, ...]) -> str | None:
    for _ in range(2 if "x2" in chain else 1):
        raw = reread(text, chain[1])
        if raw is None:
            return None
        try:
            text = raw.decode(chain[0])
        except UnicodeDecodeError:
            return None
    return text


def undo_groups(model: Model, text: str, a: int, b: int, chain: tuple[str, ...], tight: bool = False) -> tuple[str, int, int, bool] | None:
    """Undo a chain that misreads UTF-8 byte by byte, run by run: it never touches ASCII, and sound runs stay.

    None unless most of the odd characters decode; the flag is false if some of them don't, as where some were dropped.
    """
    pattern = group(chain[1])
    while not tight and a > 0 and text[a - 1] > "\x7f":
        a -= 1
    while not tight and b < len(text) and text[b] > "\x7f":
        b += 1
    done = failed = 0
    old, new = [], []

    def one(m: re.Match) -> str:
        nonlocal done, failed
        x = m[0]
        r = undo(x, chain)
        if r is None and len(x) > 5:  # all but what was dropped
            r = undo_all_but(x, chain)
            if r is not None:
                failed += 1
        if r is None or len(r) >= len(x):
            if model.oddness(x) > 4:
                failed += len(x)
            return x
        done += len(x)
        old.append(x)
        new.append(r)
        return r

    fixed = pattern.sub(one, text[a:b])
    if done <= 2 * failed or model.soundness(" ".join(new)) < model.soundness(" ".join(old)) + GAIN:
        return None
    return fixed, a, b, failed < 1


def undo_all_but(text: str, chain: tuple[str, ...]) -> str | None:
    """As undo, with U+FFFD for what doesn't decode; None if that is more than a fifth."""
    for _ in range(2 if "x2" in chain else 1):
        raw = reread(text, chain[1])
        if raw is None:
            return None
        text = raw.decode(chain[0], "replace")
    return text if text.count("\ufffd") * 5 <= len(text) else None


def begins(text: str, a: int, b: int, chain: tuple[str, ...]) -> bool:
    """Whether a stretch can be inverted from there at all: if its beginning can't, wherever it is cut, the whole can't."""
    return b - a < 64 or any(undo(text[a : a + 48 - k], chain) is not None for k in range(8))


def restore(model: Model, text: str, a: int, b: int, tight: bool = False) -> tuple[str, str, int, int, bool] | None:
    """(restored, chain, start, end, whole) of a stretch, or None if no likely chain can be inverted.

    The whole stretch, give or take its edges, must decode and be likelier as sound text afterwards.
    """
    part = text[a:b]
    before = model.soundness(part)
    odd, score = sum(c > "\x7f" and not c.isspace() for c in part), float(model.scores(part.encode("utf-8", "replace")).sum())
    # all chains as the classifier ranks them; sound text in the stretch may spoil the ranking
    for k, chain in enumerate(model.rank(part.encode("utf-8", "replace"))):
        if chain[1] == "utf-8":
            continue
        name = ">".join(chain)
        if chain[0] == "utf-8" and chain[1] not in MULTI:
            if (g := undo_groups(model, text, a, b, chain, tight)) is not None:
                return g[0], name, *g[1:]
            continue
        if odd < 8 or not MULTI.isdisjoint(chain[:2]) and score < 3 * odd:
            continue  # what is short or hardly odd decodes by chance
        edges = (0, 1, -1, 2, -2) if k < EDGED and not MULTI.isdisjoint(chain[:2]) else (0,)
        for x in edges:
            if x and not begins(text, max(0, a + x), b, chain):
                continue
            for y in edges:
                lo, hi = max(0, a + x), min(len(text), b + y)
                r = undo(text[lo:hi], chain) if lo < hi else None
                if r is not None and r != text[lo:hi] and model.soundness(r) > before + GAIN:
                    return r, name, lo, hi, True
    return None


def quoted(text: str, a: int, b: int) -> bool:
    """Whether the stretch is a short sample in quotation marks; the marks may have been drawn into it."""
    for i in range(max(0, a - 12), min(a + 3, b)):
        if text[i] in QUOTES and b - 3 <= text.find(QUOTES[text[i]], i + 1) <= min(i + 16, b + 12):
            return True
    return False


def examine(model: Model, text: str | None) -> tuple[str | None, str, str] | None:
    """(restorable, chains, restored text) of a garbled text, None for a sound one."""
    if not text or text.isascii():
        return None
    raw = text.encode("utf-8", "replace")
    found = model.stretches(raw)
    if not found and "�" not in text:
        return None
    starts = np.frombuffer(raw, dtype=np.uint8)
    chars = np.cumsum((starts & 0xC0) != 0x80)  # characters up to and with each byte
    spans = [(int(chars[x]) - 1, int(chars[min(y, len(raw) - 1)]) - 1 + (y >= len(raw))) for x, y, _ in found]
    spans = [(x, max(y, x + 1)) for x, y in spans]
    spans = [s for s in spans if not quoted(text, *s)]
    if not spans and "�" not in text:
        return None
    if not spans and all(quoted(text, m.start(), m.end()) for m in re.finditer("�+", text)):
        return None
    out, names, at, whole = [], [], 0, "�" not in text
    fixes: list = []
    open_: list = []
    for x, y in spans:
        if "�" in text[x:y]:
            names.append(">".join(model.rank(text[x:y].encode("utf-8", "replace"))[0]))
        elif (fixed := restore(model, text, x, y)) is not None:
            fixes.append(fixed)
        else:
            parts = parted(model, text, x, y)
            fixes += parts
            if not parts:
                open_.append((x, y))
    if open_ and not fixes:
        fixes = letters_exchanged(model, text, open_)
    for new, name, lo, hi, all_of_it in sorted(fixes, key=lambda f: f[2:4]):
        if lo < at:
            continue
        whole &= all_of_it
        out += [text[at:lo], new]
        at = hi
        names.append(name)
    if not names:
        return None  # odd, but no chain explains it
    out.append(text[at:])
    return ("yes" if whole else "no"), ",".join(dict.fromkeys(names)), "".join(out)


def parted(model: Model, text: str, a: int, b: int) -> list[tuple[str, str, int, int, bool]]:
    """The fixes of a stretch in which one chain follows another, each found on its own; none if most of it has none."""
    part = text[a:b]
    raw = part.encode("utf-8", "replace")
    if float(model.scores(raw).sum()) < STRONG or model.likeness(raw) < LIKE:
        return []
    chars = np.cumsum((np.frombuffer(raw, dtype=np.uint8) & 0xC0) != 0x80)
    fixes, odd, done, at = [], 0, 0, a
    for x, y in model.segments(raw):
        lo, hi = a + int(chars[x]) - 1, a + int(chars[min(y, len(raw) - 1)]) - 1 + (y >= len(raw))
        lo = max(lo, at)
        n = sum(c > "\x7f" for c in text[lo:hi])
        odd += n
        if lo < hi and (fixed := restore(model, text, lo, hi, True)) is not None and fixed[2] >= at:
            fixes.append(fixed)
            done += n
            at = fixed[3]
    return fixes if 2 * done >= odd else []


def scripts(text: str) -> set[str]:
    return {unicodedata.name(c, "?").split()[0] for c in set(text) if c.isalpha()}


def letters_exchanged(model: Model, text: str, spans: list[tuple[int, int]]) -> list[tuple[str, str, int, int, bool]]:
    """The fixes of stretches too short on their own that one single-byte chain makes sound together."""
    joined = " ".join(text[x:y] for x, y in spans)
    odd = sum(c > "\x7f" and not c.isspace() for c in joined)
    if odd < 3:
        return []
    before = model.soundness(joined) + (GAIN if odd >= 8 else FEW)
    rest = "".join(text[x:y] for x, y in zip([0, *[b for _, b in spans]], [*[a for a, _ in spans], len(text)]))
    for chain in model.rank(joined.encode("utf-8", "replace")):
        if MULTI.isdisjoint(chain[:2]):
            new = [undo(text[x:y], chain) for x, y in spans]
            if None not in new and model.soundness(" ".join(new)) > before and (odd >= 8 or scripts(" ".join(new)) <= scripts(rest)):
                return [(n, ">".join(chain), x, y, True) for n, (x, y) in zip(new, spans)]
    return []


def sound_sample(df: DataFrame, text: str, rows: int = TRAIN_ROWS) -> list[str]:
    """The texts lowest by hash that hold other characters than ASCII, none lost or of private use."""
    x = F.col(text)
    sound = df.filter(x.rlike(r"[^\x00-\x7f]") & ~x.rlike("[\\x{80}-\\x{9f}\\x{fffd}\\x{e000}-\\x{f8ff}]"))
    picked = bounded_sample(sound.filter(F.length(x) <= LONGEST).select(x.alias("t")), "t", rows)
    return [r["t"] for r in picked.collect()]


def garbled(chunks: DataFrame, model: Model) -> DataFrame:
    """(chunk_id, restorable, chain, restored) of every row whose content is garbled."""
    shared = chunks.sparkSession.sparkContext.broadcast(model)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for b in batches:
            rows = [(c, *r) for c, t in zip(b["chunk_id"], b["content"]) if (r := examine(m, t)) is not None]
            yield pd.DataFrame(rows, columns=["chunk_id", "restorable", "chain", "restored"])

    rows = spread(chunks.select("chunk_id", "content").filter(F.col("content").rlike(r"[^\x00-\x7f]")))
    return rows.mapInPandas(scan, "chunk_id string, restorable string, chain string, restored string")


def reversible(text: str) -> bool:
    """Whether a run of characters is also valid UTF-8 read byte by byte, as sound text hardly ever is."""
    for a, b in LOSSLESS:
        if a == "utf-8" and b not in MULTI:
            for m in group(b).finditer(text):
                if len(m[0]) > 1 and (r := undo(m[0], (a, b))) is not None and len(r) < len(m[0]):
                    return True
    return False


def train(texts: list[str], dirty: list[str]) -> Model:
    """Train on sound texts and those of `dirty` that seem sound, then again without those found garbled."""
    texts = texts + [t for t in dirty if not reversible(t)]
    first = Model(texts, prior=10)
    found = [examine(first, t) for t in texts]
    # one letter for another is found less surely: only multi-byte chains count against a text here
    sure = ("utf-8", "gbk", "shift_jis", "euc", "big5")
    return Model([t for t, r in zip(texts, found) if r is None or not r[1].startswith(sure)])


def trained(spark: SparkSession, sf_dir: str) -> Model:
    blocks = table(spark, sf_dir, "page_blocks").filter("type = 'text'")
    return train(sound_sample(blocks, "content_text"), sound_sample(table(spark, sf_dir, "chunks"), "content"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p4_restored(spark, sf_dir).select("chunk_id", "restorable").distinct()


def p4_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return garbled(table(spark, sf_dir, "chunks"), trained(spark, sf_dir)).dropDuplicates(["chunk_id"])
