"""p9: a mix of sources by target shares of tokens.

Method: temperature mixing. The token shares of the sources are raised to an exponent that draws them from what there is
(1) towards the targets (0), or towards equal shares where no targets are given; the exponent is bisected to meet an
entropy, or to come as near to the targets as the repetition limits allow for a mix of a given size. The weights are
realised as budgeted block permutations: every document of a source is used in whole passes, and the rest of its budget
is filled block by block in a hashed order, row by row only in the last block. Blocks hold about BLOCK_ROWS rows, so a
source with a third of all rows is spread over many tasks. Without a given size the mix is the largest at which every
source that has documents meets its target, where the exponent comes out as 0.

Tokens are those of a public tokenizer whose file is a parameter. Null and empty texts have none and are never used; a
null source belongs to none. Sources are compared in lower case with "_" for blanks and hyphens. A null limit allows one
use, a limit of 0 none. A target without usable documents reaches 0 and falls short, as does one of a share that is null
or not above 0; without any target or document the mix is empty.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagemill.session import checkpointed, spread, table

BLOCK_ROWS = 2000
#: Most targets of a mix: they are planned on the driver; more are refused.
MAX_SOURCES = 100_000
#: Characters encoded at a time.
PIECE = 50_000


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@lru_cache(1)
def encoding(path: str):
    import base64

    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def plain(source: Column | str) -> Column:
    return F.regexp_replace(F.lower(F.trim(source)), "[-\\s]+", "_")


def sized(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, source, tokens) of the documents that have any."""
    path = path or tokenizer_file()

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoding(path)
        for b in batches:
            n = [sum(len(enc.encode_ordinary(t[i : i + PIECE])) for i in range(0, len(t), PIECE)) for t in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"], "source": b["source"], "tokens": n})

    rows = docs.select("doc_id", plain("source").alias("source"), "text").filter(F.length("text") > 0)
    return spread(rows).mapInPandas(count, "doc_id bigint, source string, tokens bigint")


def tempered(shares: dict[str, float], exponent: float, towards: dict[str, float] | None = None) -> dict[str, float]:
    """Shares to the power of the exponent, times the targets to what it lacks of 1; normalised.

    1 leaves the shares, 0 gives the targets, or equal shares without any.
    """
    goal = lambda k: (1.0 if towards is None else towards.get(k, 0.0)) ** (1 - exponent)
    powers = {k: v**exponent * goal(k) if v > 0 else 0.0 for k, v in shares.items()}
    total = sum(powers.values())
    return {k: v / total for k, v in powers.items()} if total else powers


def entropy(shares: dict[str, float]) -> float:
    return -sum(v * math.log(v) for v in shares.values() if v > 0)


def exponent_for_entropy(shares: dict[str, float], target: float) -> float:
    """The exponent from 0 to 8 at which the shares have the target entropy, or the end that comes closest."""
    lo, hi = 0.0, 8.0
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if entropy(tempered(shares, mid)) > target else (lo, mid)
    return (lo + hi) / 2


def fits(weights: dict[str, float], caps: dict[str, float], size: float) -> bool:
    return all(w * size <= caps[s] * (1 + 1e-9) for s, w in weights.items())


def exponent_for_limits(shares: dict[str, float], caps: dict[str, float], size: float, towards: dict[str, float] | None = None) -> float:
    """The least exponent from 0 to 1 at which a mix of that size uses no source beyond its cap; 1 if none does."""
    if fits(tempered(shares, 0.0, towards), caps, size):
        return 0.0
    lo, hi = 0.0, 1.0
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (lo, mid) if fits(tempered(shares, mid, towards), caps, size) else (mid, hi)
    return hi


def largest(weights: dict[str, float], caps: dict[str, float]) -> float:
    """The size of the largest mix of these weights within the caps."""
    return min((caps[s] / w for s, w in weights.items() if w > 0), default=0.0)


STEPS = (
    "source string, target_share double, max_repeats int, tokens bigint, natural_share double, exponent double, weight double, "
    "passes int, rest double, n_blocks int"
)


def plan(spark: SparkSession, docs: DataFrame, targets: DataFrame, size: float | None = None, by_entropy: bool = False) -> DataFrame:
    """One row per target: its natural share, the exponent, its weight, whole passes, and tokens beyond them.

    size: tokens of the mix; None: the largest with every target met. by_entropy: the exponent at which the natural
    shares have the entropy of the targets, at the given size or the largest that the limits allow.
    """
    wanted = targets.select(plain("source").alias("source"), F.col("target_share").alias("t"), F.coalesce("max_repeats", F.lit(1)).alias("m")).filter("source is not null and t > 0")
    wanted = wanted.groupBy("source").agg(F.sum("t").alias("t"), F.max("m").alias("m"))
    if (n := wanted.count()) > MAX_SOURCES:
        raise ValueError(f"{n} targets, more than {MAX_SOURCES}")
    sizes = docs.join(F.broadcast(wanted.select("source")), "source").groupBy("source").agg(F.count("*").alias("n"), F.sum("tokens").alias("tokens"))
    rows = {r["source"]: r for r in wanted.join(sizes, "source", "left").collect()}
    total = sum(r["t"] for r in rows.values()) or 1.0
    goal = {s: r["t"] / total for s, r in rows.items()}
    caps = {s: float((r["tokens"] or 0) * max(r["m"], 0)) for s, r in rows.items()}
    have = {s: float(r["tokens"]) for s, r in rows.items() if caps[s] > 0}
    natural = {s: v / sum(have.values()) for s, v in have.items()}
    if by_entropy:
        exponent = exponent_for_entropy(natural, entropy(goal))
        weights = tempered(natural, exponent)
        size = min(largest(weights, caps), size) if size is not None else largest(weights, caps)
    else:
        if size is None:
            size = largest(tempered(natural, 0.0, goal), caps)
        exponent = exponent_for_limits(natural, caps, size, goal)
        weights = tempered(natural, exponent, goal)
        size = min(size, largest(weights, caps))
    out = []
    for s, r in sorted(rows.items()):
        n, tokens, w = r["n"] or 0, r["tokens"] or 0, weights.get(s, 0.0)
        budget = w * size
        passes = min(int((budget + 1e-6) // tokens), r["m"]) if w else 0
        rest = 0.0 if not w or passes >= r["m"] else max(budget - passes * tokens, 0.0)
        out.append((s, goal[s], r["m"], tokens, natural.get(s, 0.0), exponent, w, passes, rest, max(n // BLOCK_ROWS, 1)))
    return spark.createDataFrame(out, STEPS)


def mix(docs: DataFrame, targets: DataFrame, size: float | None = None, by_entropy: bool = False) -> tuple[DataFrame, DataFrame]:
    """(documents with their uses, plan) of the mix; docs are (doc_id, source, tokens)."""
    steps = plan(docs.sparkSession, docs, targets, size, by_entropy)
    each = docs.join(F.broadcast(steps.select("source", "passes", "rest", "n_blocks")), "source").withColumn("h", F.xxhash64("doc_id")).withColumn("block", F.pmod("h", "n_blocks"))
    totals = each.groupBy("source", "block").agg(F.sum("tokens").alias("t"))
    before = F.sum("t").over(Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    blocks = totals.withColumn("start", F.coalesce(before, F.lit(0)))
    each = each.join(blocks.select("source", "block", "start", "t"), ["source", "block"])
    whole = each.filter(F.col("start") + F.col("t") <= F.col("rest")).withColumn("extra", F.lit(1))
    beyond = each.filter(F.col("start") >= F.col("rest")).withColumn("extra", F.lit(0))
    # only the block in which the budget ends is ordered row by row; a row is taken if most of it fits
    row = F.sum("tokens").over(Window.partitionBy("source", "block").orderBy("h", "doc_id")) - F.col("tokens") / 2
    last = each.filter((F.col("start") < F.col("rest")) & (F.col("start") + F.col("t") > F.col("rest"))).withColumn("extra", F.when(F.col("start") + row <= F.col("rest"), 1).otherwise(0))
    used = [d.select("doc_id", "source", "tokens", "block", (F.col("passes") + F.col("extra")).alias("uses")) for d in (whole, beyond, last)]
    return used[0].union(used[1]).union(used[2]).filter("uses > 0"), steps


def ordered(used: DataFrame) -> DataFrame:
    """A row per use with its pass and a key to sort by: passes one after the other, blocks of a pass in their own
    order and rows of a block in theirs, each pass permuted anew; sorting by it is left to whoever reads the mix."""
    each = used.withColumn("pass", F.explode(F.sequence(F.lit(1), "uses")))
    key = F.struct("pass", F.xxhash64("source", "block", "pass").alias("block_key"), F.xxhash64("doc_id", "pass").alias("row_key"))
    return each.select("doc_id", "source", "tokens", "pass", key.alias("sort_key"))


def report(used: DataFrame, steps: DataFrame) -> DataFrame:
    """(source, shares wanted and reached, repeats): one row per target."""
    got = used.groupBy("source").agg(F.sum(F.col("tokens") * F.col("uses")).alias("reached_tokens"), F.max("uses").alias("most_uses"))
    total = F.sum("reached_tokens").over(Window.partitionBy(F.lit(1)))  # over one row per target
    return (
        steps.join(got, "source", "left")
        .withColumn("total", total)
        .select(
            "source", "target_share", "natural_share", "exponent", "weight", "max_repeats", "tokens", F.coalesce("reached_tokens", F.lit(0)).alias("reached_tokens"),
            F.coalesce("most_uses", F.lit(0)).alias("most_uses"),
            F.round(F.coalesce(F.col("reached_tokens") / F.col("total"), F.lit(0.0)), 6).alias("reached_share"),
        )
        .withColumn("falls_short", F.col("reached_share") < F.col("target_share") * 0.99 - 0.0005)
    )


def measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checkpointed(sized(table(spark, sf_dir, "documents")))


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document of the mix and how often it is used."""
    return mix(measured(spark, sf_dir), table(spark, sf_dir, "mix_targets"))[0].drop("block")


def p9_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every use of a document in the mix with its place in the order of passes."""
    return ordered(mix(measured(spark, sf_dir), table(spark, sf_dir, "mix_targets"))[0])


def p9_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share each source reaches, its repetition, and whether it falls short of its target."""
    return report(*mix(measured(spark, sf_dir), table(spark, sf_dir, "mix_targets")))


def p9_full_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of a mix as large as the targeted documents: as near to the targets as the limits then allow."""
    docs, targets = measured(spark, sf_dir), table(spark, sf_dir, "mix_targets")
    own = docs.join(F.broadcast(targets.select(plain("source").alias("source")).distinct()), "source", "left_semi")
    size = own.agg(F.sum("tokens")).first()[0] or 0
    return report(*mix(docs, targets, float(size)))


def p9_temperature(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of a mix by the natural shares alone, tempered to the entropy of the targets."""
    return report(*mix(measured(spark, sf_dir), table(spark, sf_dir, "mix_targets"), by_entropy=True))
