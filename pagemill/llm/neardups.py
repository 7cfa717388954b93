"""p5: near-duplicate texts, as pairs and as groups.

Method: BK-trees whose children are keyed by integer Hamming distance to the parent. A text's code is two bits of each of
64 min-hashes of its character shingles, as 192 bits in which two texts differ by twice the min-hashes that differ, and
the logarithm of its number of shingles in unary, LEVELS bits to a factor of e. Similar texts are close in both, so the
radius has a part of each. Codes are sharded by bands of three min-hashes; each shard holds one tree of at most SHARD
codes, and queries follow only the edges within the radius, all of a shard's together. A third bit of each min-hash then
rules out most of the hits that are not similar. What is left is verified exactly.

What the tree prunes is mostly texts of another size: min-hash bits of unrelated texts all differ by about the same, so
no tree can tell them apart by triangles. The README has the share of nodes visited.

Why not broadcast every tree: codes of all texts have no size bound. A shard's tree goes where its rows are shuffled; a
hot band is cut by size, as similar texts are in the same class of sizes or in the next, and then into shards of which
each gets the queries of the band and size. Bands overlap: 14 sets of three of the 64 min-hashes, which are those of all
shingles alike. A pair at 0.7 shares none with a probability of 0.003 (0.0006 at 0.75) and is beyond the radius with one
of 0.004 (0.0003 at 0.75): a wider one lets through many times as many dissimilar texts of one form. The measured recall is
in the README.

Texts equal but for U+0020, tab, CR and LF are one class; only classes are compared. Null texts and texts with fewer
than five such characters are similar to nothing, each a class of its own. Repeated rows of a key count once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.session import checkpointed, small_side, spread, table

SHINGLE, THRESHOLD = 5, 0.7
HASHES, ROWS, BANDS = 64, 3, 14
#: Min-hashes whose two bits may differ: at 0.7 a pair of bits differs with a probability of 0.225, more than 24 with 0.003; at 0.75 with 0.0001.
DIFFER = 24
#: Bits of the unary part for each factor of e in size, and how many similar texts may differ by: sizes of 1 to 0.7.
LEVELS = 512
APART = int(LEVELS * 0.3567) + 1
RADIUS = 2 * DIFFER + APART
#: Min-hashes whose three bits may differ, looked at where the two don't rule a pair out: more than either at 0.7 with 0.003.
DIFFER_3 = 27
#: The parts of a code, as columns.
CODE = ["fp", "fp2", "fp3", "level"]
#: Shingles that go through the hash functions together, and texts of a group.
TOGETHER, GROUP = 8192, 500
#: Most codes in one tree, in a leaf of it, and pairs of codes that are compared at a time.
SHARD, LEAF, CELLS = 4000, 64, 1 << 16

_rng = np.random.default_rng(20240229)
_MUL = _rng.integers(0, 1 << 31, HASHES, dtype=np.uint32)[:, None] * np.uint32(2) + np.uint32(1)
_BAND = np.stack([_rng.permutation(HASHES)[:ROWS] for _ in range(BANDS)])
_WEIGHT = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def compact(text: str) -> np.ndarray:
    """Code points without U+0020, tab, CR and LF."""
    p = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return p[(p != 32) & (p != 10) & (p != 9) & (p != 13)]


def shingle_hashes(p: np.ndarray) -> np.ndarray:
    """A 32-bit hash of each run of SHINGLE code points."""
    p, n = p.astype(np.uint64), len(p) - SHINGLE + 1
    h = p[:n].copy()
    for k in range(1, SHINGLE):
        h *= _MIX
        h += p[k : k + n]
    h *= _MIX
    h ^= h >> np.uint64(32)
    h *= _MIX
    return (h >> np.uint64(32)).astype(np.uint32)


def distinct(x: np.ndarray) -> np.ndarray:
    """The values in order, each once."""
    x = np.sort(x)
    keep = np.ones(len(x), dtype=bool)
    np.not_equal(x[1:], x[:-1], out=keep[1:])
    return x[keep]


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """The signature of each set of shingle hashes; small sets go through the hash functions together."""
    out = np.empty((len(sets), HASHES), dtype=np.uint32)
    a = 0
    while a < len(sets):
        b, n = a, 0
        while b < len(sets) and (b == a or n + len(sets[b]) <= TOGETHER):
            n += len(sets[b])
            b += 1
        if n > TOGETHER:
            out[a] = signature(sets[a])
        else:
            starts = np.cumsum([0] + [len(x) for x in sets[a : b - 1]])
            out[a:b] = np.minimum.reduceat(np.concatenate(sets[a:b]) * _MUL, starts, axis=1).T
        a = b
    return out


def fingerprints(sigs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Three bits of each min-hash of each signature, in three numbers of 64 bits."""
    h = sigs * np.uint32(0x9E3779B1)
    return tuple(np.packbits((h >> np.uint32(k) & np.uint32(1)).astype(np.uint8), axis=1).view(">i8")[:, 0].astype(np.int64) for k in (23, 27, 30))


def signature(x: np.ndarray) -> np.ndarray:
    """The least value of each hash function over the shingles: two texts agree in one with the probability of their similarity."""
    out = np.full(HASHES, 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(x), 4096):
        np.minimum(out, (x[at : at + 4096] * _MUL).min(axis=1), out=out)
    return out


def level(n: int) -> int:
    """The size of a text in the unary part of its code: the logarithm of its number of distinct shingles."""
    return int(LEVELS * np.log(n))


def code(fp: int, fp2: int) -> int:
    """192 bits whose Hamming distance is twice the number of min-hashes that differ in their two bits."""
    a, b = fp & 0xFFFFFFFFFFFFFFFF, fp2 & 0xFFFFFFFFFFFFFFFF
    return a << 128 | b << 64 | a ^ b


def bands(sigs: np.ndarray) -> np.ndarray:
    """A 64-bit key of each band of each signature, different for the same values in different bands."""
    s, k = sigs[:, _BAND].astype(np.uint64), _WEIGHT[None]
    for r in range(ROWS):
        k = (k ^ s[:, :, r]) * _MIX
        k ^= k >> np.uint64(29)
    return k.view(np.int64)


class BKTree:
    """Codes by Hamming distance, one at a time: a node is [bits, level, ids, {distance: node}].

    The distance is that of the bits and of the unary parts, which is the difference of the levels. Shards go through
    `near_all`, where many queries follow the same edges together; tests hold it against this.
    """

    def __init__(self) -> None:
        self.root: list | None = None
        self.size = self.visited = 0

    def near(self, bits: int, at: int) -> Iterator[object]:
        """The ids of the codes within both parts of the radius."""
        todo = [self.root] if self.root else []
        while todo:
            node = todo.pop()
            self.visited += 1
            x, y = (node[0] ^ bits).bit_count(), abs(node[1] - at)
            if x <= 2 * DIFFER and y <= APART:
                yield from node[2]
            d = x + y
            todo += [child for k, child in node[3].items() if d - RADIUS <= k <= d + RADIUS]

    def add(self, bits: int, at: int, item: object) -> None:
        self.size += 1
        if self.root is None:
            self.root = [bits, at, [item], {}]
            return
        node = self.root
        while d := (node[0] ^ bits).bit_count() + abs(node[1] - at):
            child = node[3].get(d)
            if child is None:
                node[3][d] = [bits, at, [item], {}]
                return
            node = child
        node[2].append(item)


def signed(rows: DataFrame, key: str, text: str) -> DataFrame:
    """(key, id, fp, fp2, fp3, level, bands) of each row that has a shingle; id is the digest of its compact form."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at in range(0, len(b), GROUP):
                keys, ids, sets = [], [], []
                for k, t in zip(b[key].iloc[at : at + GROUP], b[text].iloc[at : at + GROUP]):
                    p = compact(t)
                    if len(p) >= SHINGLE:
                        keys.append(k)
                        ids.append(hashlib.md5(p.tobytes()).digest())
                        sets.append(distinct(shingle_hashes(p)))
                if keys:
                    sigs = signatures(sets)
                    fp, fp2, fp3 = fingerprints(sigs)
                    yield pd.DataFrame({"key": keys, "id": ids, "fp": fp, "fp2": fp2, "fp3": fp3, "level": [level(len(x)) for x in sets], "bands": list(bands(sigs))})

    rows = spread(rows.select(key, text).filter(F.col(text).isNotNull()))
    return rows.mapInPandas(scan, "key string, id binary, fp bigint, fp2 bigint, fp3 bigint, level int, bands array<bigint>")


def hot_bands(every: DataFrame) -> DataFrame:
    """(band) of those that more than SHARD rows may have; every is checkpointed, so its partitions are known.

    A band of that many rows has its share of them in some partition, so each partition reports only those.
    """
    least = max(SHARD // max(every.rdd.getNumPartitions(), 1), 1)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = [np.concatenate(b["bands"].to_list()) for b in batches if len(b)]
        if seen:
            band, n = np.unique(np.concatenate(seen), return_counts=True)
            yield pd.DataFrame({"band": band[n >= least], "n": n[n >= least] + least})

    found = every.select("bands").mapInPandas(count, "band bigint, n bigint")
    return found.groupBy("band").agg(F.sum("n").alias("n")).filter(F.col("n") > SHARD).select("band")


def sharded(reps: DataFrame, hot: DataFrame) -> DataFrame:
    """(shard, rid, fp, fp2, fp3, level): each row in its shards; with a negative rid it only asks there.

    In a hot band a row belongs to its class of sizes and asks in the class below; a class of more than SHARD rows is cut
    further, and a row then also asks in the shards before its own.
    """
    each = reps.select("rid", *CODE, F.explode("bands").alias("band"))
    cool = each.join(hot, "band", "left_anti").select(F.col("band").alias("shard"), "rid", *CODE)
    warm = each.join(hot, "band").withColumn("size", F.floor(F.col("level") / (APART + 1)))
    cuts = small_side(warm.groupBy("band", "size").agg(F.count("*").alias("n")).select("band", "size", F.ceil(F.col("n") / SHARD).alias("cuts")).filter("cuts > 1"))
    below = cuts.select("band", (F.col("size") + 1).alias("size"), F.col("cuts").alias("cuts_below"))
    own = F.pmod(F.xxhash64("rid"), F.coalesce("cuts", F.lit(1)))
    there = lambda size, k, sign: F.struct(F.xxhash64("band", size, k).alias("shard"), (sign * F.col("rid")).alias("rid"))
    asks = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("own")), lambda k: there(F.col("size"), k, F.when(k == F.col("own"), 1).otherwise(-1)))
    asks_below = F.transform(F.sequence(F.lit(0).cast("bigint"), F.coalesce("cuts_below", F.lit(1)) - 1), lambda k: there(F.col("size") - 1, k, F.lit(-1)))
    warm = (
        warm.join(cuts, ["band", "size"], "left").join(below, ["band", "size"], "left").withColumn("own", own)
        .select(*CODE, F.explode(F.concat(asks, asks_below)).alias("at")).select("at.shard", "at.rid", *CODE)
    )
    return cool.union(warm)


def ones(x: np.ndarray) -> np.ndarray:
    """The bits that are set; numpy's own count takes the absolute value of signed numbers."""
    return np.bitwise_count(x.view(np.uint64))


def met(t: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places in t, in q) of the codes within the radius of each other, by looking at each two of them."""
    out = [(np.zeros(0, dtype=np.int64),) * 2]
    step = max(CELLS // max(t.shape[1], 1), 1)
    for at in range(0, q.shape[1], step):
        p = q[:, at : at + step]
        x = ones((t[0][:, None] ^ p[0]) | (t[1][:, None] ^ p[1])) <= DIFFER
        i, j = np.nonzero(x & (np.abs(t[3][:, None] - p[3]) <= APART))
        kept = alike(t[:, i], p[:, j])
        out.append((i[kept], at + j[kept]))
    return tuple(np.concatenate(x) for x in zip(*out))


def alike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which codes of a are within all parts of the radius of those of b at the same places."""
    x = a ^ b
    two = x[0] | x[1]
    return (ones(two) <= DIFFER) & (ones(two | x[2]) <= DIFFER_3) & (np.abs(a[3] - b[3]) <= APART)


def near_all(t: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places in t, in q) of the codes of a shard and of the queries that are within the radius of them.

    A BK-tree of the codes t that all queries go through together: at a node each follows the edges within the radius of
    its own distance. Up to LEAF codes make a leaf, of neighbouring edges where these have few, and are looked at one by one.
    """
    out = [(np.zeros(0, dtype=np.int64),) * 2]
    todo = [(np.arange(t.shape[1]), np.arange(q.shape[1]))]
    while todo:
        ti, qi = todo.pop()
        if not len(qi):
            continue
        if len(ti) <= LEAF:
            i, j = met(t[:, ti], q[:, qi])
            out.append((ti[i], qi[j]))
            continue
        root = t[:, ti[:1]]
        from_root = lambda c, root=root: 2 * ones((c[0] ^ root[0]) | (c[1] ^ root[1])).astype(np.int64) + np.abs(c[3] - root[3])
        d, dq = from_root(t[:, ti]), from_root(q[:, qi])
        order, order_q = np.argsort(d, kind="stable"), np.argsort(dq, kind="stable")
        ti, qi, dq = ti[order], qi[order_q], dq[order_q]
        edge, starts = np.unique(d[order], return_index=True)
        ends = [*starts[1:].tolist(), len(ti)]
        first = 0
        for k, (a, b) in enumerate(zip(starts.tolist(), ends)):
            full = k + 1 == len(edge) or ends[k + 1] - starts[first] > LEAF
            if full or edge[k] == 0:
                lo, hi = np.searchsorted(dq, (edge[first] - RADIUS, edge[k] + RADIUS + 1)).tolist()
                if edge[k] == 0:  # the root and those like it
                    i, j = met(t[:, ti[a:b]], q[:, qi[lo:hi]])
                    out.append((ti[a:b][i], qi[lo:hi][j]))
                else:
                    todo.append((ti[starts[first] : b], qi[lo:hi]))
                first = k + 1
    return tuple(np.concatenate(x) for x in zip(*out))


def small_hits(key: np.ndarray, codes: np.ndarray, few: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, places) of the codes within the radius in the shards that are leaves, all of a batch together."""
    for lag in range(1, LEAF):
        i = np.flatnonzero((key[lag:] == key[:-lag]) & few[lag:])
        if not len(i):
            return
        i = i[alike(codes[:, i], codes[:, i + lag])]
        yield i, i + lag


def tree_hits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pairs within the radius in each shard; rows come sorted, those that only ask after those of the tree.

    The tree of the last shard of a batch is kept for those of its rows that come in the next.
    """
    now, kept, kept_rid = None, np.zeros((len(CODE), 0), dtype=np.int64), np.zeros(0, dtype=np.int64)
    for b in batches:
        if not len(b):
            continue
        key, rid = b["shard"].to_numpy(), b["rid"].to_numpy()
        codes = np.stack([b[c].to_numpy().astype(np.int64) for c in CODE])
        edges = np.concatenate([[0], np.flatnonzero(np.diff(key)) + 1, [len(b)]])
        sizes = np.diff(edges)
        found = [(rid[i], rid[j]) for i, j in small_hits(key, codes, np.repeat(sizes <= LEAF, sizes))]
        for k in np.flatnonzero(sizes > LEAF).tolist():
            own = slice(edges[k], edges[k + 1])
            i, j = near_all(codes[:, own][:, rid[own] > 0], codes[:, own])
            found.append((rid[own][i[i < j]], rid[own][j[i < j]]))
        if key[0] == now:
            i, j = near_all(kept, codes[:, : edges[1]])
            found.append((kept_rid[i], rid[: edges[1]][j]))
        last = np.flatnonzero(rid[edges[-2] :] > 0) + edges[-2]
        same = key[-1] == now
        kept = np.concatenate([kept, codes[:, last]], axis=1) if same else codes[:, last]
        kept_rid = np.concatenate([kept_rid, rid[last]]) if same else rid[last]
        now = key[-1]
        # of two that only ask, another shard has the tree
        x, y = (np.concatenate(v) for v in zip((kept_rid[:0],) * 2, *found))
        x, y = x[(x > 0) | (y > 0)], y[(x > 0) | (y > 0)]
        x, y = np.abs(x), np.abs(y)
        yield pd.DataFrame({"a": np.minimum(x, y), "b": np.maximum(x, y)})[x != y].drop_duplicates()


@lru_cache(4096)
def shingle_set(text: str) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes; texts of a group come again and again."""
    p = compact(text).astype(np.uint64)
    n = len(p) - SHINGLE + 1
    h = p[:n].copy()
    for k in range(1, SHINGLE):
        h *= _MIX
        h ^= h >> np.uint64(31)
        h += p[k : k + n]
    return distinct(h)


def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    def one(x: str, y: str) -> float:
        s, t = shingle_set(x), shingle_set(y)
        if len(s) > len(t):
            s, t = t, s
        both = int((t[np.minimum(np.searchsorted(t, s), len(t) - 1)] == s).sum())
        return both / (len(s) + len(t) - both)

    return pd.Series([one(x, y) for x, y in zip(a, b)], dtype="float64")


def class_links(rows: DataFrame, key: str, text: str, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(members, links): (key, id) of every row, and (a, b, similarity) of every two similar classes.

    What is shuffled per class and band is one row of three numbers; a class is represented by one of its rows.
    """
    every = checkpointed(signed(rows, key, text).withColumn("rid", F.monotonically_increasing_id() + 1))
    first = every.groupBy("id").agg(F.min("rid").alias("first"), F.count("*").alias("n")).filter("n > 1")
    copies = small_side(every.select("id", "rid").join(first, "id").filter("rid <> first").select("rid"))
    reps = every.join(copies, "rid", "left_anti")
    shards = sharded(reps, small_side(hot_bands(every)))
    found = (
        shards.repartition("shard")
        .sortWithinPartitions("shard", F.col("rid").desc())
        .mapInPandas(tree_hits, "a bigint, b bigint")
        .distinct()
    )
    found = checkpointed(found)
    wanted = small_side(found.select(F.col("a").alias("rid")).union(found.select("b")).distinct())
    asked = small_side(every.join(wanted, "rid", "left_semi").select("rid", "id", F.col("key").alias(key)))
    texts = checkpointed(rows.select(key, text).join(asked, key).groupBy("rid").agg(F.first("id").alias("id"), F.first(text).alias("t")))
    near = F.pandas_udf(similarity, "double")
    sides = [texts.select(F.col("rid").alias(c), F.col("id").alias(f"id_{c}"), F.col("t").alias(f"t{c}")) for c in "ab"]
    links = (
        found.join(sides[0], "a")
        .join(sides[1], "b")
        .select("id_a", "id_b", near("ta", "tb").alias("similarity"))
        .filter(F.col("similarity") >= threshold)
        .select(F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b"), "similarity")
    )
    return every.select("key", "id").distinct(), checkpointed(links)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of chunks of at least 0.7: between similar classes, and between the copies of one class."""
    members, links = class_links(table(spark, sf_dir, "chunks"), "chunk_id", "content")
    left, right = members.select(F.col("id").alias("a"), F.col("key").alias("x")), members.select(F.col("id").alias("b"), F.col("key").alias("y"))
    across = links.join(left, "a").join(right, "b").select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
    within = left.join(right, F.col("a") == F.col("b")).select("x", "y")
    return (
        across.union(within)
        .filter(F.col("x") < F.col("y"))
        .select(F.col("x").alias("chunk_id_a"), F.col("y").alias("chunk_id_b"))
        .distinct()
    )


def components(links: DataFrame) -> DataFrame:
    """(id, root) of every linked id: each takes the least id that it can reach, by repeated halving of the paths.

    Every round joins and checkpoints; rounds grow with the logarithm of a component's width.
    """
    edges = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    roots = checkpointed(edges.groupBy(F.col("a").alias("id")).agg(F.min(F.least("a", "b")).alias("root")))
    while True:
        around = edges.join(roots, edges["b"] == roots["id"]).select(F.col("a").alias("id"), "root")
        lower = roots.union(around).groupBy("id").agg(F.min("root").alias("root"))
        of_root = roots.select(F.col("id").alias("root"), F.col("root").alias("up"))
        new = checkpointed(lower.join(of_root, "root", "left").select("id", F.least("root", F.coalesce("up", "root")).alias("root")))
        moved = new.join(roots.withColumnRenamed("root", "before"), "id").filter(F.col("root") != F.col("before"))
        if moved.isEmpty():
            return new
        roots = new


def lone(rows: DataFrame, key: str, text: str, members: DataFrame) -> DataFrame:
    """(key, id) of the rows without a shingle; id is the digest of the key, as each is a class of its own."""
    short = F.length(F.translate(text, " \t\r\n", "")) < SHINGLE
    few = rows.filter(F.col(text).isNull() | short).select(F.col(key).alias("key")).distinct()
    return few.join(members, "key", "left_anti").select("key", F.unhex(F.md5(F.col("key").cast("binary"))).alias("id"))


def groups(rows: DataFrame, key: str, text: str) -> DataFrame:
    """(key, class_id, group_id, n_links), one row per key: its class, its group and how many classes its class is linked to."""
    members, links = class_links(rows, key, text)
    n = links.select(F.col("a").alias("id")).union(links.select("b")).groupBy("id").agg(F.count("*").alias("n_links"))
    return (
        members.union(lone(rows, key, text, members))
        .join(components(links), "id", "left")
        .join(n, "id", "left")
        .select(
            F.col("key").alias(key), F.lower(F.hex("id")).alias("class_id"),
            F.lower(F.hex(F.coalesce("root", "id"))).alias("group_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
        )
    )


def p5_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per chunk: its class, its group and the number of other classes that its class is linked to."""
    return groups(table(spark, sf_dir, "chunks"), "chunk_id", "content")
