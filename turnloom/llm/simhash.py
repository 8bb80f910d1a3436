"""SimHash near-duplicates: fingerprints, vantage-point shards, exact links within a Hamming radius, components.

How links are found:

1. Fingerprints are cut into ``radius + 1`` bands. Two fingerprints within the radius agree on one band at least, so
   each fingerprint goes to one shard a band and every link lies inside a shard.
2. A shard is searched around a vantage point: its rows are ordered by their Hamming distance to it, and by the
   triangle inequality two rows whose distances differ by more than the radius cannot link, so each row meets only the
   rows of the rings at most ``radius`` away.
3. A shard of more than ``LEAF`` rows (bits that very many fingerprints share) is first split: rings around the
   vantage point, large rings in pieces of ``LEAF`` rows, and a task for every two pieces whose rings lie within
   the radius. So no task holds more than two pieces, and no pair is left out.
4. A task passes on only pairs that join what it has not joined yet, about one a row; a group of thousands of copies never
   becomes all its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnloom.llm import common

BITS = 64
RADIUS = 4
SHINGLE = 4
SEED = 42
LEAF = 4_096
STEP = 65_536  # shingles counted at a time


def shingle_hashes(text: str | None, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """XXH64 of the ``size``-word shingles of a text, in steps: A-Z lower-cased, words cut at ASCII white space and joined by
    one space; fewer words give one shingle, none give none."""
    words = (text or "").encode().lower().split()
    if not words:
        return
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    joined = b" ".join(words)
    first, last = starts[: max(1, len(words) - size + 1)], ends[min(size, len(words)) - 1 :]
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(first), STEP):
        pairs = zip(first[at : at + STEP].tolist(), last[at : at + STEP].tolist(), strict=True)
        yield np.array([digest(joined[a:b], SEED) for a, b in pairs], dtype=np.uint64)


def majority(hashes: Iterator[np.ndarray]) -> int:
    """The bits that more than half the hashes have, as a signed 64-bit number; 0 for no hashes."""
    ones, n = np.zeros(BITS, dtype=np.int64), 0
    for part in hashes:
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
        n += len(part)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.int64)[0])


@F.pandas_udf(T.LongType())
def fingerprint(texts: pd.Series) -> pd.Series:
    """64-bit SimHash of 4-word shingles."""
    return pd.Series([majority(shingle_hashes(t)) for t in texts], dtype="int64")


def fingerprint_hex(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def bands(value: Column, radius: int = RADIUS) -> Column:
    """``radius + 1`` shard keys: band number and the bits of that band."""
    cuts = [BITS * i // (radius + 1) for i in range(radius + 2)]
    return F.array(
        *[
            F.struct(F.lit(i).alias("band"), F.shiftrightunsigned(value, a).bitwiseAND((1 << b - a) - 1).alias("bits"))
            for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))
        ]
    )


def leaves(rows: DataFrame, radius: int = RADIUS, leaf: int = LEAF) -> DataFrame:
    """Add ``leaf`` to rows of ``shard, fp``: the shard itself, or for a shard of more than ``leaf`` rows every pair of pieces that the
    row takes part in."""
    vantage = F.xxhash64(F.lit("vantage"), "shard")
    ring = F.bit_count(F.col("fp").bitwiseXOR(vantage))
    rows = rows.withColumn("ring", ring)
    counts = rows.groupBy("shard", "ring").agg(F.count("*").alias("n"))
    total = counts.groupBy("shard").agg(F.sum("n").alias("total")).filter(F.col("total") > leaf)
    pieces = counts.join(total, "shard").select(
        "shard", "ring", F.ceil(F.col("n") / leaf).alias("cut"), F.lit(True).alias("large")
    )
    piece = pieces.select("shard", "ring", F.explode(F.sequence(F.lit(0), F.col("cut").cast("int") - 1)).alias("piece"))
    other = piece.select("shard", F.col("ring").alias("ring2"), F.col("piece").alias("piece2"))
    meets = (
        piece.join(other, "shard")
        .filter(F.abs(F.col("ring") - F.col("ring2")) <= radius)
        .withColumn("one", F.struct("ring", "piece"))
        .withColumn("two", F.struct(F.col("ring2").alias("ring"), F.col("piece2").alias("piece")))
        .select(
            "shard",
            "ring",
            "piece",
            F.xxhash64("shard", F.least("one", "two"), F.greatest("one", "two")).alias("leaf"),
        )
    )
    large = pieces.select("shard", "ring", "cut")
    dealt = rows.join(large, ["shard", "ring"], "left").withColumn(
        "piece", F.pmod(F.xxhash64(F.lit("piece"), "fp"), F.coalesce("cut", F.lit(1))).cast("int")
    )
    whole = dealt.filter("cut is null").withColumn("leaf", F.xxhash64("shard"))
    split = dealt.filter("cut is not null").join(meets, ["shard", "ring", "piece"])
    keep = [*rows.columns, "leaf"]
    return whole.select(*keep).drop("ring").union(split.select(*keep).drop("ring"))


class Joined:
    """Union-find over the rows of one task, a whole array of pairs at a time."""

    def __init__(self, n: int) -> None:
        self.up = np.arange(n)

    def root(self, at: np.ndarray) -> np.ndarray:
        while True:
            above = self.up[at]
            if np.array_equal(above, at):
                return at
            self.up[at] = self.up[above]
            at = above

    def new(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which pairs join rows not joined yet; they are then."""
        ra, rb = self.root(a), self.root(b)
        fresh = ra != rb
        ra, rb = ra[fresh], rb[fresh]
        while len(ra):
            np.minimum.at(self.up, np.maximum(ra, rb), np.minimum(ra, rb))
            ra, rb = self.root(ra), self.root(rb)
            apart = ra != rb
            ra, rb = ra[apart], rb[apart]
        return fresh


Check = Callable[[int, int], bool]


def link_rows(leaf: np.ndarray, fp: np.ndarray, radius: int, check: Check | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of linking pairs that span every group of linked rows in a leaf. ``check`` has the last word on a pair."""
    vantage = leaf.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    vantage ^= vantage >> np.uint64(29)
    far = np.bitwise_count(fp ^ vantage).astype(np.int16)
    order = np.lexsort((far, leaf))
    leaf, fp, far = leaf[order], fp[order], far[order]
    joined, left, right = Joined(len(fp)), [], []
    at, k = np.arange(len(fp)), 0
    while True:
        k += 1
        at = at[at + k < len(fp)]
        at = at[(leaf[at + k] == leaf[at]) & (far[at + k] - far[at] <= radius)]
        if not len(at):
            break
        hit = at[np.bitwise_count(fp[at] ^ fp[at + k]) <= radius]
        if check is not None and len(hit):
            hit = hit[joined.root(hit) != joined.root(hit + k)]
            hit = hit[[check(order[i], order[i + k]) for i in hit.tolist()]] if len(hit) else hit
        if len(hit):
            hit = hit[joined.new(hit, hit + k)]
            left.append(order[hit])
            right.append(order[hit + k])
    none = np.empty(0, dtype=np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def by_leaf(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Regroup batches sorted by ``leaf`` so that no leaf is cut."""
    rest: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        if rest and rest[0]["leaf"].iloc[0] == batch["leaf"].iloc[-1]:
            rest.append(batch)
            continue
        last = batch["leaf"].iloc[-1]
        cut = int(np.searchsorted(batch["leaf"].to_numpy(), last))
        yield pd.concat([*rest, batch.iloc[:cut]], ignore_index=True)
        rest = [batch.iloc[cut:]]
    if rest:
        yield pd.concat(rest, ignore_index=True)


def in_leaves(rows: DataFrame, *cols: str) -> DataFrame:
    """Rows with all of a leaf in one task, sorted by it."""
    return rows.select("leaf", *cols).repartition("leaf").sortWithinPartitions("leaf")


def links(fingerprints: DataFrame, radius: int = RADIUS, leaf: int = LEAF) -> DataFrame:
    """``a, b``: pairs of the distinct ``fp`` values at ``radius`` or fewer differing bits, enough to connect every group."""
    shards = F.transform(bands(F.col("fp"), radius), lambda b: F.xxhash64(b["band"], b["bits"]))
    rows = fingerprints.select("fp", F.explode(shards).alias("shard"))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in by_leaf(batches):
            fp = part["fp"].to_numpy()
            a, b = link_rows(part["leaf"].to_numpy(), fp.view(np.uint64), radius)
            yield pd.DataFrame({"a": fp[a], "b": fp[b]})

    return in_leaves(leaves(rows, radius, leaf), "fp").mapInPandas(search, "a long, b long")


def near_duplicates(docs: DataFrame, radius: int = RADIUS, leaf: int = LEAF) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row of ``docs`` (``doc_id, text``; other columns are not read).

    Documents link when their fingerprints differ in ``radius`` or fewer bits; the component is the smallest doc_id that
    links lead to. Null and empty texts have fingerprint 0, which links like any other. Repeated rows stay repeated. A
    row without doc_id keeps its links but lends no number: its component is the smallest doc_id of the others, or null.
    An empty table gives no rows.
    """
    prints = common.settle(docs.select(F.col("doc_id").cast("long").alias("doc_id"), fingerprint("text").alias("fp")))
    classes = common.settle(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    component = common.connected_components(links(classes.select("fp"), radius, leaf))
    known = classes.join(component.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "component", F.coalesce("component", "fp")
    )
    least = known.groupBy("component").agg(F.min("least").alias("component_id"))
    named = known.join(least, "component").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id")


# ---- near copies: shards on keys that similar texts share, with an exact check of every link
#
# 1. Texts with equal shingle sets are linked to one of them, which stands for all below.
# 2. The rows of a shard are checked against a few leaders of it, in joins whose rows grow with the shard and not with its square.
# 3. A pair that links connect by now needs no check. Only shards with two components or more are searched pair by pair, the
#    large ones in bounded pieces; two pieces of one component are not laid together.

SIMILARITY = 0.8
WORDS = 5
KEYS = 8  # min-hashes: a pair at similarity 0.8 shares none of them in 0.2 ** 8 of cases
BROADCAST_ROWS = 500_000  # of 41 bytes
PARITY = 4  # longs of a set's parity bits
LEADERS = 2  # of a ring of a shard
LOAD = 1_024  # shingles that weigh as much as a row
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(values: np.ndarray, seed: int) -> np.ndarray:
    values = (values ^ np.uint64(seed * 0xD1B54A32D192ED03 % 2**64)) * _MIX
    return values ^ values >> np.uint64(32)


def shingle_set(text: str | None, size: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit codes of the ``size``-word shingles; fewer words are one shingle."""
    parts = list(shingle_hashes(text, size))
    return np.unique(np.concatenate(parts)) if parts else np.empty(0, dtype=np.uint64)


def parity(codes: np.ndarray) -> np.ndarray:
    """Whether each of 64 * PARITY buckets holds an odd number of codes. Two sets differ in at least as many codes as bits."""
    odd = np.bincount((codes % np.uint64(64 * PARITY)).astype(np.int64), minlength=64 * PARITY) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


LONGS = T.ArrayType(T.LongType())


@F.pandas_udf(T.StructType().add("size", T.LongType()).add("bits", LONGS).add("keys", LONGS).add("same", T.StringType()))
def signature(texts: pd.Series) -> pd.DataFrame:
    """Number, parity bits and min-hashes of a text's distinct five-word shingles, and 128 bits that equal sets share."""
    sets = [shingle_set(t) for t in texts]
    keys = [[int(_mixed(s, t + 1).min().view(np.int64)) for t in range(KEYS)] if len(s) else [] for s in sets]
    same = [xxhash.xxh3_128_hexdigest(s.tobytes()) if len(s) else None for s in sets]
    bits = [parity(s).tolist() for s in sets]
    return pd.DataFrame({"size": [len(s) for s in sets], "bits": bits, "keys": keys, "same": pd.Series(same, dtype=object)})


@F.pandas_udf(T.ArrayType(T.LongType()))
def shingle_sets(texts: pd.Series) -> pd.Series:
    return pd.Series([shingle_set(t).view(np.int64) for t in texts])


def alike(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> bool:
    """Whether the Jaccard similarity of two arrays of distinct values is at least ``least``."""
    if min(len(a), len(b)) < least * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= least * (len(a) + len(b) - both) - 1e-9


def size_ring(size: Column, least: float) -> Column:
    """Rings of set sizes: sets of a similarity of at least ``least`` lie in one ring or two neighbouring ones."""
    return F.floor(F.log(size) / max(math.log(1 / least) * (1 + 1e-6), 1e-6))


def set_leaves(rows: DataFrame, leaf: int = LEAF) -> DataFrame:
    """Add ``leaf`` to rows of ``shard, node, ring, size, part``: the shard itself, or for a shard of a load over ``leaf`` every pair of pieces,
    in one ring or neighbouring ones, that the row takes part in.

    A row's load is 1, or one for every ``LOAD`` shingles; a piece is about ``leaf`` of it, cut by ``node``, which no two rows of a shard
    share. A ``part`` (rows connected already) of more than that has pieces of its own, which do not meet each other.
    """
    load = F.greatest(F.lit(1.0), F.col("size") / LOAD)
    parts = rows.groupBy("shard", "ring", "part").agg(F.sum(load).alias("n"))
    parts = common.settle(parts.withColumn("own", F.when(F.col("n") > leaf, F.col("part")).otherwise("")))
    total = parts.groupBy("shard").agg(F.sum("n").alias("total")).filter(F.col("total") > leaf).select("shard")
    large = parts.join(total, "shard").groupBy("shard", "ring", "own").agg(F.ceil(F.sum("n") / leaf).cast("int").alias("cut"))
    piece = large.select("shard", "ring", "own", F.explode(F.sequence(F.lit(0), F.col("cut") - 1)).alias("piece"))
    other = piece.select("shard", F.struct("ring", "own", "piece").alias("two"))
    meets = (
        piece.withColumn("one", F.struct("ring", "own", "piece"))
        .join(other, "shard")
        .filter(F.abs(F.col("ring") - F.col("two.ring")) <= 1)
        .filter((F.col("own") == "") | (F.col("own") != F.col("two.own")))
        .withColumn("leaf", F.xxhash64("shard", F.least("one", "two"), F.greatest("one", "two")))
        .select("shard", "ring", "own", "piece", "leaf")
    )
    owned = parts.filter("own != ''").select("shard", "ring", "part", "own")
    dealt = rows.join(owned, ["shard", "ring", "part"], "left").withColumn("own", F.coalesce("own", F.lit("")))
    dealt = dealt.join(large, ["shard", "ring", "own"], "left")
    keep = [*rows.columns, "leaf"]
    whole = dealt.filter("cut is null").withColumn("leaf", F.xxhash64("shard")).select(*keep)
    cut = dealt.filter("cut is not null").withColumn("piece", F.pmod(F.xxhash64(F.lit("piece"), "node"), "cut").cast("int"))
    return whole.union(cut.join(meets, ["shard", "ring", "own", "piece"]).select(*keep))


def link_sets(
    leaf: np.ndarray, size: np.ndarray, bits: np.ndarray, part: np.ndarray, sets: list[np.ndarray], least: float
) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of alike pairs that, with what joins the rows of a ``part``, span every group of alike rows in a leaf. Sizes and
    parity bits leave out only pairs whose similarity they prove to be lower."""
    order = np.lexsort((size, leaf))
    leaf, size, bits = leaf[order], size[order], bits[order]
    joined, left, right = Joined(len(size)), [], []
    number, names = pd.factorize(part[order])
    first = np.full(len(names), len(size))
    np.minimum.at(first, number, np.arange(len(size)))
    joined.new(np.arange(len(size)), first[number])
    at, k = np.arange(len(size)), 0
    while True:
        k += 1
        at = at[at + k < len(size)]
        at = at[(leaf[at + k] == leaf[at]) & (size[at] >= least * size[at + k])]
        if not len(at):
            break
        hit = at[joined.root(at) != joined.root(at + k)]
        apart = np.bitwise_count(bits[hit] ^ bits[hit + k]).sum(axis=1)
        hit = hit[apart <= (size[hit] + size[hit + k]) * (1 - least) / (1 + least) + 1e-6]
        hit = hit[[alike(sets[order[i]], sets[order[i + k]], least) for i in hit.tolist()]] if len(hit) else hit
        if len(hit):
            hit = hit[joined.new(hit, hit + k)]
            left.append(order[hit])
            right.append(order[hit + k])
    none = np.empty(0, dtype=np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def led_pairs(rows: DataFrame, leaders: DataFrame, least: float) -> DataFrame:
    """``a, b``: the rows of a shard with the leaders of their ring and the next, without pairs that sizes or parity bits rule out."""
    lead = leaders.select("shard", F.explode(F.array("ring", F.col("ring") - 1)).alias("ring"), "lead")
    both = F.col("size") + F.col("lead.size")
    bits = F.zip_with("bits", "lead.bits", lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    near = (
        (F.col("node") != F.col("lead.node"))
        & (F.least("size", "lead.size") >= least * F.greatest("size", "lead.size"))
        & (F.aggregate(bits, F.lit(0), lambda n, x: n + x) <= both * ((1 - least) / (1 + least)) + 1e-6)
    )
    pairs = rows.join(lead, ["shard", "ring"]).filter(near)
    return pairs.select(F.least("node", "lead.node").alias("a"), F.greatest("node", "lead.node").alias("b")).distinct()


def similar_links(docs: DataFrame, classes: DataFrame, least: float = SIMILARITY, leaf: int = LEAF) -> DataFrame:
    """``a, b``: nodes of ``classes`` (``node, size, bits, keys, same``; one row a distinct text) whose texts are alike, or connected by such
    links, enough to connect every group.

    Only texts that share a min-hash with another one are looked at; their shingle sets travel to the pairs and shards.
    """
    one = classes.groupBy(F.coalesce("same", "node").alias("same"))
    one = common.settle(one.agg(F.min("node").alias("node"), *[F.first(c).alias(c) for c in ["size", "bits", "keys"]]))
    copies = classes.select("same", F.col("node").alias("a")).join(one.select("same", F.col("node").alias("b")), "same")
    copies = copies.filter("a != b").select("a", "b")

    shards = F.transform("keys", lambda key, t: F.xxhash64(t, key))
    rows = one.select("node", "size", "bits", F.explode(F.array_distinct(shards)).alias("shard"))
    live = rows.groupBy("shard").agg(F.count("*").alias("_n")).filter("_n > 1").select("shard")
    rows = rows.join(live, "shard", "left_semi").withColumn("ring", size_ring(F.col("size"), least))
    rows = common.settle(rows)
    wanted = common.settle(rows.select("node").distinct())
    # where they are few, all other texts stay where they are
    wanted = F.broadcast(wanted) if wanted.count() <= BROADCAST_ROWS else wanted
    text = docs.select(_node(F.col("text")).alias("node"), "text").join(wanted, "node", "left_semi")
    sets = common.one_row_each(text, [F.col("node")], [F.col("node")]).select("node", shingle_sets("text").alias("set"))
    sets = common.settle(sets)

    place = F.xxhash64(F.lit("leader"), "node")
    leaders = rows.groupBy("shard", "ring", F.pmod(place, F.lit(LEADERS)).alias("turn"))
    leaders = leaders.agg(F.min(F.struct(place, "node", "size", "bits")).alias("lead"), F.count("*").alias("n"))
    leaders = common.settle(leaders)

    @F.pandas_udf(T.BooleanType())
    def similar(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([alike(x, y, least) for x, y in zip(a, b, strict=True)], dtype=bool)

    checked = led_pairs(rows, leaders, least)
    for end in ("a", "b"):
        checked = checked.join(sets.select(F.col("node").alias(end), F.col("set").alias(f"set_{end}")), end)
    led = common.connected_components(checked.filter(similar("set_a", "set_b")).select("a", "b"))

    part = F.coalesce("component", "node")
    parted = rows.join(led, "node", "left").select(*rows.columns, part.alias("part"))
    apart = parted.groupBy("shard").agg(F.min("part").alias("_a"), F.max("part").alias("_b")).filter("_a != _b")
    # where every row is a leader, all pairs are checked
    unseen = leaders.groupBy("shard").agg(F.max("n").alias("_n")).filter("_n > 1")
    parted = parted.join(apart, "shard", "left_semi").join(unseen, "shard", "left_semi")
    dealt = set_leaves(common.settle(parted), leaf).join(sets, "node")

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in by_leaf(batches):
            node, size = rows["node"].to_numpy(), rows["size"].to_numpy()
            bits = np.array(rows["bits"].to_list(), dtype=np.int64).reshape(-1, PARITY).view(np.uint64)
            a, b = link_sets(
                rows["leaf"].to_numpy(), size, bits, rows["part"].to_numpy(), rows["set"].to_list(), least
            )
            yield pd.DataFrame({"a": node[a], "b": node[b]})

    rest = in_leaves(dealt, "node", "size", "bits", "part", "set").mapInPandas(search, "a string, b string")
    return copies.union(led.toDF("a", "b")).union(rest)


def _node(text: Column) -> Column:
    return F.concat_ws(":", *common.text_key(F.coalesce(text, F.lit(""))))


def fingerprint_links(classes: DataFrame, radius: int = RADIUS, leaf: int = LEAF) -> DataFrame:
    """``a, b``: nodes of ``classes`` (``node, fp``) whose fingerprints differ in ``radius`` or fewer bits, enough to connect every group."""
    one = common.settle(classes.groupBy("fp").agg(F.min("node").alias("one")))
    equal = classes.join(one, "fp").select(F.col("node").alias("a"), F.col("one").alias("b")).filter("a != b")
    found = links(one.select("fp"), radius, leaf)
    for end in ("a", "b"):
        found = found.join(one.select(F.col("fp").alias(end), F.col("one").alias(f"_{end}")), end).drop(end)
    return equal.union(found.select("_a", "_b"))


def without_near_copies(
    docs: DataFrame, least: float = SIMILARITY, leaf: int = LEAF, radius: int | None = None
) -> DataFrame:
    """``docs`` (``doc_id, text``, any other columns) with one document of each group of near copies: the smallest doc_id.

    Texts are near copies when their sets of five-word shingles (A-Z lower-cased, words cut at white space; fewer words are one
    shingle) have a Jaccard similarity of at least ``least``, and so is what a chain of such links connects. Equal texts are
    copies whatever their words; null and empty texts are equal. With ``radius`` texts are near copies, too, when their SimHash fingerprints
    differ in so many bits or fewer, found and linked as ``near_duplicates`` does it; a chain may have links of both kinds. A null
    doc_id comes last; of repeated rows one stays. An empty table gives no rows.
    """
    ident, node = (common.fresh(n, docs.columns) for n in ("_id", "_node"))
    sig = signature("text")
    prints = [] if radius is None else [fingerprint("text").alias("fp")]
    marked = docs.select(F.col("doc_id"), _node(F.col("text")).alias("node"), sig.alias("sig"), *prints)
    marked = common.settle(marked.select("doc_id", "node", "sig.*", *(["fp"] if prints else [])))
    order, traits = F.struct(F.col("doc_id").isNull(), "doc_id", "node"), ["size", "bits", "keys", "same"]
    traits += ["fp"] if prints else []
    classes = common.settle(
        marked.groupBy("node").agg(*[F.first(c).alias(c) for c in traits], F.min(order).alias("first"))
    )
    found = similar_links(docs, classes.drop("first", "fp"), least, leaf)
    if radius is not None:
        found = found.union(fingerprint_links(classes, radius, leaf))
    component = common.connected_components(found)
    groups = classes.select("node", "first").join(component, "node", "left")
    kept = groups.groupBy(F.coalesce("component", "node")).agg(F.min("first").alias("first"))
    kept = common.settle(kept.select(F.xxhash64("first.doc_id").alias(ident), F.col("first.node").alias(node)))
    marked = docs.withColumns({ident: F.xxhash64("doc_id"), node: _node(F.col("text"))})
    alone = marked.join(kept, [ident, node], "left_semi")
    return common.one_row_each(alone, [F.col(ident), F.col(node)], [F.col(ident)]).drop(ident, node)
