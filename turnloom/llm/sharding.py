"""Sharding: indivisible groups of documents packed best-fit-decreasing into shards.

Best-fit-decreasing looks at group sizes only, and groups of one size are interchangeable, so the sequential part runs over
a table of sizes with counts: exact below ``EXACT`` bytes, above it rounded up to one part in ``2 ** DIGITS``. That
table has at most ``EXACT + 2 ** DIGITS * 48`` rows however many groups there are. What it decides, "the first 5 groups of
size 812 to shard 3, the next 2 to shard 0", is applied to all groups by Spark: each gets its rank among the
groups of its size, from ranks in pieces of a size and the pieces' counts.
"""

from __future__ import annotations

import random


import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnloom.llm import common

EXACT, DIGITS = 65_536, 12
PIECE = 50_000  # rows ranked by one window


class Bins:
    """Open bins by remaining capacity: a treap, a search tree that its random heap order keeps balanced."""

    def __init__(self) -> None:
        self.top, self.random = None, random.Random(1)

    def _split(self, node, key):
        if node is None:
            return None, None
        if node[0] < key:
            a, b = self._split(node[3], key)
            return [node[0], node[1], node[2], a], b
        a, b = self._split(node[2], key)
        return a, [node[0], node[1], b, node[3]]

    def _merge(self, a, b):
        if a is None or b is None:
            return a if b is None else b
        if a[1] > b[1]:
            return [a[0], a[1], a[2], self._merge(a[3], b)]
        return [b[0], b[1], self._merge(a, b[2]), b[3]]

    def add(self, remaining: int, number: int) -> None:
        a, b = self._split(self.top, (remaining, number))
        self.top = self._merge(self._merge(a, [(remaining, number), self.random.random(), None, None]), b)

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Remove and return the bin with the least remaining capacity that holds ``size``; the lower number on a tie."""
        node, found = self.top, None
        while node is not None:
            found, node = (node[0], node[2]) if node[0] >= (size, -1) else (found, node[3])
        if found is not None:
            a, rest = self._split(self.top, found)
            _, b = self._split(rest, (found[0], found[1] + 1))
            self.top = self._merge(a, b)
        return found


def best_fit(sizes: list[tuple[int, int]], capacity: int, most: int | None = None) -> list[tuple[int, int]] | None:
    """``(bin, groups)`` runs for ``(size, count)`` pairs in falling size; None if more than ``most`` bins were needed.

    As many groups of a size as fit go to a bin at once: after one is placed the bin is still the tightest that fits. A
    group larger than the capacity gets a bin of its own.
    """
    bins, runs, opened = Bins(), [], 0
    for size, count in sizes:
        while count:
            found = bins.take_tightest(size)
            if found is None:
                if opened == most:
                    return None
                found, opened = (max(capacity, size), opened), opened + 1
            remaining, number = found
            n = min(count, remaining // size)
            runs.append((number, n))
            count -= n
            bins.add(remaining - n * size, number)
    return runs


def even(sizes: list[tuple[int, int]], shards: int) -> list[tuple[int, int]]:
    """Best fit with the smallest capacity that needs no more than ``shards`` bins.

    A group that is larger than an even share first gets a bin for itself, and the rest is shared by the other bins.
    """
    sizes, alone = [list(x) for x in sizes], []
    total = sum(size * n for size, n in sizes)
    while sizes and shards - len(alone) > 1 and sizes[0][0] * (shards - len(alone)) >= total:
        total -= sizes[0][0]
        alone.append((len(alone), 1))
        sizes[0][1] -= 1
        if not sizes[0][1]:
            sizes.pop(0)
    if not sizes:
        return alone
    left = shards - len(alone)
    low = -(-total // left)
    high = low + sizes[0][0]
    low = max(low, sizes[0][0])
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if best_fit(sizes, middle, left) is not None else (middle + 1, high)
    return alone + [(number + len(alone), n) for number, n in best_fit(sizes, high, left)]


def size_class(size: Column) -> Column:
    step = F.call_function("shiftleft", F.lit(1).cast("long"), F.floor(F.log2(size)).cast("int") - DIGITS)
    return F.when(size < EXACT, size).otherwise(F.ceil(size / step).cast("long") * step)


def _ranked(rows: DataFrame, group: str, cut: Column, order: list[str], name: str) -> DataFrame:
    """Add the rank (from 0) of a row in its group, cut by hash into ``cut`` pieces that are ranked apart."""
    piece = Window.partitionBy(group, "_piece").orderBy(*order)
    rows = rows.withColumn("_piece", F.pmod(F.xxhash64(F.lit("piece"), *order), cut))
    before = Window.partitionBy(group).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy(group, "_piece")
        .agg(F.count("*").alias("_n"))
        .select(group, "_piece", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    ranked = rows.withColumn("_in", F.row_number().over(piece) - 1)
    return ranked.join(starts, [group, "_piece"]).withColumn(name, F.col("_start") + F.col("_in")).drop(
        "_piece", "_in", "_start"
    )


def pack(docs: DataFrame, shards: int | None = None, capacity: int | None = None) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` of every row of ``docs`` (``doc_id, text``; other columns are not read).

    Give ``shards`` for that many of near-equal bytes, or ``capacity`` for as few shards of that many bytes as best fit
    needs. Size is the UTF-8 bytes of the text plus 1 (a null text: 1, crc32 null). Rows with equal texts are one group
    and share a shard; null and empty texts are two groups. ``slot`` numbers the rows of a shard from 0. Repeated rows
    stay repeated, each with its slot; doc_id may be null. An empty table gives no rows.
    """
    if (shards is None) == (capacity is None):
        raise ValueError("give either shards or capacity")
    spark = docs.sparkSession
    rows = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
        *[k.alias(f"_g{i}") for i, k in enumerate(common.text_key(F.col("text")))],
    )
    groups = common.settle(
        rows.groupBy("_g0", "_g1", "size")
        .agg(F.count("*").alias("copies"))
        .withColumn("class", size_class(F.col("size") * F.col("copies")))
    )
    counted = groups.groupBy("class").agg(F.count("*").alias("n"), F.sum("copies").alias("rows"))
    table = sorted(((r["class"], r["n"], r["rows"]) for r in counted.collect()), reverse=True)  # bounded, see above
    if not table:
        empty = rows.select("doc_id", "size", "text_crc32")
        return empty.withColumns({"shard": F.lit(0), "slot": F.lit(0).cast("long")}).limit(0)
    sizes = [(size, n) for size, n, _ in table]
    runs = best_fit(sizes, capacity) if shards is None else even(sizes, shards)
    base = np.concatenate([[0], np.cumsum([n for _, n in sizes])])[:-1]
    cuts = pd.DataFrame(
        {"class": [s for s, _ in sizes], "_base": base, "_cut": [-(-n // PIECE) for _, n in sizes]}, dtype="int64"
    )
    cuts = F.broadcast(spark.createDataFrame(cuts, "class long, _base long, _cut long"))
    placed = _ranked(groups.join(cuts, "class"), "class", F.col("_cut"), ["_g0", "_g1", "size"], "_rank")
    starts = np.cumsum([0] + [n for _, n in runs])[:-1]
    numbers = np.array([number for number, _ in runs], dtype=np.int32)

    @F.pandas_udf("int")
    def shard_at(position: pd.Series) -> pd.Series:
        return pd.Series(numbers[np.searchsorted(starts, position.to_numpy(), side="right") - 1])

    placed = placed.select("_g0", "_g1", "size", shard_at(F.col("_base") + F.col("_rank")).alias("shard"))
    dealt = rows.join(placed, ["_g0", "_g1", "size"])
    pieces = F.lit(max(1, sum(n for *_, n in table) // PIECE)).cast("long")
    slots = _ranked(dealt, "shard", pieces, ["doc_id", "_g0", "_g1"], "slot")
    return slots.select("doc_id", "size", "text_crc32", "shard", F.col("slot").cast("long").alias("slot"))
