"""Benchmark decontamination: SimHash of item-sized windows, a multi-index over Hamming blocks, exact verification.

For a document and an item of n words:

1. A window of n words can only be similar if it holds shingles of the item. Moved to its first such shingle (or, cut by the
   start of the text, shortened to its last) it is no less similar, so windows are laid there only, and only where
   enough shingles lie inside for the similarity asked. Nothing is lost by either condition.
2. Windows and items get a 64-bit SimHash of their words. Items are indexed by ``radius + 1`` blocks of the fingerprint
   and their size; two fingerprints within the radius share a block, so a window finds every item within it.
3. What is found is verified on the words themselves: the weighted Jaccard similarity of the five-word shingles, with
   their multiplicities as weights.

Everything but the index is row-local: documents are neither shuffled nor compared with each other. The index is shipped in
blocks of at most ``BLOCK`` bytes of item text, so its size is bounded however large the benchmark is.
"""

from __future__ import annotations

import pickle
import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import xxhash
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 15
BLOCK = 8_000_000
BITS = 64
WORD = re.compile(r"\w+")
LEAKS = "array<struct<item_id:long,similarity:double,start:int,words:int>>"
MIX = np.uint64(0x9E3779B97F4A7C15)
FILTER = 1 << 22


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def word_hashes(tokens: list[str]) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.array([digest(t) for t in tokens], dtype=np.uint64)


def shingle_codes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit code of every ``size``-word shingle."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    codes = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        codes = (codes ^ hashes[k : n + k]) * MIX
        codes ^= codes >> np.uint64(29)
    return codes


def fingerprint(hashes: np.ndarray) -> int:
    """SimHash of a bag of words."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0)
    return int(np.packbits(bits * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def similarity(a: list[str], b: list[str], size: int) -> float:
    """Weighted Jaccard similarity of the ``size``-word shingles; fewer words are one shingle."""
    one, two = (
        Counter(tuple(t[i : i + size]) for i in range(max(1, len(t) - size + 1))) if t else Counter() for t in (a, b)
    )
    both = sum((one & two).values())
    return both / max(1, one.total() + two.total() - both)


class Index:
    """Items by shingle and, for each item size, by fingerprint block."""

    def __init__(self, items: list[tuple[int | None, str | None]], least: float, radius: int) -> None:
        self.least, self.radius = least, radius
        self.items = [(i, w) for i, w in ((i, words(t)) for i, t in items) if w]
        self.sizes, self.prints, self.at = [], [], defaultdict(list)
        self.blocks: dict[tuple[int, int, int], list[int]] = defaultdict(list)
        for number, (_, tokens) in enumerate(self.items):
            hashes = word_hashes(tokens)
            size = min(SHINGLE, len(tokens))
            self.sizes.append(size)
            self.prints.append(fingerprint(hashes))
            for code in set(shingle_codes(hashes, size).tolist()):
                self.at[size, code].append(number)
            for key in self.keys(len(tokens), self.prints[-1]):
                self.blocks[key].append(number)
        self.masks = {}
        for size in set(self.sizes):
            mask = np.zeros(FILTER, dtype=bool)
            mask[[code % FILTER for s, code in self.at if s == size]] = True
            self.masks[size] = mask

    def keys(self, n: int, value: int) -> list[tuple[int, int, int]]:
        cuts = [BITS * i // (self.radius + 1) for i in range(self.radius + 2)]
        return [(n, i, value >> a & (1 << b - a) - 1) for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]

    def windows(self, hashes: np.ndarray) -> set[tuple[int, int]]:
        """``(start, item size)`` of the windows that hold enough shingles of some item of that size."""
        met: dict[int, set[int]] = defaultdict(set)
        for size, mask in self.masks.items():
            codes = shingle_codes(hashes, size)
            for place in np.nonzero(mask[codes % np.uint64(FILTER)])[0].tolist():
                for number in self.at.get((size, int(codes[place])), ()):
                    met[number].add(place)
        found = set()
        for number, at in met.items():
            n, size = len(self.items[number][1]), self.sizes[number]
            places = np.array(sorted(at))
            cut = places + size - n
            starts = np.concatenate([cut[cut < 0], places])
            inside = np.searchsorted(places, starts + n - size, side="right") - np.searchsorted(places, starts)
            found.update((s, n) for s in starts[inside >= self.least * (n - size + 1) - 1e-9].tolist())
        return found

    def leaks(self, text: str | None) -> list[dict]:
        tokens = words(text)
        if not tokens or not self.items:
            return []
        hashes = word_hashes(tokens)
        best: dict[int, tuple[float, int, int]] = {}
        for start, n in sorted(self.windows(hashes)):
            a, b = max(0, start), min(len(tokens), start + n)
            value = fingerprint(hashes[a:b])
            for number in {x for key in self.keys(n, value) for x in self.blocks.get(key, ())}:
                if (value ^ self.prints[number]).bit_count() > self.radius:
                    continue
                worth = similarity(tokens[a:b], self.items[number][1], self.sizes[number])
                if worth >= self.least and (number not in best or worth > best[number][0]):
                    best[number] = (worth, a, b - a)
        return [
            {"item_id": self.items[k][0], "similarity": s, "start": a, "words": n} for k, (s, a, n) in sorted(best.items())
        ]


def _search(shipped: Broadcast[bytes]) -> Column:
    @F.pandas_udf(LEAKS)
    def search(texts: pd.Series) -> pd.Series:
        index = pickle.loads(shipped.value)
        return pd.Series([index.leaks(t) for t in texts])

    return search("text")


def leaks(docs: DataFrame, benchmark: DataFrame, least: float = SIMILARITY, radius: int = RADIUS) -> Column:
    """Array of the benchmark items that a text of ``docs`` holds: item_id, similarity, first word and number of words of the
    best window.

    Words are runs of letters and digits, lower-cased. Near the ends of a text a window is cut to the text. Items of
    fewer than five words have one shingle; items and texts without words match nothing. ``benchmark`` is ``item_id,
    text``; repeated items are each reported.
    """
    spark = docs.sparkSession
    total = benchmark.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    blocks = -(-total // BLOCK)
    items = benchmark.select(F.col("item_id").cast("long"), "text")
    found = []
    for block in range(blocks):
        own = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()  # about BLOCK bytes
        shipped = spark.sparkContext.broadcast(
            cloudpickle.dumps(Index(sorted(map(tuple, own), key=lambda r: (r[0] is None, r)), least, radius))
        )

        found.append(_search(shipped))
    return F.concat(*found) if found else F.array().cast(LEAKS)


def contaminated(docs: DataFrame, benchmark: DataFrame, least: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """``doc_id, item_id, similarity, start, words``: every document (row) and item at similarity ``least`` or more."""
    return docs.select("doc_id", F.explode(leaks(docs, benchmark, least, radius)).alias("_leak")).select(
        "doc_id", "_leak.*"
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame, least: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; all columns, repeated rows, null and empty texts stay."""
    return docs.filter(F.size(leaks(docs, benchmark, least, radius)) == 0)
