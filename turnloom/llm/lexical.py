"""Ranked lexical search by scanning documents with an Aho-Corasick automaton of the items' terms.

No index of the documents is made: an automaton of all terms, each guarded by a separator on both sides so that it matches whole
terms only, is broadcast and run over every text. Its matches are the term frequencies; every term leads to the items that hold it. Two
scans are made. The first counts documents, terms and the documents of each item term; the second scores and keeps each item's best
``k`` of a task, compared exactly with ties, before anything is shuffled.

Items are taken in blocks of a checked size, one automaton and two scans a block, so what is broadcast does not grow with the number of items.
"""

from __future__ import annotations

import math
import pickle
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# What a term is made of, the upper-case letters, and the constants of the score.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BASE, SHARE, GAIN, UNIT = 100, 90, 8, 1_000_000_000

BLOCK = 16_000_000  # bytes of the terms of an automaton; twice as many at most, or one item
GROUP = 1_000_000  # document-item cells scored at a time
HELD = 200_000  # candidates kept by a task before they are cut to the best
SALTS = 32
LAST = 2**63 - 1

# bytes of a text with its letters in lower case and a space for everything that ends a term
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def terms_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(TERM), F.lit(0))


def item_terms(items: DataFrame, item: str, text: str) -> DataFrame:
    """``item_id, terms``: the distinct terms of every item; rows of one id are one item."""
    rows = items.select(F.col(item).cast("long").alias("item_id"), F.explode(terms_of(F.col(text))).alias("term"))
    return rows.distinct().groupBy("item_id").agg(F.sort_array(F.collect_list("term")).alias("terms"))


def blocks_of(held: DataFrame, most: int) -> list[DataFrame]:
    """``held`` in parts of at most twice ``most`` bytes of terms (or one item), by the hash of the id; sizes are measured first."""
    cost = F.aggregate("terms", F.lit(64).cast("long"), lambda a, t: a + F.octet_length(t) + 16)
    sized = held.withColumn("bytes", cost)
    parts = max(1, math.ceil((sized.agg(F.sum("bytes")).first()[0] or 0) / most))
    while True:
        part = F.pmod(F.xxhash64("item_id"), F.lit(parts))
        sizes = sized.groupBy(part.alias("part")).agg(F.sum("bytes").alias("bytes"), F.count("*").alias("items")).collect()
        if all(r.bytes <= 2 * most or r["items"] == 1 for r in sizes):
            return [held.filter(part == r.part) for r in sorted(sizes, key=lambda r: r.part)]
        parts *= 2


class Terms:
    """The terms of a block of items: an automaton over them, and for each term the items that hold it."""

    def __init__(self, rows: list[tuple[int | None, list[str]]]) -> None:
        self.items = [i for i, _ in rows]
        places: dict[str, list[int]] = {}
        for at, (_, terms) in enumerate(rows):
            for term in terms:
                places.setdefault(term, []).append(at)
        self.terms = sorted(places)
        self.sizes = np.array([len(places[t]) for t in self.terms], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        self.places = np.array([p for t in self.terms for p in places[t]], dtype=np.int64)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for at, term in enumerate(self.terms):
            self.automaton.add_word(f" {term} ", at)
        self.automaton.make_automaton()

    def scan(self, text: bytes | None) -> tuple[int, Counter[int]]:
        """How many terms a text has, and how often each of ours is among them; neighbours share the separator between them."""
        folded = (text or b"").translate(FOLD)
        n = len(folded.split())
        said = f" {folded.decode('utf-8', 'replace')} "
        return n, Counter(map(itemgetter(1), self.automaton.iter(said))) if n else Counter()


def _texts(column: pa.Array) -> Iterator[bytes | None]:
    for text in pc.cast(column, pa.binary()):
        yield text.as_py()


def _statistics(docs: DataFrame, terms: Broadcast[bytes]) -> dict[int, int]:
    """Documents of each term by its number; under -1 the documents with a term, under -2 all their terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, seen = pickle.loads(terms.value), Counter()
        for batch in batches:
            for text in _texts(batch.column("text")):
                n, found = own.scan(text)
                seen.update(found.keys())
                if n:
                    seen[-1] += 1
                    seen[-2] += n
        yield pa.RecordBatch.from_pydict({"term": list(seen.keys()), "n": list(seen.values())}, schema=schema)

    schema = pa.schema([("term", pa.int64()), ("n", pa.int64())])
    counts = docs.select("text").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    return {r.term: r.n for r in counts.collect()}  # at most one row a term of the block


class Best:
    """The best ``k`` (score, then smaller id, null last) of every item among what it is shown."""

    def __init__(self, items: int, k: int) -> None:
        self.k, self.least = k, np.ones(items, dtype=np.int64)
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, scores: np.ndarray, docs: np.ndarray, nulls: np.ndarray) -> None:
        """``scores`` of documents (rows) for items (columns); a score below an item's ``k`` best so far is not kept."""
        row, item = np.nonzero(scores >= self.least)
        self.parts.append(np.stack([item, -scores[row, item], nulls[row], docs[row]]))
        self.size += len(row)
        if self.size > HELD:
            self.cut()

    def cut(self) -> np.ndarray:
        item, minus, null, doc = np.concatenate([np.empty((4, 0), dtype=np.int64), *self.parts], axis=1)
        order = np.lexsort((doc, null, minus, item))
        item = item[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        kept = order[place < self.k]
        rows = np.stack([item[place < self.k], minus[kept], null[kept], doc[kept]])
        full = place == self.k - 1
        self.least[item[full]] = -minus[order[full]]
        self.parts, self.size = [rows], rows.shape[1]
        return rows


def _candidates(docs: DataFrame, terms: Broadcast[bytes], weights: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """``item_id, doc_id, score``: every task's best ``k`` documents of every item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pickle.loads(terms.value)
        best, width = Best(len(own.items), k), len(own.items)
        rows = max(1, GROUP // width)
        for batch in batches:
            texts, ids = _texts(batch.column("text")), batch.column("doc_id")
            nulls = ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64)
            numbers = ids.fill_null(LAST).to_numpy()
            for at in range(0, batch.num_rows, rows):
                upto = min(at + rows, batch.num_rows)
                scores = np.zeros((upto - at) * width, dtype=np.int64)
                for row in range(upto - at):
                    n, found = own.scan(next(texts))
                    if not found:
                        continue
                    term, tf = np.array(list(found.items()), dtype=np.int64).T
                    m = BASE - SHARE + (SHARE * n * n_docs) // n_terms
                    gain = weights[term] * ((UNIT * tf) // (1000 * tf + GAIN * m))
                    sizes = own.sizes[term]
                    ends = np.cumsum(sizes)
                    held = np.arange(ends[-1]) + np.repeat(own.starts[term] - ends + sizes, sizes)
                    np.add.at(scores, row * width + own.places[held], np.repeat(gain, sizes))
                best.add(scores.reshape(-1, width), numbers[at:upto], nulls[at:upto])
        item, minus, null, doc = best.cut()
        ids = [own.items[i] for i in item.tolist()]
        docs = pa.array(doc, pa.int64(), mask=null.astype(bool))
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), docs, pa.array(-minus, pa.int64())], names=["item_id", "doc_id", "score"])

    return docs.mapInArrow(run, "item_id long, doc_id long, score long")


def search(
    items: DataFrame,
    docs: DataFrame,
    k: int = 10,
    item: str = "item_id",
    item_text: str = "text",
    doc: str = "doc_id",
    text: str = "text",
    block: int = BLOCK,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of every item with a score above 0.

    A term in ``df`` of the ``N`` documents that have terms weighs ``floor(1000 ln((2N + 2) / (2 df + 1)))``; a document of ``n`` terms gets
    ``weight * (10^9 tf div (1000 tf + 8 m))`` for it, where ``m`` is 10 + (90 n N div all terms). Equal scores go by ascending ``doc_id``, a null id
    last; rows of one ``doc_id`` are documents of their own. Item rows of one id are one item, a null id is an item too. Null, empty or
    termless texts are no documents, termless items have no rows, and an empty table on either side gives none. Other columns are not read.
    Very long texts are scanned whole. The first scan runs at once, the second with the result.
    """
    spark = docs.sparkSession
    held = item_terms(items, item, item_text)
    docs = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text"))
    found = []
    for part in blocks_of(held, block):
        own = Terms([(r.item_id, r.terms) for r in part.collect()])
        shared = spark.sparkContext.broadcast(pickle.dumps(own))
        seen = _statistics(docs, shared)
        n_docs, n_terms = seen.get(-1, 0), seen.get(-2, 0)
        dfs = [seen.get(t, 0) for t in range(len(own.terms))]
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) for df in dfs], dtype=np.int64)
        found.append(_candidates(docs, shared, weights, n_docs, n_terms, k))
    if not found:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")

    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))
    some = reduce(DataFrame.union, found).withColumn("salt", salt)
    near = some.withColumn("rank", F.row_number().over(Window.partitionBy("item_id", "salt").orderBy(*order))).filter(F.col("rank") <= k)
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order)))
    return ranked.filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
