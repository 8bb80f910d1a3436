"""Approximate nearest neighbours by inner product with a permutation index.

1. A bounded sample of ``PIVOTS`` vectors are the pivots. A vector is represented by its pivots in order of nearness and posted
   in the pivots' inverted files with its place there (in all of them: on vectors without clusters fewer lose recall). So that nearness means inner product also for
   vectors of different lengths, stored vectors get one more component that makes all lengths equal.
2. A query goes through the files of its own nearest pivots and adds up, for every vector, how far the pivot's places
   are apart (the footrule distance; a vector absent from a file counts as last).
3. The vectors of the smallest footrule, a share ``RERANK`` of every block at every size, are ranked again by the exact inner product.

The index is dealt in blocks of about ``BLOCK`` vectors, the queries in blocks of ``QUERIES``, and every pair of blocks is a
task, so memory is bounded whatever the table's size. Equal vectors are one entry with its smallest ids.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnloom.llm import common

PIVOTS = 64
RERANK = 0.5
BLOCK = 4_096
QUERIES = 16_384
NEAREST = 20


def usable(embedding: Column) -> Column:
    """Not null, not zero, no null or non-finite component."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return embedding.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(embedding, lambda x: x != 0)


def stacked(vectors: pd.Series, width: int) -> np.ndarray:
    """A matrix of the vectors; shorter ones end in zeros."""
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def places(near: np.ndarray, prefix: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row of pivot nearness: the nearest pivots in order, and the place of every pivot (``prefix`` if absent)."""
    order = np.argsort(-near, axis=1, kind="stable")[:, :prefix]
    at = np.full(near.shape, prefix, dtype=np.int16)
    np.put_along_axis(at, order, np.arange(prefix, dtype=np.int16)[None, :], axis=1)
    return order, at


def products(rows: np.ndarray, vector: np.ndarray) -> np.ndarray:
    """Inner products summed component by component, so that a pair has the same score wherever it is computed."""
    total = np.zeros(len(rows))
    for d in range(len(vector)):
        total += rows[:, d] * vector[d]
    return total


def search_block(
    stored: np.ndarray, ids: np.ndarray, queries: np.ndarray, pivots: np.ndarray, longest: float, prefix: int, rerank: float, k: int
) -> list[tuple[np.ndarray, np.ndarray]]:
    """For every query the ``k`` best (row numbers, scores) among the stored vectors of smallest footrule distance, ties to the
    smaller of ``ids``."""

    def extra(x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(longest - (x * x).sum(axis=1), 0.0))

    near = stored @ pivots.T + extra(stored)[:, None] * extra(pivots)[None, :]
    files = np.ascontiguousarray(places(near, prefix)[1].T)  # pivot -> place in every stored vector's order
    order, _ = places(queries @ pivots.T, prefix)
    keep = min(len(stored), max(k, int(np.ceil(rerank * len(stored)))))
    # what two ways of adding up a product may differ by
    slack = 1e-9 * np.sqrt(longest) * np.sqrt((queries * queries).sum(axis=1))
    found = []
    for query, own, near_zero in zip(queries, order, slack, strict=True):
        footrule = np.zeros(len(stored), dtype=np.int16 if prefix <= 128 else np.int32)
        for place, pivot in enumerate(own.tolist()):
            footrule += np.abs(files[pivot] - np.int16(place))
        near_by = np.arange(len(stored)) if keep == len(stored) else np.argpartition(footrule, keep - 1)[:keep]
        rough = stored[near_by] @ query
        if len(near_by) > k:  # all that may tie with the k-th stay, however many
            near_by = near_by[rough >= np.partition(rough, -k)[-k] - near_zero]
        score = products(stored[near_by], query)
        best = np.lexsort((ids[near_by], -score))[:k]
        found.append((near_by[best], score[best]))
    return found


def nearest(
    embeddings: DataFrame, asks: Column, k: int = NEAREST, pivots: int = PIVOTS, rerank: float = RERANK
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for every row of ``embeddings`` (``vec_id, embedding``) that ``asks`` admits its ``k`` nearest
    other rows found, by inner product, ties to the smaller vec_id; all of them where there are fewer.

    Rows without vec_id and vectors that are null, zero or hold a null or non-finite component take no part. A repeated row (same
    vec_id and vector) counts once; a shorter vector counts as ending in zeros. Other columns are not read. An empty
    table gives no rows.
    """
    rows = embeddings.filter(F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"), asks.alias("ask")
    )
    rows = rows.filter(usable(F.col("v"))).withColumns({"k0": F.xxhash64("v"), "k1": F.xxhash64(F.lit("second"), "v")})
    ids = rows.groupBy("k0", "k1", "vec_id").agg(F.first("v").alias("v"), F.max("ask").alias("ask"))
    first = Window.partitionBy("k0", "k1").orderBy("vec_id")
    some = (
        ids.select("k0", "k1", "vec_id", "v")
        .withColumn("n", F.row_number().over(first))
        .filter(F.col("n") <= k + 1)
        .groupBy("k0", "k1")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("ids"), F.first("v").alias("v"))
    )
    stored = common.settle(some)
    askers = common.settle(ids.filter("ask").select("vec_id", "k0", "k1"))
    size, width, longest = stored.agg(
        F.count("*"), F.max(F.size("v")), F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    ).first()
    schema = "q0 long, q1 long, ids array<long>, score double"
    if not size:
        none = embeddings.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
        return none
    chosen = stored.orderBy(common.hash_order("k0", "k1"), "k0", "k1").limit(pivots).select("v").toPandas()
    points = stacked(chosen["v"], width)
    asking = stored.join(askers.select("k0", "k1").distinct(), ["k0", "k1"], "left_semi")
    asked = asking.count()
    blocks, query_blocks = -(-size // BLOCK), max(1, -(-asked // QUERIES))

    def dealt(df: DataFrame, key: str, own: str, parts: int, other: str, copies: int) -> DataFrame:
        return df.withColumn(own, F.pmod(F.xxhash64(F.lit("block"), key), F.lit(parts)).cast("int")).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
        )

    def search(index: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(index) or not len(queries):
            return pd.DataFrame({"q0": [], "q1": [], "ids": [], "score": []})
        own = index["ids"].to_numpy()
        least = np.array([i[0] for i in own], dtype=np.int64)
        found = search_block(
            stacked(index["v"], width), least, stacked(queries["q"], width), points, longest, len(points), rerank, k + 1
        )
        out = [
            (a, b, own[i], s)
            for a, b, (at, score) in zip(queries["q0"], queries["q1"], found, strict=True)
            for i, s in zip(at.tolist(), score.tolist(), strict=True)
        ]
        return pd.DataFrame(out, columns=["q0", "q1", "ids", "score"])

    keys = ["block", "query_block"]
    index = dealt(stored, "k0", "block", blocks, "query_block", query_blocks).groupBy(*keys)
    own = asking.select(F.col("k0").alias("q0"), F.col("k1").alias("q1"), F.col("v").alias("q"))
    queries = dealt(own, "q0", "query_block", query_blocks, "block", blocks).groupBy(*keys)
    hits = index.cogroup(queries).applyInPandas(search, schema)
    best = Window.partitionBy("q0", "q1").orderBy(F.desc("score"), F.col("ids")[0])
    lists = (
        hits.withColumn("n", F.row_number().over(best))
        .filter(F.col("n") <= k + 1)
        .select("q0", "q1", "score", F.explode("ids").alias("vec_id"))
        .groupBy("q0", "q1")
        .agg(F.slice(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("far"), "vec_id"))), 1, k + 1).alias("hits"))
    )
    answers = askers.join(lists, (F.col("k0") == F.col("q0")) & (F.col("k1") == F.col("q1")))
    others = F.slice(F.filter("hits", lambda h: h["vec_id"] != F.col("vec_id")), 1, k)
    return answers.select(F.col("vec_id").alias("query_id"), F.posexplode(others).alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).alias("rank"), "hit.vec_id", (-F.col("hit.far")).alias("score")
    )
