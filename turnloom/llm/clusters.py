"""Centroid clustering (Lloyd's rounds) in exact integers, with an incremental distance matrix.

Every vector's integer dot products with all centroids are kept in a table. When centroids move, a product changes by the vector's
components times the centroid's change, so only components that changed are multiplied; then the nearest centroid is found anew from
``|c|^2 - 2 x.c``. A centroid that stays costs nothing, and once none moves the remaining rounds are over.

The table is written to the shared folder every round, in two folders by turns: one is read while the other is written, so the disk holds
two states whatever the number of rounds and a lost executor costs a round at most. Only centroids pass through the driver: ``k`` times
``dim`` sums a round, whatever the table.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnloom.llm import common

DIM = 64
SCALE = 1024
STATE = "vec_id long, x array<long>, dots array<long>, cluster int"


def largest(dim: int) -> int:
    """Greatest size of a component for which every squared distance fits into a long."""
    return math.isqrt((2**63 - 1) // (4 * dim))


def quantised(vectors: DataFrame, id: str, vector: str, dim: int = DIM, scale: int = SCALE) -> DataFrame:
    """``vec_id, x``: whole components ``floor(scale * v)`` of the vectors with ``dim`` usable components."""
    v, most = F.col(vector), largest(dim)
    whole = F.transform(v, lambda c: F.floor(c.cast("double") * scale))
    fits = F.forall(v, lambda c: (c.cast("double") * scale).between(-most, most + 0.5))  # a NaN is above, a null is null
    usable = v.isNotNull() & (F.size(v) == dim) & F.coalesce(fits, F.lit(False))
    return vectors.filter(usable).select(F.col(id).cast("long").alias("vec_id"), whole.alias("x"))


def first_centroids(kept: DataFrame, k: int, seed: str) -> np.ndarray:
    """The ``k`` vectors whose id has the smallest hash, repeated ids by components; a vector without id is no start."""
    place = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = kept.filter("vec_id is not null").orderBy(place, "x").limit(k).collect()
    return np.array([r.x for r in rows], dtype=np.int64)


def matrix(column: pa.ListArray, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def lists(values: np.ndarray) -> pa.ListArray:
    rows, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1) * width, pa.int32()), pa.array(values.ravel()))


def moved(state: DataFrame, change: np.ndarray, centroids: np.ndarray) -> DataFrame:
    """``state`` after centroids changed by ``change`` to ``centroids``: products brought up to date, nearest centroid found."""
    norms = (centroids * centroids).sum(axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("x"), centroids.shape[1])
            dots = matrix(batch.column("dots"), len(centroids)).copy()
            for c, by in enumerate(change):
                at = np.flatnonzero(by)
                if len(at):
                    dots[:, c] += x[:, at] @ by[at]
            cluster = (norms - 2 * dots).argmin(axis=1).astype(np.int32)  # the first of equally near ones
            columns = [batch.column("vec_id"), batch.column("x"), lists(dots), pa.array(cluster)]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "x", "dots", "cluster"])

    return state.mapInArrow(run, STATE)


def cluster_sums(state: DataFrame, dim: int) -> tuple[dict[int, int], dict[int, list[int]]]:
    """Vectors and exact component sums of every cluster; a batch is summed before anything is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, cluster = matrix(batch.column("x"), dim), batch.column("cluster").to_numpy()
            held = np.unique(cluster)
            sums = np.array([x[cluster == c].sum(axis=0) for c in held], dtype=np.int64).reshape(-1, dim)
            rows = np.array([(cluster == c).sum() for c in held], dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(rows), lists(sums)], names=["c", "n", "sums"])

    parts = state.select("x", "cluster").mapInArrow(run, "c int, n long, sums array<long>")
    each = parts.select("c", "n", F.posexplode("sums").alias("j", "s"))
    total = each.groupBy("c", "j").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    rows, sums = {}, {}
    for r in total.collect():
        rows[r.c] = r.n
        sums.setdefault(r.c, [0] * dim)[r.j] = int(r.s)
    return rows, sums


def cluster(
    vectors: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    k: int = 8,
    rounds: int = 10,
    seed: str = "3",
    dim: int = DIM,
    scale: int = SCALE,
) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256, centroid`` after ``rounds`` rounds and a last assignment.

    Vectors that are null, of another length or hold a null or non-finite component take no part, nor do components so large that a
    squared distance would not fit into a long (1.9e8 after scaling, for 64 components). Rows of one id are vectors of their own; a row
    without id is clustered but never a first centroid. Equal distances go to the smaller number. With fewer than ``k`` vectors there are as
    many centroids; an empty table gives no rows. Other columns are not read. An inertia beyond a long is null.
    """
    spark = vectors.sparkSession
    kept = quantised(vectors, id, vector, dim, scale)
    centroids = first_centroids(kept, k, seed)
    if not len(centroids):
        return _described(kept.limit(0).withColumns({"cluster": F.lit(0), "distance": F.lit(0).cast("long")}), [], {})

    k, folder = len(centroids), f"{common.shared_folder(spark)}/clusters-{uuid.uuid4().hex}"
    products = F.array_repeat(F.lit(0).cast("long"), k)
    state = kept.select("vec_id", "x", products.alias("dots"), F.lit(0).alias("cluster"))
    change = centroids
    for turn in range(rounds + 1):
        path = f"{folder}-{turn % 2}"
        moved(state, change, centroids).write.mode("overwrite").parquet(path)
        state = spark.read.schema(STATE).parquet(path)
        if turn == rounds:
            break
        rows, sums = cluster_sums(state, dim)
        means = centroids.copy()
        for c, n in rows.items():
            means[c] = [s // n for s in sums[c]]
        change, centroids = means - centroids, means
        if not change.any():
            break

    norms = F.array(*[F.lit(int(n)).cast("long") for n in (centroids * centroids).sum(axis=1)])
    own = F.aggregate("x", F.lit(0).cast("long"), lambda a, c: a + c * c)
    distance = own - 2 * F.get("dots", F.col("cluster")) + F.get(norms, F.col("cluster"))
    assigned = state.select("vec_id", "cluster", distance.alias("distance"))
    spread = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()
    return _described(assigned, centroids.tolist(), {r.cluster: int(r.d) for r in spread})


def _described(assigned: DataFrame, centroids: list[list[int]], inertia: dict[int, int]) -> DataFrame:
    """Rows with what belongs to their cluster: one value a centroid, so literals instead of a join."""

    def each(values: list[str], kind: str):
        return F.get(F.expr(f"array({', '.join(values)})").cast(f"array<{kind}>"), F.col("cluster"))

    whole = lambda n: f"{n}L" if n is not None and n < 2**63 else "null"
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return assigned.select(
        "vec_id",
        "cluster",
        "distance",
        each([whole(inertia.get(c, 0)) for c in range(len(centroids))], "long").alias("cluster_inertia"),
        F.expr(whole(sum(inertia.values()))).cast("long").alias("inertia"),
        each([f"'{d}'" for d in digests], "string").alias("centroid_sha256"),
        each([f"array({', '.join(map(whole, c))})" for c in centroids], "array<long>").alias("centroid"),
    )
