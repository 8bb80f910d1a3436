"""What several operators need: shared-folder tables, connected components, the labelled sample."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; only where the session names none (tests) a local folder of our own."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        named = tempfile.mkdtemp(prefix="run-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: work is done once, and a lost executor loses none of it."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(name: str, taken: list[str]) -> str:
    """``name``, or ``name`` with underscores in front, so that no column of ``taken`` has it (in any case)."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name = f"_{name}"
    return name


def text_key(text: Column) -> list[Column]:
    """128 bits of a text as two longs; a null text differs from every text."""
    return [F.xxhash64(text.isNull(), text), F.xxhash64(F.lit("second"), text.isNull(), text)]


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) of every node in ``edges`` (``a, b``, any orderable type).

    Alternating stars: a large star hangs every larger neighbour of a node on the smallest neighbour, a small star does
    so for the smaller ones, until each component is one star. Every round is grouping with map-side minima and joins;
    a node with very many neighbours is a skewed join key, which adaptive execution splits. Each round is written to
    the shared folder.
    """
    links = settle(
        edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    before = None
    while True:
        mark = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before or not mark[0]:
            break
        before = mark
        both = links.union(links.select(F.col("b"), F.col("a"))).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(small, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        links = settle(moved.union(small.select("a", F.col("m").alias("b"))).distinct())
    stars = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.union(links.select(F.col("b"), F.col("b")).distinct())


def hash_order(*cols: str) -> Column:
    """A fixed pseudo-random order of rows."""
    return F.xxhash64(F.lit("sample"), *cols)


def bounded_sample(df: DataFrame, rows: int, *cols: str) -> DataFrame:
    """At most ``rows`` rows, the same on any cluster: the smallest under a hash of ``cols``."""
    return df.orderBy(hash_order(*cols), *cols).limit(rows)


def one_row_each(df: DataFrame, keys: list[Column], order: list[Column]) -> DataFrame:
    """The first row of every key; a hot key is cut to one row in each task before it is shuffled."""
    *names, rank = (fresh(n, df.columns) for n in (*[f"_k{i}" for i in range(len(keys))], "_rank"))
    ranked = df.withColumns(dict(zip(names, keys, strict=True)))
    window = Window.partitionBy(*names).orderBy(*order)
    return ranked.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) == 1).drop(rank, *names)
