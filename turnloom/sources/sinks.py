"""Writers. Datasets are written as many JSON Lines files; one array document would pass through one task."""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def scratch(spark: SparkSession) -> str:
    """A new path in the cluster's ``spark.checkpoint.dir``; only where the session names none (tests) in a local folder."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir() or tempfile.mkdtemp(prefix="run-")
    return f"{named.rstrip('/')}/files-{uuid.uuid4().hex}"


def written_in_buckets(
    df: DataFrame, *columns: str, within: Callable[[DataFrame], DataFrame] = lambda dealt: dealt
) -> DataFrame:
    """``df`` as a table in the shared folder, in one bucket a shuffle partition: several readers cost its work once, joins and groups by
    ``columns`` do not move it again, and a lost executor loses none of it. ``within`` groups the rows by ``columns`` once they are dealt."""
    spark, name = df.sparkSession, f"buckets_{uuid.uuid4().hex}"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = within(df.repartition(parts, *columns)).write.bucketBy(parts, *columns).sortBy(*columns)
    dealt.option("path", scratch(spark)).saveAsTable(name)
    return spark.table(name)


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON Lines, non-ASCII text as it is, NULL fields kept."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def append_json(df: DataFrame, path: str, batch: str | None = None) -> None:
    """Add results or log rows to what is there.

    Rows added under the name of a ``batch`` are read once however often the batch is written: data go to a folder of this attempt, then one
    row in ``_commits`` says that the attempt counts. A batch that is committed is not written again; one that was stopped before its
    commit is not read, and neither is the loser of two attempts that commit at once (see ``only_committed``). As the body of ``foreachBatch``, with a name
    made of the query's and the batch's number, it gives each row once.
    """
    if batch is None:
        df.write.mode("append").json(path)
        return
    spark, key, attempt = df.sparkSession, hashlib.sha256(batch.encode()).hexdigest(), uuid.uuid4().hex
    done = commits(spark, path)
    if done is not None and done.filter(F.col("batch") == key).head(1):
        return
    df.write.json(f"{path}/batch={key}/attempt={attempt}")
    commit = spark.range(1).select(F.lit(key).alias("batch"), F.lit(attempt).alias("attempt"))
    commit.coalesce(1).write.json(f"{path}/_commits/{attempt}")


def commits(spark: SparkSession, path: str) -> DataFrame | None:
    """``batch, attempt``: the attempt that counts of every committed batch, the smallest; None where nothing was ever committed."""
    try:
        made = spark.read.schema("batch string, attempt string").json(f"{path}/_commits/*")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return made.filter("attempt is not null").groupBy("batch").agg(F.min("attempt").alias("attempt"))


def only_committed(df: DataFrame, path: str, file: Column) -> DataFrame:
    """Rows of ``df``, read from the files under ``path``, without those of attempts that do not count; ``file`` is a row's file. Rows
    that were added without a batch stay."""
    attempt = F.regexp_extract(file, "/batch=[0-9a-f]{64}/attempt=([0-9a-f]{32})/", 1)
    done = commits(df.sparkSession, path)
    if done is None:
        return df.filter(attempt == "")
    plain = df.sparkSession.range(1).select(F.lit("").alias("attempt"))
    kept = done.select("attempt").union(plain).withColumnRenamed("attempt", "_attempt")
    return df.withColumn("_attempt", attempt).join(kept, "_attempt", "left_semi").drop("_attempt")


def write_prompts(
    df: DataFrame, prompt: str, path: str, mode: str = "errorifexists", order: list[str] | None = None, files: int | None = None
) -> None:
    """Rendered prompts one after another, as text.

    With ``order``, files in order of their names hold the prompts in order of these columns (ties by the prompt, nulls first), so that
    putting them together gives the text that one task would write. Rows are dealt into ranges of (order, prompt), so a value
    of ``order`` that a third of the rows share is cut like any other. ``_offsets`` beside the files tells where each begins.
    """
    if order is None:
        df.select(prompt).write.mode(mode).text(path)
        return
    spark = df.sparkSession
    keys = [*order, prompt]
    parts = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.select(*dict.fromkeys(keys)).repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    dealt.select(prompt).write.mode(mode).text(path)
    # one row a file; the contents are not read for it
    made = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    made = made.select(F.element_at(F.split("path", "/"), -1).alias("file"), F.col("length").alias("bytes"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = made.withColumn("start", F.coalesce(F.sum("bytes").over(before), F.lit(0)))
    offsets.coalesce(1).write.mode(mode).json(f"{path}/_offsets")
