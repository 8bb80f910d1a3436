"""Appends that count once, and prompts in order."""

import json
from pathlib import Path

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from turnloom.sources import readers, sinks

RESULT = "prompt string, expected string, generated string"


def results(spark, *prompts):
    return spark.createDataFrame([(p, "e", "g") for p in prompts], RESULT)


def prompts_of(spark, path):
    return sorted(r.prompt for r in readers.read_results(spark, path).collect())


def test_a_batch_counts_once(spark, folder):
    path = f"{folder}/res"
    sinks.append_json(results(spark, "a", "b"), path, batch="run/1 é")
    sinks.append_json(results(spark, "a", "b"), path, batch="run/1 é")
    sinks.append_json(results(spark, "c"), path, batch="run/2")
    assert prompts_of(spark, path) == ["a", "b", "c"]
    sinks.append_json(results(spark, "plain"), path)
    sinks.append_json(results(spark, "plain"), path)
    assert prompts_of(spark, path) == ["a", "b", "c", "plain", "plain"]


def test_a_batch_stopped_before_its_commit(spark, folder, monkeypatch):
    path, write = f"{folder}/res", DataFrameWriter.json

    def stopped(self, path, *more, **named):
        if "_commits" in path:
            raise RuntimeError("lost")
        return write(self, path, *more, **named)

    for before in ([], ["kept"]):
        if before:
            sinks.append_json(results(spark, *before), path, batch="other")
        with monkeypatch.context() as m, pytest.raises(RuntimeError):
            m.setattr(DataFrameWriter, "json", stopped)
            sinks.append_json(results(spark, "x"), path, batch="b")
        assert prompts_of(spark, path) == before
    sinks.append_json(results(spark, "x"), path, batch="b")
    assert prompts_of(spark, path) == ["kept", "x"]


def test_two_attempts_commit_at_once(spark, folder, monkeypatch):
    path = f"{folder}/res"
    with monkeypatch.context() as m:  # neither sees the other's commit
        m.setattr(sinks, "commits", lambda *_: None)
        sinks.append_json(results(spark, "x", "y"), path, batch="b")
        sinks.append_json(results(spark, "x", "y"), path, batch="b")
    assert prompts_of(spark, path) == ["x", "y"]


def test_run_log_in_batches(spark, folder):
    path = f"{folder}/log"
    rows = spark.createDataFrame([(i, i / 2, 0.1, None) for i in range(5)], "step long, loss double, lr double, eval_loss double")
    for _ in range(2):
        sinks.append_json(rows, path, batch="first")
    assert sorted(r.step for r in readers.read_run_log(spark, path).collect()) == list(range(5))


def test_stream_of_batches(spark, folder):
    for i in range(3):
        results(spark, f"p{i}").coalesce(1).write.mode("append").json(f"{folder}/in")
    path = f"{folder}/res"

    def twice(df, number):
        for _ in range(2):
            sinks.append_json(df, path, batch=f"copy-{number}")

    stream = spark.readStream.schema(RESULT).option("maxFilesPerTrigger", 1).json(f"{folder}/in")
    run = stream.writeStream.foreachBatch(twice).option("checkpointLocation", f"{folder}/at").trigger(availableNow=True).start()
    run.awaitTermination(120)
    assert prompts_of(spark, path) == ["p0", "p1", "p2"]


@pytest.mark.parametrize("files", [1, 3, 16])
def test_prompts_in_order(spark, data, folder, files):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text")
    hot = docs.select((F.col("doc_id") * F.col("doc_id") % 7 * (F.col("doc_id") % 3)).alias("key"), "doc_id", F.col("text").alias("prompt"))
    hot = hot.union(spark.createDataFrame([(None, 1, "no key"), (5, 2, ""), (5, 2, "two\nlines\n")], hot.schema)).repartition(5)
    sinks.write_prompts(hot, "prompt", f"{folder}/out", order=["key"], files=files)
    made = sorted(Path(f"{folder}/out").glob("part-*"))
    rows = sorted(((r.key is not None, r.key or 0, (r.prompt or "").encode()) for r in hot.filter("prompt is not null").collect()))
    assert b"".join(p.read_bytes() for p in made) == b"".join(p + b"\n" for _, _, p in rows)
    assert len(made) <= files and (files < 3 or len(made) > 1)
    offsets = [json.loads(line) for f in Path(f"{folder}/out/_offsets").glob("part-*") for line in f.read_text().splitlines()]
    at = 0
    for p, row in zip(made, sorted(offsets, key=lambda r: r["file"]), strict=True):
        assert row == {"file": p.name, "bytes": p.stat().st_size, "start": at}
        at += row["bytes"]
