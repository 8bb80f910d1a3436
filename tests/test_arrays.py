"""Large JSON lists in byte ranges against the reader that takes a file whole."""

import json
import random

import pytest

from turnloom.sources import readers
from turnloom.sources.arrays import read_elements

HARD = ['plain', 'a}b', '{"x": [1, 2}', 'quote " and \\ back', '\\', '\\\\"', '},{', '日本語 😀 é', '', '[]]{{', 'line\nbreak\t"}"', '\\"}', 'x' * 300]


@pytest.fixture(params=[24, 64, 1 << 20])
def ranges(spark, request):
    """Byte ranges of a few bytes, so that they cut strings, escapes and characters."""
    names = {"spark.sql.files.maxPartitionBytes": str(request.param), "spark.sql.files.openCostInBytes": "1"}
    before = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield request.param
    for n, v in before.items():
        spark.conf.set(n, v)


def messages(seed, n=40):
    rng = random.Random(seed)
    made = []
    for i in range(n):
        text = " ".join(rng.choices(HARD, k=rng.randrange(1, 4)))
        made.append(rng.choice([{"role": "user", "content": text}, {"from": text, "value": f"v{i}"}, {"role": "a", "content": text, "meta": {"k": [{"z": text}, {}]}}]))
    return made


def written(folder, name, text):
    with open(f"{folder}/{name}", "w", encoding="utf-8") as f:
        f.write(text)


def turns_of(df):
    return sorted((r.name, r.turn, r.role, r.text) for r in df.collect())


def test_same_turns_as_whole_files(spark, folder, ranges):
    written(folder, "compact.json", json.dumps(messages(1), ensure_ascii=False, separators=(",", ":")))
    written(folder, "pretty.json", "\n" + json.dumps(messages(2), ensure_ascii=False, indent=2) + "\n")
    written(folder, "ascii.json", json.dumps(messages(3)))
    written(folder, "one.json", '[{"role": "user", "content": "}"}]')
    written(folder, "empty.json", "[]")
    written(folder, "nothing.json", "")
    got = readers.read_turn_list(spark, folder)
    assert turns_of(got) == turns_of(readers.read_turns(spark, folder)) and got.columns == ["file", "name", "turn", "role", "text"]


def test_wrapped_rows_sequences_and_arrays(spark, folder, ranges):
    rows = [{"instruction": t, "input": f"{i}", "output": t[::-1]} for i, t in enumerate(HARD)]
    written(folder, "rows.json", json.dumps({"data": rows, "version": "}"}))
    want = sorted((r["instruction"], r["input"], r["output"]) for r in rows)
    assert sorted(tuple(r) for r in readers.read_instruction_list(spark, folder, wrapped=True).collect()) == want
    written(folder, "arrays.txt", json.dumps([[t, None, [i]] for i, t in enumerate(HARD)]))
    got = {r.ordinal: json.loads(r.element) for r in read_elements(spark, folder, "*.txt", close="]").collect()}
    assert got == {i: [t, None, [i]] for i, t in enumerate(HARD)}
    written(folder, "one_by_one.jsonl", "\n".join(json.dumps(r, indent=1) for r in rows))
    got = {r.ordinal: json.loads(r.element) for r in read_elements(spark, folder, "*.jsonl", depth=0).collect()}
    assert got == dict(enumerate(rows))


def test_a_file_is_read_by_many_tasks(spark, folder):
    n = 60_000
    written(folder, "large.json", json.dumps([{"role": "user", "content": f"text {i} }} {HARD[i % len(HARD)]}"} for i in range(n)]))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(256 * 1024))
    try:
        got = readers.read_turn_list(spark, folder)
        assert spark.read.option("lineSep", "}").text(folder).rdd.getNumPartitions() > 8
        rows = got.selectExpr("count(*) AS n", "count(DISTINCT turn) AS m", "max(turn) AS top", "count_if(text LIKE concat('text ', turn, ' }%')) AS fit")
        assert rows.first()[:] == (n, n, n - 1, n)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "128MB")
