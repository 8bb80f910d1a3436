"""Splits, schedules, retrieval, statistics, files and plans."""

import json
import math
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from turnloom.operators import extract, profile, retrieve, runlog, segment, split, pair
from turnloom.plans import flows
from turnloom.sources import readers, sinks


@pytest.mark.parametrize("n", [0, 1, 4, 5, 1000])
@pytest.mark.parametrize("share", [0.8, 0.0, 1.0])
def test_split_is_exact(spark, n, share):
    df = spark.range(n)
    parts = {r.id: r.part for r in split.split_exact(df, ["id"], share).collect()}
    assert len(parts) == n
    assert sum(p == "train" for p in parts.values()) == int(n * share)
    if n == 1000:
        assert parts == {r.id: r.part for r in split.split_exact(df.repartition(7), ["id"], share).collect()}


def test_split_hash_is_close_and_shuffles_nothing(spark):
    df = split.split_hash(spark.range(20_000), ["id"])
    assert abs(df.filter("part = 'train'").count() / 20_000 - 0.8) < 0.02
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_epoch_schedule(spark):
    made = [tuple(r) for r in split.epoch_schedule(spark.range(3), ["id"], max_steps=8).orderBy("step").collect()]
    assert made == [(i + 1, i // 3 + 1, i % 3) for i in range(8)]
    short = split.epoch_schedule(spark.range(10), ["id"], max_steps=4).orderBy("step").collect()
    assert [(r.step, r.epoch, r.id) for r in short] == [(1, 1, 0), (2, 1, 1), (3, 1, 2), (4, 1, 3)]
    many = [(c, t) for c in range(7) for t in range(0, 40, c + 1)]
    pairs = spark.createDataFrame(many, "c long, t long")
    made = split.epoch_schedule(pairs, ["c", "t"], epochs=1.5, span=3).orderBy("step").collect()
    want = (many + many)[: int(1.5 * len(many))]
    assert [(r.step, r.epoch, r.c, r.t) for r in made] == [(i + 1, i // len(many) + 1, *k) for i, k in enumerate(want)]


def test_augmentation_is_reproducible_and_small(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text")
    once = {r.doc_id: r.text for r in split.augment_persona(docs, ["doc_id"]).collect()}
    assert once == {r.doc_id: r.text for r in split.augment_persona(docs.repartition(5), ["doc_id"]).collect()}
    before = {r.doc_id: r.text for r in docs.collect()}
    changed = [k for k in before if once[k] != before[k]]
    assert 0.25 < len(changed) / len(before) < 0.65
    for k in changed:
        assert before[k] in once[k]


def test_kb_search_against_a_loop(spark):
    docs = [(1, "Cats", "cats and dogs and birds"), (2, "Fish", "fish swim fast"), (3, "More", "dogs bark dogs"), (4, "", "birds")]
    asks = [(10, "do dogs swim?"), (11, "and birds"), (12, "zebra")]
    kb = spark.createDataFrame(docs, "doc_id long, title string, content string")
    qs = spark.createDataFrame(asks, "question_id long, question string")
    words = {d: re.findall(r"\w+", f"{t}\n{c}".lower()) for d, t, c in docs}
    df = {w: sum(w in ws for ws in words.values()) for ws in words.values() for w in ws}
    want = []
    for q, text in asks:
        keys = {w for w in re.findall(r"\w+", text.lower()) if w in df and 2 * df[w] < len(docs)}
        scores = {}
        for d, ws in words.items():
            hit = [w for w in keys if w in ws]
            if hit:
                scores[d] = round(sum((1 + math.log(ws.count(w))) * math.log(1 + len(docs) / df[w]) for w in hit), 6)
        best = sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:3]
        want += [(q, i + 1, d, s) for i, (d, s) in enumerate(best)]
    assert sorted(tuple(r) for r in retrieve.kb_search(qs, kb).collect()) == sorted(want)
    context = {r.question_id: r.context for r in retrieve.kb_context(qs, kb, k=1, chars=4).collect()}
    assert context[12] == "" and context[10].startswith("文档：")


def test_a_question_of_many_words_uses_them_all(spark):
    docs = [(d, "", f"w{d} w{d + 1} common") for d in range(12)]
    kb = spark.createDataFrame(docs, "doc_id long, title string, content string")
    qs = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(20)) + " common")], "question_id long, question string")
    assert {r.doc_id for r in retrieve.kb_search(qs, kb, k=12).collect()} == set(range(12))
    assert retrieve.kb_search(spark.createDataFrame([(1, "common")], qs.schema), kb).count() == 0


def test_pruned_search_gives_the_answers_of_a_full_one(spark):
    """Texts of very different lengths, many ties, more documents than the blocks that are scored first."""
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)]
    docs = [(d, "", " ".join(rng.choices(vocabulary, k=rng.choice([1, 3, 9, 40, 200])))) for d in range(400)]
    docs += [(1000 + d, "", docs[d][2]) for d in range(30)]
    asks = [(q, " ".join(rng.sample(vocabulary, rng.randrange(1, 9)))) for q in range(15)]
    kb = spark.createDataFrame(docs, "doc_id long, title string, content string")
    qs = spark.createDataFrame(asks, "question_id long, question string")
    words = {d: c.split() for d, _, c in docs}
    df = {w: sum(w in ws for ws in words.values()) for w in vocabulary}
    want, pairs = [], 0
    for q, text in asks:
        keys = [w for w in set(text.split()) if 0 < 2 * df[w] < len(docs)]
        scores = {
            d: round(sum((1 + math.log(ws.count(w))) * math.log(1 + len(docs) / df[w]) for w in keys if w in ws), 6)
            for d, ws in words.items()
            if any(w in ws for w in keys)
        }
        pairs += len(scores)
        best = sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:4]
        want += [(q, i + 1, d, s) for i, (d, s) in enumerate(best)]
    assert sorted(tuple(r) for r in retrieve.kb_search(qs, kb, k=4).collect()) == sorted(want)
    assert retrieve.scored_pairs(qs, kb, 4).count() < pairs / 2


def test_a_tenth_of_the_pairs_is_scored(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet").selectExpr("doc_id", "left(text, 40) AS title", "text AS content")
    asks = spark.read.parquet(f"{folder}/benchmark.parquet").selectExpr("item_id AS question_id", "text AS question")
    assert retrieve.scored_pairs(asks, docs, 3).count() * 10 <= docs.count() * asks.count()


def test_a_word_is_one_row_a_block(spark):
    docs = spark.createDataFrame([(d, "", "a b a" if d % 2 else "a") for d in range(200)], "doc_id long, title string, content string")
    asked = spark.createDataFrame([(1, "a"), (1, "b")], "question_id long, word string")
    held = retrieve.postings(docs, asked)
    rows = retrieve.gathered(held).collect()
    assert len({(r.word, r.block) for r in rows}) == len(rows)
    assert all(r.most == max(h.tf for h in r.holders) and r.n_docs == len(r.holders) for r in rows)
    unfolded = [(r.word, r.block, h.doc_id, h.tf) for r in rows for h in r.holders]
    assert sorted(unfolded) == sorted(tuple(r) for r in held.select("word", "block", "doc_id", "tf").collect())


def test_a_hot_word_is_dealt_out(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kb = spark.createDataFrame([(1, "a", "b")], "doc_id long, title string, content string")
        qs = spark.createDataFrame([(1, "a")], "question_id long, question string")
        plan = retrieve.kb_search(qs, kb)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert re.search(r"Exchange hashpartitioning\(word#\d+, salt#\d+", plan)
    assert re.search(r"Exchange hashpartitioning\(word#\d+, block#\d+L", plan)
    assert re.search(r"Exchange hashpartitioning\(question_id#\d+L, doc_id#\d+L", plan)


def test_statistics(spark):
    rows = [(1, 0, "user", "aaaaa"), (1, 1, "assistant", "bb\nbb"), (2, 0, "user", "é")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert sorted(tuple(r) for r in profile.conv_stats(df).collect()) == [(1, 2, 10, 4), (2, 1, 1, 0)]
    totals = {r.role: (r.conversations, r.messages, r.chars) for r in profile.corpus_totals(df).collect()}
    assert totals == {"user": (2, 2, 6), "assistant": (1, 1, 5), "all": (2, 3, 11)}
    assert [(r.conv_id, r.turn) for r in profile.longest_preview(df, F.col("conv_id") == 1).collect()] == [(1, 0)]


def test_lr_schedule(spark):
    df = spark.range(0, 101).select(runlog.warmup_cosine(F.col("id"), 100, 10, 1.0, 0.1).alias("lr"))
    lr = [r.lr for r in df.collect()]
    assert lr[5] == 0.5 and lr[10] == pytest.approx(1.0) and lr[100] == pytest.approx(0.1)
    assert lr[55] == pytest.approx(0.55)


# ---- files


def test_read_turns(spark, folder):
    with open(f"{folder}/a.json", "w") as f:
        json.dump([{"role": "user", "content": "é\nx"}, {"from": "gpt", "value": "y"}, {"role": "user", "content": "z"}], f, indent=4)
    made = [tuple(r) for r in readers.read_turns(spark, folder).orderBy("turn").collect()]
    assert [r[1:] for r in made] == [("a.json", 0, "user", "é\nx"), ("a.json", 1, "gpt", "y"), ("a.json", 2, "user", "z")]
    assert {r[0].endswith(f"{folder}/a.json") for r in made} == {True}


def test_read_instructions_in_all_shapes(spark, folder):
    rows = [{"instruction": "i", "output": "o"}, {"instruction": "j", "input": "n", "output": "p"}]
    for name, body in (("plain", rows), ("wrapped", {"data": rows})):
        os.mkdir(f"{folder}/{name}")
        with open(f"{folder}/{name}/f.json", "w") as f:
            json.dump(body, f)
        made = [tuple(r) for r in readers.read_instructions(spark, f"{folder}/{name}").collect()]
        assert sorted(made) == [("i", "", "o"), ("j", "n", "p")]


def test_read_pages(spark, folder):
    os.makedirs(f"{folder}/deep/er")
    with open(f"{folder}/deep/er/p.html", "wb") as f:
        f.write(b"<p>caf\xc3\xa9 \xff x \xef\xbf\xbd</p>")
    with open(f"{folder}/deep/skip.txt", "w") as f:
        f.write("no")
    assert [tuple(r)[1:] for r in readers.read_pages(spark, folder).collect()] == [("p.html", "<p>café  x \ufffd</p>")]


def test_equal_names_in_two_folders_are_two_files(spark, folder):
    said = {"x": [("user", "q1"), ("assistant", "a1")], "y": [("user", "q2"), ("assistant", "a2")]}
    for d, turns in said.items():
        os.makedirs(f"{folder}/{d}")
        with open(f"{folder}/{d}/chat.json", "w") as f:
            json.dump([{"role": r, "content": c} for r, c in turns], f)
        with open(f"{folder}/{d}/page.html", "w") as f:
            f.write(d)
        with open(f"{folder}/{d}/training_log.jsonl", "w") as f:
            f.write('{"step": 1, "loss": 0.5, "lr": 1e-7}')
    turns = readers.read_turns(spark, folder).withColumnRenamed("file", "conv_id")
    assert sorted((r.instruction, r.output) for r in pair.pair_adjacent(turns).collect()) == [("q1", "a1"), ("q2", "a2")]
    for read in (
        readers.read_pages(spark, folder),
        readers.read_exports(spark, folder, "*.json"),
        readers.read_run_log(spark, f"{folder}/*/training_log.jsonl").withColumnRenamed("run", "file"),
    ):
        rows = read.select("file", "name").collect()
        assert len({r.file for r in rows}) == 2 and len({r.name for r in rows}) == 1


def test_sinks(spark, folder):
    rows = spark.createDataFrame([("你好", "", "o")], "instruction string, input string, output string")
    sinks.write_json(rows, f"{folder}/out")
    lines = [r.value for r in spark.read.text(f"{folder}/out").collect()]
    assert lines == ['{"instruction":"你好","input":"","output":"o"}']
    sinks.append_json(rows, f"{folder}/out")
    assert readers.read_instructions(spark, f"{folder}/out", multi_line=False).count() == 2
    sinks.write_prompts(rows, "instruction", f"{folder}/prompts")
    assert spark.read.text(f"{folder}/prompts").first().value == "你好"


def test_read_run_log_and_results(spark, folder):
    os.mkdir(f"{folder}/log")
    with open(f"{folder}/log/a.jsonl", "w") as f:
        f.write('{"step": 1, "loss": 0.5, "lr": 1e-7}\n{"step": 20, "loss": 0.4, "lr": 2e-6, "eval_loss": 0.9}\n')
    made = [tuple(r) for r in readers.read_run_log(spark, f"{folder}/log").orderBy("step").collect()]
    assert [r[1:] for r in made] == [("a.jsonl", 1, 0.5, 1e-7, None), ("a.jsonl", 20, 0.4, 2e-6, 0.9)]
    rows = spark.createDataFrame([("p", "e", "g")], "prompt string, expected string, generated string")
    sinks.append_json(rows, f"{folder}/res")
    sinks.append_json(rows, f"{folder}/res")
    assert [tuple(r) for r in readers.read_results(spark, f"{folder}/res").collect()] == [("p", "e", "g")] * 2


def test_flow_from_export_file(spark, folder):
    tail = ",null,null,null,null,null,null,null,"
    with open(f"{folder}/raw.json", "w") as f:
        f.write("[" + ",".join(f'["m{i}"{tail}"{"user" if i % 2 == 0 else "model"}"]' for i in (0, 1, 2, 1, 3)) + "]")
    pairs = flows.exports_to_pairs(readers.read_exports(spark, folder), "file")
    assert sorted((r.instruction, r.output) for r in pairs.collect()) == [("m0", "m1"), ("m2", "m3")]


# ---- plans


def test_segmenters_shuffle_nothing(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text")
    for cut in (segment.segment_transcript, segment.segment_page_roles, segment.segment_ui_dump, segment.segment_headings):
        plan = cut(docs, ["doc_id"])._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_json_walk_is_planned_once(spark, data):
    """The tree search must not be copied into filters or repeated by its users."""
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", F.col("text").alias("json"))
    plan = extract.json_find_conversation(docs, ["doc_id"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("aggregate(sequence(") == 1


def test_only_the_lcs_score_uses_python(spark, data):
    from turnloom.plans.catalog import QUERIES

    for name, query in QUERIES.items():
        plan = query(spark, data)._jdf.queryExecution().optimizedPlan().toString()
        uses = "EvalPython" in plan or "MapInPandas" in plan
        assert uses == (name in {"score_lcs", "score_text_loss", "eval_mean_loss", "eval_mean_loss_first"}), name


def test_row_local_operators_run_on_a_stream(spark, data, folder):
    from turnloom.functions import text as T

    schema = spark.read.parquet(f"{data}/documents.parquet").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "documents.parquet").parquet(data)
    cleaned = segment.segment_transcript(
        stream.select("doc_id", F.concat(F.lit("User: "), T.drop_ui_lines(F.col("text"))).alias("text")), ["doc_id"]
    )
    q = cleaned.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/cp").start()
    q.processAllAvailable()
    q.stop()
    assert spark.read.parquet(f"{folder}/out").count() >= 200
