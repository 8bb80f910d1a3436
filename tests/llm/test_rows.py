"""Neighbours, chats and the pipeline: against brute force on small tables."""

from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from turnloom.llm import chat, decontaminate, lines, neighbours, pieces, quality_rules, simhash, toxicity
from turnloom.llm.queries import QUERIES


def exact(rows, asks, k):
    """All answers by brute force; rows of (vec_id, vector) without unusable or repeated ones."""
    answers = {}
    for i, v in rows:
        if asks(i):
            near = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), j) for j, w in rows if j != i)
            answers[i] = [(j, -s) for s, j in near[:k]]
    return answers


def answers_of(df):
    got = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        got[r.query_id].append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
    return got


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(1)
    good = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(60)]
    good += [(60 + i, good[7][1]) for i in range(30)] + [(200, [9.0] * 8), (201, [1.0, 2.0, 3.0])]
    bad = [(300, None), (320, [0.0] * 8), (340, [1.0, nan] + [0.0] * 6), (360, [inf] + [0.0] * 7), (380, [1.0, None]), (400, [])]
    rows = good + bad + [(None, good[0][1]), good[20], good[20]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("clash"))
    # all vectors ranked again, so that the answers are the exact ones
    got = answers_of(neighbours.nearest(df, F.col("vec_id") % 20 == 0, k=20, rerank=1.0))
    want = exact([(i, v + [0.0] * (8 - len(v))) for i, v in good], lambda i: i % 20 == 0, 20)
    assert set(got) == set(want)
    for i in want:
        assert [j for j, _ in got[i]] == [j for j, _ in want[i]]
        assert np.allclose([s for _, s in got[i]], [s for _, s in want[i]], atol=1e-12)
    few = answers_of(neighbours.nearest(df.filter("vec_id < 5"), F.lit(True), k=20))
    assert all(len(v) == 4 for v in few.values()) and len(few) == 5
    assert neighbours.nearest(df.limit(0), F.lit(True)).count() == 0
    assert neighbours.nearest(df.filter("vec_id = 300"), F.lit(True)).count() == 0
    assert neighbours.nearest(df, F.lit(False)).count() == 0


@pytest.mark.parametrize("block, queries", [(4096, 16384), (300, 20)])
def test_recall(spark, monkeypatch, block, queries):
    monkeypatch.setattr(neighbours, "BLOCK", block)
    monkeypatch.setattr(neighbours, "QUERIES", queries)
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, np.array(r.embedding)) for r in vectors.collect()]
    ids, matrix = np.array([i for i, _ in rows]), np.array([v for _, v in rows])
    got = answers_of(neighbours.nearest(vectors, F.col("vec_id") % 20 == 0))
    assert set(got) == set(ids[ids % 20 == 0].tolist())
    hit = 0
    for i, near in got.items():
        score = matrix @ matrix[ids == i][0]
        order = [j for j in ids[np.lexsort((ids, -score))].tolist() if j != i][:20]
        hit += len(set(order) & {j for j, _ in near})
    assert hit / (20 * len(got)) > 0.9


def test_ties_go_to_the_smaller_id(spark):
    """Signs only, so that far more than twice k vectors tie; every vector is ranked again."""
    rng = np.random.default_rng(3)
    vectors = {tuple(v) for v in rng.choice([-1.0, 1.0], size=(700, 12)).tolist()}
    ids = rng.permutation(5000)[: len(vectors)].tolist()
    rows = list(zip(ids, map(list, sorted(vectors)), strict=True))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = answers_of(neighbours.nearest(df, F.col("vec_id") % 20 == 0, k=20, rerank=1.0))
    assert got == exact(rows, lambda i: i % 20 == 0, 20)


@pytest.mark.parametrize("size", ["sf0.001", "sf0.1"])
def test_recall_of_the_query(spark, size):
    folder = f"/root/testdata/{size}"
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    ids, matrix = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows])
    got = answers_of(QUERIES["op4_permutation_neighbours"](spark, folder))
    hit = 0
    for i, near in got.items():
        score = matrix @ matrix[ids == i][0]
        order = [j for j in ids[np.lexsort((ids, -score))].tolist() if j != i][:20]
        hit += len(set(order) & {j for j, _ in near})
    assert hit / (20 * len(got)) > 0.93


# ---- chats


def chats_by_force(rows):
    said = defaultdict(set)
    for c, turn, role, text in rows:
        if c is not None and turn is not None:
            said[c].add((turn, role or "", text or ""))
    said = {c: [(r, t) for _, r, t in sorted(v)] for c, v in said.items()}
    kept = [
        c
        for c, a in said.items()
        if not any(o != c and b[: len(a)] == a and (len(b) > len(a) or o < c) for o, b in said.items())
    ]
    return {c: "".join(f"<|{r}|>\n{t}\n<|end|>\n" for r, t in said[c]) for c in kept}


CHATS = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("part", [1024, 2])
def test_snapshots(spark, part):
    talk = [("system", "be kind"), ("user", "hi\nthere"), ("assistant", ""), ("user", None), (None, "x" * 5000)]
    rows = []
    for c in range(1, 6):  # snapshots of one conversation, each a turn longer
        rows += [(c, i * 3, *talk[i]) for i in range(c)]
    rows += [(6, i, *talk[i]) for i in range(5)]  # equal to 5, other turn numbers
    rows += [(7, 0, "system", "be kind"), (7, 1, "user", "bye")]  # branches off
    rows += [(8, 0, "user", "tie"), (8, 0, "user", "tie"), (8, 0, "assistant", "tie"), (8, -4, "user", "first")]
    rows += [(None, 0, "user", "nobody"), (9, None, "user", "nowhere"), (10, 20_000_000, None, None), (10, 3, "", "")]
    df = spark.createDataFrame(rows, CHATS).withColumn("pos", F.lit("clash"))
    got = defaultdict(list)
    for r in sorted(chat.format_chats(df, part).collect(), key=lambda r: (r.conv_id, r.part)):
        assert r.part == len(got[r.conv_id]) and r.n_turns <= part and r.text.count("<|end|>") == r.n_turns
        got[r.conv_id].append(r.text)
    assert {c: "".join(p) for c, p in got.items()} == chats_by_force(rows)
    assert chat.format_chats(df.limit(0)).count() == 0


def test_one_endless_conversation(spark):
    rows = spark.range(40_000).selectExpr("id % 2 as conv_id", "id div 2 as turn", "'user' as role", "cast(id div 2 as string) as text")
    rows = rows.filter("not (conv_id = 1 and turn > 19000)")
    got = chat.format_chats(rows, 1000).collect()
    assert {r.conv_id for r in got} == {0} and sum(r.n_turns for r in got) == 20_000 and len(got) == 20


# ---- pipeline


@pytest.fixture(scope="module")
def stages(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").cache()
    made = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, data).cache()
        made.append((name, docs))
    yield dict(made)
    # later tests read the same tables and must not meet cached ones
    for _, df in made:
        df.unpersist()


def ids(df):
    return Counter(r.doc_id for r in df.select("doc_id").collect())


def test_stages_keep_the_columns(stages):
    columns = stages["documents"].columns
    *others, last = stages.values()
    assert all(df.columns == columns for df in others) and last.columns[: len(columns)] == columns


def test_toxic_documents_go(spark, data, stages):
    docs, labels = stages["documents"], spark.read.parquet(f"{data}/labels.parquet")
    model = toxicity.train(docs, labels, ~toxicity.held_out(5, 0))
    want = ids(docs) - ids(toxicity.score(docs, model).filter("toxic"))
    assert ids(stages["toxicity"]) == want


def test_lines_of_different_texts_go(stages):
    rows = [(r.doc_id, r.text) for r in stages["toxicity"].collect()]
    texts = {t for _, t in rows}
    seen = Counter(k for t in texts for k in {x.strip(" \t\n\r\v\f").encode().lower() for x in t.split("\n")} if k)
    for r, (i, t) in zip(
        sorted(stages["line dedup"].collect(), key=lambda r: r.doc_id), sorted(rows), strict=True
    ):
        kept = [x for x in t.split("\n") if seen[x.strip(" \t\n\r\v\f").encode().lower()] < lines.MIN_DOCS]
        assert (r.doc_id, r.text, r.n_chars) == (i, "\n".join(kept), len("\n".join(kept)))


def test_one_near_copy_stays(stages):
    rows = [(r.doc_id, r.text) for r in stages["line dedup"].collect()]
    sets = [simhash.shingle_set(t) for _, t in rows]
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if rows[a][1] == rows[b][1] or (len(sets[a]) and simhash.alike(sets[a], sets[b])):
                one, two = group[a], group[b]
                group = [two if g == one else g for g in group]
    least = {}
    for g, (i, _) in zip(group, rows, strict=True):
        least[g] = min(i, least.get(g, i))
    assert ids(stages["near-dedup"]) == Counter(least.values())


def test_documents_with_items_go(spark, data, stages):
    bench = spark.read.parquet(f"{data}/benchmark.parquet")
    found = ids(decontaminate.contaminated(stages["near-dedup"], bench).select("doc_id").distinct())
    assert found and ids(stages["decontamination"]) == ids(stages["near-dedup"]) - found


def test_pieces_of_what_is_left(stages):
    library = pieces.sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    rows = stages["pieces"].collect()
    assert Counter(r.doc_id for r in rows) == ids(stages["decontamination"])
    assert all(r.round_trip and r.ids == library.encode(r.text) for r in rows)


def test_run(spark, data, stages):
    got = corpus_pipeline.run(spark, data)
    assert sorted(map(str, got.collect())) == sorted(map(str, stages["pieces"].collect()))


WORKING = ["_scan", "_upper", "_at", "_id", "_node", "_k0", "_rank", "_toxic", "_d0", "_DIGIT", "_letters"]


def test_pipeline_on_empty_odd_and_clashing_tables(spark, odd, none):
    """Every stage keeps a caller's columns, whatever their names, and takes odd rows and no rows."""
    folder = "/root/testdata/sf0.001"
    for name, stage in corpus_pipeline.STAGES:
        docs = odd.withColumns({c: F.lit("mine") for c in WORKING})
        out = stage(spark, docs, folder)
        assert set(docs.columns) <= set(out.columns), name
        rows = out.select("doc_id", *WORKING).collect()
        assert rows and all(r[c] == "mine" for r in rows for c in WORKING), name
        assert stage(spark, none, folder).count() == 0, name


def test_clashing_columns_of_scores(spark, odd):
    docs = odd.withColumns({c: F.lit("mine") for c in WORKING})
    for made in (toxicity.score(docs, toxicity.Model({"fox": 2.0}, 1.0, 1.0, 0.0, 1.0)), quality_rules.score(docs, quality_rules.Model(0.0, ()))):
        assert all(r[c] == "mine" for r in made.select(*WORKING).collect() for c in WORKING)
