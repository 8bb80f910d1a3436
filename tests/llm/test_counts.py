"""Centroid clusters, token counts and ranked search: against plain versions of each."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tests.llm.conftest import LONG, ODD_TEXTS, WALL
from turnloom.llm import clusters, lexical, tokens
from turnloom.llm.queries import QUERIES

# ---- clusters


def lloyd(rows, k, rounds, seed="3"):
    """Rows of (vec_id, whole components): assignment, distances and centroids by Python integers."""
    named = [r for r in rows if r[0] is not None]
    start = sorted(named, key=lambda r: (hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))[:k]
    centroids = [list(x) for _, x in start]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), i) for i, c in enumerate(centroids))

    for _ in range(rounds):
        at = [nearest(x)[1] for _, x in rows]
        for c in range(len(centroids)):
            own = [x for (_, x), a in zip(rows, at, strict=True) if a == c]
            if own:
                centroids[c] = [sum(v) // len(own) for v in zip(*own, strict=True)]
    ends = [nearest(x) for _, x in rows]
    inertia = Counter()
    for d, c in ends:
        inertia[c] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(
        ((i is None, i or 0), c, d, inertia[c], sum(inertia.values()), sha[c]) for (i, _), (d, c) in zip(rows, ends, strict=True)
    )


def clustered(df, **options):
    got = clusters.cluster(df, **options).drop("centroid").collect()
    return sorted(((r[0] is None, r[0] or 0), *r[1:]) for r in got)


@pytest.mark.parametrize("rounds", [0, 1, 6])
def test_rounds_match_integers(spark, rounds):
    rng = random.Random(rounds)
    good = [(i, [rng.uniform(-2, 2) for _ in range(4)]) for i in range(120)]
    good += [(7, good[3][1]), (7, good[3][1]), (None, good[5][1]), (500, [0.0] * 4), (501, [-1e-9, 0.0, 0.0, 0.0])]
    bad = [None, [], [1.0] * 3, [1.0] * 5, [1.0, None, 0.0, 0.0], [float("nan")] * 4, [1.0, float("inf"), 0.0, 0.0], [1e300, 0.0, 0.0, 0.0]]
    rows = good + [(900 + i, v) for i, v in enumerate(bad)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    df = df.withColumns({c: F.lit("clash") for c in ("x", "dots", "cluster", "c", "n", "sums", "j", "distance")}).repartition(3)
    want = lloyd([(i, [math.floor(1024 * c) for c in v]) for i, v in good], 5, rounds)
    assert clustered(df, k=5, rounds=rounds, dim=4) == want


def test_equally_near_and_empty_clusters(spark):
    rows = [(i, [float(i % 2), 0.0]) for i in range(6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    want = lloyd([(i, [1024 * int(a), 0]) for i, (a, _) in rows], 6, 3)
    assert clustered(df, k=6, rounds=3, dim=2) == want and len({r[1] for r in want}) == 2


def test_few_or_no_vectors(spark):
    df = spark.createDataFrame([(1, [1.0]), (2, [2.0])], "vec_id long, embedding array<float>")
    assert [r[1:3] for r in clustered(df, k=8, rounds=2, dim=1)] == [r[1:3] for r in lloyd([(1, [1024]), (2, [2048])], 8, 2)]
    for empty in (df.limit(0), df.filter("vec_id = 1").withColumn("embedding", F.lit(None).cast("array<float>"))):
        got = clusters.cluster(empty, dim=1)
        assert got.count() == 0 and got.columns == clusters.cluster(df, dim=1).columns


def test_largest_components(spark):
    most = clusters.largest(2) // 1024
    rows = [(1, [float(most), float(-most)]), (2, [float(-most), float(most)]), (3, [float(most + 2), 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert clustered(df, k=1, rounds=0, dim=2) == lloyd([(i, [1024 * int(a) for a in v]) for i, v in rows[:2]], 1, 0)


# ---- tokens


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=tokens.MODEL)


def counts(df):
    return Counter((r.n_bytes, r.n_tokens) for r in df.collect())


def wanted(library, texts):
    return Counter((len((t or "").encode()), len(library.encode(t or ""))) for t in texts)


@pytest.mark.parametrize("whole, step, overlap", [(32_768, 16_384, 128), (60, 40, 12), (10, 3, 2), (1, 1, 1)])
def test_odd_texts_have_the_librarys_count(spark, library, odd, whole, step, overlap):
    clash = odd.withColumns({c: F.lit("clash") for c in ("n_tokens", "n_bytes", "key_a", "key_b", "n", "part", "final", "chunk")})
    if step < 10:
        clash = clash.filter(F.coalesce(F.length("text"), F.lit(0)) < 1000)
    got = tokens.count_tokens(clash, whole=whole, step=step, overlap=overlap)
    texts = [t for _, t in ODD_TEXTS if step >= 10 or len(t or "") < 1000]
    assert counts(got) == wanted(library, texts)
    assert got.columns == [c for c in clash.columns if c not in ("n_bytes", "n_tokens")] + ["n_bytes", "n_tokens"]
    assert {r.label for r in got.collect()} == {"clash"}


def random_texts(seed, n=60):
    rng = random.Random(seed)
    parts = ["the", " ", "  ", "ing", "1", "x1", "é", "日本", "😀", "\n", "\t", "▁", "<s>", "</s>", "aaaa", "\0", "ſ", "Hello", ".", "-" * 7, " " * 9]
    return ["".join(rng.choices(parts, k=rng.randrange(1, 120))) for _ in range(n)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_splices_of_random_texts(spark, library, seed):
    texts = random_texts(seed)
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = tokens.count_tokens(df, whole=20, step=16, overlap=5 + 3 * seed)
    assert counts(got) == wanted(library, texts)


def test_overlaps_without_agreement_are_widened(spark, library, monkeypatch):
    tried = []
    cut = tokens._cut
    monkeypatch.setattr(tokens, "_cut", lambda texts, step, overlap: tried.append(step) or cut(texts, step, overlap))
    # runs of one letter are cut into pieces from their start, so chunks may never agree
    texts = ["a" * 997, "ab" * 500, " " * 1001, "=" * 777, "word " * 300]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = counts(tokens.count_tokens(df, whole=50, step=31, overlap=6))
    assert got == wanted(library, texts) and len(tried) > 1


def test_copies_of_a_huge_text_and_none(spark, library):
    df = spark.createDataFrame([(i, LONG) for i in range(8)] + [(9, WALL)], "doc_id long, text string")
    got = tokens.count_tokens(df).groupBy("n_tokens").count().collect()
    assert {(r.n_tokens, r["count"]) for r in got} == {(len(library.encode(LONG)), 8), (len(library.encode(WALL)), 1)}
    assert tokens.count_tokens(df.limit(0)).count() == 0


def test_whole_table(spark, data, library, documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    for r in QUERIES["op12_token_counts"](spark, data).collect():
        n = len(library.encode(texts[r.doc_id]))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 4096)


# ---- search


def brute(items, docs, k=10):
    def terms(text):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        return re.findall(lexical.TERM, low)

    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n_docs, n_terms = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    rows = []
    for item, own in asked.items():
        scored = []
        for doc, c in held:
            m = 100 - 90 + 90 * sum(c.values()) * n_docs // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
                for t in own
                if t in c
            )
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        rows += [(item, r, None if null else d, -s) for r, (s, null, d) in enumerate(sorted(scored)[:k], 1)]
    return Counter(rows)


def found(df):
    return Counter((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect())


@pytest.mark.parametrize("block", [lexical.BLOCK, 60])
def test_odd_documents_and_items(spark, odd, block):
    items = [(1, "The FOX and the dog"), (2, None), (3, ""), (4, "!!! ..."), (None, "shared line"), (5, "word7 tail3 word7"), (5, "naïve 日本語")]
    asked = spark.createDataFrame([(i, t, "clash", "clash") for i, t in items], "item_id long, text string, term string, doc_id string")
    docs = odd.withColumns({c: F.lit("clash") for c in ("term", "terms", "n", "item_id", "salt", "rank")})
    got = lexical.search(asked, docs, k=3, block=block)
    assert found(got) == brute(items, ODD_TEXTS, 3)
    assert lexical.search(asked.limit(0), docs).count() == 0
    assert lexical.search(asked, docs.limit(0)).count() == 0
    assert lexical.search(asked.filter("item_id = 4"), docs).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_random_ties(spark, monkeypatch, seed):
    monkeypatch.setattr(lexical, "GROUP", 40)
    monkeypatch.setattr(lexical, "HELD", 30)
    rng = random.Random(seed)
    words = ["a", "b", "B", "c", "d", "dé", "e-f", "g_h", "ab", "É", "0", "x1"]
    docs = [(rng.choice([None, *range(90)]), " ".join(rng.choices(words, k=rng.randrange(0, 6)))) for _ in range(150)]
    items = [(i, " ".join(rng.choices(words, k=rng.randrange(0, 5)))) for i in range(12)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert found(lexical.search(asked, df, k=4)) == brute(items, docs, 4)


def test_blocks_hold_their_bound(spark):
    rows = spark.range(300).selectExpr("id as item_id", "transform(sequence(0, id % 7), i -> concat('t', id, '-', i)) as terms")
    parts = lexical.blocks_of(rows, 4000)
    sizes = [[64 + sum(16 + len(t) for t in r.terms) for r in p.collect()] for p in parts]
    assert sum(map(len, sizes)) == 300 and len(parts) > 3
    assert np.max([sum(s) for s in sizes]) <= 2 * 4000
