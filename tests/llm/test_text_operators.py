"""Pieces, leaks, toxic passages, quality rules and secrets: against the library, brute force and held-out labels."""

import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from turnloom.llm import decontaminate, pieces, quality_rules, secret_scan, toxicity
from turnloom.llm.queries import QUERIES

# ---- pieces


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)


def encoded(texts):
    ids, bounds = pieces.Encoder(pieces.vocabulary_of(pieces.MODEL)).encode(texts)
    return [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:], strict=False)]


def test_encoding_is_the_librarys(library):
    rng = random.Random(5)
    parts = ["a", "b", "e", " ", "th", "in", "▁", "\n", "é", "ß", "x", "1", "ing", "😀", "er", "\t", "0", "=", "==", "  ", "\0"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    spans = [(32, 126), (0, 0x2FF), (0x4E00, 0x9FFF), (1, 0xD7FF)]
    texts += ["".join(chr(rng.randint(*rng.choice(spans))) for _ in range(rng.randint(0, 30))) for _ in range(1000)]
    texts += [" " * n + "x" + " " * m for n in range(40) for m in (0, 1, 17)] + ["a" * 3000, "▁<s> </s> <0x41>"]
    assert encoded(texts) == library.encode(texts)


def test_units_learnt_in_several_slices(library, monkeypatch):
    monkeypatch.setattr(pieces, "SLICE", 50)
    monkeypatch.setattr(pieces, "KNOWN", 20)
    texts = [f"some words {i} and others {i * 7919}\nmore" for i in range(60)]
    encoder = pieces.Encoder(pieces.vocabulary_of(pieces.MODEL))
    for text in texts:
        ids, _ = encoder.encode([text])
        assert ids.tolist() == library.encode(text)


def test_few_new_units(library):
    """A batch whose new units have fewer characters than a number holds."""
    for text in ["a", "ab", "abcd", "abcdefgh", "x" * 14, "é", "\0", "日本"]:
        encoder = pieces.Encoder(pieces.vocabulary_of(pieces.MODEL))
        for said in ["known words", f"known {text} words", text]:
            assert encoder.encode([said])[0].tolist() == library.encode(said)
    rng = np.random.default_rng(4)
    for n in range(1, 24):
        codes = rng.integers(0, 3, n)
        order = pieces.suffix_array(codes, 16)
        assert [codes[i : i + 16].tolist() for i in order] == sorted(codes[i : i + 16].tolist() for i in range(n))


def test_pieces_of_odd_rows(odd, none, library):
    made = pieces.decode(pieces.encode(odd, round_trip="label"))
    assert made.columns == [*[c for c in odd.columns if c not in ("ids", "label")], "ids", "label", "decoded"]
    assert all(r.label for r in made.collect())
    for r in made.collect():
        assert r.ids == (None if r.text is None else library.encode(r.text))
        assert r.decoded == (None if r.text is None else r.text.replace("▁", " "))
    assert made.count() == odd.count() and pieces.decode(pieces.encode(none)).count() == 0


def test_decode_of_odd_ids(spark):
    rows = [([None, 5, 99_999, 300, -1],), (None,), ([],), ([pieces.vocabulary_of(pieces.MODEL).bytes[0xFF].item()],)]
    got = [r.decoded for r in pieces.decode(spark.createDataFrame(rows, "ids array<int>")).collect()]
    assert got[1:] == [None, "", "�"]


def test_pieces_of_the_whole_table(spark, data, documents, library):
    texts = {r.doc_id: r.text for r in documents.collect()}
    for r in QUERIES["op3_sentencepiece"](spark, data).collect():
        assert r.round_trip and r.ids == library.encode(texts[r.doc_id]) and r.n_ids == len(r.ids)


# ---- benchmark leaks


def leaks_by_force(text, items, least=decontaminate.SIMILARITY):
    tokens, found = decontaminate.words(text), set()
    for item, words in items:
        size = min(decontaminate.SHINGLE, len(words))
        grams = {tuple(words[k : k + size]) for k in range(len(words) - size + 1)}
        at = [p for p in range(len(tokens) - size + 1) if tuple(tokens[p : p + size]) in grams]
        for s in range(at[0] - len(words), at[-1] + len(words)) if at and words else ():
            a, b = max(0, s), min(len(tokens), s + len(words))
            if b > a and decontaminate.similarity(tokens[a:b], words, size) >= least:
                found.add(item)
                break
    return found


def test_changed_passages_are_found(spark, data, documents):
    rng = random.Random(2)
    items = [tuple(r) for r in spark.read.parquet(f"{data}/benchmark.parquet").select("item_id", "text").collect()]
    index = decontaminate.Index(items, decontaminate.SIMILARITY, decontaminate.RADIUS)
    texts = [r.text for r in documents.filter("length(text) < 4000").limit(60).collect()]
    found = 0
    for _ in range(250):
        words = list(rng.choice(index.items)[1])
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            p = rng.randrange(len(words))
            words[p : p + rng.randint(0, 1)] = rng.choice([[], ["zzq"], [f"new{rng.randrange(99)}"]])
        own = rng.choice(texts).split()
        p = rng.choice([0, len(own), rng.randrange(len(own) + 1)])
        text = " ".join([*own[:p], *words, *own[p:]])
        want = leaks_by_force(text, index.items)
        assert {leak["item_id"] for leak in index.leaks(text)} == want
        found += len(want)
    assert found > 100


def test_leaks_of_the_whole_table(spark, data, documents, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK", 4_000)  # several blocks
    bench = spark.read.parquet(f"{data}/benchmark.parquet")
    items = [(r.item_id, decontaminate.words(r.text)) for r in bench.collect()]
    want = {(r.doc_id, i) for r in documents.collect() for i in leaks_by_force(r.text, items)}
    got = [(r.doc_id, r.item_id) for r in QUERIES["op5_benchmark_leaks"](spark, data).collect()]
    assert set(got) == want and len(got) == len(want) > 0


def test_leaks_of_odd_rows(spark, odd, none):
    bench = spark.createDataFrame(
        [(1, "quick brown fox jumps over the lazy dog"), (2, None), (3, ""), (None, "some words here to read"), (5, "a"), (5, "a")],
        "item_id long, text string",
    ).withColumn("key", F.lit("clash"))
    got = Counter((r.doc_id, r.item_id) for r in decontaminate.contaminated(odd, bench).collect())
    assert got[1, 1] == got[10, 1] == 1 and got[None, None] == 1 and got[7, 5] == 2
    kept = decontaminate.without_leaks(odd, bench)
    assert kept.columns == odd.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([2, 3, 4, 5, 6, 8, 8, 9])
    assert decontaminate.without_leaks(none, bench).count() == 0
    assert decontaminate.without_leaks(odd, bench.limit(0)).count() == odd.count()


# ---- toxicity


def segments_by_force(scores):
    best = None
    for i in range(len(scores)):
        total = 0.0
        for j in range(i, len(scores)):
            total += scores[j]
            if total > 1e-12 and (best is None or total > best[2] + 1e-12):
                best = (i, j, total)
    if best is None:
        return []
    i, j, _ = best
    right = [(a + j + 1, b + j + 1, s) for a, b, s in segments_by_force(scores[j + 1 :])]
    return [*segments_by_force(scores[:i]), best, *right]


def test_maximal_segments():
    rng = random.Random(3)
    for _ in range(300):
        scores = [rng.choice([-0.5] * 4 + [rng.random() * 3]) for _ in range(rng.randint(0, 25))]
        got = toxicity.maximal_segments([(i, s) for i, s in enumerate(scores) if s > 0])
        want = segments_by_force(scores)
        assert [g[:2] for g in got] == [w[:2] for w in want]
        assert np.allclose([g[2] for g in got], [w[2] for w in want])


def auc(label, score):
    order = np.argsort(score, kind="stable")
    _, at, n = np.unique(np.asarray(score)[order], return_inverse=True, return_counts=True)
    rank = (np.cumsum(n) - (n - 1) / 2)[at]
    ones = np.asarray(label)[order] == 1
    k = ones.sum()
    return (rank[ones].sum() - k * (k + 1) / 2) / (k * (~ones).sum())


def test_toxicity_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    got = QUERIES["op10_toxic_passages"](spark, folder).join(labels, "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert held and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert auc([r.toxic for r in held], [r.score for r in held]) > 0.95
    assert sum(r.predicted and not r.toxic for r in held) <= 0.01 * len(held)
    assert sum(r.predicted and r.toxic for r in held) >= 0.85 * sum(r.toxic for r in held)


def test_evidence_counts_contexts(spark):
    """Against sets: contexts of every word by label, of the whole sample and without each fold."""
    rng = random.Random(5)
    rows = [(" ".join(rng.choices("abcd", k=rng.randint(0, 6))), float(rng.random() < 0.5), rng.randrange(toxicity.FOLDS)) for _ in range(60)]
    got = {r.word: (r.toxic, r.clean) for r in toxicity.evidence(spark.createDataFrame(rows, "text string, label double, fold int")).collect()}
    met = set()
    for text, label, fold in rows:
        tokens = ["", *text.split(), ""]
        met |= {(b, (a, c), label, fold) for a, b, c in zip(tokens, tokens[1:], tokens[2:], strict=False)}
    for word in "abcd":
        for label, mine in ((1.0, got[word][0]), (0.0, got[word][1])):
            left = [{c for w, c, at, f in met if w == word and at == label and f != k} for k in (-1, *range(toxicity.FOLDS))]
            assert mine == [len(x) for x in left]


def test_words_of_equal_evidence_are_treated_alike():
    rows = [(f"w{i}", 9, 0) for i in range(6000)] + [("rare", 2, 0), ("plain", 9, 90)]
    scores, _ = toxicity.marking(rows, 60_000, 600_000, {}, 1_000_000)
    assert set(scores) == {f"w{i}" for i in range(6000)} and len(set(scores.values())) == 1


def test_toxicity_of_odd_rows(spark, odd, none):
    docs = spark.createDataFrame(
        [(i, f"w{i % 7} {'vile' if i % 2 else 'kind'} w{i % 5} and w{i % 3}") for i in range(60)], "doc_id long, text string"
    )
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    model = toxicity.train(docs, labels.union(labels).unionByName(spark.createDataFrame([(None, 1), (3, None)], labels.schema)), F.lit(True))
    assert "vile" in model.scores and "kind" not in model.scores
    scored = toxicity.score(docs, model).collect()
    assert all(r.toxic == bool(r.doc_id % 2) for r in scored)
    assert all(r.text[p.start : p.end] == "vile" for r in scored for p in r.passages)
    made = toxicity.score(odd, model)
    assert made.columns == [*odd.columns, "passages", "toxic"] and not any(r.toxic for r in made.collect())
    assert toxicity.score(none, model).count() == 0
    untaught = toxicity.train(none, labels, F.lit(True))
    assert {r.score for r in toxicity.score(odd, untaught).collect()} == {0.5}


# ---- quality


def test_quality_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    got = QUERIES["op9_quality_rules"](spark, folder).join(labels, "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert auc([r.quality for r in held], [r.score for r in held]) > 0.97
    assert sum(r.predicted == r.quality for r in held) > 0.95 * len(held)


def test_paths_of_a_tree():
    tree = """Tree
  If (feature 0 <= 1.5)
   If (feature 1 <= 2.0)
    Predict: 0.0
   Else (feature 1 > 2.0)
    Predict: 1.0
  Else (feature 0 > 1.5)
   Predict: 1.0"""
    low, high = (0, "<=", 1.5), (0, ">", 1.5)
    assert quality_rules.paths(tree) == {(low,), (high,), (low, (1, "<=", 2.0)), (low, (1, ">", 2.0))}
    assert quality_rules.simplified([(0, "<=", 3.0), (0, "<=", 1.0), (0, ">", 0.5)]) == ((0, "<=", 1.0), (0, ">", 0.5))


def test_quality_of_odd_rows(spark, odd, none):
    docs = spark.createDataFrame(
        [(i, "plain words in a line. " * 3 if i % 2 else "!!!! $$$ &&&") for i in range(80)], "doc_id long, text string"
    )
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    model = quality_rules.train(docs, labels.union(labels), F.lit(True))
    assert model.rules and all(r.good == bool(r.doc_id % 2) for r in quality_rules.score(docs, model).collect())
    made = quality_rules.score(odd, model)
    assert made.columns == [*odd.columns, "good"] and all(0 <= r.score <= 1 for r in made.collect())
    assert quality_rules.score(none, model).count() == 0
    untaught = quality_rules.train(none, labels, F.lit(True))
    assert {r.score for r in quality_rules.score(odd, untaught).collect()} == {0.5}


def test_statistics_are_named():
    assert quality_rules.NAMES == list(quality_rules.statistics(F.lit("x")))


# ---- secrets


def test_spans():
    text = 'token = "abc123def456" and 0123456789abcdef0 but words; password: hunter22, x=1'
    got = [(text[a:b], assigned) for a, b, assigned in secret_scan.spans(text)]
    assert got == [("abc123def456", True), ("0123456789abcdef0", False), ("hunter22", True)]


def test_secrets_on_held_out_findings(spark):
    got = QUERIES["op1_secret_findings"](spark, "/root/testdata/sf0.1").collect()
    held = [r for r in got if r.held_out]
    held = [r for r in held if r.label is not None]
    assert sum(r.label for r in held) > 10 and sum(not r.label for r in held) > 10
    assert sum(r.secret == bool(r.label) for r in held) > 0.95 * len(held)


def test_headers_and_long_names():
    def found(text):
        return [(text[a:b], assigned) for a, b, assigned in secret_scan.spans(text)]

    assert found("Authorization: Bearer aB3dE5fG7hJ9kL1m\n") == [("aB3dE5fG7hJ9kL1m", True)]
    assert found("auth => 'Basic  dXNlcjpwYXNz'") == [("dXNlcjpwYXNz", True)]
    assert found(f"x{'_' * 500}secret{'y' * 500}{' ' * 50}={' ' * 50}hunter2222") == [("hunter2222", True)]
    assert found("note: token=abcdef, secret-free: no, tokens are words") == [("abcdef", True)]
    assert found("token " * 50_000 + "token" * 50_000) == []


def test_findings_see_whole_words(spark):
    """Words around a candidate by brute force, however long and far they are."""
    rng = random.Random(11)
    words = ["a", "of", "é" * 70, "long" * 30, "key", " " * 60, "-", "x_1", "token=zz9zz9zz9", "Q7" * 12]
    for _ in range(200):
        text = rng.choice(["", " ", ": "]).join(rng.choice([" ", ". ", '"']) + rng.choice(words) for _ in range(12))
        around = secret_scan.Neighbours(text)
        for a, b, _ in secret_scan.spans(text):
            tokens = [(m.start(), m.end(), m.group().lower()) for m in secret_scan.WORD.finditer(text)]
            want = [w for _, e, w in tokens if e <= a][-3:] + [w for s, _, w in tokens if s >= b][:2]
            assert around.words(a, b) == want
            assert around.sign(a) == text[:a].rstrip("\"' ")[-2:]


def test_planted_secrets(spark):
    """A forest of reviewed findings: keys without a name are told from identifiers by what stands around them."""
    rng = random.Random(2)
    made = []
    for i in range(240):
        value = "".join(rng.choices("ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz23456789", k=rng.randint(18, 40))) + "7"
        whole = rng.choice(["commit", "build", "release"]) + "-2024-" + rng.choice(["update", "install", "network"]) + "-version-12"
        made.append((i, f"we rotated the key {value} after the leak" if i % 2 else f"see the notes of {whole} for more"))
    found = secret_scan.candidates(spark.createDataFrame(made, "doc_id long, text string"))
    known = found.withColumn("label", F.col("doc_id") % 2)
    scored = secret_scan.score(known, secret_scan.train(known.filter("doc_id < 160"))).filter("doc_id >= 160").collect()
    assert len(scored) == 80 and sum(r.secret == bool(r.doc_id % 2) for r in scored) >= 78


def test_labels_of_findings(spark):
    rows = [(True, 4.0, 20), (True, 1.0, 20), (True, 4.0, 6), (False, 1.0, 20), (False, 4.0, 20)]
    df = spark.createDataFrame(rows, "assigned boolean, entropy double, length int")
    got = df.select(secret_scan.silver(F.col("assigned"), F.col("entropy"), F.col("length")).alias("x")).collect()
    assert [r.x for r in got] == [1.0, 0.0, 0.0, 0.0, None]


def test_rules_by_plain_evaluation(spark, documents):
    """The compiled expression against the rules gone through one after another."""
    docs, labels = documents, spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    model = quality_rules.train(docs, labels, F.lit(True))
    stats = [s.alias(n) for n, s in quality_rules.statistics(F.col("text")).items()]
    seen = docs.select("doc_id", "text", *stats).dropDuplicates(["text"]).collect()
    scores = {r.text: r.score for r in quality_rules.score(docs, model).collect()}
    assert model.rules
    for r in seen:
        values = [r[n] for n in quality_rules.NAMES]
        fired = [w for w, rule in model.rules if all((values[at] <= bound) == (kind == "<=") for at, kind, bound in rule)]
        assert abs(scores[r.text] - 1 / (1 + np.exp(-(model.intercept + sum(fired))))) < 1e-9


def test_secrets_of_odd_rows(odd, none):
    found = secret_scan.candidates(odd).collect()
    assert {(r.doc_id, r.start, r.length) for r in found} >= {(6, 0, 120_000)}
    assert secret_scan.candidates(none).count() == 0 and secret_scan.candidates(odd.drop("source")).count() == len(found)
    assert secret_scan.train(secret_scan.candidates(odd).withColumn("label", F.lit(1))) is None
    assert all(r.secret for r in secret_scan.score(secret_scan.candidates(odd), None).collect())


def test_suffixes_are_sorted_from_several_characters(monkeypatch):
    """Few sorts: the first takes as many characters as fit into a number."""
    rng = random.Random(8)
    sorts, sort = [], np.argsort
    monkeypatch.setattr(np, "argsort", lambda *a, **k: sorts.append(1) or sort(*a, **k))
    for letters in ("ab", "abcdefghijklmnop", "a\0é😀"):
        codes = np.array([ord(rng.choice(letters)) for _ in range(400)], dtype=np.int64)
        del sorts[:]
        order = pieces.suffix_array(codes, 16).tolist()
        assert len(sorts) <= 3
        assert sorted(order) == list(range(400))
        heads = [codes[i : i + 16].tolist() for i in order]
        assert heads == sorted(heads)
