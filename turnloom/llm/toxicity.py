"""Toxicity: every maximal-scoring passage of a text under word log-odds, judged by extreme-value statistics.

Training, on a bounded sample of labelled documents:

1. A word's evidence is the number of different contexts (previous word, next word) it has in toxic and in clean
   documents, so copies and repeated lines count once.
2. Log-odds with a Dirichlet prior proportional to the word's frequency in all documents; a word's score is the
   lower confidence bound of its log-odds. Words of at least ``EVIDENCE`` toxic contexts and a bound before the prior of at
   least ``LEAST_BOUND`` mark, however many they are; all others cost ``DRIFT``.
3. ``decay`` solves E[exp(decay * score)] = 1 over clean text (Karlin-Altschul), ``rate`` is fitted to the clean
   sample: a text of N words has about ``rate * N * exp(-decay * S)`` passages of score S or more by chance.
4. A logistic curve maps the surprise of a text's best passage, -ln P(score by chance), to a probability.

Steps 3 (``rate``) and 4 look at texts through words learned without them: the sample is dealt into ``FOLDS`` by the hash of the
text, so equal texts share a fold, and each fold is scanned with the words that the other folds teach.

Scoring is a linear scan (Ruzzo-Tompa) over the words of each text, without a shuffle.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pandas as pd
import xxhash
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnloom.llm import common

SAMPLE_ROWS = 20_000
FOLDS = 5
EVIDENCE = 3
LEAST_BOUND = 1.5
PRIOR = 500.0
FLOOR = 0.5
CONFIDENCE = 1.645  # one-sided, 95 %
DRIFT = 0.1
PIECE = 50_000
SIGNIFICANT = 0.01  # chance of a passage, below which it is reported
WORD = re.compile(r"\w+")
PASSAGES = "array<struct<start:int,end:int,score:double>>"


@dataclass(frozen=True)
class Model:
    """``scores`` of the marking words, the extreme-value parameters and the calibration curve."""

    scores: dict[str, float]
    decay: float
    rate: float
    intercept: float
    slope: float


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def maximal_segments(hits: list[tuple[int, float]], drift: float = 0.5) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first word, last word, score), given the words of positive score; others cost ``drift``."""
    found: list[tuple[int, int, float, float, int]] = []  # first, last, total before and after, nearest with less before
    total, at = 0.0, 0
    for word, score in hits:
        before = total - drift * (word - at)
        first, total, at = word, before + score, word + 1
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= before:
                j = found[j][4]
            if j < 0 or found[j][3] >= total:
                found.append((first, word, before, total, j))
                break
            first, before = found[j][0], found[j][2]
            del found[j:]
    return [(first, last, after - before) for first, last, before, after, _ in found]


def scan(scores: dict[str, float]) -> Column:
    """Struct of a text's word count, best segment score and segments as character spans."""
    known = frozenset(scores)

    @F.pandas_udf(f"n_words long, best double, passages {PASSAGES}")
    def segments(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            tokens = words(text)
            if known.isdisjoint(tokens):
                rows.append((len(tokens), 0.0, []))
                continue
            spans = [m.span() for m in WORD.finditer(text)]
            tokens = [text[a:b].lower() for a, b in spans]
            hits = [(i, scores[t]) for i, t in enumerate(tokens) if t in known]
            found = [
                {"start": spans[a][0], "end": spans[b][1], "score": s} for a, b, s in maximal_segments(hits, DRIFT) if s > 0
            ]
            rows.append((len(tokens), max((f["score"] for f in found), default=0.0), found))
        return pd.DataFrame(rows, columns=["n_words", "best", "passages"])

    return segments("text")


def surprise(model: Model, best: Column, n_words: Column) -> Column:
    """-ln of the chance that a clean text of this length has a passage of this score; 0 without one."""
    expected = model.rate * F.greatest(n_words, F.lit(1)) * F.exp(-model.decay * best)
    chance = F.when(expected < 1e-9, expected).otherwise(1 - F.exp(-expected))
    return F.when(best > 0, F.least(F.lit(60.0), -F.log(F.greatest(chance, F.lit(1e-30))))).otherwise(0.0)


def labelled(docs: DataFrame, labels: DataFrame, label: str, learn: Column, rows: int) -> DataFrame:
    """``text, label`` (0.0 or 1.0) of at most ``rows`` labelled documents that ``learn`` admits; a doc_id labelled twice
    counts once, with the larger label."""
    known = labels.filter(learn & F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.max(label).cast("double").alias("label"))
    sample = common.bounded_sample(known, rows, "doc_id")
    fold = F.pmod(F.xxhash64(F.lit("fold"), "text"), F.lit(FOLDS)).cast("int").alias("fold")
    return docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("text", "label", fold)


def contexts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """``word, context, label, fold`` of every word, in pieces of about ``PIECE`` rows."""
    names = ["word", "context", "label", "fold"]
    rows = []
    for batch in batches:
        for text, label, fold in zip(batch["text"], batch["label"], batch["fold"], strict=True):
            tokens = ["", *words(text), ""]
            for at in range(0, len(tokens) - 2, PIECE):
                part = tokens[at : at + PIECE + 2]
                near = zip(part, part[1:], part[2:], strict=False)
                rows += {(b, xxhash.xxh64_intdigest(f"{a} {c}") >> 1, label, fold) for a, b, c in near}
                if len(rows) >= PIECE:
                    yield pd.DataFrame(rows, columns=names)
                    rows = []
    yield pd.DataFrame(rows, columns=names)


def frequencies(docs: DataFrame, known: set[str]) -> tuple[dict[str, int], int]:
    """Occurrences of the known words in all documents, and of all words."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found, total = Counter(), 0
            for text in batch["text"]:
                tokens = words(text)
                total += len(tokens)
                if not known.isdisjoint(tokens):
                    found.update(t for t in tokens if t in known)
            yield pd.DataFrame([*found.items(), ("", total)], columns=["word", "n"])

    counted = docs.select("text").mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    by_word = {r["word"]: r["n"] for r in counted.collect()}  # the known words and one more
    return by_word, by_word.pop("", 0)


def log_odds(yt: float, yc: float, nt: float, nc: float, prior: float, total: float) -> float:
    """Lower confidence bound of a word's log-odds, toxic against clean."""
    a, b = yt + prior, yc + prior
    delta = math.log(a / (nt + total - a)) - math.log(b / (nc + total - b))
    return delta - CONFIDENCE * math.sqrt(1 / a + 1 / b)


def decay_of(weighted: list[tuple[float, float]], drift: float) -> float:
    """The positive root of E[exp(x * score)] = 1; ``weighted`` are (probability, score) of the scoring words."""
    rest = 1 - sum(p for p, _ in weighted)

    def over(x: float) -> float:
        return sum(p * math.exp(min(x * s, 700)) for p, s in weighted) + rest * math.exp(-x * drift) - 1

    low, high = 1e-6, 1.0
    while over(high) < 0 and high < 64:
        low, high = high, high * 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if over(middle) < 0 else (low, middle)
    return high


def evidence(sample: DataFrame) -> DataFrame:
    """``word``, ``toxic`` and ``clean``: numbers of contexts as arrays, first of the whole sample, then of the sample without fold 0, 1, ..."""
    met = sample.mapInPandas(contexts, "word string, context long, label double, fold int")
    met = met.groupBy("word", "context", "label").agg(F.min("fold").alias("low"), F.max("fold").alias("high"))

    def count(label: float) -> Column:
        own = F.col("label") == label
        left = [own & ~((F.col("low") == k) & (F.col("high") == k)) for k in range(FOLDS)]
        return F.array(*[F.sum(c.cast("long")) for c in (own, *left)])

    return met.groupBy("word").agg(count(1.0).alias("toxic"), count(0.0).alias("clean"))


def marking(
    rows: list[tuple[str, int, int]], nt: int, nc: int, often: dict[str, int], total: int
) -> tuple[dict[str, float], float]:
    """Scores of the words that mark, of (word, toxic contexts, clean contexts), and the decay that follows from them."""
    scores, weighted = {}, []
    for word, yt, yc in rows:
        if yt < EVIDENCE or not nt or not nc or log_odds(yt, yc, nt, nc, FLOOR, 2 * FLOOR) < LEAST_BOUND:
            continue
        prior = PRIOR * often.get(word, 0) / max(total, 1) + FLOOR
        score = log_odds(yt, yc, nt, nc, prior, PRIOR)
        if score > 0:
            scores[word] = score
            weighted.append(((yc + prior) / (nc + PRIOR), score))
    return scores, decay_of(weighted, DRIFT) if scores else 1.0


def train(
    docs: DataFrame, labels: DataFrame, learn: Column, label: str = "toxic", rows: int = SAMPLE_ROWS
) -> Model:
    """Model from at most ``rows`` labelled documents and the word frequencies of all documents.

    Words of enough evidence come to the driver; their number grows with the sample and not with ``docs``. With no toxic or no clean
    document in the sample, or no word that marks, the model scores every text by the base rate.
    """
    sample = common.settle(labelled(docs, labels, label, learn, rows))
    counts = common.settle(evidence(sample))
    by_label = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    toxic, clean = by_label.get(1.0, 0), by_label.get(0.0, 0)
    base = math.log((toxic + 1) / (clean + 1))
    sums = [F.sum(F.col(c)[k]) for k in range(FOLDS + 1) for c in ("toxic", "clean")]
    totals = [n or 0 for n in counts.agg(*sums).first()]
    if not toxic or not clean:
        return Model({}, 1.0, 1.0, base, 0.0)
    known = counts.filter(F.col("toxic")[0] >= EVIDENCE).collect()
    often, total = frequencies(docs, {r["word"] for r in known})
    lexica = [
        marking([(r["word"], r["toxic"][k], r["clean"][k]) for r in known], *totals[2 * k : 2 * k + 2], often, total)
        for k in range(FOLDS + 1)
    ]
    (scores, decay), parts = lexica[0], []
    if not scores:
        return Model({}, 1.0, 1.0, base, 0.0)
    for k, (others, slower) in enumerate(lexica[1:]):
        part = sample.filter(F.col("fold") == k).select("label", scan(others).alias("s"))
        parts.append(part.select("label", "s.n_words", (F.col("s.best") * (slower / decay)).alias("best")))
    scanned = common.settle(reduce(DataFrame.union, parts))
    by_chance, length = (
        scanned.filter("label = 0").agg(F.sum((F.col("best") > 0).cast("int")), F.sum("n_words")).first()
    )
    draft = Model(scores, decay, (by_chance + FLOOR) / max(length, 1), 0.0, 0.0)
    x = surprise(draft, F.col("best"), F.col("n_words")).alias("x")
    data = VectorAssembler(inputCols=["x"], outputCol="features").transform(scanned.select("label", x))
    fit = LogisticRegression(regParam=1e-4, maxIter=50).fit(data)
    return Model(scores, decay, draft.rate, float(fit.intercept), max(0.0, float(fit.coefficients[0])))


def probability(model: Model, scanned: Column) -> Column:
    worth = surprise(model, scanned["best"], scanned["n_words"])
    return 1 / (1 + F.exp(-(F.lit(model.intercept) + F.lit(model.slope) * worth)))


def is_toxic(model: Model) -> Column:
    """Whether the column ``text`` has a score of at least 0.5; never null."""
    return probability(model, scan(model.scores)) >= 0.5


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score`` (0 to 1), ``toxic`` (score at least 0.5) and ``passages``: start and end (characters) and score of
    every passage whose chance is below ``SIGNIFICANT``, in text order.

    Whole texts are scanned; null and empty texts have no passage and get the lowest score. Columns of these names are
    replaced, others are kept, rows are neither dropped nor added.
    """
    name = common.fresh("_scan", docs.columns)
    s = F.col(name)
    least = F.log(F.lit(model.rate) * F.greatest(s["n_words"], F.lit(1)) / SIGNIFICANT) / model.decay
    found = docs.withColumn(name, scan(model.scores))
    found = found.withColumns(
        {
            "score": probability(model, s),
            "passages": F.filter(s["passages"], lambda p: p["score"] >= least),
        }
    )
    return found.withColumn("toxic", F.col("score") >= 0.5).drop(name)


def held_out(parts: int, rest: int) -> Column:
    """Whether crc32 of the doc_id's text leaves ``rest`` when divided by ``parts``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts == rest
