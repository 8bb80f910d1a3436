"""Quality classifier: a sparse ensemble of rules over text statistics.

Trees are grown on a bounded sample of labelled documents; every path from a root is a rule, a conjunction of
bounds on statistics. A logistic regression with a lasso penalty weighs the rules and drops most of them. What is left is
compiled into one Spark column expression, so scoring is a projection over whole texts.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnloom.llm import common

SAMPLE_ROWS = 20_000
TREES, DEPTH = 16, 4
PENALTY = 0.001
MIN_RULE_ROWS = 10


def statistics(text: Column) -> dict[str, Column]:
    """Statistics of a text by name; an empty or null text has 0 for all."""
    text = F.coalesce(text, F.lit(""))
    chars = F.greatest(F.length(text), F.lit(1)).cast("double")
    tokens = F.filter(F.split(text, r"[\s]+"), lambda w: w != "")
    lines = F.split(text, "\n")
    n_words = F.greatest(F.size(tokens), F.lit(1)).cast("double")

    def share(pattern: str) -> Column:
        return F.length(F.regexp_replace(text, pattern, "")) / chars

    def count(mark: str) -> Column:
        return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))

    return {
        "log_chars": F.log1p(F.length(text).cast("double")),
        "log_words": F.log1p(F.size(tokens).cast("double")),
        "word_length": F.length(text) / n_words,
        "upper": share(r"[^\p{Lu}]+"),
        "marks": share(r"[\p{L}\p{N}\s]+"),
        "digits": share(r"[^0-9]+"),
        "distinct_words": F.size(F.array_distinct(tokens)) / n_words,
        "distinct_lines": F.size(F.array_distinct(lines)) / F.size(lines).cast("double"),
        "line_length": F.length(text) / F.size(lines).cast("double"),
        "bars": count("|") / n_words,
        "shouts": count("!") / n_words,
        "stops": count(".") / n_words,
        "commas": count(",") / n_words,
        "multibyte": (F.octet_length(text) - F.length(text)) / chars,
    }


NAMES = (
    "log_chars log_words word_length upper marks digits distinct_words distinct_lines line_length bars shouts stops "
    "commas multibyte"
).split()

Rule = tuple[tuple[int, str, float], ...]  # (statistic, "<=" or ">", bound), all of which must hold


@dataclass(frozen=True)
class Model:
    intercept: float
    rules: tuple[tuple[float, Rule], ...]


def paths(tree: str) -> set[Rule]:
    """All rules of a printed tree: one for every inner path and leaf."""
    found, above = set(), []
    for line in tree.splitlines():
        test = re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line)
        if test:
            depth = len(test[1])
            above = [(d, t) for d, t in above if d < depth] + [(depth, (int(test[2]), test[3], float(test[4])))]
            found.add(simplified(t for _, t in above))
    return found


def simplified(tests) -> Rule:
    """The tightest bound of each kind on each statistic, in a fixed order."""
    tight: dict[tuple[int, str], float] = {}
    for at, kind, bound in tests:
        old = tight.get((at, kind))
        tight[at, kind] = bound if old is None else min(old, bound) if kind == "<=" else max(old, bound)
    return tuple((at, kind, bound) for (at, kind), bound in sorted(tight.items()))


def holds(rule: Rule, stats: list[Column]) -> Column:
    return reduce(and_, [stats[at] <= bound if kind == "<=" else stats[at] > bound for at, kind, bound in rule])


def train(docs: DataFrame, labels: DataFrame, learn: Column, label: str = "quality", rows: int = SAMPLE_ROWS) -> Model:
    """Model from at most ``rows`` labelled documents that ``learn`` admits; a doc_id labelled twice counts once, with the larger
    label. Without both labels in the sample the model has no rules and scores every text by the base rate."""
    known = labels.filter(learn & F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.max(label).cast("double").alias("label"))
    sample = F.broadcast(common.bounded_sample(known, rows, "doc_id"))
    stats = [s.alias(n) for n, s in statistics(F.col("text")).items()]
    sample = docs.select("doc_id", "text").join(sample, "doc_id").select("label", *stats)
    sample = common.settle(sample)
    n, good = sample.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    base = math.log((good + 1) / (n - good + 1))
    if good in (0, n):
        return Model(base, ())
    data = sample.select("label", array_to_vector(F.array(*NAMES)).alias("features"))
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, seed=1, minInstancesPerNode=MIN_RULE_ROWS, featureSubsetStrategy="onethird"
    ).fit(data)
    rules = sorted(set().union(*[paths(tree.toDebugString) for tree in forest.trees]))
    if not rules:
        return Model(base, ())
    columns = [F.col(name) for name in NAMES]
    fired = F.array(*[holds(rule, columns).cast("double") for rule in rules])
    data = common.settle(sample.select("label", fired.alias("fired"))).select("label", array_to_vector("fired").alias("features"))
    fit = LogisticRegression(regParam=PENALTY, elasticNetParam=1.0, standardization=False, maxIter=200).fit(data)
    kept = [(float(w), rule) for w, rule in zip(fit.coefficients, rules, strict=True) if w != 0]
    return Model(float(fit.intercept), tuple(kept))


def compiled(model: Model, columns: list[Column]) -> Column:
    """Score expression over the statistics, given as columns in the order of ``NAMES``."""
    total = F.lit(model.intercept)
    for weight, rule in model.rules:
        total = total + F.when(holds(rule, columns), F.lit(weight)).otherwise(0.0)
    return 1 / (1 + F.exp(-total))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: label 1 likelier) and ``good`` (score at least 0.5); columns of these names are
    replaced, others kept, rows neither dropped nor added. Whole texts are read; null and empty texts are scored alike."""
    stats = {common.fresh(f"_{name}", docs.columns): s for name, s in statistics(F.col("text")).items()}
    scored = docs.withColumns(stats).withColumn("score", compiled(model, [F.col(name) for name in stats]))
    return scored.withColumn("good", F.col("score") >= 0.5).drop(*stats)
