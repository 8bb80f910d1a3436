"""Secret scans: candidates by pattern, false positives removed by a random forest trained on labelled findings.

A candidate is a long token with a digit, or the value given to a name like ``token`` or ``password``. What the forest sees:
its length; how its characters follow each other (changes of kind, letter pairs that words have); how much of it
words of a dictionary cover; where it was found (the path); and the words around it. The dictionary and the letter
pairs come from the vocabulary of a public tokenizer.
"""

from __future__ import annotations

import math
import pickle
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import sentencepiece
import xxhash
from pyspark import cloudpickle
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnloom.llm import common
from turnloom.llm.pieces import MODEL

SAMPLE_ROWS = 20_000
TREES, DEPTH = 40, 8
BUCKETS = 12
BEFORE, AFTER = 3, 2  # neighbouring words that the forest sees
NAMES = "token secret passwd password pwd api_key apikey api-key access_key auth credential private_key bearer".split()
SCHEMES = "bearer basic digest token".split()  # words of an authorization header before the credential itself
# an identifier that holds a name is read once, from its start, so that the scan is linear without bounds on lengths
ASSIGNED = re.compile(
    rf"(?<![\w-])(?=[\w-]*?(?:{'|'.join(NAMES)}))[\w-]++[\"']?\s*+(?:=>|=|:)\s*+[\"']?"
    rf"(?:(?:{'|'.join(SCHEMES)})\s++)?+[\"']?([^\s\"',;]{{6,}})",
    re.I,
)
LONG = re.compile(r"(?<![\w+/=.-])(?=[A-Za-z+/_=.-]*[0-9])[A-Za-z0-9+/_=.-]{16,}")
CREDENTIAL = re.compile("|".join(NAMES))
WORD = re.compile(r"\w+")
FINDINGS = "start int, length int, assigned boolean, entropy double, features array<double>"


class Dictionary:
    """Words of at least four letters and the letter pairs of words, from a tokenizer's vocabulary."""

    def __init__(self, path: str) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = (model.id_to_piece(i).lstrip("▁").lower() for i in range(model.get_piece_size()))
        words = {p for p in pieces if p.isalpha()}
        self.words = {w for w in words if len(w) >= 4}
        self.longest = max(map(len, self.words))
        self.pairs = {a + b for w in words for a, b in zip(w, w[1:], strict=False)}

    def coverage(self, text: str) -> float:
        """Share of the characters that dictionary words cover, longest first from the left."""
        text, at, covered = text.lower(), 0, 0
        while at < len(text):
            n = next((n for n in range(min(self.longest, len(text) - at), 3, -1) if text[at : at + n] in self.words), 0)
            covered, at = covered + n, at + max(n, 1)
        return covered / max(1, len(text))


def spans(text: str) -> list[tuple[int, int, bool]]:
    """Start, end and whether the value is assigned to a credential's name, of all candidates of a text; an assigned one stands
    for a long one that it meets."""
    lower = text.lower()
    assigned = [(*m.span(1), True) for m in ASSIGNED.finditer(text)] if any(n in lower for n in NAMES) else []
    found, at = list(assigned), 0
    for m in LONG.finditer(text):
        a, b = m.span()
        while at < len(assigned) and assigned[at][1] <= a:
            at += 1
        if at == len(assigned) or assigned[at][0] >= b:
            found.append((a, b, False))
    return sorted(found)


def kind(c: str) -> int:
    return 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3


def entropy(text: str) -> float:
    return -sum(n / len(text) * math.log2(n / len(text)) for n in Counter(text).values())


def bucket(kind_of: str, text: str) -> int:
    return xxhash.xxh32_intdigest(f"{kind_of} {text}") % BUCKETS


class Neighbours:
    """The whole words around any place of a text."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.spans = [m.span() for m in WORD.finditer(text)]
        self.starts, self.ends = [a for a, _ in self.spans], [b for _, b in self.spans]

    def words(self, start: int, end: int) -> list[str]:
        """The last words that end by ``start`` and the first that begin from ``end`` on, in lower case."""
        last, first = bisect_right(self.ends, start), bisect_left(self.starts, end)
        near = self.spans[max(0, last - BEFORE) : last] + self.spans[first : first + AFTER]
        return [self.text[a:b].lower() for a, b in near]

    def sign(self, start: int) -> str:
        """The two characters before ``start`` and the quotation marks and spaces in front of it."""
        while start and self.text[start - 1] in "\"' ":
            start -= 1
        return self.text[max(0, start - 2) : start]


def features(dictionary: Dictionary, around: Neighbours, start: int, end: int, path: str | None) -> list[float]:
    value, near, sign = around.text[start:end], around.words(start, end), around.sign(start)
    kinds = [kind(c) for c in value]
    pairs = list(zip(value.lower(), value.lower()[1:], strict=False))
    changes = sum(a != b for a, b in zip(kinds, kinds[1:], strict=False)) / max(1, len(kinds) - 1)
    letters = [a + b for a, b in pairs if a.isalpha() and b.isalpha()]
    natural = sum(p in dictionary.pairs for p in letters) / max(1, len(letters))
    beside = [0.0] * BUCKETS
    for w in near:
        beside[bucket("word", w)] += 1.0
    where = [0.0] * BUCKETS
    for w in WORD.findall((path or "").lower()):
        where[bucket("path", w)] += 1.0
    return [
        float(len(value)),
        math.log1p(len(value)),
        *[kinds.count(k) / len(kinds) for k in range(4)],
        changes,
        natural,
        len(letters) / max(1, len(pairs)),
        len(set(value)) / len(value),
        dictionary.coverage(value),
        float(any(CREDENTIAL.search(w) for w in near)),
        float(sign.endswith(("=", ":", "=>"))),
        float(around.text[max(0, start - 1) : start] in ('"', "'")),
        *beside,
        *where,
    ]


def candidates(docs: DataFrame, path: str = "source", model: str = MODEL) -> DataFrame:
    """``doc_id, start, length, assigned, entropy, features`` of every candidate in every text (characters from 0).

    Null and empty texts have none. ``path`` names the column with the place a text was found at; a null one says nothing, and where
    the column is missing every path is null. Repeated rows give repeated findings.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(Dictionary(model)))

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        dictionary = pickle.loads(shipped.value)
        for batch in batches:
            rows = []
            for doc_id, text, where in zip(batch["doc_id"], batch["text"], batch["path"], strict=True):
                text = text or ""
                found = spans(text)
                around = Neighbours(text if found else "")
                for a, b, assigned in found:
                    rows.append(
                        (
                            None if pd.isna(doc_id) else int(doc_id),
                            a,
                            b - a,
                            assigned,
                            entropy(text[a:b]),
                            features(dictionary, around, a, b, where),
                        )
                    )
            out = pd.DataFrame(rows, columns=["doc_id", "start", "length", "assigned", "entropy", "features"])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    where = F.col(path) if path in docs.columns else F.lit(None)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", where.cast("string").alias("path"))
    return source.mapInPandas(scan, f"doc_id long, {FINDINGS}")


def train(findings: DataFrame, rows: int = SAMPLE_ROWS) -> RandomForestClassificationModel | None:
    """Forest from at most ``rows`` labelled findings (``features, label``); None where they do not have both labels."""
    known = findings.filter("label is not null").select("features", F.col("label").cast("double").alias("label"))
    sample = common.settle(known.orderBy(common.hash_order("features"), "label").limit(rows))
    if sample.select("label").distinct().count() < 2:
        return None
    data = sample.select("label", array_to_vector("features").alias("features"))
    return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=1).fit(data)


def score(findings: DataFrame, forest: RandomForestClassificationModel | None) -> DataFrame:
    """Findings with ``score``, the forest's probability of a secret, and ``secret`` (at least 0.5). Without a forest every finding
    is kept, with score 1."""
    if forest is None:
        return findings.withColumns({"score": F.lit(1.0), "secret": F.lit(True)})
    plain = common.fresh("_features", findings.columns)
    data = findings.withColumnRenamed("features", plain).withColumn("features", array_to_vector(plain))
    chance = vector_to_array("probability")[1]
    scored = forest.transform(data).withColumns({"score": chance, "secret": chance >= 0.5})
    return scored.select(*[c for c in findings.columns if c != "features"], F.col(plain).alias("features"), "score", "secret")


def silver(assigned: Column, entropy: Column, length: Column) -> Column:
    """A label for tables that have no reviewed findings: 1 for a value given to a credential's name that is long and irregular
    enough to be a generated secret, 0 for what is short or regular, null for what is irregular with no name to it: that may
    be a secret or an identifier, and only a review can tell."""
    strong = (entropy >= 3.0) & (length >= 12)
    return F.when(assigned | ~strong, strong.cast("double"))
