"""Text comparison scores."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

# Weights of the text loss.
MATCH_WEIGHT = 0.4
LCS_WEIGHT = 0.4
LENGTH_WEIGHT = 0.2


def char_match(a: Column, b: Column) -> Column:
    """Positions at which both texts hold the same character."""
    same = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: F.coalesce(x == y, F.lit(False)))
    return F.when((F.length(a) == 0) | (F.length(b) == 0), 0).otherwise(F.size(F.filter(same, lambda s: s)))


def lcs_length(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence of the whole texts.

    A Python step: a built-in expression needs a cell per pair of characters, this one a
    big-integer step per character. The helper is nested so that it travels to executors by value.
    """

    def lcs(x: str, y: str) -> int:
        # bit-parallel (Hyyrö 2004): bit i of `row` is cleared where the match count rises at x[i]
        where: dict[str, int] = {}
        for i, ch in enumerate(x):
            where[ch] = where.get(ch, 0) | (1 << i)
        row = full = (1 << len(x)) - 1
        for ch in y:
            hits = row & where.get(ch, 0)
            row = ((row + hits) | (row - hits)) & full
        return len(x) - row.bit_count()

    @F.pandas_udf(IntegerType())
    def lengths(xs: pd.Series, ys: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else lcs(x, y) for x, y in zip(xs, ys)], dtype="Int32")

    return lengths(a, b)


def text_loss(output: Column, target: Column, matched: Column, lcs: Column) -> Column:
    """Clamped loss; an empty output costs 1, and identical texts still cost 0.2."""
    longest = F.greatest(F.length(output), F.length(target))
    gap = F.abs(F.length(output) - F.length(target))
    score = (MATCH_WEIGHT * matched + LCS_WEIGHT * lcs - LENGTH_WEIGHT * gap) / longest
    loss = F.greatest(F.least(1.0 - score, F.lit(1.0)), F.lit(0.0))
    return F.when(F.coalesce(F.length(output), F.lit(0)) == 0, 1.0).otherwise(loss)


def echo_loss(output: Column, training_text: Column) -> Column:
    """One minus the matched share of the training text; 1 without an output."""
    loss = 1.0 - char_match(training_text, output) / F.length(training_text)
    return F.when(F.coalesce(F.length(output), F.lit(0)) == 0, 1.0).otherwise(loss)
