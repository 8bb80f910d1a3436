"""Expected answers against generated ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnloom.functions import similarity


def eval_compare(expected: DataFrame, generated: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys, prompt, expected, generated`` of the rows that were generated."""
    return expected.join(generated, list(keys)).select(*keys, "prompt", "expected", "generated")


def with_loss(compared: DataFrame) -> DataFrame:
    """Add ``matched``, ``lcs`` and ``loss`` over the whole texts."""
    out, target = F.col("generated"), F.col("expected")
    return (
        compared.withColumn("matched", similarity.char_match(out, target))
        .withColumn("lcs", similarity.lcs_length(out, target))
        .withColumn("loss", similarity.text_loss(out, target, F.col("matched"), F.col("lcs")))
    )


def eval_mean_loss(
    expected: DataFrame, generated: DataFrame, keys: Sequence[str], first: int | None = None
) -> DataFrame:
    """Mean loss over the expected rows, a row without a generated answer counting 1.

    ``first`` takes the first rows by key only, as the periodic check during a run does.
    """
    rows = expected if first is None else expected.orderBy(*keys).limit(first)
    scored = with_loss(rows.join(generated, list(keys), "left"))
    return scored.agg(
        F.count("*").alias("rows"),
        F.count("generated").alias("answered"),
        F.avg(F.coalesce("loss", F.lit(1.0))).alias("mean_loss"),
    )
