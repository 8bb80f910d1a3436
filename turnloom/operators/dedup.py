"""Exact deduplication by content."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnloom.operators.ordered import SPAN, fold_before
from turnloom.operators.pair import CONV, TURN


def dedup_rows(df: DataFrame, text: str, order: list[str], within: list[str] | None = None) -> DataFrame:
    """Keep the first row, by ``order``, of every non-empty text (of every ``within`` and text).

    ``order`` is one or two integer columns that tell rows of one text apart, the second below 10^17. Texts are compared by 256 bits of hash, so
    only numbers are aggregated, on the map side first: a text that fills a third of the table costs its task one row per
    map partition. The texts move once, for the join that picks the first rows.
    """
    digest = [F.xxhash64(F.lit(seed), text) for seed in range(4)]
    names = [f"_digest{i}" for i in range(4)]
    # both numbers in one that a hash aggregate can keep the least of
    wide = [F.col(c).cast("decimal(20,0)") for c in order]
    place = reduce(lambda high, low: high * F.lit(10**18).cast("decimal(19,0)") + low, wide)
    marked = df.filter(F.length(text) > 0).withColumns(
        dict(zip(names, digest, strict=True)) | {"_place": place.cast("decimal(38,0)")}
    )
    keys = [*(within or []), *names]
    first = marked.groupBy(*keys).agg(F.min("_place").alias("_place"))
    return marked.join(first, [*keys, "_place"], "left_semi").select(*df.columns)


def dedup_turns(turns: DataFrame, scope: str = "corpus") -> DataFrame:
    """First occurrence of every turn text, in the corpus or in its own conversation; roles do not matter."""
    if scope == "conversation":
        return dedup_rows(turns, "text", [TURN], [CONV])
    return dedup_rows(turns, "text", [CONV, TURN])


def renumber_turns(turns: DataFrame, span: int = SPAN) -> DataFrame:
    """Dense turn numbers from 0, after rows were removed."""
    ranked = fold_before(turns, [CONV], TURN, {"_rank": ("sum", F.lit(1).cast("bigint"))}, span)
    return ranked.withColumn(TURN, F.coalesce("_rank", F.lit(0))).drop("_rank")
