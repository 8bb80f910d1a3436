"""Corpus statistics; every one is an aggregate that combines on the map side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnloom.functions import text as T

# Characters a token, preview length, token budgets.
CHARS_PER_TOKEN = 2.5
PREVIEW_CHARS = 500
TOKEN_BUDGETS = (256, 512, 2048)


def estimated_tokens(chars: Column) -> Column:
    return F.floor(chars / F.lit(CHARS_PER_TOKEN)).cast("bigint")


def conv_stats(turns: DataFrame) -> DataFrame:
    return (
        turns.groupBy("conv_id")
        .agg(F.count("*").alias("turns"), F.sum(F.length("text").cast("bigint")).alias("chars"))
        .withColumn("est_tokens", estimated_tokens(F.col("chars")))
    )


def corpus_totals(turns: DataFrame) -> DataFrame:
    """Conversations, messages and characters for every role, and in all (``role`` is ``all``)."""
    # conversation counts: one row a (role, conversation) first, then counted
    per_conv = turns.groupBy("role", "conv_id").agg(
        F.count("*").alias("messages"), F.sum(F.length("text").cast("bigint")).alias("chars")
    )
    by_role = per_conv.groupBy("role").agg(
        F.count("*").alias("conversations"), F.sum("messages").alias("messages"), F.sum("chars").alias("chars")
    )
    in_all = (
        per_conv.groupBy("conv_id")
        .agg(F.sum("messages").alias("messages"), F.sum("chars").alias("chars"))
        .agg(F.count("*").alias("conversations"), F.sum("messages").alias("messages"), F.sum("chars").alias("chars"))
    )
    return by_role.unionByName(in_all.withColumn("role", F.lit("all")))


def longest_preview(turns: DataFrame, only: Column | None = None) -> DataFrame:
    """Opening of the longest message of every conversation (of those where ``only`` holds), first one on ties."""
    chosen = turns if only is None else turns.filter(only)
    opening = F.replace(F.left("text", F.lit(PREVIEW_CHARS)), F.lit("\n"), F.lit(" "))
    return (
        chosen.select("conv_id", "turn", F.length("text").alias("n"), opening.alias("opening"))
        .groupBy("conv_id")
        .agg(F.max_by(F.struct("turn", "n", "opening"), F.struct("n", -F.col("turn"))).alias("m"))
        .select("conv_id", "m.turn", F.col("m.n").alias("n_chars"), F.col("m.opening").alias("preview"))
    )


def head_preview(df: DataFrame, keys: Sequence[str], text: str = "text") -> DataFrame:
    return df.select(*keys, F.left(text, F.lit(PREVIEW_CHARS)).alias("preview"))


def token_budget(rows: DataFrame, text: str, budgets: Sequence[int] = TOKEN_BUDGETS) -> DataFrame:
    """For every token budget, how many rows exceed it by the estimate, and their share."""
    tokens = estimated_tokens(F.length(text))
    counted = rows.agg(
        F.count("*").alias("rows"), *[F.count_if(tokens > b).alias(f"_{b}") for b in budgets]
    )
    each = F.array(*[F.struct(F.lit(b).alias("budget"), F.col(f"_{b}").alias("over")) for b in budgets])
    return counted.select("rows", F.inline(each)).select(
        "budget", "rows", "over", F.round(F.col("over") / F.col("rows"), 6).alias("share")
    )
