"""Reproducible splits, augmentation and epoch schedules.

All randomness is ``md5(seed, purpose, key)``: the same rows get the same fate on any cluster.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnloom.functions import text as T
from turnloom.operators.ordered import SPAN, fold_before

# Shares and augmentation material.
TRAIN_SHARE = 0.8
VALIDATION_SHARE = 0.05
SQUEEZE_SHARE = 0.3
PUNCTUATION_SHARE = 0.2
PUNCTUATION = ("，", "。", "！", "？")
EMOJI_SHARE = 0.3
NICKNAME_SHARE = 0.2
EMOJI = ("💄", "👗", "👠", "👜", "💅", "👚", "👒", "💃", "✨", "❤️")
NICKNAMES = ("亲爱的", "宝贝", "美女", "姐妹")

DRAW_BITS = 32


def row_hash(seed: str, purpose: str, keys: Sequence[str]) -> Column:
    return F.md5(F.concat_ws("|", F.lit(seed), F.lit(purpose), *[F.col(k).cast("string") for k in keys]))


def draw(seed: str, purpose: str, keys: Sequence[str]) -> Column:
    """A whole number in [0, 2^32) for the row."""
    return F.conv(F.substr(row_hash(seed, purpose, keys), F.lit(1), F.lit(DRAW_BITS // 4)), 16, 10).cast("bigint")


def chance(seed: str, purpose: str, keys: Sequence[str], share: float) -> Column:
    return draw(seed, purpose, keys) < int(share * 2**DRAW_BITS)


def split_hash(df: DataFrame, keys: Sequence[str], share: float = TRAIN_SHARE, seed: str = "0") -> DataFrame:
    """Add ``part``: ``train`` for about ``share`` of the rows. Row-local, no shuffle."""
    return df.withColumn("part", F.when(chance(seed, "split", keys, share), "train").otherwise("val"))


def split_exact(df: DataFrame, keys: Sequence[str], share: float = TRAIN_SHARE, seed: str = "0") -> DataFrame:
    """Add ``part``: exactly floor(share * n) rows are ``train``, taken in hash order; ``keys`` are unique.

    The cut is one (hash, keys) value, found from the key columns alone: rows are counted by the first hash digits (65,536
    buckets), the cut falls into one bucket, and only that bucket's keys are ranked. Then every row is compared with it.
    """
    place = F.struct(row_hash(seed, "split", keys).alias("_hash"), *keys)
    hashed = df.select(place.alias("_place"), F.left(row_hash(seed, "split", keys), F.lit(4)).alias("_bucket"))
    counts = hashed.groupBy("_bucket").agg(F.count("*").alias("_n"))
    running = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    quota = F.floor(F.sum("_n").over(Window.partitionBy()) * F.lit(share))
    # at most 65,536 rows from here on, whatever the input
    cut = (
        counts.select("_bucket", "_n", F.sum("_n").over(running).alias("_upto"), quota.alias("_quota"))
        .filter((F.col("_upto") >= F.col("_quota")) & (F.col("_quota") > 0))
        .select(F.col("_bucket").alias("_at"), (F.col("_quota") - F.col("_upto") + F.col("_n")).alias("_take"))
        .orderBy("_at")
        .limit(1)
    )
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy("_place"))
    last = (
        hashed.join(F.broadcast(cut), F.col("_bucket") == F.col("_at"))  # one row
        .withColumn("_rank", rank)
        .filter(F.col("_rank") == F.col("_take"))
        .select("_place")
        .scalar()
    )
    return df.withColumn("part", F.when(F.coalesce(place <= last, F.lit(False)), "train").otherwise("val"))


def augment_punctuation(df: DataFrame, keys: Sequence[str], text: str = "text", seed: str = "0") -> DataFrame:
    """Some rows with whitespace squeezed, some with one punctuation mark put in."""
    squeezed = F.when(chance(seed, "squeeze", keys, SQUEEZE_SHARE), T.squeeze_whitespace(F.col(text))).otherwise(
        F.col(text)
    )
    at = (draw(seed, "position", keys) % F.length("_t")).cast("int")
    mark = F.get(F.array(*[F.lit(p) for p in PUNCTUATION]), (draw(seed, "mark", keys) % len(PUNCTUATION)).cast("int"))
    put = F.concat(F.left("_t", at), mark, F.substr("_t", at + 1))
    hit = chance(seed, "punctuation", keys, PUNCTUATION_SHARE) & (F.length("_t") > 0)
    return df.withColumn("_t", squeezed).withColumn(text, F.when(hit, put).otherwise(F.col("_t"))).drop("_t")


def augment_persona(df: DataFrame, keys: Sequence[str], text: str = "text", seed: str = "0") -> DataFrame:
    """Some rows with an emoji at the end, some with a salutation in front unless one is there."""
    emoji = F.get(F.array(*[F.lit(e) for e in EMOJI]), (draw(seed, "emoji", keys) % len(EMOJI)).cast("int"))
    nickname = F.get(F.array(*[F.lit(n) for n in NICKNAMES]), (draw(seed, "name", keys) % len(NICKNAMES)).cast("int"))
    ended = F.when(
        chance(seed, "add emoji", keys, EMOJI_SHARE), F.concat(F.col(text), F.lit(" "), emoji)
    ).otherwise(F.col(text))
    greet = chance(seed, "add name", keys, NICKNAME_SHARE) & ~F.col("_t").rlike("|".join(NICKNAMES))
    return (
        df.withColumn("_t", ended)
        .withColumn(text, F.when(greet, F.concat(nickname, F.lit("～"), F.col("_t"))).otherwise(F.col("_t")))
        .drop("_t")
    )


def epoch_schedule(
    df: DataFrame,
    keys: Sequence[str],
    epochs: float = 1.0,
    max_steps: int | None = None,
    span: int = SPAN,
    sample: DataFrame | None = None,
) -> DataFrame:
    """``step, epoch, keys``: the rows in key order, repeated for ``epochs`` passes or until ``max_steps`` steps are reached.

    ``keys`` are unique together. A row's step is how many rows come before it; they are counted in blocks by rank, so the whole table
    may be one sequence. ``sample`` is a cheaper table with ``keys`` alike, to cut the blocks by.
    """
    placed = lambda rows: rows.select(*keys, F.struct(*keys).alias("_place"), F.lit(0).alias("_all"))
    one = {"_before": ("sum", F.lit(1).cast("bigint"))}
    total = df.agg(F.count("*").alias("n")).scalar()
    ranked = fold_before(placed(df), ["_all"], "_place", one, span, placed(df if sample is None else sample))
    steps = F.floor(F.lit(epochs) * F.col("_n")) if max_steps is None else F.lit(max_steps).cast("bigint")
    return (
        ranked.withColumn("_n", total)
        .withColumns({"_steps": steps, "_rank": F.coalesce("_before", F.lit(0)) + 1})
        .filter("_rank <= _steps")
        .withColumn("epoch", F.explode(F.expr("sequence(0L, (_steps - _rank) div _n)")))
        .select((F.col("epoch") * F.col("_n") + F.col("_rank")).alias("step"), (F.col("epoch") + 1).alias("epoch"), *keys)
    )
