"""Training-log analytics. Input: ``run, step, loss, lr, eval_loss``; steps start at 1 and may have gaps.

A run can hold most of the log, so running values use ``fold_before`` and never a window over a whole run.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnloom.operators.ordered import SPAN, fold_before

# Learning-rate schedules.
PEAK_LR = 3e-5
FLOOR_SHARE = 0.1
WARMUP_STEPS = 300
MAX_STEPS = 100
RATIO_PEAK_LR = 5e-4
RATIO_MIN_LR = 1e-5
WARMUP_RATIO = 0.1


def _windows(log: DataFrame, size: int, span: int) -> DataFrame:
    """Add ``window``: how many flushes came before. A flush is a logged step divisible by ``size``."""
    flush = F.when(F.col("step") % size == 0, 1).otherwise(0).cast("bigint")
    return fold_before(log, ["run"], "step", {"window": ("sum", flush)}, span).withColumn(
        "window", F.coalesce("window", F.lit(0))
    )


def accumulation_windows(log: DataFrame, size: int, span: int = SPAN) -> DataFrame:
    """Flushed gradient-accumulation windows: ``run, window, flush_step, rows, accumulated``.

    ``accumulated`` is sum(loss) / size; steps after the last flush are not reported.
    """
    return (
        _windows(log, size, span)
        .groupBy("run", "window")
        .agg(
            F.max("step").alias("flush_step"),
            F.count("*").alias("rows"),
            (F.sum("loss") / size).alias("accumulated"),
        )
        .filter(F.col("flush_step") % size == 0)
    )


def epoch_means(log: DataFrame, rows_per_epoch: int, size: int, span: int = SPAN) -> DataFrame:
    """Mean loss of every epoch, and the smaller figure the training script prints.

    The script adds up flushed windows (a remainder goes to the epoch in which it is flushed) and divides by the
    rows of an epoch.
    """
    epoch_of = lambda c: F.expr(f"({c} - 1) div {rows_per_epoch} + 1")
    true_means = log.groupBy("run", epoch_of("step").alias("epoch")).agg(
        F.count("*").alias("rows"), F.avg("loss").alias("mean_loss")
    )
    printed = (
        accumulation_windows(log, size, span)
        .groupBy("run", epoch_of("flush_step").alias("epoch"))
        .agg((F.sum("accumulated") / rows_per_epoch).alias("printed_loss"))
    )
    return true_means.join(printed, ["run", "epoch"], "left").withColumn(
        "printed_loss", F.coalesce("printed_loss", F.lit(0.0))
    )


def best_so_far(log: DataFrame, span: int = SPAN) -> DataFrame:
    """Evaluated steps with the best earlier evaluation loss and whether this one is strictly better."""
    evaluated = log.filter(F.col("eval_loss").isNotNull())
    seen = fold_before(evaluated, ["run"], "step", {"best_before": ("min", F.col("eval_loss"))}, span)
    return seen.select(
        "run",
        "step",
        "eval_loss",
        "best_before",
        (F.col("best_before").isNull() | (F.col("eval_loss") < F.col("best_before"))).alias("improved"),
    )


def warmup_cosine(step: Column, total: int, warmup: int, peak: float, floor: float) -> Column:
    """Linear warm-up to ``peak``, then a half cosine down to ``floor`` at ``total``."""
    down = floor + 0.5 * (peak - floor) * (1 + F.cos(math.pi * (step - warmup) / (total - warmup)))
    return F.when(step < warmup, peak * (step / warmup) if warmup else F.lit(peak)).otherwise(down)


def lr_audit(
    log: DataFrame,
    total: int = MAX_STEPS,
    warmup: int = WARMUP_STEPS,
    peak: float = PEAK_LR,
    floor: float = PEAK_LR * FLOOR_SHARE,
    tolerance: float = 1e-9,
) -> DataFrame:
    """Logged learning rate against the schedule: ``run, step, lr, expected_lr, deviates``."""
    expected = warmup_cosine(F.col("step"), total, warmup, peak, floor)
    return log.select(
        "run",
        "step",
        F.round("lr", 12).alias("lr"),
        F.round(expected, 12).alias("expected_lr"),
        (F.abs(F.col("lr") - expected) > tolerance).alias("deviates"),
    )
