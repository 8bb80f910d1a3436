"""Choosing among generated answers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnloom.functions import script as S
from turnloom.functions import text as T
from turnloom.functions.binding import let

# Attempts, acceptance limits and the reply when every attempt fails.
MAX_ATTEMPTS = 3
MIN_ANSWER_CHARS = 30
MIN_SENTENCE_CHARS = 5
SENTENCE_BONUS = 0.1
EARLY_SHARE = 0.6
EARLY_SENTENCES = 2
FALLBACK_ANSWER = (
    "让我告诉您关于《塞尔达传说》系列游戏的情况。这是任天堂最著名的游戏系列之一，以其独特的冒险体验和创新玩法而闻名。"
    "最新作品是《王国之泪》，它延续了旷野之息的开放世界设计，同时加入了更多新玩法。您想了解哪些具体方面？"
)


def score_candidates(candidates: DataFrame, script: str = S.HAN) -> DataFrame:
    """Add ``answer`` (filtered), ``share``, ``sentences`` and ``score``; the score is NULL for a rejected answer."""
    said = F.filter(F.split("answer", "[。！？]"), lambda s: F.length(T.strip(s)) >= MIN_SENTENCE_CHARS)
    valid = (F.length("answer") >= MIN_ANSWER_CHARS) & F.col("share").isNotNull() & (F.col("sentences") >= 1)
    of_content = let(
        S.content_chars(F.col("answer")),
        lambda body: F.when(F.length(body) > 0, S.script_chars(F.col("answer"), script) / F.length(body)),
    )
    return (
        candidates.withColumn("answer", S.filter_answer(T.strip(F.col("text")), script))
        .withColumn("sentences", F.size(said))
        .withColumn("share", of_content)
        .withColumn("score", F.when(valid, F.col("share") + SENTENCE_BONUS * F.col("sentences")))
    )


def best_of_n(
    prompts: DataFrame, candidates: DataFrame, script: str = S.HAN, max_attempts: int = MAX_ATTEMPTS
) -> DataFrame:
    """One answer a prompt: ``prompt_id, attempt, score, answer``.

    Attempts are taken in order; a strictly better one replaces the best so far, and a good one that does so ends the
    search. The choice is made on numbers alone, which become columns of one row a prompt by a hash aggregate; then the
    one text that was chosen is fetched by its key. (prompt_id, attempt) is unique. A prompt without a valid attempt gets the fallback, with a NULL attempt.
    """
    numbers = ("score", "share", "sentences")
    slots = [
        F.max(F.when((F.col("attempt") == k) & F.col("score").isNotNull(), F.col(n))).alias(f"_{n}{k}")
        for k in range(1, max_attempts + 1)
        for n in numbers
    ]
    tried = candidates.filter(F.col("attempt").between(1, max_attempts))
    scored = score_candidates(tried, script).groupBy("prompt_id").agg(*slots)

    def better(state: Column, k: int) -> Column:
        score = F.col(f"_score{k}")
        improves = score.isNotNull() & ~state["done"] & (score > F.coalesce(state["score"], F.lit(0.0)))
        good = (F.col(f"_share{k}") > EARLY_SHARE) & (F.col(f"_sentences{k}") >= EARLY_SENTENCES)
        return F.when(improves, F.struct(F.lit(k).alias("attempt"), score.alias("score"), good.alias("done"))).otherwise(state)

    start = F.struct(F.lit(None).cast("int").alias("attempt"), F.lit(None).cast("double").alias("score"), F.lit(False).alias("done"))
    chosen = scored.select("prompt_id", reduce(better, range(1, max_attempts + 1), start).alias("best"))
    chosen = chosen.select("prompt_id", "best.attempt", "best.score").filter("attempt is not null")
    text = tried.select("prompt_id", "attempt", "text").join(chosen, ["prompt_id", "attempt"])
    best = text.withColumn("answer", S.filter_answer(T.strip(F.col("text")), script))
    return prompts.select("prompt_id").join(best, "prompt_id", "left").select(
        "prompt_id",
        "attempt",
        F.round("score", 6).alias("score"),
        F.coalesce("answer", F.lit(FALLBACK_ANSWER)).alias("answer"),
    )
