"""Knowledge documents for questions.

Ranking: a document scores the sum, over all words of a question that it holds, of (1 + ln tf) times the word's weight.
A word weighs ln(1 + N / df), and nothing when at least half the documents hold it, so leaving such words out
changes no score and no question meets every document by way of a stop word.

Search is pruned by block maxima. Documents of about the same length stand in blocks, since what a word can add grows with the length of
a text; for every word and block the greatest tf is kept. Their sum over a question's words bounds all scores of the block. The
two blocks with the highest bounds are scored first, their k-th best score is the question's threshold, and of the other blocks only
those whose bound reaches it are scored. The answers are the exact ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnloom.functions import prompts
from turnloom.functions import text as T
from turnloom.sources.sinks import written_in_buckets

WORD = r"[\p{L}\p{N}]+"
SALTS = 32
BLOCK = 32  # documents a block, on the average
OCTAVE = 8  # length classes for every doubling of the length
FIRST = 8  # blocks of a question that are scored to find its threshold
SLACK = 1e-5  # more than rounding a score to six places, or the order of a sum, can change


def words(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit(WORD), F.lit(0))


def blocked(docs: DataFrame) -> DataFrame:
    """``doc_id, block, searched``: documents of a length class are dealt over blocks by their hash."""
    searched = F.concat_ws("\n", "title", "content")
    length = F.floor(F.log2(F.length("searched") + 1) * OCTAVE).cast("bigint")
    sized = docs.select("doc_id", searched.alias("searched")).withColumn("class", length)
    buckets = sized.groupBy("class").agg(F.ceil(F.count("*") / BLOCK).alias("buckets"))
    place = F.shiftleft("class", 40) + F.pmod(F.xxhash64("doc_id"), F.col("buckets"))
    # at most OCTAVE classes for each of the 31 doublings that a text can have
    return sized.join(F.broadcast(buckets), "class").select("doc_id", place.alias("block"), "searched")


def postings(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """``doc_id, block, word, tf`` of the words in ``asked``: a document's words stand in one task, so they are counted before
    they are shuffled."""
    held = blocked(docs).select("doc_id", "block", F.explode(words(F.col("searched"))).alias("word"))
    counted = held.join(asked.select("word").distinct(), "word", "left_semi").groupBy("doc_id", "block", "word")
    return counted.agg(F.count("*").alias("tf"))


def gathered(held: DataFrame) -> DataFrame:
    """``word, block, most, n_docs, holders``: one row for the documents of a block that hold a word, with the greatest tf among them. A
    block has about ``BLOCK`` documents, so a list is short, and steps that look at blocks only do not read it."""
    holder = F.struct("doc_id", "tf")
    return held.groupBy("word", "block").agg(
        F.max("tf").alias("most"), F.count("*").alias("n_docs"), F.collect_list(holder).alias("holders")
    )


def asked_words(questions: DataFrame) -> DataFrame:
    return questions.select("question_id", F.explode(F.array_distinct(words(F.col("question")))).alias("word"))


def word_weights(asked: DataFrame, docs: DataFrame, held: DataFrame) -> DataFrame:
    """``question_id, word, weight``: the words of every question that weigh something."""
    total = docs.agg(F.count("*").alias("n")).scalar()
    df = held.groupBy("word").agg(F.sum("n_docs").alias("df")).filter(F.col("df") * 2 < total)
    return asked.join(df, "word").select("question_id", "word", F.log(1 + total / F.col("df")).alias("weight"))


def _impact(tf: Column) -> Column:
    return 1 + F.log(tf)


def _bounds(weights: DataFrame, held: DataFrame) -> DataFrame:
    """``question_id, block, bound``: no document of the block scores more for the question. The blocks of a word are dealt out over
    ``SALTS`` parts that all meet the questions with the word, and bounds are summed on the way to (question, block)."""
    dealt = held.select("word", "block", "most").withColumn("salt", F.pmod(F.xxhash64("block"), F.lit(SALTS)).cast("int"))
    salted = weights.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    met = dealt.join(salted, ["word", "salt"])
    return met.groupBy("question_id", "block").agg(F.sum(_impact(F.col("most")) * F.col("weight")).alias("bound"))


def _scores(chosen: DataFrame, weights: DataFrame, held: DataFrame) -> DataFrame:
    """``question_id, doc_id, score`` of all documents in the ``chosen`` (question, block)."""
    held = held.select("word", "block", "holders")
    met = chosen.join(weights, "question_id").join(held, ["word", "block"]).select("question_id", "weight", F.inline("holders"))
    scored = met.groupBy("question_id", "doc_id").agg(F.sum(_impact(F.col("tf")) * F.col("weight")).alias("score"))
    return scored.withColumn("score", F.round("score", 6))


def scored_pairs(questions: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """``question_id, doc_id, score`` of the pairs that bounds cannot rule out: all of the best ``k`` of every question are among
    them. The postings are read several times, so they are counted at once and written to the shared
    folder, in buckets that all later joins and groups of them share; the rest is lazy."""
    asked = asked_words(questions)
    held = written_in_buckets(postings(docs, asked), "word", "block", within=gathered)
    weights = word_weights(asked, docs, held)
    bounds = _bounds(weights, held)
    order = Window.partitionBy("question_id").orderBy(F.desc("bound"), "block")
    first = bounds.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= FIRST).select("question_id", "block")
    seen = _scores(first, weights, held).withColumn(
        "place", F.row_number().over(Window.partitionBy("question_id").orderBy(F.desc("score"), "doc_id"))
    )
    thresholds = seen.filter(F.col("place") == k).select("question_id", F.col("score").alias("least"))
    reached = F.col("bound") >= F.coalesce("least", F.lit(0.0)) - SLACK
    chosen = bounds.join(thresholds, "question_id", "left").filter(reached).select("question_id", "block")
    return _scores(chosen, weights, held)


def kb_search(questions: DataFrame, docs: DataFrame, k: int = 3) -> DataFrame:
    """``question_id, rank, doc_id, score``: the best ``k`` documents of every question, ties by ``doc_id``. Each task passes on only
    its own best ``k`` rows a question."""
    best = Window.partitionBy("question_id").orderBy(F.desc("score"), "doc_id")
    return (
        scored_pairs(questions, docs, k)
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("question_id", F.col("rank").cast("bigint").alias("rank"), "doc_id", "score")
    )


def kb_context(
    questions: DataFrame, docs: DataFrame, k: int = 2, chars: int = 300, always_ellipsis: bool = False
) -> DataFrame:
    """``question_id, question, context``: titles and openings of the best documents; empty without a hit."""
    cut = T.clip if always_ellipsis else T.truncate
    hits = kb_search(questions, docs, k)
    entry = F.concat(F.lit(prompts.DOCUMENT_LABEL), F.col("title"), F.lit("\n"), cut(F.col("content"), chars))
    # the hit list is k rows a question; only the matching documents' openings travel
    shown = docs.select("doc_id", entry.alias("entry")).join(hits, "doc_id")
    gathered = shown.groupBy("question_id").agg(F.collect_list(F.struct("rank", "entry")).alias("entries"))
    joined = F.array_join(F.transform(F.array_sort("entries"), lambda e: e["entry"]), "\n\n")
    return questions.join(gathered, "question_id", "left").select(
        "question_id", "question", F.coalesce(joined, F.lit("")).alias("context")
    )


def kb_prompt(questions: DataFrame, docs: DataFrame, k: int = 2, chars: int = 300) -> DataFrame:
    """Question, its knowledge and the system prompt as one prompt."""
    asked = T.strip(T.remove_emoji_range(F.col("question")))
    return kb_context(questions, docs, k, chars).select(
        "question_id", prompts.inst_context(asked, F.col("context")).alias("prompt")
    )
