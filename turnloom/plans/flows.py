"""The composed jobs: exports to training text, pages to a corpus report, files to rows, questions to prompts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnloom.functions import prompts
from turnloom.functions import text as T
from turnloom.operators import dedup, extract, pair, profile, segment

TURN_CHARS = 400


def turns_to_prompts(turns: DataFrame) -> DataFrame:
    """Normalize roles, drop repeated texts, pair, render: the main path from turns to training text."""
    named = turns.withColumn("role", pair.normalize_role(F.col("role")))
    pairs = pair.pair_adjacent(dedup.dedup_turns(named), sample=turns)
    text = prompts.header_system(F.col("instruction"), F.col("input"), F.col("output"))
    return pairs.select("conv_id", "turn", text.alias("prompt"))


def likely_turns(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``conv_id, turn``: about as many turns as a document of this length may have, without looking into it. Sequential rules take the
    cuts of their blocks from here, so that documents are parsed once. Keys and lengths are dealt out first: the two readers of the cuts
    share that exchange, and documents are read for it once."""
    chars = F.coalesce(F.length(text), F.lit(0)).alias("_chars")
    sized = docs.select(F.col(key).alias("conv_id"), chars).repartition("conv_id", "_chars")
    # what is added is 0; it names the key, so that the reader that only counts needs the same columns
    numbers = F.explode(F.expr(f"sequence(0L, (_chars + hash(conv_id) % 1) div {TURN_CHARS})"))
    return sized.select("conv_id", numbers.alias("turn"))


def exports_to_pairs(exports: DataFrame, key: str) -> DataFrame:
    """Raw exports to instruction rows: extract, drop repeats, repair, pair."""
    turns = extract.extract_export_array(exports, [key]).withColumnRenamed(key, "conv_id")
    cleaned = turns.withColumn("text", T.recover_contaminated(F.col("text")))
    return pair.pair_adjacent(cleaned, sample=likely_turns(exports, key, "raw"))


def pages_to_stats(pages: DataFrame, keys: Sequence[str], markdown: str) -> DataFrame:
    """Heading-structured pages to conversation statistics."""
    return profile.conv_stats(segment.segment_headings(pages, keys, markdown).withColumnRenamed(keys[0], "conv_id"))


def pages_to_pairs(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """Saved chat pages to instruction rows by carry-forward pairing."""
    turns = extract.extract_precedence(pages, [key], html).drop("method").withColumnRenamed(key, "conv_id")
    return pair.pair_carry_forward(turns, sample=likely_turns(pages, key, html))


def files_to_history_pairs(files: DataFrame, key: str, text: str = "text") -> DataFrame:
    """JSON or transcript files to instruction rows with history."""
    turns = extract.route_json_text(files, [key], text).drop("route").withColumnRenamed(key, "conv_id")
    return pair.pair_history(turns, sample=likely_turns(files, key, text))
