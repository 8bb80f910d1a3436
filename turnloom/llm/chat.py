"""Chat formatting: logged snapshots of growing conversations collapse into the longest one, which is then rendered.

A conversation that was logged after every turn appears once for each length. Every turn gets a rolling hash of the
conversation up to it: the sum of the hashes of (place, role, text) so far, in four 32-bit parts, so that a hash can be summed
in blocks. A conversation whose last hash is the hash of an earlier turn in another one is a prefix of it and
goes by an anti-join; of conversations that are equal turn by turn the smallest conv_id stays.

DataFrame functions only. Places and sums are folded in blocks of turns (``fold_before``), so a conversation that
holds a third of all rows is spread over many tasks, and a text that very many conversations start with is counted before it
is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnloom.llm.blocks import fold_before

PART = 1_024  # turns in a rendered part
HEAD, TAIL = "<|", "|>\n"
END = "<|end|>\n"
SUMS = ["_s0", "_s1", "_s2", "_s3"]


def numbered(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, pos``: turns of a conversation numbered from 1 by turn, role and text.

    Rows without conv_id or turn belong to no conversation and are left out; a turn logged twice in one conversation (same
    turn, role and text) counts once. Null roles and texts count as empty.
    """
    rows = (
        turns.filter("conv_id is not null and turn is not null")
        .select(
            "conv_id",
            F.col("turn").cast("long").alias("turn"),
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        )
        .withColumns({"_h0": F.xxhash64("role", "text"), "_h1": F.xxhash64(F.lit("second"), "role", "text")})
        .groupBy("conv_id", "turn", "_h0", "_h1")
        .agg(F.first("role").alias("role"), F.first("text").alias("text"))
    )
    # most conversations have one row a turn; several at one turn are put in order inside the turn
    several = rows.groupBy("conv_id", "turn").agg(
        F.sort_array(F.collect_list(F.struct("role", "text"))).alias("_said"), F.count("*").alias("_n")
    )
    before = fold_before(several, ["conv_id"], "turn", {"_before": ("sum", F.col("_n"))})
    return before.select(
        "conv_id", "turn", F.coalesce("_before", F.lit(0)).alias("_before"), F.posexplode("_said").alias("_at", "_one")
    ).select("conv_id", "turn", "_one.role", "_one.text", (F.col("_before") + F.col("_at") + 1).alias("pos"))


def rolling(rows: DataFrame) -> DataFrame:
    """Add to numbered turns the four sums that stand for the conversation up to and with each turn."""
    parts = []
    for seed in ("one", "two"):
        h = F.xxhash64(F.lit(seed), "pos", "role", "text")
        parts += [h.bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned(h, 32)]
    own = rows.select("conv_id", "pos", *[p.alias(f"_p{i}") for i, p in enumerate(parts)])
    folds = {f"_b{i}": ("sum", F.col(f"_p{i}")) for i in range(4)}
    summed = fold_before(own, ["conv_id"], "pos", folds)
    return summed.select(
        "conv_id", "pos", *[(F.coalesce(f"_b{i}", F.lit(0)) + F.col(f"_p{i}")).alias(s) for i, s in enumerate(SUMS)]
    )


def maximal(rows: DataFrame) -> DataFrame:
    """``conv_id`` of the conversations that are no prefix of another one, one of each set of equal ones."""
    sums = rolling(rows)
    ends = sums.groupBy("conv_id").agg(F.max_by(F.struct("pos", *SUMS), "pos").alias("_end")).select("conv_id", "_end.*")
    lengths = ends.select("conv_id", F.col("pos").alias("_last"))
    inner = sums.join(lengths, "conv_id").filter("pos < _last").select("pos", *SUMS).distinct()
    longest = ends.groupBy("pos", *SUMS).agg(F.min("conv_id").alias("conv_id"))
    return longest.join(inner, ["pos", *SUMS], "left_anti").select("conv_id")


def rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit(HEAD), role, F.lit(TAIL), text, F.lit("\n" + END))


def format_chats(turns: DataFrame, part: int = PART) -> DataFrame:
    """``conv_id, part, n_turns, text`` of the maximal conversations in ``turns`` (``conv_id, turn, role, text``; other columns are
    not read).

    A conversation's text is its parts joined in order; each part renders ``part`` turns, so that one endless conversation is no
    endless row. See ``numbered`` for null, tied and repeated rows. An empty table gives no rows.
    """
    rows = numbered(turns)
    kept = rows.join(maximal(rows), "conv_id", "left_semi")
    said = F.sort_array(F.collect_list(F.struct("pos", rendered(F.col("role"), F.col("text")).alias("said"))))
    return (
        kept.groupBy("conv_id", F.floor((F.col("pos") - 1) / part).cast("long").alias("part"))
        .agg(said.alias("_said"))
        .select(
            "conv_id",
            "part",
            F.size("_said").cast("long").alias("n_turns"),
            F.array_join(F.transform("_said", lambda s: s["said"]), "").alias("text"),
        )
    )
