"""Turns to instruction rows.

Input: ``conv_id, turn, role, text``. All rules are folds over earlier turns, so one very long conversation
is spread over many tasks (see ``ordered``). Where turns are dear to compute, ``sample`` takes the blocks from a cheaper table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnloom.operators.ordered import SPAN, fold_before, sent_on

CONV, TURN = "conv_id", "turn"

# Role aliases and instructions.
USER_ALIASES = ("user", "human", "input")
ASSISTANT_ALIASES = ("assistant", "ai", "model", "gpt")
CARRY_USER_ALIASES = ("user", "human")
CARRY_ASSISTANT_ALIASES = ("assistant", "ai", "model")
CONTINUE_INSTRUCTION = "You are a helpful AI assistant. Continue the conversation."
ANSWER_INSTRUCTION = "You are a helpful AI assistant."
CONTEXT_INTRO = "\n\nContext:\n"

HISTORY_BLOCK = 256


def normalize_role(role: Column) -> Column:
    """Known aliases, in any case, to ``user`` or ``assistant``; anything else unchanged."""
    low = F.lower(role)
    return F.when(low.isin(*USER_ALIASES), "user").when(low.isin(*ASSISTANT_ALIASES), "assistant").otherwise(role)


def _before_row() -> dict[str, tuple[str, Column]]:
    """The turn before: ``prev_turn``, ``prev_role``, ``prev_text``."""
    return {f"prev_{c}": ("prev", F.col(c)) for c in (TURN, "role", "text")}


def pair_adjacent(
    turns: DataFrame, span: int = SPAN, sample: DataFrame | None = None, renumber: bool = False
) -> DataFrame:
    """A user turn directly followed by an assistant turn. Keyed by the user turn, with ``renumber`` by how many turns its
    conversation has before it (dense numbers after rows were removed, in the same pass)."""
    folds = _before_row() | ({"rank": ("sum", F.lit(1).cast("bigint"))} if renumber else {})
    rows = fold_before(turns, [CONV], TURN, folds, span, sample)
    return rows.filter("role = 'assistant' AND prev_role = 'user'").select(
        CONV,
        # the row before has one row less before it
        (F.expr("rank - 1") if renumber else F.col("prev_turn")).alias(TURN),
        F.col("prev_text").alias("instruction"),
        F.lit("").alias("input"),
        F.col("text").alias("output"),
    )


def pair_stats(turns: DataFrame, span: int = SPAN) -> DataFrame:
    """Messages, pairs and unpaired scan steps of the adjacent rule, over the whole table.

    A scan step that forms no pair is a row that has a successor and belongs to no pair.
    """
    rows = fold_before(turns.select(CONV, TURN, "role"), [CONV], TURN, {"prev_role": ("prev", F.col("role"))}, span)
    closes = F.coalesce((F.col("role") == "assistant") & (F.col("prev_role") == "user"), F.lit(False))
    per_conv = (
        rows.withColumn("closes", closes)
        .groupBy(CONV)
        .agg(
            F.count("*").alias("messages"),
            F.count_if("closes").alias("pairs"),
            F.max_by(F.col("closes"), F.col(TURN)).alias("ends_in_pair"),
        )
    )
    loose_end = F.when(F.col("ends_in_pair"), 0).otherwise(1)
    return per_conv.agg(
        F.sum("messages").alias("messages"),
        F.sum("pairs").alias("pairs"),
        F.sum(F.col("messages") - 2 * F.col("pairs") - loose_end).alias("skipped"),
    )


def pair_carry_forward(turns: DataFrame, span: int = SPAN, sample: DataFrame | None = None) -> DataFrame:
    """Each assistant turn with the latest user turn anywhere before it; the user turn is not used up."""
    low = F.lower("role")
    asked = F.when(low.isin(*CARRY_USER_ALIASES), F.col("text"))
    rows = fold_before(turns, [CONV], TURN, {"asked": ("last", asked)}, span, sample)
    return rows.filter(low.isin(*CARRY_ASSISTANT_ALIASES) & F.col("asked").isNotNull()).select(
        CONV,
        TURN,
        F.lit(ANSWER_INSTRUCTION).alias("instruction"),
        F.col("asked").alias("input"),
        F.col("text").alias("output"),
    )


def pair_outer(turns: DataFrame, source: Column | None = None, span: int = SPAN) -> DataFrame:
    """Every assistant turn; input is the directly preceding user turn, else empty."""
    rows = fold_before(turns, [CONV], TURN, _before_row(), span)
    return rows.filter(F.col("role") == "assistant").select(
        CONV,
        TURN,
        F.lit(ANSWER_INSTRUCTION).alias("instruction"),
        F.when(F.col("prev_role") == "user", F.col("prev_text")).otherwise("").alias("input"),
        F.col("text").alias("output"),
        (F.lit(None).cast("string") if source is None else source).alias("source"),
    )


def survivors(turns: DataFrame) -> DataFrame:
    """User and assistant turns under normalized roles: the rows a history is made of."""
    return turns.withColumn("role", normalize_role(F.col("role"))).filter(F.col("role").isin("user", "assistant"))


def pair_history(
    turns: DataFrame,
    max_turns: int | None = None,
    span: int = SPAN,
    block: int = HISTORY_BLOCK,
    sample: DataFrame | None = None,
) -> DataFrame:
    """Assistant turns after a user turn, with everything said before as history and as instruction context.

    ``history_len`` says how many surviving turns precede the pair; the history holds all of them, or with ``max_turns`` the
    latest so many, whatever the length of the conversation. Written-out histories grow with the square of a
    conversation, so they are never shuffled: a turn is sent to its own block and to the later blocks that may look back on it, and there each
    pair cuts its history out. Without a limit blocks are those of ``ordered`` (``span``), a conversation within one is sent once, and
    a turn's place in what its block has been sent is its rank; with ``max_turns`` turns are ranked first, and only the last of a block
    of ``block`` ranks go to the next ones. ``history_turns`` is the linear form.
    """
    if max_turns is None:
        said = survivors(turns).select(CONV, TURN, "role", "text")
        sent = sent_on(said, [CONV], TURN, span, turns if sample is None else sample)
        rank = F.lit(None).cast("bigint")
    else:
        readers = F.sequence(F.expr(f"rank div {block}"), F.expr(f"(rank + 1 + {max_turns}) div {block}"))
        sent = history_turns(turns, span, sample).select("*", F.explode(readers).alias("_reader"))
        sent, rank = sent.withColumn("_own", F.expr(f"rank div {block} = _reader")), F.col("rank")
    said = F.struct(F.col("role"), F.col("text").alias("content")).alias("said")
    entry = F.struct(rank.alias("rank"), TURN, said)
    read = sent.repartition(CONV, "_reader").groupBy(CONV, "_reader")
    read = read.agg(F.sort_array(F.collect_list(entry)).alias("_entries"), F.count_if("_own").alias("_n"))

    role = lambda at: F.get("_entries", at)["said"]["role"]
    own = F.greatest(F.size("_entries") - F.col("_n"), F.lit(1)).cast("int")
    answers = F.filter(
        F.sequence(own, F.size("_entries") - 1), lambda at: (role(at) == "assistant") & (role(at - 1) == "user")
    )
    # a block past the end of its conversation has no turns of its own
    pairs = read.filter("_n > 0").select(CONV, "_entries", F.explode(answers).alias("_at"))
    asked, said = F.get("_entries", F.col("_at") - 1), F.get("_entries", F.col("_at"))
    first = F.lit(0) if max_turns is None else F.greatest(F.col("_at") - 1 - max_turns, F.lit(0))
    return _history_pairs(
        pairs.select(
            CONV,
            said[TURN].alias(TURN),
            F.coalesce(said["rank"], F.col("_at").cast("bigint")).alias("rank"),
            asked["said"]["content"].alias("prev_text"),
            said["said"]["content"].alias("text"),
            F.slice("_entries.said", first + 1, F.col("_at") - 1 - first).alias("history"),
        )
    )


def _history_pairs(rows: DataFrame) -> DataFrame:
    said = F.transform("history", lambda h: F.concat(h["role"], F.lit(": "), h["content"], F.lit("\n")))
    context = F.when(F.size("history") > 0, F.concat(F.lit(CONTEXT_INTRO), F.array_join(said, ""))).otherwise("")
    return rows.select(
        CONV,
        TURN,
        F.concat(F.lit(CONTINUE_INSTRUCTION), context).alias("instruction"),
        F.col("prev_text").alias("input"),
        F.col("text").alias("output"),
        "history",
        (F.col("rank") - 1).alias("history_len"),
    )


def history_turns(turns: DataFrame, span: int = SPAN, sample: DataFrame | None = None) -> DataFrame:
    """Surviving turns with their rank: the history of a pair is the rows of rank below its ``history_len``.

    Linear in the input, unlike written-out histories.
    """
    cuts = turns if sample is None else sample
    ranked = fold_before(survivors(turns), [CONV], TURN, {"rank": ("sum", F.lit(1).cast("bigint"))}, span, cuts)
    return ranked.withColumn("rank", F.coalesce("rank", F.lit(0)))
