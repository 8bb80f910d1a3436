"""Text to turns.

A transcript is one row, so it is cut inside the row: lines to an array, openers found by expression, the lines
between two openers joined. Nothing is shuffled and no document waits for another.
Output rows: the key columns, ``turn`` (bigint), ``role``, ``text``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnloom.functions import text as T
from turnloom.functions.binding import let

# Transcript markers and their roles.
TRANSCRIPT_MARKERS = {
    "User:": "user",
    "Human:": "user",
    "AI:": "assistant",
    "Assistant:": "assistant",
    "System:": "system",
    "Input:": "user",
    "input:": "user",
    "Output:": "assistant",
    "output:": "assistant",
    "Model:": "assistant",
    "model:": "assistant",
}
# Openers of page text and of interface dumps.
PAGE_USER = r"(?iu)\A(User|Human|You):?"
PAGE_ASSISTANT = r"(?iu)\A(ChatGPT|Assistant|AI|Model):?"
DUMP_USER = r"(?iu)\A(user|input|prompt):"
DUMP_ASSISTANT = r"(?iu)\A(model|output|response):"
# Fixed value: a heading line.
HEADING = rf"(?iu)\n[{T.WS_CLASS}]*(?:\*\*)?(User|Model)(?:\*\*)?[{T.WS_CLASS}]*\n"

LINES, OPENERS, TURNS = "_lines", "_openers", "_turns"


def explode_turns(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row a turn of the turn array.

    The outer form, because for the plain one Spark infers a filter on the array and moves it, with the whole
    expression that makes the array, below every projection: each text would be cut several times.
    """
    exploded = df.select(*keys, F.posexplode_outer(TURNS).alias("turn", "t")).filter(F.col("turn").isNotNull())
    return exploded.select(*keys, F.col("turn").cast("bigint").alias("turn"), "t.role", F.col("t.text").alias("text"))


def _cut(
    df: DataFrame,
    lines: Column,
    role_of: Callable[[Column], Column],
    body_of: Callable[[Column], Column],
    blank_body_is_line: bool,
) -> DataFrame:
    """Add the turn array: an opener line starts a turn, lines before the first opener are dropped."""

    def opener(l: Column, i: Column) -> Column:
        # only an opener has a body
        opened = lambda r: F.when(r.isNotNull(), F.struct(i.alias("at"), r.alias("role"), body_of(l).alias("body")))
        return let(role_of(l), opened)

    def turn(o: Column, k: Column) -> Column:
        end = F.coalesce(F.get(OPENERS, k + 1)["at"], F.size(LINES))
        first = F.array(o["body"])
        if not blank_body_is_line:
            first = F.filter(first, lambda b: F.length(b) > 0)
        tail = F.slice(F.col(LINES), o["at"] + 2, end - o["at"] - 1)
        return F.struct(o["role"].alias("role"), F.array_join(F.concat(first, tail), "\n").alias("text"))

    return (
        df.withColumn(LINES, lines)
        .withColumn(OPENERS, F.filter(F.transform(LINES, opener), lambda o: o.isNotNull()))
        .withColumn(TURNS, F.transform(OPENERS, turn))
    )


def _drop_empty_last(turns: Column) -> Column:
    last_empty = F.length(F.get(turns, F.size(turns) - 1)["text"]) == 0
    return F.when((F.size(turns) > 0) & last_empty, F.slice(turns, 1, F.size(turns) - 1)).otherwise(turns)


def transcript_turns(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the turn array of a marked transcript."""
    markers = "\\A(" + "|".join(TRANSCRIPT_MARKERS) + ")"
    roles = F.create_map(*[F.lit(x) for kv in TRANSCRIPT_MARKERS.items() for x in kv])
    marker = lambda l: F.regexp_extract(T.strip(l), markers, 1)
    return _cut(
        df,
        T.lines(F.col(text)),
        lambda l: roles[marker(l)],
        lambda l: T.strip(F.regexp_replace(T.strip(l), markers, "")),
        blank_body_is_line=True,
    )


def segment_transcript(df: DataFrame, keys: Sequence[str], text: str = "text") -> DataFrame:
    """``User: …`` / ``AI: …`` transcripts; continuation lines stay as they are, empty turns are kept."""
    return explode_turns(transcript_turns(df, text), keys)


def _stripped_turns(df: DataFrame, text: str, user: str, assistant: str) -> DataFrame:
    cut = _cut(
        df,
        T.paragraphs(F.col(text)),
        lambda l: F.when(F.rlike(l, F.lit(user)), "user").when(F.rlike(l, F.lit(assistant)), "assistant"),
        lambda l: T.strip(
            F.when(F.rlike(l, F.lit(user)), F.regexp_replace(l, user, "")).otherwise(
                F.regexp_replace(l, assistant, "")
            )
        ),
        blank_body_is_line=False,
    )
    return cut.withColumn(TURNS, _drop_empty_last(F.col(TURNS)))


def page_role_turns(df: DataFrame, text: str = "text", strict: bool = False) -> DataFrame:
    """Add the turn array of visible page text."""
    colon = lambda p: p.removesuffix("?") if strict else p
    return _stripped_turns(df, text, colon(PAGE_USER), colon(PAGE_ASSISTANT))


def segment_page_roles(df: DataFrame, keys: Sequence[str], text: str = "text", strict: bool = False) -> DataFrame:
    """Page text with role labels. The colon is optional, so ``Users like`` opens a turn; ``strict`` needs it."""
    return explode_turns(page_role_turns(df, text, strict), keys)


def ui_dump_turns(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the turn array of an interface dump."""
    return _stripped_turns(df, text, DUMP_USER, DUMP_ASSISTANT)


def segment_ui_dump(df: DataFrame, keys: Sequence[str], text: str = "text") -> DataFrame:
    """``Input:`` / ``Output:`` dumps; the colon is required."""
    return explode_turns(ui_dump_turns(df, text), keys)


def heading_turns(df: DataFrame, text: str = "text", legacy: bool = False) -> DataFrame:
    """Add the turn array of a page whose turns stand under ``User`` and ``Model`` lines."""
    body = F.concat(F.lit("\n"), F.replace(F.col(text), F.lit("\r\n"), F.lit("\n")))
    label = F.col("_label")
    role_of = lambda r: F.when((r if legacy else F.lower(r)) == ("Model" if legacy else "model"), "assistant").otherwise("user")
    turn = lambda role, t: F.struct(role.alias("role"), t.alias("text"))
    return (
        df.withColumn("_body", body)
        .withColumn("_label", F.regexp_extract_all("_body", F.lit(HEADING), F.lit(1)))
        .withColumn(LINES, F.split("_body", HEADING))
        .withColumn(
            TURNS,
            F.filter(
                F.concat(
                    F.array(turn(F.lit("user"), T.leading_chunk(F.col(LINES)[0]))),
                    F.zip_with(
                        label,
                        F.slice(F.col(LINES), F.lit(2), F.size(label)),
                        lambda r, t: turn(role_of(r), T.drop_ui_lines(t)),
                    ),
                ),
                lambda t: F.length(t["text"]) > 0,
            ),
        )
        .drop("_body", "_label")
    )


def segment_headings(df: DataFrame, keys: Sequence[str], text: str = "text", legacy: bool = False) -> DataFrame:
    """Heading lines to turns. ``legacy`` takes only the exact word ``Model`` as the assistant."""
    return explode_turns(heading_turns(df, text, legacy), keys)


def alternating_turns(items: Column) -> Column:
    """Even items are the user's, odd ones the assistant's."""
    return F.transform(
        items, lambda t, i: F.struct(F.when(i % 2 == 0, "user").otherwise("assistant").alias("role"), t.alias("text"))
    )


def segment_alternating(df: DataFrame, keys: Sequence[str], items: str = "messages") -> DataFrame:
    return explode_turns(df.withColumn(TURNS, alternating_turns(F.col(items))), keys)
