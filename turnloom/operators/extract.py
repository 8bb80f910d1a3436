"""Exports and saved pages to turns. All row-local: a page or export blob is cut inside its row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnloom.functions import markup
from turnloom.functions import text as T
from turnloom.functions.binding import let
from turnloom.operators import jsonwalk, segment
from turnloom.operators.dedup import dedup_rows
from turnloom.operators.segment import TURNS, explode_turns

# Where a message of an export array starts and ends, and the script tag of embedded application state.
MESSAGE_START = '["'
MESSAGE_END = '"' + ",null" * 7 + ',"(user|model)"'
STATE_SCRIPT = r"(?is)<script[^>]*\bid=[\x22\x27]__NEXT_DATA__[\x22\x27][^>]*>([^<]*+(?:<(?!/script\s*>)[^<]*+)*+)</script\s*>"
UNKNOWN_ROLE = "unknown"

JSON_ESCAPE = r'\\(["\\/bfnrt]|u[0-9A-Fa-f]{4})'
TURN_ARRAY = "array<struct<role:string,text:string>>"


def unescape_json(body: Column) -> Column:
    """Body of a JSON string, unescaped; as it is when it is not a valid body."""
    bare = F.regexp_replace(body, JSON_ESCAPE, "")
    valid = ~F.rlike(bare, F.lit(r'["\\\x00-\x1f]'))
    value = F.get_json_object(F.concat(F.lit('{"v":"'), body, F.lit('"}')), "$.v")
    return F.when(valid, F.coalesce(value, body)).otherwise(body)


def export_turns(raw: Column) -> Column:
    """Turn array of one raw export blob, empty messages dropped.

    The blob is cut at the message ends first; a message reaches from the first start in its piece to the end, so it
    swallows what looks like further starts, and every character is read once.
    """
    roles = F.regexp_extract_all(raw, F.lit(MESSAGE_END), F.lit(1))
    pieces = F.split(raw, MESSAGE_END)

    def turn(role: Column, piece: Column) -> Column:
        at = F.instr(piece, F.lit(MESSAGE_START))
        body = F.when(at > 0, F.substr(piece, at + len(MESSAGE_START)))
        text = let(body, lambda b: T.strip(F.replace(unescape_json(b), F.lit(T.THOUGHTS_LABEL), F.lit(""))))
        return F.struct(F.when(role == "user", "user").otherwise("assistant").alias("role"), text.alias("text"))

    # the piece after the last end has no role
    turns = F.filter(F.zip_with(roles, pieces, lambda r, p: F.when(r.isNotNull(), turn(r, p))), lambda t: t.isNotNull())
    return F.filter(turns, lambda t: F.length(t["text"]) > 0)


def extract_export_array(df: DataFrame, keys: Sequence[str], raw: str = "raw") -> DataFrame:
    """Turns of raw exports, repeated texts of one export dropped; turn numbers may have gaps."""
    turns = explode_turns(df.withColumn(TURNS, export_turns(F.col(raw))), keys)
    return dedup_rows(turns, "text", ["turn"], list(keys))


def state_turns(html: Column) -> Column:
    """Turn array of the application state embedded in a page; empty when there is none.

    Items without a ``message`` object are passed over, so plain role/content lists give nothing.
    """
    turn_of = lambda m: F.struct(
        F.coalesce(F.get_json_object(m, "$.message.author.role"), F.lit(UNKNOWN_ROLE)).alias("role"),
        F.array_join(_string_parts(F.get_json_object(m, "$.message.content.parts")), "").alias("text"),
    )
    state = F.regexp_extract(html, STATE_SCRIPT, 1)
    items = let(state, lambda s: jsonwalk.find_messages(F.when(s != "", s)))
    turns = F.filter(F.transform(items, turn_of), lambda t: F.length(t["text"]) > 0)
    return F.coalesce(turns.cast(TURN_ARRAY), F.array().cast(TURN_ARRAY))


def _string_parts(parts: Column) -> Column:
    kids = let(F.coalesce(parts, F.lit("[]")), lambda p: jsonwalk.children(F.lit("ARRAY"), p))
    return F.transform(F.filter(kids, lambda k: k["kind"] == "STRING"), lambda k: k["raw"])


def extract_next_data(df: DataFrame, keys: Sequence[str], html: str = "html") -> DataFrame:
    return explode_turns(df.withColumn(TURNS, state_turns(F.col(html))), keys)


def page_turns(df: DataFrame, html: str = "html") -> DataFrame:
    """Add the turn array of a saved page and ``method``: embedded state, else role labels, else ``none``."""
    found = df.withColumn("_state", state_turns(F.col(html)))
    by_state = F.size("_state") > 0
    # a page with state is not read a second time
    page = F.when(~by_state, F.col(html))
    both = segment.page_role_turns(found.withColumn("_visible", markup.visible_text(page)), "_visible").withColumn(
        "_heuristic", F.coalesce(F.col(TURNS).cast(TURN_ARRAY), F.array().cast(TURN_ARRAY))
    )
    return both.withColumn(TURNS, F.when(by_state, F.col("_state")).otherwise(F.col("_heuristic"))).withColumn(
        "method", F.when(by_state, "state").when(F.size("_heuristic") > 0, "labels").otherwise("none")
    )


def extract_precedence(df: DataFrame, keys: Sequence[str], html: str = "html") -> DataFrame:
    """Turns by the first extractor that finds any, with the method used."""
    return explode_turns(page_turns(df, html), [*keys, "method"])


def heading_pages(df: DataFrame, html: str = "html") -> DataFrame:
    """Add ``title`` and the turn array of saved pages whose turns stand under heading lines."""
    titled = df.withColumn("title", markup.title(F.col(html))).withColumn("_markdown", markup.markdown(F.col(html)))
    return segment.heading_turns(titled, "_markdown").drop("_markdown")


def extract_heading_pages(df: DataFrame, keys: Sequence[str], html: str = "html") -> DataFrame:
    """``keys, title, turn, role, text`` of saved pages; pages without a turn give no row."""
    return explode_turns(heading_pages(df, html), [*keys, "title"])


def conversation_turns(df: DataFrame, json: str = "json") -> DataFrame:
    """Add the turn array of the conversation found in a JSON document.

    A list of objects is read by ``role``/``content`` or ``from``/``value`` (the second name only when the first is
    absent), a list of strings alternates, a single string is a transcript, a URL is no content.
    """
    found = df.withColumn("_found", jsonwalk.find_conversation(F.col(json)))
    kind, raw = F.col("_found.kind"), F.col("_found.raw")
    is_list = kind == "ARRAY"
    kids = jsonwalk.children(kind, F.when(is_list, raw))
    as_transcript = segment.transcript_turns(
        found.withColumn("_kids", F.when(is_list, kids)).withColumn(
            "_script", F.when((kind == "STRING") & ~F.startswith(raw, F.lit("http")), raw)
        ),
        "_script",
    )
    def by_key(keys: Column, m: Column, first: str, second: str) -> Column:
        named = F.when(F.array_contains(keys, first), F.get_json_object(m, f"$.{first}"))
        return named.when(F.array_contains(keys, second), F.get_json_object(m, f"$.{second}")).otherwise("")

    objects = F.transform(
        "_kids",
        lambda k: let(
            F.json_object_keys(k["raw"]),
            lambda keys: F.struct(
                by_key(keys, k["raw"], "role", "from").alias("role"),
                by_key(keys, k["raw"], "content", "value").alias("text"),
            ),
        ),
    ).cast(TURN_ARRAY)
    strings = segment.alternating_turns(F.transform("_kids", lambda k: k["raw"])).cast(TURN_ARRAY)
    head = F.get("_kids", F.lit(0))["kind"]
    turns = F.when(head == "OBJECT", objects).when(head == "STRING", strings).otherwise(F.col(TURNS).cast(TURN_ARRAY))
    return as_transcript.withColumn(TURNS, F.coalesce(turns, F.array().cast(TURN_ARRAY))).drop("_kids", "_script")


def json_find_conversation(df: DataFrame, keys: Sequence[str], json: str = "json") -> DataFrame:
    return explode_turns(conversation_turns(df, json), keys)


def routed_turns(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the turn array and ``route`` of a file that is JSON or, on a syntax error, a transcript.

    Valid JSON without a conversation yields nothing; it does not fall back.
    """
    is_json = jsonwalk.json_kind(F.col(text)).isNotNull()
    routed = df.withColumn("route", F.when(is_json, "json").otherwise("text"))
    by_json = conversation_turns(
        routed.withColumn("_json", F.when(F.col("route") == "json", F.col(text))), "_json"
    ).withColumnRenamed(TURNS, "_by_json")
    return segment.transcript_turns(
        by_json.withColumn("_plain", F.when(F.col("route") == "text", F.col(text))), "_plain"
    ).withColumn(TURNS, F.when(F.col("route") == "json", F.col("_by_json")).otherwise(F.col(TURNS)))


def route_json_text(df: DataFrame, keys: Sequence[str], text: str = "text") -> DataFrame:
    return explode_turns(routed_turns(df, text), [*keys, "route"])


def quarantine(df_with_turns: DataFrame, keys: Sequence[str], raw: Column, source: Column) -> DataFrame:
    """Records whose dialogue could not be parsed, kept whole with the reason."""
    note = F.when(F.startswith(raw, F.lit("http")), "URL instead of content").otherwise(
        "Failed to parse dialogue structure"
    )
    record = F.struct(raw.alias("raw_dump"), source.alias("source"), note.alias("note"))
    # generated rather than filtered, so that the turn array is not worked out again for a filter further down
    unparsed = F.when(F.coalesce(F.size(TURNS), F.lit(0)) <= 0, F.array(record))
    return df_with_turns.select(*keys, F.inline(unparsed))
