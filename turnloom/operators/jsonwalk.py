"""Ordered search in JSON trees of any depth, inside the row.

A document is walked level by level: an ``aggregate`` expression carries the open nodes of one level and what was
found so far. Every node has its path of child positions, so the depth-first first hit is the smallest path.
The number of levels is bounded per document by the brackets it opens, not by a fixed depth.
Object keys keep their order (``map<string,string>``); a parallel ``map<string,variant>`` gives the value types.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnloom.functions.binding import let
from turnloom.functions.text import strip

# Keys searched, in order of preference.
CONVERSATION_KEYS = ("link", "conversations", "messages", "history", "chat")
ROLE_KEYS = ("role", "from")
URL_KEYS = ("link", "url", "share_link", "source")
PARSER_DEPTH = 1_000  # the JSON parser accepts no deeper nesting

KID = "struct<key:string,kind:string,raw:string>"
NODE = "struct<path:array<int>,name:string,kind:string,raw:string>"
HIT = "struct<path:array<int>,kind:string,raw:string>"


STRICT = {"allowSingleQuotes": "false"}
KIDS = f"array<{KID}>"


def _kind(v: Column) -> Column:
    return F.regexp_extract(F.coalesce(F.schema_of_variant(v), F.lit("VOID")), "^[A-Z]+", 0)


# strings, brackets and separators, and everything else between them (numbers and words)
TOKEN = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"|[\[\]{}:,]|[^\s\[\]{}:,"]+'


def _kind_of_token(token: Column) -> Column:
    head = F.left(token, F.lit(1))
    return (
        F.when(head == "{", "OBJECT")
        .when(head == "[", "ARRAY")
        .when(head == '"', "STRING")
        .when(head.isin("t", "f"), "BOOLEAN")
        .when(head == "n", "VOID")
        .when(F.rlike(token, F.lit(r"\A-?[0-9]+\z")), "BIGINT")
        .otherwise("DOUBLE")
    )


def _kinds_by_token(raw: Column) -> Column:
    """Types of the children of a container by the first token of each, for the rare one whose variant parse fails (a key that is
    repeated somewhere in it). Every child is typed by its own text."""
    start = F.struct(F.lit(0).alias("depth"), F.lit(False).alias("due"), F.array().cast("array<string>").alias("kinds"))

    def step(state: Column, token: Column) -> Column:
        opens, closes = token.isin("[", "{"), token.isin("]", "}")
        depth = state["depth"] + F.when(opens, 1).when(closes, -1).otherwise(0)
        first = state["due"] & ~closes
        in_list = F.startswith(raw, F.lit("["))
        due = (
            F.when(state["depth"] == 0, in_list)
            .when(state["depth"] == 1, F.when(in_list, token == ",").otherwise(token == ":"))
            .otherwise(False)
        )
        kinds = F.when(first, F.concat(state["kinds"], F.array(_kind_of_token(token)))).otherwise(state["kinds"])
        return F.struct(depth.alias("depth"), due.alias("due"), kinds.alias("kinds"))

    return F.aggregate(F.regexp_extract_all(raw, F.lit(TOKEN), F.lit(0)), start, step, lambda state: state["kinds"])


def children(kind: Column, raw: Column) -> Column:
    """``array<struct<key, kind, raw>>`` of an object (in key order) or array node; empty for scalars."""
    entry = lambda key, kind, text: F.struct(key.alias("key"), kind.alias("kind"), text.alias("raw"))

    def typed(pairs: Column, variants: Column) -> Column:
        """``pairs`` of key and text, typed by the variants parsed beside them."""
        exact = F.zip_with(pairs, variants, lambda p, v: entry(p["key"], _kind(v), p["value"]))
        by_token = F.zip_with(pairs, _kinds_by_token(strip(raw)), lambda p, k: entry(p["key"], k, p["value"]))
        return F.coalesce(exact, by_token)

    of_object = let(
        F.map_entries(F.from_json(raw, "map<string,string>")),
        lambda pairs: typed(pairs, F.map_values(F.from_json(raw, "map<string,variant>"))),
    )
    keyless = lambda t: F.struct(F.lit(None).cast("string").alias("key"), t.alias("value"))
    of_array = let(
        F.transform(F.from_json(raw, "array<string>"), keyless),
        lambda pairs: typed(pairs, F.from_json(raw, "array<variant>")),
    )
    found = F.when(kind == "OBJECT", of_object.cast(KIDS)).when(kind == "ARRAY", of_array.cast(KIDS))
    return F.coalesce(found, F.array().cast(KIDS))


def json_kind(json: Column) -> Column:
    """Type of a whole document; NULL when it is not JSON from its first to its last character.

    The parsers stop at the end of the first value, so ``5 apples`` passes them. The text is therefore also read
    inside ``[...]`` and inside ``{"v":...}``: what follows a first value cannot close both.
    """
    in_list = F.json_array_length(F.concat(F.lit("["), json, F.lit("]"))) == 1
    in_object = F.json_object_keys(F.concat(F.lit('{"v":'), json, F.lit("}"))) == F.array(F.lit("v"))
    kind = (
        F.when(F.from_json(json, "map<string,string>", STRICT).isNotNull(), "OBJECT")
        .when(F.from_json(json, "array<string>", STRICT).isNotNull(), "ARRAY")
        .otherwise(let(F.try_parse_json(json), lambda v: F.when(v.isNotNull(), _kind(v))))
    )
    return F.when(in_list & in_object, kind)


def _walk(
    root_kind: Column,
    root_raw: Column,
    hit: Callable[[Column, Column], Column],
    opened: Callable[[Column, Column], Column],
) -> Column:
    """All hits of the tree. ``hit(node, kids)`` is a HIT or NULL; ``opened(node, kids)`` the NODEs to visit next."""
    return let(root_raw, lambda raw: _walk_bound(root_kind, raw, hit, opened))


def _walk_bound(root_kind: Column, root_raw: Column, hit, opened) -> Column:
    brackets = F.regexp_count(root_raw, F.lit(r"[\[{]"))
    levels = F.sequence(F.lit(0), F.least(F.coalesce(brackets, F.lit(0)), F.lit(PARSER_DEPTH)).cast("int"))
    root = F.array(
        F.struct(
            F.array().cast("array<int>").alias("path"),
            F.lit("$").alias("name"),
            root_kind.alias("kind"),
            root_raw.alias("raw"),
        )
    ).cast(f"array<{NODE}>")
    start = F.struct(root.alias("open"), F.array().cast(f"array<{HIT}>").alias("hits"))

    def looked_at(node: Column) -> Column:
        return let(
            children(node["kind"], node["raw"]),
            lambda kids: F.struct(
                hit(node, kids).cast(HIT).alias("hit"), opened(node, kids).cast(f"array<{NODE}>").alias("next")
            ),
        )

    def level(state: Column, _: Column) -> Column:
        return let(
            F.transform(state["open"], lambda n: looked_at(n)),
            lambda looked: F.struct(
                F.flatten(F.transform(looked, lambda x: x["next"])).cast(f"array<{NODE}>").alias("open"),
                F.concat(
                    state["hits"], F.filter(F.transform(looked, lambda x: x["hit"]), lambda h: h.isNotNull())
                ).cast(f"array<{HIT}>").alias("hits"),
            ),
        )

    # an empty level costs nothing to step over
    step = lambda state, i: F.when(F.size(state["open"]) > 0, level(state, i)).otherwise(state)
    return F.aggregate(levels, start, step, lambda state: state["hits"])


def _no_nodes() -> Column:
    return F.array().cast(f"array<{NODE}>")


def _descend(node: Column, kids: Column, rank: Callable[[Column, Column], Column] = lambda k, i: i) -> Column:
    return F.transform(
        kids,
        lambda k, i: F.struct(
            F.concat(node["path"], F.array(rank(k, i).cast("int"))).alias("path"),
            k["key"].alias("name"),
            k["kind"].alias("kind"),
            k["raw"].alias("raw"),
        ),
    )


def _truthy(kind: Column, raw: Column) -> Column:
    number = kind.isin("BIGINT", "DECIMAL", "DOUBLE", "FLOAT", "INT", "SMALLINT", "TINYINT")
    empty = (
        (kind == "VOID")
        | ((kind == "STRING") & (raw == ""))
        | ((kind == "BOOLEAN") & (raw == "false"))
        | (kind.isin("OBJECT", "ARRAY") & raw.isin("{}", "[]"))
        | (number & F.coalesce(raw.try_cast("double") == 0, F.lit(False)))
    )
    return ~empty


def _first(hits: Column) -> Column:
    return F.array_min(hits)


def _keyed(kids: Column, keys: Sequence[str], kinds: Sequence[str] | None = None) -> Column:
    """The child under the first of ``keys`` that is present (with one of ``kinds``, if given)."""
    def under(key: str) -> Column:
        return F.filter(kids, lambda k: (k["key"] == key) & (k["kind"].isin(*kinds) if kinds else F.lit(True)))

    found = [under(key) for key in keys]
    return F.get(F.concat(*found), F.lit(0))


def find_conversation(json: Column) -> Column:
    """First conversation of a JSON document as ``struct<path, kind, raw>``, depth first; NULL if none.

    An object gives its ``link``, else the first conversation key; a list is a conversation when it starts with a
    message object or a string. An empty conversation is passed over and not searched.
    """

    def kept(path: Column, kind: Column, raw: Column) -> Column:
        return F.when(_truthy(kind, raw), F.struct(path.alias("path"), kind.alias("kind"), raw.alias("raw")).cast(HIT))

    def head_is_message(kids: Column) -> Column:
        def is_message(head: Column) -> Column:
            names = F.json_object_keys(F.when(head["kind"] == "OBJECT", head["raw"]))
            return (head["kind"] == "STRING") | F.arrays_overlap(names, F.array(*[F.lit(k) for k in ROLE_KEYS]))

        return let(F.get(kids, F.lit(0)), is_message)

    def stops(node: Column, kids: Column) -> Column:
        as_object = (node["kind"] == "OBJECT") & _keyed(kids, CONVERSATION_KEYS).isNotNull()
        as_array = (node["kind"] == "ARRAY") & (F.size(kids) > 0) & head_is_message(kids)
        return F.coalesce(as_object | as_array, F.lit(False))

    def hit(node: Column, kids: Column) -> Column:
        value = F.when(
            node["kind"] == "OBJECT",
            let(_keyed(kids, CONVERSATION_KEYS), lambda k: kept(node["path"], k["kind"], k["raw"])),
        ).otherwise(kept(node["path"], node["kind"], node["raw"]))
        return F.when(stops(node, kids), value)

    def opened(node: Column, kids: Column) -> Column:
        return F.when(stops(node, kids), _no_nodes()).otherwise(_descend(node, kids))

    return let(json, lambda text: _first(_walk(json_kind(text), text, hit, opened)))


def find_url(json: Column) -> Column:
    """First URL of a JSON document, link-like keys first at every object; NULL if none."""
    def hit(node: Column, kids: Column) -> Column:
        url = strip(node["raw"])
        return F.when(
            (node["kind"] == "STRING") & (F.startswith(url, F.lit("http://")) | F.startswith(url, F.lit("https://"))),
            F.struct(node["path"].alias("path"), node["kind"].alias("kind"), url.alias("raw")).cast(HIT),
        )

    def rank(k: Column, i: Column) -> Column:
        preferred = F.array_position(F.array(*[F.lit(x) for x in URL_KEYS]), F.coalesce(k["key"], F.lit("")))
        return F.when(preferred > 0, preferred - 1).otherwise(i + len(URL_KEYS))

    def walk(root: Column) -> Column:
        # a document that is one string is searched by its value, not by its quoted text
        raw = F.when(root == "STRING", F.try_variant_get(F.try_parse_json(json), "$", "string")).otherwise(json)
        return _first(_walk(root, raw, hit, lambda n, kids: _descend(n, kids, rank)))["raw"]

    return let(json_kind(json), walk)


def find_messages(json: Column) -> Column:
    """Message objects of an embedded application state, as raw JSON texts; NULL if there are none.

    The first object with a ``mapping`` object gives the mapping's values, or with a ``messages`` list that list.
    """

    def under(kids: Column) -> Column:
        return F.coalesce(_keyed(kids, ["mapping"], ["OBJECT"]), _keyed(kids, ["messages"], ["ARRAY"]))

    def hit(node: Column, kids: Column) -> Column:
        kept = lambda k: F.when(
            (node["kind"] == "OBJECT") & k.isNotNull() & ~k["raw"].isin("{}", "[]"),
            F.struct(node["path"].alias("path"), k["kind"].alias("kind"), k["raw"].alias("raw")).cast(HIT),
        )
        return let(under(kids), kept)

    def opened(node: Column, kids: Column) -> Column:
        stop = (node["kind"] == "OBJECT") & under(kids).isNotNull()
        return F.when(F.coalesce(stop, F.lit(False)), _no_nodes()).otherwise(_descend(node, kids))

    found = let(json, lambda text: _first(_walk(json_kind(text), text, hit, opened)))
    kids = let(found, lambda f: children(f["kind"], f["raw"]))
    return F.transform(F.filter(kids, lambda k: k["kind"] == "OBJECT"), lambda k: k["raw"])


# Type names shown by the profile.
TYPE_NAMES = {"OBJECT": "dict", "ARRAY": "list", "STRING": "str", "BIGINT": "int", "BOOLEAN": "bool", "VOID": "NoneType"}


def json_nodes(json: Column) -> Column:
    """``array<struct<path, type, length>>`` of every key; a list is followed through its first element."""
    root = json_kind(json)

    def visited(node: Column, kids: Column) -> Column:
        # the text carries type and list length; the path of positions is not shown
        name = F.lit("float")
        for kind, shown in TYPE_NAMES.items():
            name = F.when(node["kind"] == kind, shown).otherwise(name)
        size = F.when(node["kind"] == "ARRAY", F.size(kids).cast("string")).otherwise("")
        return F.struct(
            node["path"].alias("path"), name.alias("kind"), F.concat(size, F.lit("|"), node["name"]).alias("raw")
        ).cast(HIT)

    def opened(node: Column, kids: Column) -> Column:
        some = F.when(node["kind"] == "ARRAY", F.slice(kids, 1, 1)).otherwise(kids)
        return F.transform(
            some,
            lambda k, i: F.struct(
                F.concat(node["path"], F.array(i)).alias("path"),
                F.concat(
                    node["name"], F.when(node["kind"] == "ARRAY", "[0]").otherwise(F.concat(F.lit("."), k["key"]))
                ).alias("name"),
                k["kind"].alias("kind"),
                k["raw"].alias("raw"),
            ),
        )

    return F.transform(
        _walk(root, json, visited, opened),
        lambda h: F.struct(
            F.regexp_replace(h["raw"], r"\A[0-9]*\|", "").alias("path"),
            h["kind"].alias("type"),
            F.regexp_extract(h["raw"], r"\A([0-9]*)\|", 1).try_cast("bigint").alias("length"),
        ),
    )


def refused(df: DataFrame, keys: Sequence[str], json: str = "json") -> DataFrame:
    """``keys, n_chars, reason`` of documents that begin like JSON but that the parser does not accept: ``depth`` when the text opens more
    brackets than the parser follows, else ``syntax``."""
    text = strip(F.col(json))
    brackets = F.length(text) - F.length(F.translate(text, "[{", ""))
    like = F.rlike(text, F.lit(r"\A[\[{]")) & json_kind(F.col(json)).isNull()
    reason = F.when(brackets > PARSER_DEPTH, "depth").otherwise("syntax")
    return df.filter(like).select(*keys, F.length(json).alias("n_chars"), reason.alias("reason"))


def json_profile(df: DataFrame, json: str) -> DataFrame:
    """How often every path has every type, with the list lengths, over a JSON column."""
    return (
        df.select(F.explode(json_nodes(F.col(json))).alias("n"))
        .groupBy(F.col("n.path").alias("path"), F.col("n.type").alias("type"))
        .agg(F.count("*").alias("rows"), F.min("n.length").alias("min_length"), F.max("n.length").alias("max_length"))
    )
