"""Inputs of the registered queries, derived by Spark from the given tables.

The tables hold alternating conversations, plain documents and pages without application state. Each function here
turns a whole table into the shape an operator expects (marked transcripts, dumps, exports, JSON trees, candidate
answers, logs). All derivations are row-local, so the work of a query grows with its table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values shared with the SQL oracles: what is put in front of, or after, the lines of a document, in turn.
TRANSCRIPT_PREFIXES = ("", "User: ", "", "  AI: ", "Input:", "output: ", " Human:  ", "Model:", "System: ", "assistant: ")
PAGE_PREFIXES = ("", "You: ", "", " chatgpt ", "Model:", "", "Users like ", "AI", "", "human:")
DUMP_PREFIXES = ("", "User:", "", " MODEL: ", "prompt:  ", "", "Response:", "input ", "output:")
HEADING_SUFFIXES = ("", "\nUser", "", "\n**Model**", "\n  model \t", "\nUser\nModel", "")
UI_SUFFIXES = (
    "",
    "\n Edit ",
    "\nmore_vert",
    "\n![a](x/watermark.png)",
    "\n![a](x/real.png)",
    "\n",
    "\nthoughts!",
    "\nCopy",
)
ITEM_ROLES = ("user", "assistant", "Human", "gpt")

# Letters and marks replaced to get text in another script.
LATIN_HALF, HAN_HALF = "etaoi.?!", "的一是不了。？！"
LATIN_FULL, HAN_FULL = "etaoinshrdlu.?!", "的一是不了人我在有他这中。？！"


def _cycle(values: Sequence[str], i: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), (i % len(values)).cast("int"))


def lines_of(text: str = "text") -> Column:
    return F.split(text, "\n")


def ragged(turns: DataFrame) -> DataFrame:
    """Conversations whose roles no longer alternate, so that the pairing rules differ."""
    pick = F.length("text") % 5
    role = F.when(pick == 0, "Human").when(pick == 1, "assistant").when(pick == 2, "model").when(pick == 3, "user")
    return turns.withColumn("role", role.otherwise(F.col("role")))


JOINED = 100


def joined(turns: DataFrame) -> DataFrame:
    """A hundred conversations end to end as one."""
    return turns.withColumn("turn", F.col("conv_id") % JOINED * 1_000 + F.col("turn")).withColumn(
        "conv_id", F.expr(f"conv_id div {JOINED}")
    )


def with_copies(turns: DataFrame) -> DataFrame:
    """Every conversation and its copy under another number."""
    return turns.unionByName(turns.withColumn("conv_id", F.col("conv_id") + 1_000_000))


def prefixed(docs: DataFrame, prefixes: Sequence[str]) -> DataFrame:
    text = F.array_join(F.transform(lines_of(), lambda l, i: F.concat(_cycle(prefixes, i), l)), "\n")
    return docs.select("doc_id", text.alias("text"))


def suffixed(docs: DataFrame, suffixes: Sequence[str]) -> DataFrame:
    text = F.array_join(F.transform(lines_of(), lambda l, i: F.concat(l, _cycle(suffixes, i))), "\n")
    return docs.select("doc_id", text.alias("text"))


def with_lead(docs: DataFrame) -> DataFrame:
    """Documents below the remains of a page header."""
    t = F.col("text")
    kind = F.col("doc_id") % 4
    text = (
        F.when(kind == 0, t)
        .when(kind == 1, F.concat(F.lit("nav\nme@mail.com\n"), t))
        .when(kind == 2, F.concat(F.lit("a@b.com\nx\n  # Title\n1,234 tokens\n"), t))
        .otherwise(F.concat(t, F.lit("\nlast@x.com")))
    )
    return docs.select("doc_id", text.alias("text"))


def contaminated(turns: DataFrame) -> DataFrame:
    """Every third turn wrapped in export debris, every third with a marker but no body."""
    t = F.col("text")
    kind = F.col("turn") % 3
    text = (
        F.when(kind == 0, F.concat(F.lit('prompts/x],["'), t, F.lit('",null,[1,2]')))
        .when(kind == 1, F.concat(F.lit("prompts/"), t))
        .otherwise(t)
    )
    return turns.withColumn("text", text)


def in_han(text: Column, latin: str = LATIN_FULL, han: str = HAN_FULL) -> Column:
    return F.translate(F.lower(text), latin, han)


HAN_GAP = "你"  # between words it leaves Latin runs of many lengths


def han_docs(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", in_han(F.col("text")).alias("text"))


def instruction_rows(pairs: DataFrame) -> DataFrame:
    """Pairs, some with an input."""
    given = F.when(F.col("turn") % 4 == 0, F.concat(F.lit("ref "), F.col("conv_id").cast("string"))).otherwise("")
    return pairs.withColumn("input", given)


def candidates(docs: DataFrame) -> DataFrame:
    """Three attempts a document, each more in the target script than the one before."""
    t = F.col("text")
    tries = F.array(t, in_han(t, LATIN_HALF, HAN_HALF), F.concat(F.lit("[INST]"), in_han(t)))
    return docs.select(F.col("doc_id").alias("prompt_id"), F.posexplode(tries).alias("attempt", "text")).withColumn(
        "attempt", F.col("attempt") + 1
    )


FOREIGN = "☃"


def generated(pairs: DataFrame) -> DataFrame:
    """An answer to most pairs: shifted by one, cut in half, equal, or none; every seventh character of some is foreign."""
    out = F.col("output")
    kind = F.length(out) % 4
    answer = (
        F.when(kind == 0, F.substr(out, F.lit(2)))
        .when(kind == 1, F.left(out, F.expr("length(output) div 2")))
        .when(kind == 2, out)
    )
    edited = F.when(F.col("conv_id") % 2 == 1, F.regexp_replace(answer, "(?s)(.{6}).", f"$1{FOREIGN}")).otherwise(answer)
    return pairs.select("conv_id", "turn", edited.alias("generated")).filter(F.col("generated").isNotNull())


def expected(pairs: DataFrame) -> DataFrame:
    return pairs.select("conv_id", "turn", F.col("instruction").alias("prompt"), F.col("output").alias("expected"))


def knowledge(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.left("text", F.lit(40)).alias("title"), F.col("text").alias("content"))


def questions(benchmark: DataFrame) -> DataFrame:
    return benchmark.select(F.col("item_id").alias("question_id"), F.col("text").alias("question"))


def run_log(events: DataFrame) -> DataFrame:
    """The events as the log of several interleaved runs; every run has gaps in its steps."""
    step = F.col("event_id") + 1
    loss = F.col("value") / 500
    return events.select(
        F.col("event_type").alias("run"),
        step.alias("step"),
        loss.alias("loss"),
        (F.lit(3e-5) * F.least(step / 300, F.lit(1.0))).alias("lr"),
        F.when(step % 4 == 0, loss / 2).alias("eval_loss"),
    )


def chat_pages(pages: DataFrame) -> DataFrame:
    """Pages with the heading lines of a chat put between their blocks."""
    html = F.replace(F.col("html"), F.lit("</h1>"), F.lit("</h1><p><b>Model</b></p>"))
    return pages.select("page_id", F.replace(html, F.lit("<br>"), F.lit("<p>User</p>")).alias("html"))


def _json_string(text: Column) -> Column:
    quoted = F.to_json(F.array(text))
    return F.substr(quoted, F.lit(2), F.length(quoted) - 2)


def _items(role_key: str, content_key: str) -> Column:
    return F.to_json(
        F.transform(
            lines_of(),
            lambda l, i: F.struct(_cycle(ITEM_ROLES, i).alias(role_key), l.alias(content_key)),
        )
    )


def _alternately(first: str, second: str) -> Column:
    return F.transform(lines_of(), lambda l, i: F.concat(F.when(i % 2 == 0, first).otherwise(second), l))


def json_trees(docs: DataFrame) -> DataFrame:
    """Every document as a conversation somewhere in a JSON tree; nine shapes, two of them without one."""
    strings = F.to_json(lines_of())
    wrap = lambda before, inner, after: F.concat(F.lit(before), inner, F.lit(after))
    shapes = (
        wrap('{"meta":{"title":"t"},"conversations":', _items("role", "content"), "}"),
        wrap('{"a":{"b":{"messages":', _items("from", "value"), '}},"note":1}'),
        strings,
        wrap('{"data":{"link":"https://x.example/', F.col("doc_id").cast("string"), '"}}'),
        wrap('{"chat":', _json_string(F.array_join(_alternately("User: ", "AI: "), "\n")), "}"),
        wrap('{"x":{"messages":[]},"y":[0,{"history":', _items("role", "content"), "}]}"),
        wrap('{"z":[1,[2,[[],', _items("role", "content"), "]]]}"),
        wrap('{"k":1,"body":{"m":[true,null,', strings.substr(F.lit(2), F.length(strings) - 1), "}}"),
        wrap('{"d":' * 12 + '{"chat":', strings, "}" + "}" * 12),
    )
    return _shaped(docs, shapes)


def _shaped(docs: DataFrame, shapes: Sequence[Column], name: str = "json") -> DataFrame:
    kind = F.col("doc_id") % len(shapes)
    value = shapes[-1]
    for i, shape in enumerate(shapes[:-1]):
        value = F.when(kind == i, shape).otherwise(value)
    return docs.select("doc_id", "text", value.alias(name))


def url_trees(docs: DataFrame) -> DataFrame:
    """Every document's text in a JSON tree with a URL somewhere, or nowhere."""
    body, key = _json_string(F.col("text")), F.col("doc_id").cast("string")
    part = lambda *xs: F.concat(*[F.lit(x) if isinstance(x, str) else x for x in xs])
    shapes = (
        part('{"note":"see http","items":[{"id":1,"url":"https://e.example/', key, '"}],"link":"","body":', body, "}"),
        part('{"first":"http://first.example/', key, '","source":"  https://src.example/', key, ' ","body":', body, "}"),
        part('["x",["http://l.example/', key, '"],', body, "]"),
        part('{"k":[{"body":', body, "}]}"),
        part('"https://top.example/', key, '"'),
    )
    return _shaped(docs, shapes)


def mixed_files(docs: DataFrame) -> DataFrame:
    """Every document as a JSON file, a transcript, JSON that is broken, or JSON without a conversation."""
    transcript = F.array_join(_alternately("User: ", "AI: "), "\n")
    shapes = (
        F.concat(F.lit('{"messages":'), _items("role", "content"), F.lit("}")),
        transcript,
        F.concat(F.lit('{"messages":[,\nUser: broken\n'), transcript),
        F.concat(F.lit('{"body":{"t":'), _json_string(F.col("text")), F.lit("}}")),
        F.concat(F.lit('{"link":"http://x.example/'), F.col("doc_id").cast("string"), F.lit('"}')),
    )
    return _shaped(docs, shapes, "raw")


def turn_arrays(docs: DataFrame) -> DataFrame:
    """Every document as a JSON list of messages."""
    keyed = F.when(F.col("doc_id") % 2 == 0, _items("role", "content")).otherwise(_items("from", "value"))
    return docs.select("doc_id", keyed.alias("json"))


def exports(docs: DataFrame) -> DataFrame:
    """Every document as a raw export; the first message has debris in front of it, which the pattern swallows."""

    def message(l: Column, i: Column) -> Column:
        body = F.concat(l, F.when(i % 3 == 1, " Expand to view model thoughts").otherwise(""))
        role = F.when(i % 2 == 0, "user").otherwise("model")
        return F.concat(F.lit("["), _json_string(body), F.lit("," + "null," * 7 + '"'), role, F.lit('"]'))

    raw = F.array_join(F.transform(lines_of(), message), ",")
    return docs.select("doc_id", F.concat(F.lit('[["prompts/p1",null,['), raw, F.lit("]]]")).alias("raw"))


def _escaped(text: Column) -> Column:
    for char, ref in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(char), F.lit(ref))
    return text


def state_pages(docs: DataFrame) -> DataFrame:
    """Every document as a chat page: state as mapping, state as list, state of plain messages, or no state."""
    speaker = lambda i: F.when(i % 2 == 0, "user").otherwise("assistant")
    node = lambda l, i: F.struct(
        F.struct(
            F.struct(speaker(i).alias("role")).alias("author"), F.struct(F.array(l, F.lit("")).alias("parts")).alias("content")
        ).alias("message")
    )
    bare = lambda l, i: F.struct(F.struct(F.struct(F.array(l).alias("parts")).alias("content")).alias("message"))
    mapping = F.map_from_arrays(
        F.transform(lines_of(), lambda l, i: F.concat(F.lit("n"), i.cast("string"))), F.transform(lines_of(), node)
    )
    state = (
        F.concat(F.lit('{"props":{"pageProps":{"mapping":'), F.to_json(mapping), F.lit("}}}")),
        F.concat(F.lit('{"messages":'), F.to_json(F.transform(lines_of(), bare)), F.lit("}")),
        F.concat(F.lit('{"messages":'), _items("role", "content"), F.lit("}")),
    )
    tag = lambda s: F.concat(
        F.lit('<script id="__NEXT_DATA__" type="application/json">'), F.replace(s, F.lit("<"), F.lit("\\u003c")), F.lit("</script>")
    )
    kind = F.col("doc_id") % 4
    script = F.when(kind == 0, tag(state[0])).when(kind == 1, tag(state[1])).when(kind == 2, tag(state[2])).otherwise("")
    shown = F.array_join(
        F.transform(
            lines_of(),
            lambda l, i: F.concat(
                F.lit("<p>"), F.when(i % 2 == 0, "User: ").otherwise("AI: "), _escaped(l), F.lit("</p>")
            ),
        ),
        "",
    )
    html = F.concat(F.lit("<html><head><title>T</title></head><body>"), shown, script, F.lit("</body></html>"))
    return docs.select("doc_id", html.alias("html"))
