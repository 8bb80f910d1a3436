"""HTML pages to text, by regular expressions only.

Not a full HTML parser: comments, script-like subtrees and tags are removed and character references decoded, which
is what the chat extractors downstream need. Patterns read a page once from left to right; what is opened and never closed
reaches to the end, as in a browser.
"""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from turnloom.functions import text as T
from turnloom.functions.binding import let

# Subtrees that never hold conversation text.
HIDDEN_TAGS = ("script", "style", "nav", "footer", "header")
UNKNOWN_TITLE = "Unknown"
BLOCK_MIN_CHARS = 20
BLOCK_PREVIEW = 100
BLOCKS_PER_PAGE = 21

# the rest of a tag: quoted values may hold any character
ATTRS = r"(?:[^>\x22']*+(?:(?:\x22[^\x22]*+\x22|'[^']*+')[^>\x22']*+)*+|[^>]*+)"
ANY_TAG = rf"<[!/A-Za-z]{ATTRS}>"
TITLE = r"(?is)<title[^>]*>(.*?)</title\s*>"
TOKEN = rf"{ANY_TAG}|[^<]+|<"
TAG_NAME = r"\A</?([A-Za-z][A-Za-z0-9]*)"
CLASS_ATTR = r"(?i)\bclass\s*=\s*(?:\x22([^\x22]*)\x22|'([^']*)'|([^\s\x22'>]+))"
VOID_TAGS = "area base br col embed hr img input link meta source track wbr".split()

REFERENCE = r"\A(#[0-9]+|#[xX][0-9A-Fa-f]+|[A-Za-z][A-Za-z0-9]*);"
# References that most pages have, looked up before all others.
COMMON = "lt gt quot apos nbsp copy reg middot hellip ndash mdash lsquo rsquo ldquo rdquo amp".split()
REPLACEMENT = 0xFFFD
LAST_CODE = 0x10FFFF
# numbers 128 to 159 mean the characters of this code page
WESTERN = "cp1252"

BLOCK_TAGS = (
    "div section article main aside header footer nav form fieldset figure figcaption table thead tbody tfoot tr td th "
    "ul ol dl dt dd pre blockquote address hr"
).split()

# Markup kept as Markdown-like text, applied in this order.
MARKDOWN_RULES = (
    (r"(?i)<h1\b[^>]*>", "\n\n# "),
    (r"(?i)<h2\b[^>]*>", "\n\n## "),
    (r"(?i)<h3\b[^>]*>", "\n\n### "),
    (r"(?i)<h4\b[^>]*>", "\n\n#### "),
    (r"(?i)<h5\b[^>]*>", "\n\n##### "),
    (r"(?i)<h6\b[^>]*>", "\n\n###### "),
    (r"(?i)</h[1-6]\s*>", "\n\n"),
    (r"(?i)</?p\b[^>]*>", "\n\n"),
    (rf"(?i)</?(?:{'|'.join(BLOCK_TAGS)})\b{ATTRS}>", "\n\n"),
    (r"(?i)<br\b[^>]*>", "  \n"),
    (r"(?i)<li\b[^>]*>", "\n  * "),
    (r"(?i)</?(?:b|strong)\b[^>]*>", "**"),
)
VALUE = r"(?:\x22([^\x22]*)\x22|'([^']*)'|([^\s\x22'>]+))"
IMAGE_RULES = (
    (rf"(?i)<img\b[^>]*?\balt\s*=\s*{VALUE}[^>]*?\bsrc\s*=\s*{VALUE}[^>]*>", (1, 2, 3), (4, 5, 6)),
    (rf"(?i)<img\b[^>]*?\bsrc\s*=\s*{VALUE}[^>]*?\balt\s*=\s*{VALUE}[^>]*>", (4, 5, 6), (1, 2, 3)),
    (rf"(?i)<img\b[^>]*?\bsrc\s*=\s*{VALUE}[^>]*>", (), (1, 2, 3)),
)
LINK_OPEN = r"(?i)<a\b"
LINK_REST = rf"(?is)\A[^>]*?\bhref\s*=\s*{VALUE}[^>]*>(.*?)</a\s*>"


def hidden_pattern(tags) -> str:
    """Comments and subtrees of the tags, whichever starts first."""
    subtrees = [rf"<{tag}\b{ATTRS}>.*?(?:</{tag}\s*>|\z)" for tag in tags]
    return "(?is)" + "|".join([r"<!--.*?(?:-->|\z)", *subtrees])


def _hidden_by_steps(tags) -> str:
    """What ``hidden_pattern`` matches, for Java only: a look at every ``<``, in a subtree too, instead of one at every character."""
    subtrees = [rf"{tag}\b{ATTRS}>[^<]*+(?:<(?!/{tag}\s*>)[^<]*+)*+(?:</{tag}\s*>)?+" for tag in tags]
    return "(?is)<(?:" + "|".join([r"!--.*?(?:-->|\z)", *subtrees]) + ")"


def _named() -> tuple[Column, Column]:
    names = {name[:-1]: chars for name, chars in html5.items() if name.endswith(";")}
    common = {name: names[name] for name in COMMON}
    return tuple(F.from_json(F.lit(json.dumps(m)), "map<string,string>") for m in (common, names))


def _numeric(digits: Column) -> Column:
    """Character of ``65`` or ``x41``; what is no character becomes U+FFFD."""
    is_hex = F.lower(F.left(digits, F.lit(1))) == "x"
    bare = F.ltrim(F.when(is_hex, F.substr(digits, F.lit(2))).otherwise(digits), F.lit("0"))
    value = F.when(is_hex, F.conv(bare, 16, 10)).otherwise(F.conv(bare, 10, 10)).try_cast("bigint")
    value = F.when(F.length(bare) > 10, LAST_CODE + 1).otherwise(F.coalesce(value, F.lit(0)))
    western = [bytes([i]).decode(WESTERN, "ignore") for i in range(128, 160)]
    codes = F.array(*[F.lit(ord(c) if c else i + 128) for i, c in enumerate(western)])

    def code(v: Column) -> Column:
        none = (v == 0) | v.between(0xD800, 0xDFFF) | (v > LAST_CODE)
        return F.when(none, REPLACEMENT).when(v.between(128, 159), F.get(codes, (v - 128).cast("int"))).otherwise(v)

    return F.decode(F.unhex(F.lpad(F.hex(let(value, code).cast("bigint")), 8, "0")), "UTF-32")


def decode_references(c: Column) -> Column:
    """Named and numeric character references, each decoded once; unknown ones stay as they are. What makes the text is worked out once."""
    common, names = _named()

    def decoded(p: Column) -> Column:
        def char(ref: Column) -> Column:
            by_name = F.coalesce(F.try_element_at(common, ref), F.try_element_at(names, ref))
            return F.when(ref == "", F.lit(None)).when(
                F.startswith(ref, F.lit("#")), _numeric(F.substr(ref, F.lit(2)))
            ).otherwise(by_name)

        def put(ref: Column) -> Column:
            rest = F.substr(p, F.length(ref) + 2)
            return let(char(ref), lambda x: F.when(x.isNotNull(), F.concat(x, rest)).otherwise(F.concat(F.lit("&"), p)))

        return let(F.regexp_extract(p, REFERENCE, 1), put)

    def joined(parts: Column) -> Column:
        rest = F.transform(F.slice(parts, F.lit(2), F.size(parts)), decoded)
        return F.concat(F.get(parts, F.lit(0)), F.array_join(rest, ""))

    return let(c, lambda t: F.when(F.contains(t, F.lit("&")), let(F.split(t, "&"), joined)).otherwise(t))


def _without_hidden(html: Column, tags=HIDDEN_TAGS) -> Column:
    return F.regexp_replace(html, _hidden_by_steps(tags), "\n")


def visible_text(html: Column) -> Column:
    """Text nodes of a page, one a line, stripped, blank lines dropped."""
    bare = decode_references(F.regexp_replace(_without_hidden(html), ANY_TAG, "\n"))
    return F.array_join(T.paragraphs(bare), "\n")


def title(html: Column) -> Column:
    """Title text; ``Unknown`` without a title tag; NULL when the tag is empty."""
    body = F.nullif(decode_references(F.regexp_extract(html, TITLE, 1)), F.lit(""))
    return F.when(html.rlike(TITLE), body).otherwise(UNKNOWN_TITLE)


def _groups(*numbers: int) -> str:
    return "".join(f"${n}" for n in numbers)


def _links(c: Column) -> Column:
    """``[text](target)``; a link is looked for up to the next one, so an unclosed link costs nothing more."""
    parts = F.split(c, LINK_OPEN)

    def link(p: Column) -> Column:
        made = F.regexp_replace(p, LINK_REST, f"[$4]({_groups(1, 2, 3)})")
        return F.when(F.rlike(p, F.lit(LINK_REST)), made).otherwise(F.concat(F.lit("<a"), p))

    rest = F.transform(F.slice(parts, F.lit(2), F.size(parts)), link)
    return F.concat(F.get(parts, F.lit(0)), F.array_join(rest, ""))


def markdown(html: Column) -> Column:
    """Headings, paragraphs, blocks, lists, bold, links and images as Markdown-like text."""
    c = _without_hidden(html, ("head", "script", "style"))
    for pattern, alt, src in IMAGE_RULES:
        c = F.regexp_replace(c, pattern, f"![{_groups(*alt)}]({_groups(*src)})")
    c = _links(c)
    for pattern, markdown_text in MARKDOWN_RULES:
        c = F.regexp_replace(c, pattern, markdown_text)
    c = decode_references(F.regexp_replace(c, ANY_TAG, ""))
    return T.strip(F.regexp_replace(c, r"\n{3,}", "\n\n"))


ELEMENT = "struct<tag:string,css_class:string>"
BLOCK = "struct<tag:string,css_class:string,n_chars:int,preview:string>"


def text_blocks(html: Column) -> Column:
    """``array<struct<tag, css_class, n_chars, preview>>`` of the longer text nodes, first 21, with the element around each.

    Tags and texts are read in order with the stack of open elements; an end tag closes the last element of its name.
    """
    start = F.struct(F.array().cast(f"array<{ELEMENT}>").alias("open"), F.array().cast(f"array<{BLOCK}>").alias("blocks"))

    def state(open_: Column, blocks: Column) -> Column:
        return F.struct(open_.alias("open"), blocks.alias("blocks"))

    def element(tag: Column, token: Column) -> Column:
        css = F.concat(*[F.regexp_extract(token, CLASS_ATTR, i) for i in (1, 2, 3)])
        return F.struct(tag.alias("tag"), F.nullif(css, F.lit("")).alias("css_class")).cast(ELEMENT)

    def after_tag(s: Column, token: Column) -> Column:
        def moved(tag: Column) -> Column:
            opened = s["open"]
            names = F.reverse(F.transform(opened, lambda e: e["tag"]))
            closes = F.startswith(token, F.lit("</"))
            kept = F.slice(opened, F.lit(1), (F.size(opened) - F.array_position(names, tag)).cast("int"))
            popped = F.when(F.array_contains(names, tag), kept).otherwise(opened)
            empty = tag.isin(*VOID_TAGS) | F.endswith(token, F.lit("/>")) | (tag == "")
            pushed = F.when(empty, opened).otherwise(F.concat(opened, F.array(element(tag, token))))
            return state(F.when(closes, popped).otherwise(pushed), s["blocks"])

        return let(F.lower(F.regexp_extract(token, TAG_NAME, 1)), moved)

    def after_text(s: Column, token: Column) -> Column:
        def added(body: Column) -> Column:
            around = F.element_at(s["open"], -1)
            block = F.struct(
                around["tag"].alias("tag"),
                around["css_class"].alias("css_class"),
                F.length(body).alias("n_chars"),
                F.left(body, F.lit(BLOCK_PREVIEW)).alias("preview"),
            ).cast(BLOCK)
            long = (F.length(body) > BLOCK_MIN_CHARS) & (F.size(s["blocks"]) < BLOCKS_PER_PAGE) & (F.size(s["open"]) > 0)
            return F.when(long, state(s["open"], F.concat(s["blocks"], F.array(block)))).otherwise(s)

        return let(T.strip(decode_references(token)), added)

    def step(s: Column, token: Column) -> Column:
        tag = F.rlike(token, F.lit(r"\A<[!/A-Za-z]"))
        return F.when(tag, after_tag(s, token)).when(F.length(token) > BLOCK_MIN_CHARS, after_text(s, token)).otherwise(s)

    tokens = F.regexp_extract_all(_without_hidden(html, ("head", "script", "style")), F.lit(TOKEN), F.lit(0))
    return F.aggregate(tokens, start, step, lambda s: s["blocks"])
