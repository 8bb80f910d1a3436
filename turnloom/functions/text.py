"""Cleaners and small text helpers.

Everything here is a built-in expression on one row. Character classes are written with ``\\x{...}``
escapes, which Java and RE2 both read, so a pattern means the same in Spark and in the SQL oracle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from turnloom.functions.binding import let

# The code points a Unicode-aware strip() removes.
WS_CLASS = (
    r"\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
WS_CHARS = "".join(
    map(
        chr,
        [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680]
        + [*range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000],
    )
)

# Interface labels that an export leaves on a line of their own.
UI_LINES = (
    "expand to view model thoughts",
    "chevron_right",
    "edit",
    "more_vert",
    "sharecompare_arrowsadd",
    "auto",
    "thoughts",
    "copy",
    "share",
    "good",
    "bad",
    "refresh",
)
ICON_FILES = ("watermark.png", "unnamed.png")
IMAGE_LINE = r"\A!\[[^\n]*\]\([^\n]*\)\z"
TOKEN_COUNTER = r"\p{Nd}+,\p{Nd}+[" + WS_CLASS + r"]+tokens"
THOUGHTS_LABEL = "Expand to view model thoughts"

# Instruction tags, in removal order.
PROMPT_TAGS = ("[/INST]", "[INST]", "<<SYS>>", "<</SYS>>")

# Pictograph block, and the only code points whose Unicode name says EMOJI.
EMOJI_RANGE = r"[\x{1F300}-\x{1F9FF}]+"
NAMED_EMOJI = r"[\x{1F3FB}-\x{1F3FF}\x{1F9B0}-\x{1F9B3}]"

# Sentence ends, sentence buffer length, characters an answer may hold.
SENTENCE_ENDS = "。！？"
SENTENCE_BUFFER = 100
ALLOWED_PUNCTUATION = "。，、；：？！…—·ˉ¨\"々～‖∶＂＇｀｜〃〔〕〈〉《》「」『』．（）-"
TERM_PATTERN = r"([A-Za-z]+)[（(]([^)）]+)[)）]"

# What a contaminated export body looks like.
CONTAMINATION_MARKERS = ("prompts/",)
CONTAMINATION_START = '],["'
CONTAMINATION_END = '",null,['

LEADING_CHUNK_LIMIT = 20_000


def strip(c: Column) -> Column:
    """Trim all Unicode whitespace, not only spaces."""
    return F.btrim(c, F.lit(WS_CHARS))


def lines(c: Column) -> Column:
    return F.split(c, "\n")


def squeeze_whitespace(c: Column) -> Column:
    """Words joined by single spaces."""
    return strip(F.regexp_replace(c, f"[{WS_CLASS}]+", " "))


def drop_ui_lines(c: Column) -> Column:
    """Remove interface labels and icon-only image lines; keep blank lines; strip the whole."""

    def keep(line: Column) -> Column:
        bare = strip(line)
        icon = bare.rlike(IMAGE_LINE) & (
            F.contains(line, F.lit(ICON_FILES[0])) | F.contains(line, F.lit(ICON_FILES[1]))
        )
        return ~(F.lower(bare).isin(*UI_LINES) | icon)

    return strip(F.array_join(F.filter(lines(c), keep), "\n"))


def leading_chunk(c: Column) -> Column:
    """Text before the first heading, cut to its title or account line; NULL if it is not a turn."""
    rows = lines(strip(c))
    title = F.array_position(F.transform(rows, lambda r: F.startswith(strip(r), F.lit("# "))), True)
    account = F.transform(rows, lambda r: F.contains(r, F.lit("@")) & F.contains(r, F.lit(".com")))
    # one past the last account line; 0 when there is none
    after_account = F.size(account) - F.array_position(F.reverse(account), True) + 1
    start = F.when(title > 0, title - 1).when(F.array_contains(account, True), after_account).otherwise(0)
    kept = F.slice(rows, (start + 1).cast("int"), F.size(rows))
    body = F.regexp_replace(drop_ui_lines(F.array_join(kept, "\n")), TOKEN_COUNTER, "")
    return F.when((F.length(body) > 0) & (F.length(body) < LEADING_CHUNK_LIMIT), body)


def _swallowed(c: Column) -> Column:
    """The message inside a contaminated export body: from the first start to the first end after it; NULL if there is none."""

    def cut(rest: Column) -> Column:
        end = F.instr(rest, F.lit(CONTAMINATION_END))
        return F.when(end > 0, F.left(rest, end - 1))

    at = F.instr(c, F.lit(CONTAMINATION_START))
    return let(F.when(at > 0, F.substr(c, at + len(CONTAMINATION_START))), cut)


def is_contaminated(c: Column, markers: Sequence[str] = CONTAMINATION_MARKERS) -> Column:
    hit = F.lit(False)
    for m in markers:
        hit = hit | F.contains(c, F.lit(m))
    return hit & _swallowed(c).isNotNull()


def recover_contaminated(c: Column, markers: Sequence[str] = CONTAMINATION_MARKERS) -> Column:
    """Replace an export body that swallowed its neighbours by the message inside it."""
    return F.when(is_contaminated(c, markers), _swallowed(c)).otherwise(c)


def strip_prompt_tags(c: Column) -> Column:
    for tag in PROMPT_TAGS:
        c = F.replace(c, F.lit(tag), F.lit(""))
    return strip(c)


def remove_emoji_range(c: Column) -> Column:
    return F.regexp_replace(c, EMOJI_RANGE, "")


def has_named_emoji(c: Column) -> Column:
    return c.rlike(NAMED_EMOJI)


def remove_named_emoji(c: Column) -> Column:
    return F.regexp_replace(c, NAMED_EMOJI, "")


def sentences(c: Column, ends: str = SENTENCE_ENDS, buffer: int = SENTENCE_BUFFER) -> Column:
    """Array of sentences: cut after a sentence end or once the buffer is exceeded."""
    pieces = F.lit(f"(?s).{{1,{buffer + 1}}}")
    # cut at sentence ends first; only what is longer than the buffer is cut again
    parts = F.transform(
        F.split(c, f"(?<=[{ends}])"),
        lambda p: F.when(F.length(p) > buffer + 1, F.regexp_extract_all(p, pieces, F.lit(0))).otherwise(F.array(p)),
    )
    parts = F.filter(F.transform(F.flatten(parts), strip), lambda s: F.length(s) > 0)
    closers = [F.lit(e) for e in ends]
    return F.transform(
        parts, lambda s: F.when(F.right(s, F.lit(1)).isin(*closers), s).otherwise(F.concat(s, closers[0]))
    )


def segment_sentences(c: Column, ends: str = SENTENCE_ENDS, buffer: int = SENTENCE_BUFFER) -> Column:
    """One sentence a line; NULL (reject) when nothing is left."""
    return let(F.array_join(sentences(c, ends, buffer), "\n"), lambda out: F.when(F.length(out) > 0, out))


def format_terms(c: Column) -> Column:
    """``term(desc)`` in any bracket style to full-width brackets."""
    opened = lambda t: F.contains(t, F.lit("(")) | F.contains(t, F.lit("（"))
    return let(c, lambda t: F.when(opened(t), F.regexp_replace(t, TERM_PATTERN, "$1（$2）")).otherwise(t))


def keep_allowed(c: Column, script: str) -> Column:
    """Only ASCII letters and digits, spaces, newlines, the listed punctuation and the script."""
    # common characters are ruled out by the lookahead, four times as fast in Java as one large negated class
    return F.regexp_replace(c, f"(?![A-Za-z0-9 \\n{script}])[^{ALLOWED_PUNCTUATION}]", "")


def keep_script_lines(c: Column, script: str) -> Column:
    """Only the lines that hold at least one character of the script."""
    return F.array_join(F.filter(lines(c), lambda r: F.rlike(r, F.lit(f"[{script}]"))), "\n")


def truncate(c: Column, n: int) -> Column:
    """First ``n`` characters, with an ellipsis only when something was cut."""
    return F.when(F.length(c) > n, F.concat(F.left(c, F.lit(n)), F.lit("..."))).otherwise(c)


def clip(c: Column, n: int) -> Column:
    """First ``n`` characters, always with an ellipsis."""
    return F.concat(F.left(c, F.lit(n)), F.lit("..."))


def paragraphs(c: Column) -> Column:
    """Non-blank lines, stripped."""
    return F.filter(F.transform(lines(c), strip), lambda p: F.length(p) > 0)
