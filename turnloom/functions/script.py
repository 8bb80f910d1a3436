"""Script (writing-system) predicates and answer filters."""

from __future__ import annotations

import bisect
import re
from collections.abc import Callable

import ahocorasick
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType

from turnloom.functions import text as T
from turnloom.functions.binding import let

# The basic Han block, and every block of characters named CJK UNIFIED IDEOGRAPH.
HAN = r"\x{4E00}-\x{9FFF}"
HAN_ALL = (
    HAN + r"\x{3400}-\x{4DBF}\x{20000}-\x{2A6DF}\x{2A700}-\x{2B739}\x{2B740}-\x{2B81D}\x{2B820}-\x{2CEA1}"
    r"\x{2CEB0}-\x{2EBE0}\x{2EBF0}-\x{2EE5D}\x{30000}-\x{3134A}\x{31350}-\x{323AF}"
)
ACCENTED_LATIN = r"\x{C0}-\x{24F}"

# whitespace and punctuation, in runs: what is neither letter, number, mark, symbol nor a control other than whitespace
# (three times as fast in Java as listing the whitespace)
CONTENT = r"[\p{L}\p{N}\p{M}\p{S}[\p{C}&&[^\x09-\x0d\x1c-\x1f\x85]]]"
NON_CONTENT = f"[^{CONTENT[1:]}+"

# Thresholds and replies of the answer filters.
MOSTLY_SHARE = 0.5
GATE_SHARE = 0.4
VERDICT_SHARE = 0.5
VERDICT_MIN_CHARS = 20
VERDICT_MIN_SENTENCES = 2
VERDICT_REPLIES = {
    "script": "抱歉，我将用中文重新组织答案。",
    "short": "抱歉，让我重新思考并给出更完整的回答。",
    "sentences": "抱歉，让我重新组织语言，给出更详细的解释。",
}


def content_chars(c: Column) -> Column:
    """Text without whitespace and punctuation."""
    return F.regexp_replace(c, NON_CONTENT, "")


def script_chars(c: Column, script: str = HAN) -> Column:
    """How many characters belong to the script."""
    return F.length(F.regexp_replace(c, f"[^{script}]+", ""))


WORK = 200  # characters passed over for one of a text before its runs are put into an automaton


def _latin_runs_out() -> Callable[[str], str]:
    """What ``without_latin_runs`` does to one text. The helper is nested so that it travels to executors by value."""

    def left(text: str) -> str:
        runs = re.findall("[A-Za-z]+", text)
        if not runs:
            return text
        kinds = list(dict.fromkeys(runs))
        rests = one_by_one(runs, kinds, WORK * len(text)) or by_automaton(runs, kinds)
        return "".join([re.sub("[A-Za-z]+", "", text), *[rests[run] for run in runs if rests[run]]])

    def one_by_one(runs: list[str], kinds: list[str], work: int) -> dict[str, str] | None:
        """Mostly short runs come up early and leave little to look through; None where they do not."""
        whole, absent = "\n".join(kinds), {}
        for run in runs:
            if len(whole) < len(kinds):
                break
            if absent.get(run) == len(whole):
                continue
            if work < 0:
                return None
            work -= len(whole)
            rest = whole.replace(run, "")
            if len(rest) == len(whole):
                absent[run] = len(whole)
            whole = rest
        return dict(zip(kinds, whole.split("\n"), strict=True))

    def by_automaton(runs: list[str], kinds: list[str]) -> dict[str, str]:
        automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i, kind in enumerate(kinds):
            automaton.add_word(kind, i)
        automaton.make_automaton()
        # a run that is repeated is taken out again at each of its places, which matters where letters have come together
        turns = [[] for _ in kinds]
        for at, run in enumerate(runs):
            turns[automaton.get(run)].append(at)
        after = lambda i, at: turns[i][bisect.bisect_right(turns[i], at)] if turns[i][-1] > at else len(runs)
        rests = {}
        for kind in kinds:
            rest, at = kind, -1
            while rest:
                at = min((after(i, at) for _, i in automaton.iter(rest)), default=len(runs))
                if at == len(runs):
                    break
                rest = rest.replace(runs[at], "")
            rests[kind] = rest
        return rests

    return left


def without_latin_runs(c: Column) -> Column:
    """The characters left (other ones first) when Latin runs are taken out one after another, each wherever it then stands in the
    text: the letters of a short run also go from the longer runs after it.

    Runs never grow together, so equal runs always look alike and each different run is worked on once. They are looked through for one run
    after another, and where that would take long an automaton of a text's runs finds in one pass over a run which of them it holds; the
    earliest is taken out, and what is left is passed over again for later ones. So the cost is the length of the text times how
    many runs go from one run, and not times all runs. Python with Arrow, because a built-in expression has no map to look runs up in.
    """
    left = _latin_runs_out()

    @F.pandas_udf(StringType())
    def taken_out(texts: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else left(t) for t in texts], dtype=object)

    return taken_out(c)


def _mostly(bare: Column, script: str) -> Column:
    """Whether the script holds over half of what ``without_latin_runs`` leaves. Runs are taken out only where the letters that stay
    decide, which they do not when the script outweighs all letters, or not even the other characters."""
    left = _latin_runs_out()
    others = re.sub(r"\\x\{([0-9A-Fa-f]+)\}", lambda m: re.escape(chr(int(m[1], 16))), f"[^{script}]+")
    of_letters = re.sub(others, "", "".join(chr(i) for i in range(128) if chr(i).isalpha())) != ""

    def mostly(text: str) -> bool:
        rest = re.sub("[A-Za-z]+", "", text)
        n = len(re.sub(others, "", rest))
        if not of_letters and rest and (n > MOSTLY_SHARE * len(text) or n <= MOSTLY_SHARE * len(rest)):
            return n > MOSTLY_SHARE * len(text)
        rest = left(text)
        return not rest or len(re.sub(others, "", rest)) > MOSTLY_SHARE * len(rest)

    @F.pandas_udf(BooleanType())
    def decided(texts: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else mostly(t) for t in texts], dtype=object)

    return decided(bare)


def is_mostly_script(c: Column, script: str = HAN_ALL, legacy: bool = True) -> Column:
    """Share of script characters over one half, Latin terms not counted; empty text passes.

    ``legacy=False`` takes out exactly the Latin letters, whatever other runs the text has.
    """
    bare = content_chars(c)
    if legacy:
        return _mostly(bare, script)
    return let(
        F.regexp_replace(bare, "[A-Za-z]+", ""),
        lambda rest: (F.length(rest) == 0) | (script_chars(rest, script) > MOSTLY_SHARE * F.length(rest)),
    )


def script_share(c: Column, script: str = HAN) -> Column:
    """Script share of the content characters; NULL when there are none."""
    return let(
        content_chars(c), lambda body: F.when(F.length(body) > 0, script_chars(body, script) / F.length(body))
    )


def passes_gate(c: Column, script: str = HAN, share: float = GATE_SHARE) -> Column:
    """Empty text fails; text of punctuation alone passes; otherwise the share decides."""
    return (F.length(c) > 0) & F.coalesce(script_share(c, script) >= share, F.lit(True))


def _share_reached(c: Column, script: str) -> Column:
    """Whether the script share reaches the gate, or there is no content; content is counted only where all characters, or none of the
    script, do not decide."""
    return let(
        script_chars(c, script),
        lambda n: F.when(n >= GATE_SHARE * F.length(c), True)
        .when(n == 0, ~F.rlike(c, F.lit(CONTENT)))
        .otherwise(F.coalesce(n / F.length(content_chars(c)) >= GATE_SHARE, F.lit(True))),
    )


def filter_answer(c: Column, script: str = HAN) -> Column:
    """Full answer filter: the cleaned answer, or NULL when it must be generated again."""

    def shaped(bare: Column) -> Column:
        return F.when(_share_reached(bare, script), T.keep_allowed(T.format_terms(T.segment_sentences(bare)), script))

    return F.when(F.length(c) > 0, let(T.remove_named_emoji(T.strip_prompt_tags(c)), shaped))


def verdict(c: Column, script: str = HAN) -> Column:
    """First failing check of an answer (``script``, ``short``, ``sentences``) or ``ok``."""

    def checked(bare: Column) -> Column:
        full = F.filter(F.split(bare, "。"), lambda s: F.length(T.strip(s)) > 0)
        return (
            F.when(script_chars(bare, script) < F.length(bare) * VERDICT_SHARE, "script")
            .when(F.length(bare) < VERDICT_MIN_CHARS, "short")
            .when(F.size(full) < VERDICT_MIN_SENTENCES, "sentences")
            .otherwise("ok")
        )

    return let(T.strip_prompt_tags(c), checked)


def verdict_reply(c: Column, code: Column, script: str = HAN) -> Column:
    """What the user is shown: an apology for a failed check, else the lines in the script."""
    reply = T.keep_script_lines(T.strip_prompt_tags(c), script)
    for failed, apology in VERDICT_REPLIES.items():
        reply = F.when(code == failed, apology).otherwise(reply)
    return reply
