"""SQL (DuckDB) restatements of the registered queries.

Written independently of the Spark plans where the operators are sequential: the Spark side cuts texts inside a row,
the SQL side unnests lines and numbers segments by window; the Spark side folds, the SQL side uses ``lag``.
"""

from __future__ import annotations

from turnloom.functions import markup, prompts, script, similarity
from turnloom.functions import text as T
from turnloom.operators import pair, profile, quality, retrieve, runlog, segment, split
from turnloom.plans import fixtures as X
from turnloom.plans.catalog import EPOCH_ROWS, FLUSH_SIZE, RECENT_TURNS, SCHEDULE_EPOCHS, SEED

ORACLES: dict[str, str] = {}


def q(s: str) -> str:
    """A SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def qlist(values) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]"


NL = "chr(10)"
WS = q(T.WS_CHARS)


def strip(e: str) -> str:
    return f"trim({e}, {WS})"


def lines(e: str = "text") -> str:
    return f"string_split({e}, {NL})"


def cycle(values, i: str = "i") -> str:
    """The value for line number ``i`` (from 1)."""
    return f"{qlist(values)}[(({i} - 1) % {len(values)} + 1)::INT]"


def joined(e: str) -> str:
    return f"array_to_string({e}, {NL})"


def sub(e: str, pattern: str, to: str = "") -> str:
    return f"regexp_replace({e}, {q(pattern)}, {q(to)}, 'g')"


# ---------------------------------------------------------------- derived inputs

PREFIXED = lambda prefixes: (
    f"SELECT doc_id, {joined(f'list_transform({lines()}, lambda l, i: {cycle(prefixes)} || l)')} AS text FROM documents"
)
SUFFIXED = lambda suffixes: (
    f"SELECT doc_id, {joined(f'list_transform({lines()}, lambda l, i: l || {cycle(suffixes)})')} AS text FROM documents"
)
# one row a line: doc_id, i (from 0), l
DOC_LINES = f"SELECT doc_id, unnest({lines()}) AS l, generate_subscripts({lines()}, 1) - 1 AS i FROM documents"

RAGGED = """SELECT conv_id, turn, CASE length(text) % 5 WHEN 0 THEN 'Human' WHEN 1 THEN 'assistant' WHEN 2 THEN 'model'
    WHEN 3 THEN 'user' ELSE role END AS role, text FROM conversations"""


def named(turns: str) -> str:
    users = ", ".join(q(a) for a in pair.USER_ALIASES)
    assistants = ", ".join(q(a) for a in pair.ASSISTANT_ALIASES)
    return (
        f"SELECT conv_id, turn, CASE WHEN lower(role) IN ({users}) THEN 'user' WHEN lower(role) IN ({assistants}) "
        f"THEN 'assistant' ELSE role END AS role, text FROM ({turns})"
    )


def adjacent(turns: str) -> str:
    return f"""SELECT conv_id, turn, text AS instruction, '' AS input, next_text AS output FROM (
        SELECT *, lead(role) OVER w AS next_role, lead(text) OVER w AS next_text FROM ({turns})
        WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
    WHERE role = 'user' AND next_role = 'assistant'"""


PAIRS = adjacent("SELECT * FROM conversations")
ROWS = f"""SELECT conv_id, turn, instruction, output,
    CASE WHEN turn % 4 = 0 THEN 'ref ' || conv_id ELSE '' END AS input FROM ({PAIRS})"""


def in_han(e: str = "text", latin: str = X.LATIN_FULL, han: str = X.HAN_FULL) -> str:
    return f"translate(lower({e}), {q(latin)}, {q(han)})"


HAN_DOCS = f"SELECT doc_id, {in_han()} AS text FROM documents"
HALF = in_han("text", X.LATIN_HALF, X.HAN_HALF)

# ---------------------------------------------------------------- sources

ITEM = f"{cycle(X.ITEM_ROLES, 'i + 1')}"

ORACLES["src_json_turns"] = f"SELECT doc_id, i AS turn, {ITEM} AS role, l AS text FROM ({DOC_LINES})"
ORACLES["src_instructions"] = f"SELECT instruction, input, output FROM ({ROWS})"
ORACLES["src_json_list"] = "SELECT doc_id, length(text) AS n_chars, md5(text) AS digest FROM documents"
ORACLES["src_pages"] = "SELECT page_id, url, length(html) AS n_chars, md5(html) AS digest FROM pages"

# shape 0: messages; 1: transcript; 2: broken JSON around a transcript; 3 and 4: nothing
ORACLES["src_route_json_text"] = f"""
SELECT doc_id, 'json' AS route, i AS turn, {ITEM} AS role, l AS text FROM ({DOC_LINES}) WHERE doc_id % 5 = 0
UNION ALL
SELECT doc_id, 'text', i, CASE WHEN i % 2 = 0 THEN 'user' ELSE 'assistant' END, {strip('l')}
FROM ({DOC_LINES}) WHERE doc_id % 5 = 1
UNION ALL
SELECT doc_id, 'text', 0, 'user', 'broken' FROM documents WHERE doc_id % 5 = 2
UNION ALL
SELECT doc_id, 'text', i + 1, CASE WHEN i % 2 = 0 THEN 'user' ELSE 'assistant' END, {strip('l')}
FROM ({DOC_LINES}) WHERE doc_id % 5 = 2"""

ORACLES["quarantine_unparsed"] = """
SELECT doc_id, '{"body":{"t":' || to_json(text)::VARCHAR || '}}' AS raw_dump, 'doc/' || doc_id AS source,
    'Failed to parse dialogue structure' AS note FROM documents WHERE doc_id % 5 = 3
UNION ALL
SELECT doc_id, 'http://x.example/' || doc_id, 'doc/' || doc_id, 'URL instead of content'
FROM documents WHERE doc_id % 5 = 4"""

# ---------------------------------------------------------------- segmenters


def sessions(source: str, role: str, body: str, keep_blank: bool) -> str:
    """Lines to segments: ``role`` and ``body`` are expressions over a line ``l`` and the stripped line ``s``."""
    line = "l" if keep_blank else "s"
    return f"""
    WITH ls AS (
        SELECT doc_id, l, {strip('l')} AS s, i FROM (
            SELECT doc_id, unnest({lines()}) AS l, generate_subscripts({lines()}, 1) AS i FROM ({source}))
    ), marked AS (
        SELECT doc_id, i, {line} AS line, {role} AS role, {body} AS body FROM ls {'' if keep_blank else "WHERE s <> ''"}
    ), numbered AS (
        SELECT *, count(role) OVER (PARTITION BY doc_id ORDER BY i) AS seg FROM marked
    )
    SELECT doc_id, seg - 1 AS turn, first(role ORDER BY i) AS role,
        coalesce(string_agg(CASE WHEN role IS NULL THEN line ELSE {'body' if keep_blank else "nullif(body, '')"} END,
            {NL} ORDER BY i), '') AS text,
        max(seg) OVER (PARTITION BY doc_id) AS last_seg
    FROM numbered WHERE seg > 0 GROUP BY doc_id, seg"""


def transcript(source: str) -> str:
    markers = "|".join(segment.TRANSCRIPT_MARKERS)
    marker = f"regexp_extract(s, {q(f'^({markers})')}, 1)"
    cases = " ".join(f"WHEN {q(m)} THEN {q(r)}" for m, r in segment.TRANSCRIPT_MARKERS.items())
    body = strip(f"substr(s, length({marker}) + 1)")
    return f"SELECT doc_id, turn, role, text FROM ({sessions(source, f'CASE {marker} {cases} END', body, True)})"


def labelled(source: str, user: str, assistant: str) -> str:
    user, assistant = user.replace("(?iu)", "(?i)"), assistant.replace("(?iu)", "(?i)")
    role = f"""CASE WHEN regexp_matches(s, {q(user)}) THEN 'user' WHEN regexp_matches(s, {q(assistant)}) THEN 'assistant' END"""
    body = strip(
        f"CASE WHEN regexp_matches(s, {q(user)}) THEN regexp_replace(s, {q(user)}, '') "
        f"ELSE regexp_replace(s, {q(assistant)}, '') END"
    )
    return f"""SELECT doc_id, turn, role, text FROM ({sessions(source, role, body, False)})
    WHERE NOT (turn + 1 = last_seg AND text = '')"""


ORACLES["seg_transcript"] = transcript(PREFIXED(X.TRANSCRIPT_PREFIXES))
ORACLES["seg_page_roles"] = labelled(PREFIXED(X.PAGE_PREFIXES), segment.PAGE_USER, segment.PAGE_ASSISTANT)
ORACLES["seg_page_roles_strict"] = labelled(
    PREFIXED(X.PAGE_PREFIXES), r"(?i)\A(User|Human|You):", r"(?i)\A(ChatGPT|Assistant|AI|Model):"
)
ORACLES["seg_ui_dump"] = labelled(PREFIXED(X.DUMP_PREFIXES), segment.DUMP_USER, segment.DUMP_ASSISTANT)


def ui_clean(e: str) -> str:
    labels = ", ".join(q(u) for u in T.UI_LINES)
    icon = " OR ".join(f"contains(x, {q(f)})" for f in T.ICON_FILES)
    bare = strip("x")
    return strip(
        joined(
            f"list_filter({lines(e)}, lambda x: NOT (lower({bare}) IN ({labels}) "
            f"OR (regexp_matches({bare}, {q(T.IMAGE_LINE)}) AND ({icon}))))"
        )
    )


def lead_clean(source: str) -> str:
    """``doc_id, text``: the leading chunk, by unnested lines."""
    return f"""
    WITH ls AS (
        SELECT doc_id, unnest({lines(strip('text'))}) AS l, generate_subscripts({lines(strip('text'))}, 1) AS i
        FROM ({source})
    ), starts AS (
        SELECT doc_id, min(CASE WHEN starts_with({strip('l')}, '# ') THEN i END) AS title,
            max(CASE WHEN contains(l, '@') AND contains(l, '.com') THEN i + 1 END) AS after_account
        FROM ls GROUP BY doc_id
    ), kept AS (
        SELECT s.doc_id, coalesce(string_agg(l, {NL} ORDER BY i) FILTER (WHERE i >= coalesce(title, after_account, 1)), '') AS text
        FROM ls JOIN starts s ON ls.doc_id = s.doc_id GROUP BY s.doc_id
    ), cleaned AS (SELECT doc_id, {sub(ui_clean('text'), T.TOKEN_COUNTER)} AS text FROM kept)
    SELECT doc_id, CASE WHEN length(text) > 0 AND length(text) < {T.LEADING_CHUNK_LIMIT} THEN text END AS text FROM cleaned"""


def headings(source: str, model: str) -> str:
    pattern = q(segment.HEADING.replace("(?iu)", "(?i)"))
    body = f"{NL} || replace(text, chr(13) || {NL}, {NL})"
    return f"""
    WITH src AS ({source}), cut AS (
        SELECT doc_id, regexp_split_to_array({body}, {pattern}) AS parts,
            regexp_extract_all({body}, {pattern}, 1) AS labels FROM src
    ), lead_in AS ({lead_clean("SELECT doc_id, parts[1] AS text FROM cut")}),
    under AS (
        SELECT doc_id, k, CASE WHEN {model} THEN 'assistant' ELSE 'user' END AS role, {ui_clean('t')} AS text
        FROM (SELECT doc_id, unnest(labels) AS label, unnest(parts[2:]) AS t, generate_subscripts(labels, 1) AS k FROM cut)
    ), every AS (
        SELECT doc_id, 0 AS k, 'user' AS role, text FROM lead_in WHERE text IS NOT NULL
        UNION ALL SELECT * FROM under WHERE text <> ''
    )
    SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY k) - 1 AS turn, role, text FROM every"""


ORACLES["seg_headings"] = headings(SUFFIXED(X.HEADING_SUFFIXES), "lower(label) = 'model'")
ORACLES["seg_headings_legacy"] = headings(SUFFIXED(X.HEADING_SUFFIXES), "label = 'Model'")
ORACLES["seg_alternating"] = f"""
SELECT doc_id, i AS turn, CASE WHEN i % 2 = 0 THEN 'user' ELSE 'assistant' END AS role, l AS text FROM ({DOC_LINES})"""
ORACLES["role_normalize"] = f"""
SELECT r.conv_id, r.turn, r.role AS raw_role, n.role FROM ({RAGGED}) r
JOIN ({named(RAGGED)}) n ON r.conv_id = n.conv_id AND r.turn = n.turn"""

# ---------------------------------------------------------------- extractors

ORACLES["json_find_conversation"] = f"""
WITH ls AS ({DOC_LINES})
SELECT doc_id, i AS turn, {ITEM} AS role, l AS text FROM ls WHERE doc_id % 9 IN (0, 1, 5, 6)
UNION ALL
SELECT doc_id, i, CASE WHEN i % 2 = 0 THEN 'user' ELSE 'assistant' END, CASE WHEN doc_id % 9 = 4 THEN {strip('l')} ELSE l END
FROM ls WHERE doc_id % 9 IN (2, 4, 8)"""
ORACLES["json_find_url"] = f"""
SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'https://e.example/' || doc_id WHEN 1 THEN 'https://src.example/' || doc_id
    WHEN 2 THEN 'http://l.example/' || doc_id WHEN 4 THEN 'https://top.example/' || doc_id
    WHEN 3 THEN CASE WHEN starts_with({strip('text')}, 'http://') OR starts_with({strip('text')}, 'https://') THEN {strip('text')} END
    END AS url FROM documents"""

STATE_TURNS = f"""
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS turn,
    CASE WHEN doc_id % 4 = 1 THEN 'unknown' WHEN i % 2 = 0 THEN 'user' ELSE 'assistant' END AS role, l AS text
FROM ({DOC_LINES}) WHERE doc_id % 4 IN (0, 1) AND l <> ''"""
SHOWN = f"""SELECT doc_id, string_agg(CASE WHEN i % 2 = 0 THEN 'User: ' ELSE 'AI: ' END || l, {NL} ORDER BY i) AS text
    FROM ({DOC_LINES}) WHERE doc_id % 4 IN (2, 3) GROUP BY doc_id"""
# the title stands above the first label and is dropped with everything else before it
SHOWN_TURNS = labelled(SHOWN, segment.PAGE_USER, segment.PAGE_ASSISTANT)
ORACLES["extract_next_data"] = STATE_TURNS
PRECEDENCE = f"""SELECT doc_id, 'state' AS method, turn, role, text FROM ({STATE_TURNS})
UNION ALL SELECT doc_id, 'labels', turn, role, text FROM ({SHOWN_TURNS})"""
ORACLES["extract_precedence"] = PRECEDENCE

# turn numbers count the non-empty messages of an export
EXPORT_TURNS = f"""
WITH shown AS (
    SELECT doc_id, i, l || CASE WHEN i % 3 = 1 THEN {q(' ' + T.THOUGHTS_LABEL)} ELSE '' END AS body,
        to_json(l)::VARCHAR AS quoted FROM ({DOC_LINES})
), read AS (
    SELECT doc_id, i, CASE WHEN i % 2 = 0 THEN 'user' ELSE 'assistant' END AS role,
        {strip(f"replace(CASE WHEN i = 0 THEN 'prompts/p1" + '",null,[["' + f"' || substr(quoted, 2, length(quoted) - 2) ELSE body END, {q(T.THOUGHTS_LABEL)}, '')")} AS text
    FROM shown
), numbered AS (
    SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS turn, role, text FROM read WHERE text <> ''
)
SELECT doc_id, turn, role, text FROM numbered
QUALIFY row_number() OVER (PARTITION BY doc_id, text ORDER BY turn) = 1"""
ORACLES["extract_export_array"] = EXPORT_TURNS


# the references that the pages have, the ampersand last so that nothing is decoded twice
REFERENCES = "< lt > gt \" quot ' apos \u00a0 nbsp © copy ® reg · middot … hellip – ndash — mdash ‘ lsquo ’ rsquo “ ldquo ” rdquo & amp"
REFERENCES = list(zip(REFERENCES.split(" ")[1::2], REFERENCES.split(" ")[::2], strict=True))


def re2(pattern: str) -> str:
    """Java's possessive quantifiers as plain ones, which take as long in a linear matcher."""
    return pattern.replace("*+", "*")


def decoded(e: str) -> str:
    for ref, char in REFERENCES:
        e = f"replace({e}, '&{ref};', {q(char)})"
    return e


def unhidden(e: str, tags) -> str:
    return sub(e, re2(markup.hidden_pattern(tags)), "\n")


VISIBLE = joined(
    f"list_filter(list_transform({lines(decoded(sub(unhidden('html', markup.HIDDEN_TAGS), re2(markup.ANY_TAG), chr(10))))}, "
    f"lambda x: {strip('x')}), lambda x: x <> '')"
)
ORACLES["page_visible_text"] = f"SELECT page_id, {VISIBLE} AS text FROM pages"
ORACLES["page_title"] = f"""
SELECT page_id, CASE WHEN regexp_matches(html, {q(markup.TITLE)})
    THEN nullif({decoded(f"regexp_extract(html, {q(markup.TITLE)}, 1)")}, '') ELSE {q(markup.UNKNOWN_TITLE)} END AS title
FROM pages"""


def markdown(e: str) -> str:
    e = unhidden(e, ("head", "script", "style"))
    for pattern, alt, src in markup.IMAGE_RULES:
        e = sub(e, pattern, "![" + "".join(rf"\{n}" for n in alt) + "](" + "".join(rf"\{n}" for n in src) + ")")
    rest = f"CASE WHEN regexp_matches(p, {q(markup.LINK_REST)}) THEN {sub('p', markup.LINK_REST, '[' + chr(92) + '4](' + chr(92) + '1' + chr(92) + '2' + chr(92) + '3)')} ELSE '<a' || p END"
    pieces = f"string_split_regex({e}, {q(markup.LINK_OPEN)})"
    e = f"({pieces}[1] || array_to_string(list_transform({pieces}[2:], lambda p: {rest}), ''))"
    for pattern, to in markup.MARKDOWN_RULES:
        e = sub(e, re2(pattern), to)
    return strip(sub(decoded(sub(e, re2(markup.ANY_TAG))), r"\n{3,}", "\n\n"))


ORACLES["page_markdown"] = f"SELECT page_id, {markdown('html')} AS markdown FROM pages"

CHAT_PAGES = """SELECT page_id, replace(replace(html, '</h1>', '</h1><p><b>Model</b></p>'), '<br>', '<p>User</p>') AS html
    FROM pages"""
ORACLES["extract_heading_pages"] = f"""
SELECT doc_id AS page_id, t.title, turn, role, text
FROM ({headings(f"SELECT page_id AS doc_id, {markdown('html')} AS text FROM ({CHAT_PAGES})", "lower(label) = 'model'")})
JOIN ({ORACLES['page_title']}) t ON t.page_id = doc_id"""

SHOWN_HTML = unhidden("html", ("head", "script", "style"))
TAG = f"lower(regexp_extract(token, {q(markup.TAG_NAME)}, 1))"
DEPTH_OF = f"list_position(list_reverse(list_transform(open, lambda e: split_part(e, '|', 1))), {TAG})"
# one token of every page a step, with the open elements as tag|class
BLOCK_NODES = f"""
    tokens AS (SELECT page_id, regexp_extract_all(h, {q(re2(markup.TOKEN))}) AS token FROM (SELECT page_id, {SHOWN_HTML} AS h FROM SHOWN)),
    steps(page_id, i, open, body, tag, css_class) AS (
        SELECT page_id, 0, []::VARCHAR[], NULL::VARCHAR, NULL::VARCHAR, NULL::VARCHAR FROM tokens
        UNION ALL
        SELECT page_id, i + 1, CASE
            WHEN NOT regexp_matches(token, '^<[!/A-Za-z]') THEN open
            WHEN token[1:2] = '</' THEN CASE WHEN {DEPTH_OF} > 0 THEN open[1:len(open) - {DEPTH_OF}] ELSE open END
            WHEN {TAG} IN ('', {', '.join(q(t) for t in markup.VOID_TAGS)}) OR token[-2:] = '/>' THEN open
            ELSE list_append(open, {TAG} || '|' || {' || '.join(f"regexp_extract(token, {q(markup.CLASS_ATTR)}, {i})" for i in (1, 2, 3))}) END,
            CASE WHEN NOT regexp_matches(token, '^<[!/A-Za-z]') AND len(open) > 0 THEN token END,
            split_part(open[-1], '|', 1), nullif(split_part(open[-1], '|', 2), '')
        FROM (SELECT s.page_id, s.i, s.open, t.token[s.i + 1] AS token FROM steps s JOIN tokens t ON t.page_id = s.page_id
            WHERE s.i < len(t.token))
    ), long AS (
        SELECT page_id, tag, css_class, b, row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS pos
        FROM (SELECT *, {strip(decoded('body'))} AS b FROM steps) WHERE length(b) > {markup.BLOCK_MIN_CHARS}
    )
SELECT page_id, pos, tag, css_class, length(b) AS n_chars, left(b, {markup.BLOCK_PREVIEW}) AS preview
FROM long WHERE pos < {markup.BLOCKS_PER_PAGE}"""
ORACLES["page_text_blocks"] = f"WITH RECURSIVE shown AS (SELECT page_id, html FROM pages), {BLOCK_NODES.replace('FROM SHOWN', 'FROM shown')}"

# ---------------------------------------------------------------- cleaners

ORACLES["clean_ui_lines"] = f"SELECT doc_id, {ui_clean('text')} AS text FROM ({SUFFIXED(X.UI_SUFFIXES)})"
WITH_LEAD = f"""SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN text WHEN 1 THEN concat('nav', {NL}, 'me@mail.com', {NL}, text)
    WHEN 2 THEN concat('a@b.com', {NL}, 'x', {NL}, '  # Title', {NL}, '1,234 tokens', {NL}, text)
    ELSE concat(text, {NL}, 'last@x.com') END AS text FROM documents"""
ORACLES["clean_leading_chunk"] = lead_clean(WITH_LEAD)

CONTAMINATED = """SELECT conv_id, turn, role, text AS plain, CASE turn % 3 WHEN 0 THEN 'prompts/x],["' || text || '",null,[1,2]'
    WHEN 1 THEN 'prompts/' || text ELSE text END AS text FROM conversations"""
ORACLES["clean_contaminated"] = f"""
SELECT conv_id, turn, role, CASE WHEN turn % 3 = 0 THEN plain ELSE text END AS text FROM ({CONTAMINATED})"""
ORACLES["clean_contaminated_stats"] = f"""
SELECT count(*) AS rows, count(*) FILTER (WHERE turn % 3 = 0) AS changed FROM ({CONTAMINATED})"""


def untagged(e: str) -> str:
    for tag in T.PROMPT_TAGS:
        e = f"replace({e}, {q(tag)}, '')"
    return strip(e)


TAGGED = "'[INST] <<SYS>>' || chr(10) || text || '[IN[INST]ST]' || chr(10) || '<</SYS>> [/INST]'"
ORACLES["clean_prompt_tags"] = f"SELECT doc_id, {untagged(TAGGED)} AS text FROM documents"
ORACLES["clean_emoji_range"] = "SELECT doc_id, text FROM documents"
TONED = "text || CASE doc_id % 3 WHEN 0 THEN '👍🏽' WHEN 1 THEN '😀' ELSE '' END"
ORACLES["has_emoji"] = f"""
SELECT doc_id, regexp_matches({TONED}, {q(T.NAMED_EMOJI)}) AS found, length({sub(TONED, T.NAMED_EMOJI)}) AS n_chars
FROM documents"""


def segmented(e: str) -> str:
    ends, n = T.SENTENCE_ENDS, T.SENTENCE_BUFFER
    pattern = f"(?s)[^{ends}]{{0,{n}}}[{ends}]|[^{ends}]{{{n + 1}}}|[^{ends}]+$"
    closed = f"CASE WHEN right(x, 1) IN ('。', '！', '？') THEN x ELSE x || '。' END"
    parts = f"list_filter(list_transform(regexp_extract_all({e}, {q(pattern)}), lambda x: {strip('x')}), lambda x: x <> '')"
    return f"nullif({joined(f'list_transform({parts}, lambda x: {closed})')}, '')"


ORACLES["sentence_segment"] = f"SELECT doc_id, {segmented('text')} AS text FROM ({HAN_DOCS})"
TERMED = "replace(replace(text, ', ', '(说明）'), '. ', '（x)')"


def terms(e: str) -> str:
    return sub(e, T.TERM_PATTERN, r"\1（\2）")


def allowed(e: str) -> str:
    return sub(e, f"[^{script.HAN}A-Za-z0-9 \\n{T.ALLOWED_PUNCTUATION}]")


ORACLES["clean_term_format"] = f"SELECT doc_id, {terms(TERMED)} AS text FROM documents"
ORACLES["clean_allowlist"] = f"SELECT doc_id, {allowed('text')} AS text FROM ({HAN_DOCS})"


def script_lines(e: str, cls: str) -> str:
    return joined(f"list_filter({lines(e)}, lambda x: regexp_matches(x, {q(f'[{cls}]')}))")


ORACLES["clean_script_lines"] = f"SELECT doc_id, {script_lines('text', script.ACCENTED_LATIN)} AS text FROM documents"


def truncated(e: str, n: int) -> str:
    return f"CASE WHEN length({e}) > {n} THEN left({e}, {n}) || '...' ELSE {e} END"


ORACLES["text_truncate"] = f"""
SELECT doc_id, {truncated('text', 1000)} AS text, {truncated('text', 300)} AS short_text, left(text, 500) || '...' AS clipped
FROM documents"""
ORACLES["text_paragraphs"] = f"""
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS pos, {strip('l')} AS paragraph
FROM ({DOC_LINES}) WHERE {strip('l')} <> ''"""

# ---------------------------------------------------------------- deduplication

COPIES = lambda turns: (
    f"SELECT * FROM ({turns}) UNION ALL SELECT conv_id + 1000000, turn, role, text FROM ({turns})"
)


def first_copies(turns: str, key: str = "text", order: str = "conv_id, turn") -> str:
    return f"SELECT * FROM ({turns}) WHERE text <> '' QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {order}) = 1"


ALL_TURNS = "SELECT conv_id, turn, role, text FROM conversations"
ORACLES["dedup_turns"] = first_copies(COPIES(ALL_TURNS))
ORACLES["dedup_turns_in_conversation"] = first_copies(
    f"SELECT conv_id, turn, role, role AS text FROM ({COPIES(RAGGED)})", "conv_id, text", "turn"
)
ORACLES["dedup_documents"] = first_copies("SELECT doc_id, text, lang FROM documents", "text", "doc_id")
KEPT = first_copies(COPIES(RAGGED))
RENUMBERED = (
    f"SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS turn, role, text FROM ({KEPT})"
)
ORACLES["dedup_then_pair"] = adjacent(named(RENUMBERED))

# ---------------------------------------------------------------- pairing

ORACLES["pair_adjacent"] = PAIRS
ORACLES["pair_adjacent_ragged"] = adjacent(named(RAGGED))
ORACLES["pair_adjacent_blocks"] = ORACLES["pair_adjacent_ragged"]


def with_history(turns: str, latest: int | None = None) -> str:
    """``history`` is the joined text of all (or the ``latest``) surviving turns before the pair."""
    recent = "" if latest is None else f" AND h.rank >= p.history_len - {latest}"
    return f"""
    WITH kept AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS rank
        FROM ({named(turns)}) WHERE role IN ('user', 'assistant')
    ), pairs AS (
        SELECT a.conv_id, a.turn, u.text AS input, a.text AS output, u.rank AS history_len
        FROM kept a JOIN kept u ON a.conv_id = u.conv_id AND a.rank = u.rank + 1
        WHERE a.role = 'assistant' AND u.role = 'user'
    )
    SELECT p.conv_id, p.turn, p.input, p.output, p.history_len,
        {q(pair.CONTINUE_INSTRUCTION)} || CASE WHEN p.history_len > 0 THEN {q(pair.CONTEXT_INTRO)}
            || string_agg(h.role || ': ' || h.text || {NL}, '' ORDER BY h.rank) ELSE '' END AS instruction,
        coalesce(string_agg(h.role || '=' || h.text, {NL} || '--' || {NL} ORDER BY h.rank), '') AS history
    FROM pairs p LEFT JOIN kept h ON h.conv_id = p.conv_id AND h.rank < p.history_len{recent}
    GROUP BY p.conv_id, p.turn, p.input, p.output, p.history_len"""


ORACLES["pair_history"] = with_history(ALL_TURNS)
ORACLES["pair_history_ragged"] = with_history(RAGGED)
JOINED = f"""SELECT conv_id // {X.JOINED} AS conv_id, conv_id % {X.JOINED} * 1000 + turn AS turn, role, text FROM conversations"""
ORACLES["pair_history_long"] = with_history(JOINED)
ORACLES["pair_history_recent"] = with_history(JOINED, RECENT_TURNS)


def carried(turns: str) -> str:
    return f"""
    SELECT conv_id, turn, {q(pair.ANSWER_INSTRUCTION)} AS instruction, asked AS input, text AS output FROM (
        SELECT *, last_value(CASE WHEN lower(role) IN ('user', 'human') THEN text END IGNORE NULLS) OVER (
            PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS asked FROM ({turns}))
    WHERE lower(role) IN ('assistant', 'ai', 'model') AND asked IS NOT NULL"""


ORACLES["pair_carry_forward"] = carried(RAGGED)
ORACLES["pair_outer"] = f"""
SELECT conv_id, turn, {q(pair.ANSWER_INSTRUCTION)} AS instruction,
    CASE WHEN before_role = 'user' THEN before_text ELSE '' END AS input, text AS output, 'conv/' || conv_id AS source
FROM (SELECT *, lag(role) OVER w AS before_role, lag(text) OVER w AS before_text FROM ({named(RAGGED)})
    WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
WHERE role = 'assistant'"""
ORACLES["pair_stats"] = f"""
SELECT count(*) AS messages, count(*) FILTER (WHERE opens)::BIGINT AS pairs,
    count(*) FILTER (WHERE after IS NOT NULL AND NOT opens AND NOT closes)::BIGINT AS skipped
FROM (SELECT lead(role) OVER w AS after, coalesce(role = 'user' AND lead(role) OVER w = 'assistant', false) AS opens,
        coalesce(role = 'assistant' AND lag(role) OVER w = 'user', false) AS closes
    FROM ({named(RAGGED)}) WINDOW w AS (PARTITION BY conv_id ORDER BY turn))"""

# ---------------------------------------------------------------- prompts

USER = "instruction || CASE WHEN input <> '' THEN chr(10) || input ELSE '' END"


def block(role: str, body: str) -> str:
    return f"'<|start_header_id|>{role}<|end_header_id|>' || chr(10) || chr(10) || {body} || '<|eot_id|>'"


def prompt_sql(**columns: str) -> str:
    return f"SELECT conv_id, turn, {', '.join(f'{e} AS {n}' for n, e in columns.items())} FROM ({ROWS})"


SYSTEM_BLOCK = block("system", q(prompts.DEFAULT_SYSTEM))
OPENED = f"{SYSTEM_BLOCK} || {block('user', USER)} || '<|start_header_id|>assistant<|end_header_id|>' || chr(10) || chr(10)"
INST = f"'[INST] ' || {USER} || ' [/INST]'"
ORACLES["prompt_header_system"] = prompt_sql(
    prompt=f"{SYSTEM_BLOCK} || {block('user', USER)} || {block('assistant', 'output')}"
)
ORACLES["prompt_header_plain"] = prompt_sql(prompt=f"{block('user', USER)} || {block('assistant', 'output')} || chr(10)")
ORACLES["prompt_header_open"] = prompt_sql(prompt=OPENED, training_text=f"{OPENED} || ' ' || output")
ORACLES["prompt_inst"] = prompt_sql(prompt=INST, training_text=f"{INST} || ' ' || output")
ORACLES["prompt_inst_sys"] = prompt_sql(
    prompt=f"""'[INST] <<SYS>>' || chr(10) || {q(prompts.QA_SYSTEM)} || chr(10) || '<</SYS>>' || chr(10) || chr(10)
    || CASE WHEN output <> '' THEN {q(prompts.CONTEXT_INTRO_REFERENCE)} || {truncated('output', 300)} || chr(10) || chr(10) ELSE '' END
    || instruction || CASE WHEN input <> '' THEN {q(prompts.EXTRA_INTRO)} || input ELSE '' END || ' [/INST]'""",
    expert_prompt=f"""concat('[INST] <<SYS>>', chr(10), {q(prompts.EXPERT_SYSTEM)}, chr(10), '<</SYS>>', chr(10), chr(10),
    {q(prompts.EXPERT_LEAD)}, instruction, ' [/INST]')""",
)


def inst_context(instruction: str, context: str) -> str:
    return f"""'[INST] ' || {q(prompts.KNOWLEDGE_SYSTEM)} || chr(10) || chr(10) || CASE WHEN {context} <> ''
    THEN {q(prompts.CONTEXT_INTRO_KNOWLEDGE)} || {context} || chr(10) || chr(10) ELSE '' END || {instruction} || ' [/INST]'"""


ORACLES["prompt_inst_context"] = prompt_sql(
    prompt=inst_context("instruction", "input"),
    without_context=f"'[INST] ' || {q(prompts.PLAIN_SYSTEM)} || chr(10) || chr(10) || instruction || ' [/INST]'",
)
S1, S2, S3 = prompts.SECTION_TITLES
ORACLES["prompt_sections"] = prompt_sql(prompt=f"{q(S1)} || instruction || {q(S2)} || input || {q(S3)} || output")


def message_rows(*messages: tuple[str, str]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT conv_id, turn, {i}::BIGINT AS pos, {q(role)} AS role, {content} AS content FROM ({ROWS})"
        for i, (role, content) in enumerate(messages)
    )


ORACLES["prompt_messages"] = message_rows(("system", q(prompts.CHAT_SYSTEM)), ("user", USER), ("assistant", "output"))
ORACLES["prompt_history_messages"] = message_rows(
    ("user", "instruction"), ("assistant", "output"), ("user", "input"), ("assistant", "instruction"), ("user", "instruction || '?'")
)

# ---------------------------------------------------------------- predicates and answer filters


def count_of(e: str, cls: str) -> str:
    return f"length({sub(e, f'[^{cls}]')})"


def content(e: str) -> str:
    return sub(e, f"[{T.WS_CLASS}\\p{{P}}]+")


def mostly(e: str, cls: str, legacy: bool = True) -> str:
    """``legacy``: runs go one by one, each wherever it then stands."""
    bare = content(e)
    one_by_one = f"list_reduce(list_prepend({bare}, regexp_extract_all({bare}, '[A-Za-z]+')), lambda rest, run: replace(rest, run, ''))"
    rest = one_by_one if legacy else sub(bare, "[A-Za-z]+")
    return f"(length({rest}) = 0 OR {count_of(rest, cls)} > {script.MOSTLY_SHARE} * length({rest}))"


def share(e: str, cls: str = script.HAN) -> str:
    return f"({count_of(content(e), cls)}::DOUBLE / nullif(length({content(e)}), 0))"


def gate(e: str) -> str:
    return f"(length({e}) > 0 AND coalesce({share(e)} >= {script.GATE_SHARE}, true))"


GAPPED = f"replace(text, ' ', '{X.HAN_GAP}')"
ORACLES["is_mostly_script"] = f"""
SELECT doc_id, {mostly('text', script.HAN_ALL)} AS raw, {mostly(HALF, script.HAN_ALL)} AS han,
    {mostly('text', script.ACCENTED_LATIN)} AS accented FROM documents"""
ORACLES["is_mostly_script_mixed"] = f"""
SELECT conv_id, turn, {mostly(GAPPED, script.HAN_ALL)} AS one_by_one, {mostly(GAPPED, script.HAN_ALL, False)} AS letters
FROM conversations"""
ORACLES["script_ratio_gate"] = f"""
SELECT doc_id, round({share('half')}, 6) AS share, {gate('half')} AS passes, {gate('text')} AS raw_passes
FROM (SELECT doc_id, text, {HALF} AS half FROM documents)"""

CANDIDATES = f"""SELECT doc_id AS prompt_id, unnest([1, 2, 3]) AS attempt,
    unnest([text, {HALF}, '[INST]' || {in_han()}]) AS text FROM documents"""


def filtered(e: str) -> str:
    """``bare`` is the text without tags and named emoji."""
    return f"""SELECT * EXCLUDE (bare), CASE WHEN length(text) > 0 AND coalesce({share('bare')} >= {script.GATE_SHARE}, true)
        THEN {allowed(terms(segmented('bare')))} END AS answer
    FROM (SELECT *, {sub(untagged('text'), T.NAMED_EMOJI)} AS bare FROM ({e}))"""


ORACLES["filter_response_full"] = f"""
SELECT prompt_id, attempt, answer, answer IS NULL AS regenerate FROM ({filtered(CANDIDATES)})"""

VERDICTS = f"""
SELECT prompt_id, attempt, bare, CASE
    WHEN {count_of('bare', script.HAN)} < length(bare) * {script.VERDICT_SHARE} THEN 'script'
    WHEN length(bare) < {script.VERDICT_MIN_CHARS} THEN 'short'
    WHEN len(list_filter(string_split(bare, '。'), lambda x: {strip('x')} <> '')) < {script.VERDICT_MIN_SENTENCES} THEN 'sentences'
    ELSE 'ok' END AS verdict
FROM (SELECT prompt_id, attempt, {untagged('text')} AS bare FROM ({CANDIDATES}))"""
APOLOGIES = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in script.VERDICT_REPLIES.items())
ORACLES["response_verdict"] = f"""
SELECT prompt_id, attempt, verdict, CASE verdict {APOLOGIES} ELSE {script_lines('bare', script.HAN)} END AS reply FROM ({VERDICTS})"""
ORACLES["response_verdict_counts"] = f"SELECT verdict, count(*) AS rows FROM ({VERDICTS}) GROUP BY verdict"

SAID = f"len(list_filter(regexp_split_to_array(answer, '[。！？]'), lambda x: length({strip('x')}) >= {quality.MIN_SENTENCE_CHARS}))"
ORACLES["best_of_n"] = f"""
WITH measured AS (
    SELECT prompt_id, attempt, answer, {count_of('answer', script.HAN)}::DOUBLE / length({content('answer')}) AS share, {SAID} AS said
    FROM ({filtered(f"SELECT prompt_id, attempt, {strip('text')} AS text FROM ({CANDIDATES})")})
    WHERE answer IS NOT NULL AND length(answer) >= {quality.MIN_ANSWER_CHARS} AND length({content('answer')}) > 0
), scored AS (
    SELECT *, share + {quality.SENTENCE_BONUS} * said AS score FROM measured WHERE said >= 1
), ordered AS (
    SELECT *, score > coalesce(max(score) OVER (PARTITION BY prompt_id ORDER BY attempt
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS improves FROM scored
), ends AS (
    SELECT prompt_id, min(attempt) AS stop FROM ordered
    WHERE improves AND share > {quality.EARLY_SHARE} AND said >= {quality.EARLY_SENTENCES} GROUP BY prompt_id
), chosen AS (
    SELECT o.* FROM ordered o LEFT JOIN ends e ON o.prompt_id = e.prompt_id
    WHERE improves AND attempt <= coalesce(stop, attempt)
    QUALIFY row_number() OVER (PARTITION BY o.prompt_id ORDER BY attempt DESC) = 1
)
SELECT doc_id AS prompt_id, attempt, round(score, 6) AS score, coalesce(answer, {q(quality.FALLBACK_ANSWER)}) AS answer
FROM documents LEFT JOIN chosen ON prompt_id = doc_id"""

# ---------------------------------------------------------------- scoring

GENERATED = f"""SELECT conv_id, turn, CASE WHEN conv_id % 2 = 1
    THEN regexp_replace(answer, '(.{{6}}).', '\\1{X.FOREIGN}', 'gs') ELSE answer END AS generated
FROM (SELECT *, CASE length(output) % 4 WHEN 0 THEN substr(output, 2)
    WHEN 1 THEN left(output, length(output) // 2) WHEN 2 THEN output END AS answer FROM ({PAIRS}))"""
COMPARED = f"""SELECT p.conv_id, p.turn, p.instruction AS prompt, p.output AS expected, g.generated
    FROM ({PAIRS}) p JOIN ({GENERATED}) g ON p.conv_id = g.conv_id AND p.turn = g.turn WHERE g.generated IS NOT NULL"""
ORACLES["eval_compare"] = COMPARED


def matches(a: str, b: str) -> str:
    return f"len(list_filter(list_zip(string_split({a}, ''), string_split({b}, ''), true), lambda x: x[1] = x[2]))"


ORACLES["score_char_match"] = f"SELECT conv_id, turn, {matches('generated', 'expected')} AS matched FROM ({COMPARED})"

# A generated answer without its foreign characters is a subsequence of the expected one by construction (a suffix, a
# prefix or the whole with characters taken out) and the expected one has none of them, so that remainder is the longest
# common subsequence. The general case is tested against brute force.
LCS = f"length(replace(generated, '{X.FOREIGN}', ''))"
LOSSES = f"""
SELECT conv_id, turn, CASE WHEN generated = '' THEN 1.0 ELSE greatest(least(1 - (
    {similarity.MATCH_WEIGHT}::DOUBLE * {matches('generated', 'expected')} + {similarity.LCS_WEIGHT}::DOUBLE * {LCS}
    - {similarity.LENGTH_WEIGHT}::DOUBLE * (length(expected) - length(generated))) / length(expected), 1.0), 0.0) END AS loss
FROM ({COMPARED})"""
ORACLES["score_lcs"] = f"SELECT conv_id, turn, {LCS} AS lcs FROM ({COMPARED})"
ORACLES["score_text_loss"] = f"SELECT conv_id, turn, round(loss, 6) AS loss FROM ({LOSSES})"
ORACLES["score_echo_loss"] = f"""
SELECT conv_id, turn, round(CASE WHEN generated = '' THEN 1.0 ELSE 1.0 - {matches("(prompt || ' ' || expected)", 'generated')}::DOUBLE
    / length(prompt || ' ' || expected) END, 6) AS loss FROM ({COMPARED})"""


def mean_loss(expected: str) -> str:
    return f"""SELECT count(*) AS rows, count(loss) AS answered, round(avg(coalesce(loss, 1.0)), 6) AS mean_loss
    FROM ({expected}) p LEFT JOIN ({LOSSES}) l ON p.conv_id = l.conv_id AND p.turn = l.turn"""


ORACLES["eval_mean_loss"] = mean_loss(PAIRS)
ORACLES["eval_mean_loss_first"] = mean_loss(f"SELECT * FROM ({PAIRS}) ORDER BY conv_id, turn LIMIT 10")

# ---------------------------------------------------------------- retrieval

WORDS = lambda e: f"regexp_extract_all(lower({e}), {q(retrieve.WORD)})"
KNOWLEDGE = "SELECT doc_id, left(text, 40) AS title, text AS content FROM documents"


def search(k: int) -> str:
    return f"""
    WITH docs AS ({KNOWLEDGE}), words AS (
        SELECT doc_id, word, count(*) AS tf FROM (
            SELECT doc_id, unnest({WORDS("title || chr(10) || content")}) AS word FROM docs) GROUP BY doc_id, word
    ), frequency AS (SELECT word, count(*) AS df FROM words GROUP BY word),
    asked AS (SELECT DISTINCT item_id AS question_id, unnest({WORDS('text')}) AS word FROM benchmark),
    weighed AS (
        SELECT question_id, a.word, ln(1 + (SELECT count(*) FROM docs)::DOUBLE / df) AS weight
        FROM asked a JOIN frequency f ON a.word = f.word WHERE 2 * df < (SELECT count(*) FROM docs)
    ), scored AS (
        SELECT question_id, doc_id, round(sum((1 + ln(tf)) * weight), 6) AS score
        FROM words w JOIN weighed k ON w.word = k.word GROUP BY question_id, doc_id
    )
    SELECT question_id, row_number() OVER (PARTITION BY question_id ORDER BY score DESC, doc_id) AS rank, doc_id, score
    FROM scored QUALIFY rank <= {k}"""


def context_sql(k: int, cut: str) -> str:
    return f"""
    SELECT item_id AS question_id, any_value(b.text) AS question, coalesce(string_agg({q(prompts.DOCUMENT_LABEL)} || title || {NL}
        || {cut}, {NL} || {NL} ORDER BY rank), '') AS context
    FROM benchmark b LEFT JOIN ({search(k)}) h ON item_id = question_id LEFT JOIN ({KNOWLEDGE}) d ON d.doc_id = h.doc_id
    GROUP BY item_id"""


ORACLES["kb_search"] = search(3)
ORACLES["kb_context"] = context_sql(2, truncated("content", 300))
ORACLES["kb_context_clipped"] = context_sql(3, "left(content, 500) || '...'")
ORACLES["kb_prompt"] = f"""
SELECT question_id, {inst_context(strip(sub('question', T.EMOJI_RANGE)), 'context')} AS prompt
FROM ({context_sql(2, truncated('content', 300))})"""

# ---------------------------------------------------------------- splits, augmentation, schedules


def digest(purpose: str, *keys: str) -> str:
    return f"md5(concat_ws('|', {q(SEED)}, {q(purpose)}, {', '.join(keys)}))"


def drawn(purpose: str, *keys: str) -> str:
    return f"('0x' || left({digest(purpose, *keys)}, {split.DRAW_BITS // 4}))::BIGINT"


def chance(purpose: str, part: float, *keys: str) -> str:
    return f"({drawn(purpose, *keys)} < {int(part * 2**split.DRAW_BITS)})"


CT = ("conv_id", "turn")
ORACLES["split_exact"] = f"""
SELECT conv_id, turn, CASE WHEN row_number() OVER (ORDER BY {digest('split', *CT)}, conv_id, turn)
    <= floor(count(*) OVER () * {split.TRAIN_SHARE}::DOUBLE) THEN 'train' ELSE 'val' END AS part FROM ({PAIRS})"""
ORACLES["split_hash"] = f"""
SELECT conv_id, turn, CASE WHEN {chance('split', split.TRAIN_SHARE, *CT)} THEN 'train' ELSE 'val' END AS part,
    CASE WHEN {chance('split', 1 - split.VALIDATION_SHARE, *CT)} THEN 'train' ELSE 'val' END AS part_95 FROM conversations"""
AT = f"({drawn('position', 'doc_id')} % length(t))"
ORACLES["augment_punct"] = f"""
SELECT doc_id, CASE WHEN {chance('punctuation', split.PUNCTUATION_SHARE, 'doc_id')} AND length(t) > 0 THEN left(t, {AT})
    || {qlist(split.PUNCTUATION)}[{drawn('mark', 'doc_id')} % {len(split.PUNCTUATION)} + 1] || substr(t, {AT} + 1) ELSE t END AS text
FROM (SELECT doc_id, CASE WHEN {chance('squeeze', split.SQUEEZE_SHARE, 'doc_id')}
    THEN {strip(sub('text', f'[{T.WS_CLASS}]+', ' '))} ELSE text END AS t FROM documents)"""
ORACLES["augment_persona"] = f"""
SELECT doc_id, CASE WHEN {chance('add name', split.NICKNAME_SHARE, 'doc_id')} AND NOT regexp_matches(t, {q('|'.join(split.NICKNAMES))})
    THEN {qlist(split.NICKNAMES)}[{drawn('name', 'doc_id')} % {len(split.NICKNAMES)} + 1] || '～' || t ELSE t END AS text
FROM (SELECT doc_id, text || CASE WHEN {chance('add emoji', split.EMOJI_SHARE, 'doc_id')}
    THEN ' ' || {qlist(split.EMOJI)}[{drawn('emoji', 'doc_id')} % {len(split.EMOJI)} + 1] ELSE '' END AS t
    FROM (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN '宝贝' || text ELSE text END AS text FROM documents))"""
ORACLES["epoch_schedule"] = f"""
WITH ranked AS (SELECT conv_id, turn, row_number() OVER (ORDER BY conv_id, turn) AS rank, count(*) OVER () AS n FROM ({PAIRS}))
SELECT e * n + rank AS step, e + 1 AS epoch, conv_id, turn
FROM (SELECT *, unnest(range(0, {int(SCHEDULE_EPOCHS) + 1})) AS e FROM ranked) WHERE e * n + rank <= floor({SCHEDULE_EPOCHS} * n)"""

# ---------------------------------------------------------------- statistics


def stats(turns: str, key: str = "conv_id") -> str:
    return f"""SELECT {key} AS conv_id, count(*) AS turns, sum(length(text))::BIGINT AS chars,
    floor(sum(length(text))::BIGINT / {profile.CHARS_PER_TOKEN}::DOUBLE)::BIGINT AS est_tokens FROM ({turns}) GROUP BY {key}"""


ORACLES["conv_stats"] = stats(ALL_TURNS)
ORACLES["corpus_totals"] = """
SELECT coalesce(role, 'all') AS role, count(DISTINCT conv_id) AS conversations, count(*) AS messages,
    sum(length(text))::BIGINT AS chars FROM conversations GROUP BY ROLLUP (role)"""
ORACLES["longest_preview"] = f"""
SELECT conv_id, turn, length(text) AS n_chars, replace(left(text, {profile.PREVIEW_CHARS}), {NL}, ' ') AS preview
FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY length(text) DESC, turn) = 1"""
JSON_TYPES = """CASE json_type({v}) WHEN 'OBJECT' THEN 'dict' WHEN 'ARRAY' THEN 'list' WHEN 'VARCHAR' THEN 'str'
    WHEN 'UBIGINT' THEN 'int' WHEN 'BIGINT' THEN 'int' WHEN 'BOOLEAN' THEN 'bool' WHEN 'NULL' THEN 'NoneType' ELSE 'float' END"""
ORACLES["json_profile"] = f"""
WITH nodes AS (
    SELECT '$' AS path, {JSON_TYPES.format(v='props')} AS type FROM events
    UNION ALL
    SELECT '$.' || k, {JSON_TYPES.format(v="json_extract(props, '$.' || k)")} FROM (SELECT props, unnest(json_keys(props)) AS k FROM events)
)
SELECT path, type, count(*) AS rows, NULL::BIGINT AS min_length, NULL::BIGINT AS max_length FROM nodes GROUP BY path, type"""
ITEMS_JSON = lambda role, body: (
    f"to_json(list_transform({lines()}, lambda l, i: {{'{role}': {cycle(X.ITEM_ROLES)}, '{body}': l}}))::VARCHAR"
)
LINES_JSON = f"to_json({lines()})::VARCHAR"
SCRIPT = joined(f"list_transform({lines()}, lambda l, i: CASE WHEN i % 2 = 1 THEN 'User: ' ELSE 'AI: ' END || l)")
TREES = f"""SELECT doc_id, (CASE doc_id % 9
    WHEN 0 THEN '{{"meta":{{"title":"t"}},"conversations":' || {ITEMS_JSON('role', 'content')} || '}}'
    WHEN 1 THEN '{{"a":{{"b":{{"messages":' || {ITEMS_JSON('from', 'value')} || '}}}},"note":1}}'
    WHEN 2 THEN {LINES_JSON}
    WHEN 3 THEN '{{"data":{{"link":"https://x.example/' || doc_id || '"}}}}'
    WHEN 4 THEN '{{"chat":' || to_json({SCRIPT})::VARCHAR || '}}'
    WHEN 5 THEN '{{"x":{{"messages":[]}},"y":[0,{{"history":' || {ITEMS_JSON('role', 'content')} || '}}]}}'
    WHEN 6 THEN '{{"z":[1,[2,[[],' || {ITEMS_JSON('role', 'content')} || ']]]}}'
    WHEN 7 THEN '{{"k":1,"body":{{"m":[true,null,' || substr({LINES_JSON}, 2) || '}}}}'
    ELSE repeat('{{"d":', 12) || '{{"chat":' || {LINES_JSON} || repeat('}}', 13) END)::JSON AS j FROM documents"""
ORACLES["json_profile_trees"] = f"""
WITH RECURSIVE nodes(path, j) AS (
    SELECT '$', j FROM ({TREES})
    UNION ALL
    SELECT path || step.suffix, step.j FROM nodes, LATERAL (
        SELECT '.' || k AS suffix, json_extract(nodes.j, '$."' || k || '"') AS j
        FROM (SELECT unnest(json_keys(nodes.j)) AS k) WHERE json_type(nodes.j) = 'OBJECT'
        UNION ALL
        SELECT '[0]', json_extract(nodes.j, '$[0]') WHERE json_type(nodes.j) = 'ARRAY' AND json_array_length(nodes.j) > 0
    ) step
), typed AS (
    SELECT path, {JSON_TYPES.format(v='j')} AS type, CASE WHEN json_type(j) = 'ARRAY' THEN json_array_length(j)::BIGINT END AS n FROM nodes
)
SELECT path, type, count(*) AS rows, min(n) AS min_length, max(n) AS max_length FROM typed GROUP BY path, type"""
ORACLES["head_preview"] = f"SELECT doc_id, left(text, {profile.PREVIEW_CHARS}) AS preview FROM documents"
ORACLES["token_budget"] = f"""
SELECT budget, count(*) AS rows, count(*) FILTER (WHERE tokens > budget) AS over, round(over / count(*), 6) AS share
FROM (SELECT floor(length(text) / {profile.CHARS_PER_TOKEN}::DOUBLE) AS tokens, unnest({list(profile.TOKEN_BUDGETS)}) AS budget FROM documents)
GROUP BY budget"""

# ---------------------------------------------------------------- run logs

LOG = """SELECT event_type AS run, event_id + 1 AS step, value / 500 AS loss,
    3e-5::DOUBLE * least((event_id + 1)::DOUBLE / 300, 1.0) AS lr, CASE WHEN (event_id + 1) % 4 = 0 THEN value / 500 / 2 END AS eval_loss
    FROM events"""
WINDOWS = f"""
SELECT run, win AS window, max(step) AS flush_step, count(*) AS rows, sum(loss) / {FLUSH_SIZE} AS accumulated FROM (
    SELECT *, coalesce(sum((step % {FLUSH_SIZE} = 0)::BIGINT) OVER (PARTITION BY run ORDER BY step
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS win FROM ({LOG}))
GROUP BY run, win HAVING max(step) % {FLUSH_SIZE} = 0"""
ORACLES["runlog_windows"] = f'SELECT * REPLACE (round(accumulated, 9) AS accumulated) FROM ({WINDOWS})'
ORACLES["runlog_epoch"] = f"""
SELECT t.run, t.epoch, t.rows, round(mean_loss, 6) AS mean_loss, round(coalesce(printed, 0), 6) AS printed_loss
FROM (SELECT run, (step - 1) // {EPOCH_ROWS} + 1 AS epoch, count(*) AS rows, avg(loss) AS mean_loss FROM ({LOG}) GROUP BY 1, 2) t
LEFT JOIN (SELECT run, (flush_step - 1) // {EPOCH_ROWS} + 1 AS epoch, sum(accumulated) / {EPOCH_ROWS} AS printed FROM ({WINDOWS}) GROUP BY 1, 2) p
ON t.run = p.run AND t.epoch = p.epoch"""
ORACLES["runlog_best"] = f"""
SELECT run, step, eval_loss, best_before, best_before IS NULL OR eval_loss < best_before AS improved FROM (
    SELECT *, min(eval_loss) OVER (PARTITION BY run ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best_before
    FROM ({LOG}) WHERE eval_loss IS NOT NULL)"""


def audit(total: int, warmup: int, peak: float, floor: float) -> str:
    expected = f"""CASE WHEN step < {warmup} THEN {peak}::DOUBLE * step / {warmup} ELSE {floor}::DOUBLE + 0.5::DOUBLE * ({peak}::DOUBLE - {floor}::DOUBLE)
        * (1 + cos(pi() * (step - {warmup}) / ({total} - {warmup}))) END"""
    return f"""SELECT run, step, round(lr, 12) AS lr, round(expected, 12) AS expected_lr, abs(lr - expected) > 1e-9 AS deviates
    FROM (SELECT *, {expected} AS expected FROM ({LOG}))"""


ORACLES["runlog_lr_audit"] = audit(
    runlog.MAX_STEPS, runlog.WARMUP_STEPS, runlog.PEAK_LR, runlog.PEAK_LR * runlog.FLOOR_SHARE
)
ORACLES["runlog_lr_audit_ratio"] = audit(
    EPOCH_ROWS * 200, int(EPOCH_ROWS * 200 * runlog.WARMUP_RATIO), runlog.RATIO_PEAK_LR, runlog.RATIO_MIN_LR
)

# ---------------------------------------------------------------- composed jobs

ORACLES["flow_turns_to_prompts"] = f"""
SELECT conv_id, turn, {SYSTEM_BLOCK} || {block('user', USER)} || {block('assistant', 'output')} AS prompt
FROM ({adjacent(first_copies(named(ALL_TURNS)))})"""
ORACLES["flow_exports_to_pairs"] = adjacent(f"SELECT doc_id AS conv_id, turn, role, text FROM ({EXPORT_TURNS})")
ORACLES["flow_pages_to_pairs"] = carried(f"SELECT doc_id AS conv_id, turn, role, text FROM ({PRECEDENCE})")
ORACLES["flow_pages_to_stats"] = stats(ORACLES["seg_headings"], "doc_id")
ORACLES["flow_files_to_history_pairs"] = f"""
SELECT conv_id, turn, input, output, history_len, length(instruction) AS n_chars
FROM ({with_history(f"SELECT doc_id AS conv_id, turn, role, text FROM ({ORACLES['src_route_json_text']})")})"""
