"""Registered queries: name -> callable(spark, folder) -> DataFrame, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnloom.functions import markup, prompts, script, similarity
from turnloom.functions import text as T
from turnloom.operators import (
    dedup,
    evaluate,
    extract,
    jsonwalk,
    pair,
    profile,
    quality,
    retrieve,
    runlog,
    segment,
    split,
)
from turnloom.plans import fixtures as X
from turnloom.plans import flows
from turnloom.sources import readers, sinks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SEED = "7"
FLUSH_SIZE = 8
EPOCH_ROWS = 1_000
SCHEDULE_EPOCHS = 2.5
RECENT_TURNS = 5


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return readers.read_table(spark, folder, name)


def docs(spark: SparkSession, folder: str) -> DataFrame:
    return readers.spread(table(spark, folder, "documents"))


def pages(spark: SparkSession, folder: str) -> DataFrame:
    return readers.spread(table(spark, folder, "pages"))


def turns(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "conversations")


def pairs(spark: SparkSession, folder: str) -> DataFrame:
    df = turns(spark, folder)
    return pair.pair_adjacent(df)


def rows(spark: SparkSession, folder: str) -> DataFrame:
    return X.instruction_rows(pairs(spark, folder))


# ---- sources


@query
def src_json_turns(spark, folder):
    return readers.explode_turns(X.turn_arrays(docs(spark, folder)), ["doc_id"], "json")


@query
def src_json_list(spark, folder):
    """Documents as messages of large JSON files, spread over lines, and read back in byte ranges."""
    path = sinks.scratch(spark)
    said = F.struct(F.col("doc_id").cast("string").alias("role"), F.col("text").alias("content"))
    docs(spark, folder).select(F.to_json(said, {"pretty": "true"})).write.text(path)
    read = readers.read_turn_list(spark, path, depth=0)
    return read.select(
        F.col("role").cast("bigint").alias("doc_id"), F.length("text").alias("n_chars"), F.md5("text").alias("digest")
    )


@query
def src_instructions(spark, folder):
    # even conversations come as plain rows, odd ones wrapped in a "data" list
    own = F.struct("instruction", "input", "output")
    wrapped = F.col("conv_id") % 2 == 1
    raw = rows(spark, folder).select(
        *[F.when(~wrapped, F.col(c)).alias(c) for c in ("instruction", "input", "output")],
        F.when(wrapped, F.array(own)).alias("data"),
    )
    return readers.unwrap_instructions(raw)


@query
def src_pages(spark, folder):
    df = pages(spark, folder)
    return df.select("page_id", "url", F.length("html").alias("n_chars"), F.md5("html").alias("digest"))


@query
def src_route_json_text(spark, folder):
    return extract.route_json_text(X.mixed_files(docs(spark, folder)), ["doc_id"], "raw")


@query
def quarantine_unparsed(spark, folder):
    routed = extract.routed_turns(X.mixed_files(docs(spark, folder)), "raw")
    # a URL found where a conversation should be is reported as the URL
    shown = F.coalesce(F.when(F.startswith(F.col("_found.raw"), F.lit("http")), F.col("_found.raw")), F.col("raw"))
    source = F.concat(F.lit("doc/"), F.col("doc_id").cast("string"))
    return extract.quarantine(routed, ["doc_id"], shown, source)


# ---- segmenters


@query
def seg_transcript(spark, folder):
    return segment.segment_transcript(X.prefixed(docs(spark, folder), X.TRANSCRIPT_PREFIXES), ["doc_id"])


@query
def seg_page_roles(spark, folder):
    return segment.segment_page_roles(X.prefixed(docs(spark, folder), X.PAGE_PREFIXES), ["doc_id"])


@query
def seg_page_roles_strict(spark, folder):
    return segment.segment_page_roles(X.prefixed(docs(spark, folder), X.PAGE_PREFIXES), ["doc_id"], strict=True)


@query
def seg_ui_dump(spark, folder):
    return segment.segment_ui_dump(X.prefixed(docs(spark, folder), X.DUMP_PREFIXES), ["doc_id"])


@query
def seg_headings(spark, folder):
    return segment.segment_headings(X.suffixed(docs(spark, folder), X.HEADING_SUFFIXES), ["doc_id"])


@query
def seg_headings_legacy(spark, folder):
    return segment.segment_headings(X.suffixed(docs(spark, folder), X.HEADING_SUFFIXES), ["doc_id"], legacy=True)


@query
def seg_alternating(spark, folder):
    lists = docs(spark, folder).select("doc_id", X.lines_of().alias("messages"))
    return segment.segment_alternating(lists, ["doc_id"])


@query
def role_normalize(spark, folder):
    return X.ragged(turns(spark, folder)).select(
        "conv_id", "turn", F.col("role").alias("raw_role"), pair.normalize_role(F.col("role")).alias("role")
    )


# ---- extractors


@query
def json_find_conversation(spark, folder):
    return extract.json_find_conversation(X.json_trees(docs(spark, folder)), ["doc_id"])


@query
def json_find_url(spark, folder):
    return X.url_trees(docs(spark, folder)).select("doc_id", jsonwalk.find_url(F.col("json")).alias("url"))


@query
def extract_next_data(spark, folder):
    return extract.extract_next_data(X.state_pages(docs(spark, folder)), ["doc_id"])


@query
def extract_precedence(spark, folder):
    return extract.extract_precedence(X.state_pages(docs(spark, folder)), ["doc_id"])


@query
def extract_heading_pages(spark, folder):
    return extract.extract_heading_pages(X.chat_pages(pages(spark, folder)), ["page_id"])


@query
def extract_export_array(spark, folder):
    return extract.extract_export_array(X.exports(docs(spark, folder)), ["doc_id"])


@query
def page_visible_text(spark, folder):
    return pages(spark, folder).select("page_id", markup.visible_text(F.col("html")).alias("text"))


@query
def page_title(spark, folder):
    return pages(spark, folder).select("page_id", markup.title(F.col("html")).alias("title"))


@query
def page_markdown(spark, folder):
    return pages(spark, folder).select("page_id", markup.markdown(F.col("html")).alias("markdown"))


@query
def page_text_blocks(spark, folder):
    blocks = F.posexplode(markup.text_blocks(F.col("html"))).alias("pos", "b")
    return pages(spark, folder).select("page_id", blocks).select("page_id", F.col("pos").cast("bigint"), "b.*")


# ---- cleaners


@query
def clean_ui_lines(spark, folder):
    df = X.suffixed(docs(spark, folder), X.UI_SUFFIXES)
    return df.select("doc_id", T.drop_ui_lines(F.col("text")).alias("text"))


@query
def clean_leading_chunk(spark, folder):
    df = X.with_lead(docs(spark, folder))
    return df.select("doc_id", T.leading_chunk(F.col("text")).alias("text"))


@query
def clean_contaminated(spark, folder):
    df = X.contaminated(turns(spark, folder))
    return df.withColumn("text", T.recover_contaminated(F.col("text")))


@query
def clean_contaminated_stats(spark, folder):
    df = X.contaminated(turns(spark, folder))
    after = T.recover_contaminated(F.col("text"))
    return df.agg(F.count("*").alias("rows"), F.count_if(after != F.col("text")).alias("changed"))


@query
def clean_prompt_tags(spark, folder):
    tagged = F.concat(F.lit("[INST] <<SYS>>\n"), F.col("text"), F.lit("[IN[INST]ST]\n<</SYS>> [/INST]"))
    return docs(spark, folder).select("doc_id", T.strip_prompt_tags(tagged).alias("text"))


@query
def clean_emoji_range(spark, folder):
    dotted = F.replace(F.col("text"), F.lit("a"), F.lit("🌍a😀"))
    return docs(spark, folder).select("doc_id", T.remove_emoji_range(dotted).alias("text"))


@query
def has_emoji(spark, folder):
    toned = F.concat(F.col("text"), F.when(F.col("doc_id") % 3 == 0, "👍🏽").when(F.col("doc_id") % 3 == 1, "😀").otherwise(""))
    return docs(spark, folder).select(
        "doc_id", T.has_named_emoji(toned).alias("found"), F.length(T.remove_named_emoji(toned)).alias("n_chars")
    )


@query
def sentence_segment(spark, folder):
    return X.han_docs(docs(spark, folder)).select("doc_id", T.segment_sentences(F.col("text")).alias("text"))


@query
def clean_term_format(spark, folder):
    termed = F.replace(F.replace(F.col("text"), F.lit(", "), F.lit("(说明）")), F.lit(". "), F.lit("（x)"))
    return docs(spark, folder).select("doc_id", T.format_terms(termed).alias("text"))


@query
def clean_allowlist(spark, folder):
    return X.han_docs(docs(spark, folder)).select("doc_id", T.keep_allowed(F.col("text"), script.HAN).alias("text"))


@query
def clean_script_lines(spark, folder):
    kept = T.keep_script_lines(F.col("text"), script.ACCENTED_LATIN)
    return docs(spark, folder).select("doc_id", kept.alias("text"))


@query
def text_truncate(spark, folder):
    return docs(spark, folder).select(
        "doc_id",
        T.truncate(F.col("text"), 1000).alias("text"),
        T.truncate(F.col("text"), 300).alias("short_text"),
        T.clip(F.col("text"), 500).alias("clipped"),
    )


@query
def text_paragraphs(spark, folder):
    parts = F.posexplode(T.paragraphs(F.col("text"))).alias("pos", "paragraph")
    return docs(spark, folder).select("doc_id", parts).withColumn("pos", F.col("pos").cast("bigint"))


# ---- deduplication


@query
def dedup_turns(spark, folder):
    return dedup.dedup_turns(X.with_copies(turns(spark, folder)))


@query
def dedup_turns_in_conversation(spark, folder):
    df = X.with_copies(X.ragged(turns(spark, folder))).withColumn("text", F.col("role"))
    return dedup.dedup_turns(df, scope="conversation")


@query
def dedup_documents(spark, folder):
    return dedup.dedup_rows(table(spark, folder, "documents").select("doc_id", "text", "lang"), "text", ["doc_id"])


@query
def dedup_then_pair(spark, folder):
    copied = X.with_copies(X.ragged(turns(spark, folder)))
    return pair.pair_adjacent(_named(dedup.dedup_turns(copied)), sample=copied, renumber=True)


# ---- pairing: as delivered, and with ragged roles, where the rules differ


def _named(df):
    return df.withColumn("role", pair.normalize_role(F.col("role")))


@query
def pair_adjacent(spark, folder):
    return pairs(spark, folder)


@query
def pair_adjacent_ragged(spark, folder):
    df = turns(spark, folder)
    return pair.pair_adjacent(_named(X.ragged(df)))


@query
def pair_adjacent_blocks(spark, folder):
    """Blocks of four turns, so that most conversations have several."""
    return pair.pair_adjacent(_named(X.ragged(turns(spark, folder))), span=4)


@query
def pair_history(spark, folder):
    df = turns(spark, folder)
    return _history_text(pair.pair_history(df))


@query
def pair_history_ragged(spark, folder):
    df = turns(spark, folder)
    return _history_text(pair.pair_history(X.ragged(df)))


@query
def pair_history_long(spark, folder):
    """Conversations of hundreds of turns keep their whole history."""
    return _history_text(pair.pair_history(X.joined(turns(spark, folder))))


@query
def pair_history_recent(spark, folder):
    return _history_text(pair.pair_history(X.joined(turns(spark, folder)), max_turns=RECENT_TURNS))


def _history_text(df):
    said = F.transform("history", lambda h: F.concat(h["role"], F.lit("="), h["content"]))
    return df.withColumn("history", F.array_join(said, "\n--\n"))


@query
def pair_carry_forward(spark, folder):
    df = turns(spark, folder)
    return pair.pair_carry_forward(X.ragged(df))


@query
def pair_outer(spark, folder):
    df = turns(spark, folder)
    source = F.concat(F.lit("conv/"), F.col("conv_id").cast("string"))
    return pair.pair_outer(_named(X.ragged(df)), source)


@query
def pair_stats(spark, folder):
    df = turns(spark, folder)
    return pair.pair_stats(_named(X.ragged(df)))


# ---- prompts


I, N, O = (lambda: F.col("instruction")), (lambda: F.col("input")), (lambda: F.col("output"))


def _prompt(spark, folder, **columns):
    return rows(spark, folder).select("conv_id", "turn", *[c.alias(n) for n, c in columns.items()])


@query
def prompt_header_system(spark, folder):
    return _prompt(spark, folder, prompt=prompts.header_system(I(), N(), O()))


@query
def prompt_header_plain(spark, folder):
    return _prompt(spark, folder, prompt=prompts.header_plain(I(), N(), O()))


@query
def prompt_header_open(spark, folder):
    opened = prompts.header_open(I(), N())
    return _prompt(spark, folder, prompt=opened, training_text=prompts.training_text(opened, O()))


@query
def prompt_inst(spark, folder):
    inst = prompts.inst(I(), N())
    return _prompt(spark, folder, prompt=inst, training_text=prompts.training_text(inst, O()))


@query
def prompt_inst_sys(spark, folder):
    none = F.lit("")
    return _prompt(
        spark,
        folder,
        prompt=prompts.inst_sys(I(), T.truncate(O(), 300), N()),
        expert_prompt=prompts.inst_sys(I(), none, none, prompts.EXPERT_SYSTEM, prompts.EXPERT_LEAD),
    )


@query
def prompt_inst_context(spark, folder):
    return _prompt(
        spark, folder, prompt=prompts.inst_context(I(), N()), without_context=prompts.inst_context(I(), system=prompts.PLAIN_SYSTEM)
    )


@query
def prompt_sections(spark, folder):
    return _prompt(spark, folder, prompt=prompts.sections(I(), N(), O()))


@query
def prompt_messages(spark, folder):
    made = prompts.messages(I(), N(), O())
    return _messages(rows(spark, folder).select("conv_id", "turn", made.alias("messages")))


def _messages(df):
    return df.select("conv_id", "turn", F.posexplode("messages").alias("pos", "m")).select(
        "conv_id", "turn", F.col("pos").cast("bigint").alias("pos"), "m.role", "m.content"
    )


@query
def prompt_history_messages(spark, folder):
    past = F.array(F.struct(I().alias("user"), O().alias("bot")), F.struct(N().alias("user"), I().alias("bot")))
    made = prompts.history_messages(past, F.concat(I(), F.lit("?")))
    return _messages(rows(spark, folder).select("conv_id", "turn", made.alias("messages")))


# ---- predicates and answer filters


@query
def is_mostly_script(spark, folder):
    df = docs(spark, folder)
    han = X.in_han(F.col("text"), X.LATIN_HALF, X.HAN_HALF)
    return df.select(
        "doc_id",
        script.is_mostly_script(F.col("text")).alias("raw"),
        script.is_mostly_script(han).alias("han"),
        script.is_mostly_script(F.col("text"), script.ACCENTED_LATIN).alias("accented"),
    )


@query
def is_mostly_script_mixed(spark, folder):
    """Latin runs of many lengths between Han characters."""
    mixed = F.replace("text", F.lit(" "), F.lit(X.HAN_GAP))
    return turns(spark, folder).select(
        "conv_id",
        "turn",
        script.is_mostly_script(mixed).alias("one_by_one"),
        script.is_mostly_script(mixed, legacy=False).alias("letters"),
    )


@query
def script_ratio_gate(spark, folder):
    df = docs(spark, folder)
    half = X.in_han(F.col("text"), X.LATIN_HALF, X.HAN_HALF)
    return df.select(
        "doc_id",
        F.round(script.script_share(half), 6).alias("share"),
        script.passes_gate(half).alias("passes"),
        script.passes_gate(F.col("text")).alias("raw_passes"),
    )


@query
def filter_response_full(spark, folder):
    cand = X.candidates(docs(spark, folder))
    cand = cand.withColumn("answer", script.filter_answer(F.col("text")))
    return cand.select("prompt_id", "attempt", "answer", F.col("answer").isNull().alias("regenerate"))


def _verdicts(spark, folder):
    cand = X.candidates(docs(spark, folder)).withColumn("verdict", script.verdict(F.col("text")))
    return cand.withColumn("reply", script.verdict_reply(F.col("text"), F.col("verdict")))


@query
def response_verdict(spark, folder):
    return _verdicts(spark, folder).select("prompt_id", "attempt", "verdict", "reply")


@query
def response_verdict_counts(spark, folder):
    return _verdicts(spark, folder).groupBy("verdict").agg(F.count("*").alias("rows"))


@query
def best_of_n(spark, folder):
    asked = table(spark, folder, "documents").select(F.col("doc_id").alias("prompt_id"))
    return quality.best_of_n(asked, X.candidates(docs(spark, folder)))


# ---- scoring


def _eval(spark, folder):
    made = pairs(spark, folder)
    return X.expected(made), X.generated(made)


@query
def eval_compare(spark, folder):
    return evaluate.eval_compare(*_eval(spark, folder), ["conv_id", "turn"])


@query
def score_char_match(spark, folder):
    df = evaluate.eval_compare(*_eval(spark, folder), ["conv_id", "turn"])
    matched = similarity.char_match(F.col("generated"), F.col("expected"))
    return df.select("conv_id", "turn", matched.cast("bigint").alias("matched"))


def _losses(spark, folder):
    return evaluate.with_loss(evaluate.eval_compare(*_eval(spark, folder), ["conv_id", "turn"]))


@query
def score_lcs(spark, folder):
    return _losses(spark, folder).select("conv_id", "turn", F.col("lcs").cast("bigint").alias("lcs"))


@query
def score_text_loss(spark, folder):
    return _losses(spark, folder).select("conv_id", "turn", F.round("loss", 6).alias("loss"))


@query
def score_echo_loss(spark, folder):
    df = evaluate.eval_compare(*_eval(spark, folder), ["conv_id", "turn"])
    loss = similarity.echo_loss(F.col("generated"), F.concat(F.col("prompt"), F.lit(" "), F.col("expected")))
    return df.select("conv_id", "turn", F.round(loss, 6).alias("loss"))


@query
def eval_mean_loss(spark, folder):
    whole = evaluate.eval_mean_loss(*_eval(spark, folder), ["conv_id", "turn"])
    return whole.withColumn("mean_loss", F.round("mean_loss", 6))


@query
def eval_mean_loss_first(spark, folder):
    """The periodic check: the first ten rows."""
    some = evaluate.eval_mean_loss(*_eval(spark, folder), ["conv_id", "turn"], first=10)
    return some.withColumn("mean_loss", F.round("mean_loss", 6))


# ---- retrieval


def _kb(spark, folder):
    return X.questions(table(spark, folder, "benchmark")), X.knowledge(docs(spark, folder))


@query
def kb_search(spark, folder):
    return retrieve.kb_search(*_kb(spark, folder))


@query
def kb_context(spark, folder):
    return retrieve.kb_context(*_kb(spark, folder))


@query
def kb_context_clipped(spark, folder):
    return retrieve.kb_context(*_kb(spark, folder), k=3, chars=500, always_ellipsis=True)


@query
def kb_prompt(spark, folder):
    return retrieve.kb_prompt(*_kb(spark, folder))


# ---- splits, augmentation, schedules


@query
def split_exact(spark, folder):
    return split.split_exact(pairs(spark, folder).select("conv_id", "turn"), ["conv_id", "turn"], seed=SEED)


@query
def split_hash(spark, folder):
    df = split.split_hash(turns(spark, folder).select("conv_id", "turn"), ["conv_id", "turn"], seed=SEED)
    held = split.split_hash(df.drop("part"), ["conv_id", "turn"], 1 - split.VALIDATION_SHARE, SEED)
    return df.join(held.withColumnRenamed("part", "part_95"), ["conv_id", "turn"])


@query
def augment_punct(spark, folder):
    return split.augment_punctuation(docs(spark, folder).select("doc_id", "text"), ["doc_id"], seed=SEED)


@query
def augment_persona(spark, folder):
    df = docs(spark, folder).select(
        "doc_id", F.when(F.col("doc_id") % 5 == 0, F.concat(F.lit("宝贝"), "text")).otherwise(F.col("text")).alias("text")
    )
    return split.augment_persona(df, ["doc_id"], seed=SEED)


@query
def epoch_schedule(spark, folder):
    return split.epoch_schedule(
        pairs(spark, folder), ["conv_id", "turn"], epochs=SCHEDULE_EPOCHS, sample=turns(spark, folder)
    )


# ---- statistics


@query
def conv_stats(spark, folder):
    return profile.conv_stats(turns(spark, folder))


@query
def corpus_totals(spark, folder):
    return profile.corpus_totals(turns(spark, folder))


@query
def longest_preview(spark, folder):
    return profile.longest_preview(turns(spark, folder))


@query
def json_profile(spark, folder):
    return jsonwalk.json_profile(readers.spread(table(spark, folder, "events")), "props")


@query
def json_profile_trees(spark, folder):
    return jsonwalk.json_profile(X.json_trees(docs(spark, folder)), "json")


@query
def head_preview(spark, folder):
    return profile.head_preview(table(spark, folder, "documents"), ["doc_id"])


@query
def token_budget(spark, folder):
    return profile.token_budget(table(spark, folder, "documents"), "text")


# ---- run logs


def _log(spark, folder):
    return X.run_log(table(spark, folder, "events"))


@query
def runlog_windows(spark, folder):
    df = runlog.accumulation_windows(_log(spark, folder), FLUSH_SIZE)
    return df.withColumn("accumulated", F.round("accumulated", 9))


@query
def runlog_epoch(spark, folder):
    df = runlog.epoch_means(_log(spark, folder), EPOCH_ROWS, FLUSH_SIZE)
    return df.withColumns({c: F.round(c, 6) for c in ("mean_loss", "printed_loss")})


@query
def runlog_best(spark, folder):
    return runlog.best_so_far(_log(spark, folder))


@query
def runlog_lr_audit(spark, folder):
    return runlog.lr_audit(_log(spark, folder))


@query
def runlog_lr_audit_ratio(spark, folder):
    log = _log(spark, folder)
    total = EPOCH_ROWS * 200
    return runlog.lr_audit(
        log, total, int(total * runlog.WARMUP_RATIO), runlog.RATIO_PEAK_LR, runlog.RATIO_MIN_LR
    )


# ---- composed jobs


@query
def flow_turns_to_prompts(spark, folder):
    df = turns(spark, folder)
    return flows.turns_to_prompts(df)


@query
def flow_exports_to_pairs(spark, folder):
    return flows.exports_to_pairs(X.exports(docs(spark, folder)), "doc_id")


@query
def flow_pages_to_pairs(spark, folder):
    return flows.pages_to_pairs(X.state_pages(docs(spark, folder)), "doc_id")


@query
def flow_pages_to_stats(spark, folder):
    return flows.pages_to_stats(X.suffixed(docs(spark, folder), X.HEADING_SUFFIXES), ["doc_id"], "text")


@query
def flow_files_to_history_pairs(spark, folder):
    df = flows.files_to_history_pairs(X.mixed_files(docs(spark, folder)), "doc_id", "raw")
    return df.select("conv_id", "turn", "input", "output", "history_len", F.length("instruction").alias("n_chars"))
