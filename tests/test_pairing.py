"""Window and fold versions of the sequential rules against short loops, on random turn lists."""

import random
import re

import pytest
from pyspark.sql import functions as F

from turnloom.operators import dedup, ordered, pair, runlog
from turnloom.plans import catalog, flows

ROLES = ["user", "assistant", "system", "Human", "gpt"]


def conversations(seed, n=40, longest=14):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        turn = 0
        for _ in range(rng.randrange(0, longest)):
            turn += rng.choice([1, 1, 1, 2, 7])
            rows.append((conv, turn, rng.choice(ROLES), f"t{rng.randrange(25)}"))
    return rows


def by_conv(rows):
    out = {}
    for r in sorted(rows):
        out.setdefault(r[0], []).append(r)
    return out


@pytest.fixture(scope="module", params=[1, 2])
def rows(request):
    return conversations(request.param)


@pytest.fixture(scope="module")
def turns(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").cache()


PLANS = [{"span": 3}, {"span": 8}, {"span": 1000}]


def got(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


@pytest.mark.parametrize("plan", PLANS)
def test_adjacent(turns, rows, plan):
    want = []
    for conv, seq in by_conv(rows).items():
        i = 0
        while i < len(seq) - 1:
            if seq[i][2] == "user" and seq[i + 1][2] == "assistant":
                want.append((conv, seq[i][1], seq[i][3], "", seq[i + 1][3]))
                i += 1
            i += 1
    assert got(pair.pair_adjacent(turns, **plan), "conv_id", "turn", "instruction", "input", "output") == sorted(want)


@pytest.mark.parametrize("plan", PLANS)
def test_stats(turns, rows, plan):
    pairs = skipped = 0
    for seq in by_conv(rows).values():
        i = 0
        while i < len(seq) - 1:
            hit = seq[i][2] == "user" and seq[i + 1][2] == "assistant"
            pairs, skipped, i = pairs + hit, skipped + (not hit), i + 1 + hit
    row = pair.pair_stats(turns, **plan).first()
    assert (row.messages, row.pairs, row.skipped) == (len(rows), pairs, skipped)


@pytest.mark.parametrize("plan", PLANS)
def test_carry_forward(turns, rows, plan):
    want = []
    for conv, seq in by_conv(rows).items():
        asked = None
        for _, turn, role, text in seq:
            if role.lower() in ("user", "human"):
                asked = text
            elif role.lower() in ("assistant", "ai", "model") and asked is not None:
                want.append((conv, turn, asked, text))
    assert got(pair.pair_carry_forward(turns, **plan), "conv_id", "turn", "input", "output") == sorted(want)


@pytest.mark.parametrize("plan", PLANS)
def test_outer(turns, rows, plan):
    want = []
    for conv, seq in by_conv(rows).items():
        for before, (_, turn, role, text) in zip([None, *seq], seq):
            if role == "assistant":
                want.append((conv, turn, before[3] if before and before[2] == "user" else "", text))
    assert got(pair.pair_outer(turns, **plan), "conv_id", "turn", "input", "output") == sorted(want)


def history_of(rows):
    want = {}
    for conv, seq in by_conv(rows).items():
        kept = [(t, "user" if r in ("user", "Human") else "assistant", x) for _, t, r, x in seq if r != "system"]
        for i, (turn, role, text) in enumerate(kept):
            if role == "assistant" and i and kept[i - 1][1] == "user":
                want[conv, turn] = (kept[i - 1][2], text, [(r, x) for _, r, x in kept[: i - 1]])
    return want


@pytest.mark.parametrize("plan", PLANS)
def test_history(turns, rows, plan):
    made = {(r.conv_id, r.turn): r for r in pair.pair_history(turns, **plan).collect()}
    want = history_of(rows)
    assert made.keys() == want.keys()
    for key, (asked, answer, said) in want.items():
        r = made[key]
        assert (r.input, r.output, [tuple(h) for h in r.history], r.history_len) == (asked, answer, said, len(said))
        context = "".join(f"{role}: {text}\n" for role, text in said)
        assert r.instruction == pair.CONTINUE_INSTRUCTION + (f"\n\nContext:\n{context}" if said else "")


@pytest.mark.parametrize("block", [1, 2, 5])
def test_history_in_blocks(turns, rows, block):
    want = history_of(rows)
    made = {(r.conv_id, r.turn): r for r in pair.pair_history(turns, block=block).collect()}
    assert {k: [tuple(h) for h in r.history] for k, r in made.items()} == {k: said for k, (_, _, said) in want.items()}


@pytest.mark.parametrize("plan", [{"span": 3}, {"span": 1000}])
def test_history_is_the_ranked_turns_before(turns, rows, plan):
    ranked = {}
    for r in sorted(pair.history_turns(turns, **plan).collect(), key=lambda r: (r.conv_id, r.rank)):
        ranked.setdefault(r.conv_id, []).append((r.role, r.text))
    for r in pair.pair_history(turns, **plan).collect():
        assert ranked[r.conv_id][: r.history_len] == [tuple(h) for h in r.history]


@pytest.mark.parametrize("block", [2, 256])
def test_max_turns_keeps_the_latest(turns, rows, block):
    want = history_of(rows)
    for r in pair.pair_history(turns, max_turns=2, block=block).collect():
        said = want[r.conv_id, r.turn][2]
        assert [tuple(h) for h in r.history] == said[-2:] and r.history_len == len(said)


@pytest.mark.parametrize("latest", [None, 2])
def test_a_long_conversation_keeps_its_history(spark, latest):
    said = [(7, i, "user" if i % 2 == 0 else "assistant", f"t{i}") for i in range(700)]
    made = pair.pair_history(spark.createDataFrame(said, "conv_id long, turn long, role string, text string"), latest)
    rows = made.collect()
    assert len(rows) == 350
    for r in rows:
        before = [x[2:] for x in said[: r.turn - 1]]
        assert [tuple(h) for h in r.history] == (before if latest is None else before[-latest:])
        assert ("Context:" in r.instruction) == bool(before)


def test_written_out_histories_are_not_shuffled(turns):
    """No exchange or join by the turn: only blocks of turns travel, and turns are ranked once."""
    plan = pair.pair_history(turns)._jdf.queryExecution().executedPlan().toString()
    dealt = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert any("_reader" in keys for keys in dealt) and not any("turn#" in keys for keys in dealt)
    assert plan.count("row_number()") <= 2


@pytest.mark.parametrize("latest", [None, 2])
def test_texts_are_dealt_once_for_a_history(turns, latest):
    """One exchange to the readers, besides those that rank turns for a limit; no task waits for a whole conversation."""
    plan = pair.pair_history(turns, latest)._jdf.queryExecution().executedPlan().toString()
    dealt = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert sum("_reader#" in keys for keys in dealt) == 1 and not any("conv_id#" in keys and "_block#" in keys for keys in dealt)
    assert latest or len(dealt) == 1


@pytest.mark.parametrize("span", [3, 7, 1000])
def test_rows_are_sent_to_later_blocks_of_their_group(turns, rows, span):
    sent = ordered.sent_on(turns, ["conv_id"], "turn", span).collect()
    own = {(r.conv_id, r.turn): r._reader for r in sent if r._own}
    assert sorted(own) == sorted(r[:2] for r in rows) and len(sent) == len({(r.conv_id, r.turn, r._reader) for r in sent})
    assert sorted(own.values()) == [own[k] for k in sorted(own)]  # blocks follow the keys
    readers = {}
    for r in sent:
        readers.setdefault((r.conv_id, r.turn), []).append(r._reader)
    for (conv, turn), block in own.items():
        wanted = {b for (c, _), b in own.items() if c == conv and b >= block}
        assert wanted <= set(readers[conv, turn]) and min(readers[conv, turn]) == block
        # past the last block with a row of the group there is at most one, which its last cut begins
        assert max(readers[conv, turn]) <= max(wanted) + 1
    assert (len(sent) == len(own)) == (span == 1000)


@pytest.mark.parametrize("scope", ["corpus", "conversation"])
def test_dedup(turns, rows, scope):
    seen, want = set(), []
    for r in sorted(rows):
        key = r[3] if scope == "corpus" else (r[0], r[3])
        if key not in seen:
            seen.add(key)
            want.append(r)
    assert got(dedup.dedup_turns(turns, scope), "conv_id", "turn", "role", "text") == want


def test_dedup_drops_empty_and_changes_adjacency(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", ""), (1, 3, "user", "a"), (1, 4, "assistant", "c")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert got(pair.pair_adjacent(df), "instruction", "output") == [("a", "c"), ("b", "")]
    assert got(pair.pair_adjacent(dedup.renumber_turns(dedup.dedup_turns(df))), "turn", "instruction", "output") == [(1, "b", "c")]


@pytest.mark.parametrize("plan", PLANS)
def test_renumber(turns, rows, plan):
    want = [(conv, i, seq_row[3]) for conv, seq in by_conv(rows).items() for i, seq_row in enumerate(seq)]
    assert got(dedup.renumber_turns(turns, **plan), "conv_id", "turn", "text") == sorted(want)


@pytest.mark.parametrize("plan", PLANS)
def test_folds(turns, rows, plan):
    n = F.length("text").cast("long")
    df = ordered.fold_before(
        turns,
        ["conv_id"],
        "turn",
        {"total": ("sum", n), "low": ("min", F.col("turn") % 5), "high": ("max", F.col("turn") % 5)},
        **plan,
    )
    want = []
    for conv, seq in by_conv(rows).items():
        for i, (_, turn, _, _) in enumerate(seq):
            prior = seq[:i]
            want.append(
                (
                    conv,
                    turn,
                    sum(len(p[3]) for p in prior) if prior else None,
                    min((p[1] % 5 for p in prior), default=None),
                    max((p[1] % 5 for p in prior), default=None),
                )
            )
    assert got(df, "conv_id", "turn", "total", "low", "high") == sorted(want)


def folds():
    return {
        "total": ("sum", F.col("turn").cast("decimal(38,0)")),
        "low": ("min", F.col("text")),
        "high": ("max", F.col("turn")),
        "seen": ("last", F.when(F.col("role") == "user", F.col("text"))),
        "before": ("prev", F.col("text")),
    }


def loop(rows):
    """The folds by a loop over every group."""
    want = []
    for seq in by_conv(rows).values():
        for i, (conv, turn, _, _) in enumerate(seq):
            prior = seq[:i]
            users = [p[3] for p in prior if p[2] == "user"]
            total = sum(p[1] for p in prior) if prior else None
            low, high = min((p[3] for p in prior), default=None), max((p[1] for p in prior), default=None)
            want.append((conv, turn, total, low, high, users[-1] if users else None, prior[-1][3] if prior else None))
    return sorted(want, key=str)


def folded(df, **options):
    made = ordered.fold_before(df, ["conv_id"], "turn", folds(), **options)
    assert made.columns == [*df.columns, *folds()]
    return sorted(([tuple(r) for r in made.select("conv_id", "turn", *folds()).collect()]), key=str)


def sparse(seed, groups, n=240):
    rng = random.Random(seed)
    orders = [rng.randrange(-(2**62), 2**62) for _ in range(n // 2)] + rng.sample(range(1_700_000_000_000, 1_700_000_100_000), n - n // 2)
    return [(rng.choice(groups), o, rng.choice(["user", "assistant", "system"]), f"t{i}") for i, o in enumerate(orders)]


@pytest.mark.parametrize("span", [1, 2, 7, 60, 1000])
@pytest.mark.parametrize("groups", [[1], [1, 1, 1, 1, 2, 3, 4], list(range(-2**60, 2**60, 2**55))])
def test_sparse_orders_match_a_loop(spark, span, groups):
    rows = sparse(span, groups)
    df = spark.createDataFrame([*rows, (None, 1, "user", "x"), (1, None, "user", "x")], "conv_id long, turn long, role string, text string")
    assert folded(df, span=span) == loop(rows)


def test_cuts_of_another_table_change_nothing(spark):
    rows = sparse(3, [1, 1, 2])
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    other = spark.range(100).selectExpr("1L AS conv_id", "(id - 50) * 90000000000000000 AS turn")
    for sample in (other, other.limit(0), df.filter("conv_id = 2")):
        assert folded(df, span=3, sample=sample) == loop(rows)
    assert folded(df.limit(0), span=3) == []


def test_a_group_of_the_whole_table_is_spread_evenly(spark):
    """A million rows of one group at random 64-bit orders: no task of the window gets twice the median."""
    spread = spark.range(1_000_000).selectExpr("7L AS conv_id", "xxhash64(id) AS turn", "'user' AS role", "'' AS text")
    parts, adaptive = spark.conf.get("spark.sql.shuffle.partitions"), "spark.sql.adaptive.enabled"
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "32")
        spark.conf.set(adaptive, "false")
        made = ordered.fold_before(spread, ["conv_id"], "turn", {"n": ("sum", F.lit(1))}, span=1000)
        sizes = sorted(r["count"] for r in made.groupBy(F.spark_partition_id().alias("p")).count().collect())
        assert len(sizes) == 32 and sizes[-1] <= 2 * sizes[16]
        assert made.agg(F.max("n"), F.sum(F.col("n").cast("long"))).first()[:] == (999_999, 999_999 * 1_000_000 // 2)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set(adaptive, "true")


def test_no_window_sees_a_whole_conversation(spark):
    df = spark.range(5000).selectExpr("1L AS conv_id", "id AS turn", "if(id % 2 = 0, 'user', 'assistant') AS role", "cast(id AS string) AS text")
    out = pair.pair_adjacent(df, span=100)
    assert out.count() == 2500
    plan = out._jdf.queryExecution().executedPlan().toString()
    payload_windows = [w for w in plan.split("windowspecdefinition(")[1:] if "turn#" in w.split(")")[0]]
    assert payload_windows and all("_block#" in w.split(")")[0] for w in payload_windows)


def test_building_a_query_runs_no_job(spark, data):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "building")
    made = [
        catalog.QUERIES[name](spark, data)
        for name in ("pair_adjacent", "pair_history", "dedup_then_pair", "split_exact", "epoch_schedule")
    ]
    # reading a Parquet schema is a job; the rest builds plans
    assert len(tracker.getJobIdsForGroup("building")) <= 2 * len(made)
    spark.sparkContext.setJobGroup("rest", "rest")
    plan = made[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(_block#") >= 1


def test_runlog_windows_with_gaps(spark):
    """A missing flush step leaves its losses to the next flush, as the training loop does."""
    steps = [1, 2, 3, 5, 6, 7, 8, 9, 12, 13]  # 4 is missing
    log = spark.createDataFrame([("r", s, float(s), 0.0, None) for s in steps], "run string, step long, loss double, lr double, eval_loss double")
    made = got(runlog.accumulation_windows(log, 4, span=3), "flush_step", "rows", "accumulated")
    assert made == [(8, 7, 32 / 4), (12, 2, 21 / 4)]
    epochs = {r.epoch: (r.mean_loss, r.printed_loss) for r in runlog.epoch_means(log, 10, 4, span=3).collect()}
    assert epochs[1] == (sum(s for s in steps if s <= 10) / 8, 32 / 4 / 10)
    assert epochs[2] == (25 / 2, 21 / 4 / 10)


def test_best_so_far_is_strict(spark):
    losses = [0.5, 0.5, 0.4, 0.6, 0.4, 0.1]
    log = spark.createDataFrame([("r", i + 1, 0.0, 0.0, v) for i, v in enumerate(losses)], "run string, step long, loss double, lr double, eval_loss double")
    assert [i for _, i in got(runlog.best_so_far(log, span=2), "step", "improved")] == [True, False, True, False, False, True]


def test_documents_are_read_once_for_the_cuts(spark):
    """Both readers of a sample share its exchange: what makes a document's text runs once a document."""
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def text(i):
        made.add(1)
        return "x" * (flows.TURN_CHARS * (i % 5))

    docs = spark.range(40).select("id", text("id").alias("text"))
    said = [(i, t, "assistant" if t % 2 else "user", f"{i}/{t}") for i in range(40) for t in range(4)]
    turns = spark.createDataFrame(said, "conv_id long, turn long, role string, text string")
    rows = pair.pair_carry_forward(turns, span=8, sample=flows.likely_turns(docs, "id", "text"))
    assert got(rows, "conv_id", "turn", "input") == [(i, t, f"{i}/{t - 1}") for i in range(40) for t in (1, 3)]
    assert made.value == 40


def test_likely_turns(spark):
    docs = spark.createDataFrame([(1, ""), (2, None), (3, "x" * 800), (None, "x")], "k int, t string")
    likely = [tuple(r) for r in flows.likely_turns(docs, "k", "t").collect()]
    assert sorted(likely, key=str) == [(1, 0), (2, 0), (3, 0), (3, 1), (3, 2), (None, 0)]
