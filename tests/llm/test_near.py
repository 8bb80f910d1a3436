"""SimHash links and components, near copies, shards, shared lines: against brute force on whole small tables."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from turnloom.llm import common, lines, sharding, simhash
from turnloom.llm.queries import QUERIES


def fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(n, links):
    up = list(range(n))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return [root(x) for x in range(n)]


def expected_components(rows, radius=4):
    prints = [fingerprint(t) for _, t in rows]
    n = len(rows)
    linked = [(a, b) for a in range(n) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= radius]
    roots, ids = components(n, linked), defaultdict(list)
    for r, (i, _) in zip(roots, rows, strict=True):
        if i is not None:
            ids[r].append(i)
    return Counter((i, f"{p:016x}", min(ids[r], default=None)) for (i, _), p, r in zip(rows, prints, roots, strict=True))


@pytest.mark.parametrize("leaf", [simhash.LEAF, 3])
def test_components_odd(odd, leaf):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    got = simhash.near_duplicates(odd, leaf=leaf)
    assert Counter(map(tuple, got.collect())) == expected_components(rows)


def test_components_whole_table(spark, data, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = QUERIES["op6_simhash_near_duplicates"](spark, data).collect()
    assert Counter(map(tuple, got)) == expected_components(rows)


def test_no_documents(none):
    assert simhash.near_duplicates(none).count() == 0
    assert simhash.without_near_copies(none).count() == 0
    assert sharding.pack(none, shards=8).count() == 0
    assert lines.drop_shared_lines(none).count() == 0


@pytest.mark.parametrize("leaf", [simhash.LEAF, 7])
def test_links_in_large_shards(spark, leaf):
    """A ball of fingerprints round one point, in pieces and whole, gives the components of all pairs."""
    random = np.random.default_rng(3)
    near = [int(random.integers(0, 2**62))]
    for _ in range(150):
        near.append(near[random.integers(0, len(near))] ^ sum(1 << int(b) for b in random.integers(0, 60, 4)))
    values = sorted({*near, *random.integers(0, 2**62, 100).tolist()})
    df = spark.createDataFrame([(v,) for v in values], "fp long")
    found = [(r.a, r.b) for r in simhash.links(df, leaf=leaf).collect()]
    at = {v: i for i, v in enumerate(values)}
    assert all((a ^ b).bit_count() <= 4 for a, b in found)
    want = [(i, j) for i, a in enumerate(values) for j, b in enumerate(values[:i]) if (a ^ b).bit_count() <= 4]
    assert components(len(values), [(at[a], at[b]) for a, b in found]) == components(len(values), want)


def test_connected_components(spark):
    random = np.random.default_rng(5)
    edges = [(int(a), int(b)) for a, b in random.integers(0, 300, (220, 2))] + [(i, i + 1) for i in range(400, 460)]
    got = common.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    want = components(500, edges)
    assert {r.node: r.component for r in got} == {n: want[n] for e in edges if e[0] != e[1] for n in e}
    assert common.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def near_copies(rows, least=0.8):
    sets = [simhash.shingle_set(t) for _, t in rows]
    linked = []
    for a in range(len(rows)):
        for b in range(a):
            both = len(np.intersect1d(sets[a], sets[b]))
            whole = len(sets[a]) + len(sets[b]) - both
            if (rows[a][1] or "") == (rows[b][1] or "") or (whole and both / whole >= least):
                linked.append((a, b))
    groups = defaultdict(list)
    for r, (i, _) in zip(components(len(rows), linked), rows, strict=True):
        groups[r].append((i is None, i))
    return Counter(min(g)[1] for g in groups.values())


@pytest.mark.parametrize("leaf", [simhash.LEAF, 3])
def test_near_copies(spark, documents, leaf):
    base = [(r.doc_id, r.text) for r in documents.orderBy("doc_id").limit(60).collect()]
    rows = list(base)
    for i, text in base[:25]:
        words = text.split(" ")
        for k in range(3):
            changed = list(words)
            changed[(k * 7 + 3) % len(words)] = f"changed{k}"
            rows.append((1000 + i * 10 + k, " ".join(changed)))
    rows += [(5000, None), (5001, ""), (5002, " "), (None, "x y"), (None, "x y"), (7, base[7][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("node", F.lit("clash"))
    got = simhash.without_near_copies(df, leaf=leaf)
    assert got.columns == df.columns
    assert Counter(r.doc_id for r in got.collect()) == near_copies(rows)


def test_fingerprints_link_in_the_pipeline(spark, data):
    """Texts of equal words in runs: one fingerprint, but shingle sets less alike than 0.8; a chain may go on over alike shingles."""
    own = [f"w{i}" for i in range(40)]
    rows = [(1, " ".join(own * 30)), (2, " ".join([*own * 30, *[f"n{i}" for i in range(14)]])), (3, " ".join([*own * 30, *[f"n{i}" for i in range(15)]]))]
    rows += [(4, "quite another text of its own"), (5, None), (6, " "), (7, "")]
    prints = [fingerprint(t) for _, t in rows]
    sets = [set(simhash.shingle_set(t).tolist()) for _, t in rows]
    assert (prints[0] ^ prints[1]).bit_count() <= 4 and len(sets[0] & sets[1]) < 0.8 * len(sets[0] | sets[1])
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.near_copies(spark, df, data).collect()) == [1, 4, 5]


@pytest.mark.parametrize("leaf", [simhash.LEAF, 3])
def test_near_copies_of_small_vocabulary(spark, leaf):
    """Few distinct words in long texts: a sixth of the shingles new, but most of the distinct words."""
    random, rows = np.random.default_rng(11), []
    for i in range(12):
        own = [f"w{i}x{w}" for w in random.integers(0, 300, 5000)]
        rows.append((i, " ".join(own)))
        rows.append((100 + i, " ".join([*own, *[f"n{i}x{w}" for w in range(1000)]])))
    want = near_copies(rows)
    assert set(want) == set(range(12))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter(r.doc_id for r in simhash.without_near_copies(df, leaf=leaf).collect()) == want


def test_near_copies_in_hot_group(spark, monkeypatch):
    """Near copies, most of all rows, do not meet in one task nor in all pairs of pieces; what they leave over is still found."""
    random, own = np.random.default_rng(12), [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(w.upper() if random.random() < 0.5 else w for w in own)) for i in range(150)]
    for i in range(150):  # one word more, then chains that leave the group step by step
        rows.append((200 + i, " ".join([*own, f"new{i}"])))
    for i in range(5, 30):
        rows.append((400 + i, " ".join([*own, *[f"more{j}" for j in range(i)]])))
        rows.append((500 + i, " ".join([*own[:20], *[f"own{i}x{j}" for j in range(20)]])))
    seen, real, leaf = [], simhash.in_leaves, 16

    def spy(dealt, *cols):
        count = dealt.groupBy("leaf").count().agg(F.max("count"), F.sum("count")).first()
        seen.append((count[0] or 0, count[1] or 0))
        return real(dealt, *cols)

    monkeypatch.setattr(simhash, "in_leaves", spy)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter(r.doc_id for r in simhash.without_near_copies(df, leaf=leaf).collect())
    assert got == near_copies(rows)
    assert seen and max(n for n, _ in seen) <= 4 * leaf and sum(n for _, n in seen) <= simhash.KEYS * len(rows)


def lines_expected(rows, least, chars=1, copies=True):
    def keys(text):
        return [line.strip().lower() for line in (text or "").encode().split(b"\n")]

    docs = rows if copies else list({t: (i, t) for i, t in rows}.values())
    seen = Counter(k for _, t in docs for k in set(keys(t)) if len(k.decode()) >= chars)
    out = Counter()
    for i, text in rows:
        kept = [x for x, k in zip((text or "").split("\n"), keys(text), strict=True) if seen[k] < least]
        out[i, "\n".join(kept), len(keys(text)), len(keys(text)) - len(kept)] += 1
    return out


@pytest.mark.parametrize("least, chars, copies", [(2, 1, True), (2, 1, False), (3, 6, True), (10, 1, True)])
def test_shared_lines(odd, least, chars, copies):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    got = lines.drop_shared_lines(odd, least, chars, copies)
    assert set(got.columns) == {*odd.columns, "n_dropped"}
    made = Counter((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got.collect())
    assert made == lines_expected(rows, least, chars, copies)


def test_shared_lines_whole_table(spark, data, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    want = {(i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, t, n, d in lines_expected(rows, 10)}
    got = QUERIES["op7_line_dedup"](spark, data).select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect()
    assert {tuple(r) for r in got} == want and any(r.n_dropped for r in got)


def check_shards(got, rows):
    assert len(got) == len(rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (i, len((t or "").encode()) + 1, None if t is None else zlib.crc32(t.encode())) for i, t in rows
    )
    for shard in {r.shard for r in got}:
        slots = sorted(r.slot for r in got if r.shard == shard)
        assert slots == list(range(len(slots)))
    groups = defaultdict(set)
    for r in got:
        groups[r.size, r.text_crc32].add(r.shard)
    assert all(len(s) == 1 for s in groups.values())


def test_even_shards(spark, data, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = QUERIES["op2_best_fit_shards"](spark, data).collect()
    check_shards(got, rows)
    full = Counter()
    for r in got:
        full[r.shard] += r.size
    assert set(full) == set(range(8)) and max(full.values()) - min(full.values()) < 0.01 * sum(full.values()) / 8


def test_odd_shards(odd):
    got = sharding.pack(odd, shards=8).collect()
    check_shards(got, [(r.doc_id, r.text) for r in odd.collect()])
    assert {r.shard for r in got} <= set(range(8))


def test_fixed_capacity(documents):
    got = sharding.pack(documents, capacity=200_000).collect()
    full = Counter()
    for r in got:
        full[r.shard] += r.size
    assert max(full.values()) <= 200_000 and len(full) <= sum(full.values()) / 200_000 + 2


def plain_best_fit(items, capacity):
    bins, at = [], []
    for size in sorted(items, reverse=True):
        room = [(left, i) for i, left in enumerate(bins) if left >= size]
        if not room:
            bins.append(max(capacity, size))
        i = min(room)[1] if room else len(bins) - 1
        bins[i] -= size
        at.append(i)
    return at


def test_best_fit_is_best_fit_decreasing():
    random = np.random.default_rng(2)
    for _ in range(200):
        capacity = int(random.integers(5, 60))
        items = random.integers(1, capacity + 4, random.integers(1, 60)).tolist()
        runs = sharding.best_fit(sorted(Counter(items).items(), reverse=True), capacity)
        got = [b for b, n in runs for _ in range(n)]
        sizes = sorted(items, reverse=True)
        assert Counter(zip(sizes, got, strict=True)) == Counter(zip(sizes, plain_best_fit(items, capacity), strict=True))
