"""Registered queries of the operators, with the SQL each is checked against where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnloom.llm import (
    chat,
    clusters,
    common,
    decontaminate,
    lexical,
    lines,
    neighbours,
    pieces,
    quality_rules,
    secret_scan,
    sharding,
    simhash,
    tokens,
    toxicity,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op6_simhash_near_duplicates(spark, folder):
    return simhash.near_duplicates(table(spark, folder, "documents"))


@query
def op7_line_dedup(spark, folder):
    kept = lines.drop_shared_lines(table(spark, folder, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ORACLES["op7_line_dedup"] = rf"""
WITH l AS (
    SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)),
k AS (
    SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), '{UPPER}', '{LOWER}') AS key
    FROM l),
shared AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(s.key) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE s.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN shared s USING (key) GROUP BY doc_id
"""


@query
def op2_best_fit_shards(spark, folder):
    packed = sharding.pack(table(spark, folder, "documents"), shards=8)
    return packed.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


@query
def op10_toxic_passages(spark, folder):
    docs, held = table(spark, folder, "documents"), toxicity.held_out(5, 0)
    model = toxicity.train(docs, table(spark, folder, "labels"), ~held)
    return toxicity.score(docs, model).select(
        "doc_id", held.alias("held_out"), "score", F.col("toxic").cast("int").alias("predicted"), "passages"
    )


@query
def op3_sentencepiece(spark, folder):
    ids = pieces.encode(table(spark, folder, "documents").select("doc_id", "text"), round_trip="round_trip")
    return ids.select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids", "round_trip")


@query
def op5_benchmark_leaks(spark, folder):
    return decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op4_permutation_neighbours(spark, folder):
    return neighbours.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op8_maximal_chats(spark, folder):
    return chat.format_chats(table(spark, folder, "conversations"))


ORACLES["op8_maximal_chats"] = """
WITH t AS (
    SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS pos FROM t),
c AS (SELECT conv_id, list({'role': role, 'text': text} ORDER BY pos) AS said FROM n GROUP BY conv_id),
kept AS (
    SELECT conv_id FROM c WHERE NOT EXISTS (
        SELECT 1 FROM c AS o WHERE o.conv_id <> c.conv_id AND o.said[1] = c.said[1] AND o.said[1:len(c.said)] = c.said
            AND (len(o.said) > len(c.said) OR o.conv_id < c.conv_id)))
SELECT conv_id, (pos - 1) // 1024 AS part, count(*) AS n_turns,
    string_agg('<|' || role || '|>' || chr(10) || text || chr(10) || '<|end|>' || chr(10), '' ORDER BY pos) AS text
FROM n WHERE conv_id IN (SELECT conv_id FROM kept) GROUP BY conv_id, part
"""


@query
def op9_quality_rules(spark, folder):
    docs, held = table(spark, folder, "documents"), toxicity.held_out(3, 1)
    model = quality_rules.train(docs, table(spark, folder, "labels"), ~held)
    scored = quality_rules.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held.alias("held_out"), "score", F.col("good").cast("int").alias("predicted"))


@query
def op1_secret_findings(spark, folder):
    """Findings are labelled by rule (the tables hold no reviewed ones); a fifth of the documents trains nothing."""
    found = common.settle(secret_scan.candidates(table(spark, folder, "documents")))
    held = toxicity.held_out(5, 0)
    label = secret_scan.silver(F.col("assigned"), F.col("entropy"), F.col("length"))
    forest = secret_scan.train(found.filter(~held).withColumn("label", label))
    return secret_scan.score(found, forest).select(
        "doc_id", "start", "length", held.alias("held_out"), label.cast("int").alias("label"), "score", "secret"
    )


CLUSTERS, ROUNDS, DIM = 8, 10, clusters.DIM
CENTROID = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


@query
def op11_centroid_clusters(spark, folder):
    return clusters.cluster(table(spark, folder, "embeddings"), k=CLUSTERS, rounds=ROUNDS).select(*CENTROID)


def _rounds() -> str:
    """The rounds one after another: distances of all vectors to the centroids, the nearest, the means."""
    steps = []
    for i in range(ROUNDS + 1):
        steps.append(f"""
d{i} AS MATERIALIZED (SELECT r, k, sum((x - c) * (x - c)) AS d FROM v JOIN c{i} USING (j) GROUP BY r, k),
a{i} AS MATERIALIZED (SELECT r, k, d FROM d{i} QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, k) = 1)""")
        if i < ROUNDS:
            steps.append(f"""
s{i} AS (SELECT k, j, sum(x)::BIGINT AS s, count(*) AS n FROM a{i} JOIN v USING (r) GROUP BY k, j),
c{i + 1} AS MATERIALIZED (
    SELECT k, j, CASE WHEN n IS NULL THEN c ELSE (s - ((s % n) + n) % n) // n END AS c FROM c{i} LEFT JOIN s{i} USING (k, j))""")
    return ",".join(steps)


ORACLES["op11_centroid_clusters"] = f"""
WITH e AS (
    SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, embedding FROM embeddings
    WHERE len(embedding) = {DIM} AND len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c))) = {DIM}),
v AS MATERIALIZED (
    SELECT r, generate_subscripts(embedding, 1) AS j, floor(1024 * unnest(embedding)::DOUBLE)::BIGINT AS x FROM e),
f AS (SELECT r, row_number() OVER (ORDER BY sha256('3:' || vec_id::VARCHAR)) - 1 AS k FROM e QUALIFY k < {CLUSTERS}),
c0 AS MATERIALIZED (SELECT k, j, x AS c FROM f JOIN v USING (r)),{_rounds()},
g AS (SELECT k, sum(d) AS own FROM a{ROUNDS} GROUP BY k),
h AS (SELECT k, sha256(string_agg(c::VARCHAR, ',' ORDER BY j)) AS centroid_sha256 FROM c{ROUNDS} GROUP BY k)
SELECT vec_id, k::INTEGER AS cluster, d::BIGINT AS distance, own::BIGINT AS cluster_inertia,
    (SELECT sum(d) FROM a{ROUNDS})::BIGINT AS inertia, centroid_sha256
FROM a{ROUNDS} JOIN e USING (r) JOIN g USING (k) JOIN h USING (k)
"""

CONTEXT = 4096


@query
def op12_token_counts(spark, folder):
    """Counts of the library's tokens; a document over ``CONTEXT`` tokens would have to be cut for a model of that context."""
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    counted = tokens.count_tokens(table(spark, folder, "documents").select("doc_id", "text"), model=model)
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > CONTEXT).alias("over_limit"))


@query
def op13_ranked_search(spark, folder):
    return lexical.search(table(spark, folder, "benchmark"), table(spark, folder, "documents"))


TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
ORACLES["op13_ranked_search"] = rf"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}') AS ts FROM documents),
w AS (SELECT r, doc_id, len(ts) AS n FROM d WHERE len(ts) > 0),
total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM w),
q AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}')) AS term FROM benchmark),
t AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ts) AS term FROM d) GROUP BY r, term),
f AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM t, total GROUP BY term, docs),
s AS (
    SELECT item_id, r, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms))))::BIGINT AS score
    FROM q JOIN f USING (term) JOIN t USING (term) JOIN w USING (r), total GROUP BY item_id, r)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM s JOIN w USING (r) WHERE score > 0 QUALIFY rank <= 10
"""
