"""Line dedup: lines that very many documents share leave every document."""

from __future__ import annotations

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnloom.llm import common

MIN_DOCS = 10
MIN_CHARS = 1
KEYS = "array<struct<key:binary,at:array<int>>>"


def line_keys(min_chars: int) -> Column:
    """Per document, every distinct key of its lines (ASCII white space stripped, A-Z lower-cased, 128-bit hash) and the lines
    that have it; keys of fewer than ``min_chars`` code points are left out."""

    @F.pandas_udf(KEYS)
    def keys(texts: pd.Series) -> pd.Series:
        rows = []
        for text in texts:
            at: dict[bytes, list[int]] = {}
            for i, line in enumerate((text or "").encode().split(b"\n")):
                key = line.strip().lower()
                if len(key) >= min_chars and (min_chars <= 1 or len(key.decode()) >= min_chars):
                    at.setdefault(xxhash.xxh3_128_digest(key), []).append(i)
            rows.append([{"key": k, "at": v} for k, v in at.items()])
        return pd.Series(rows)

    return keys("text")


@F.pandas_udf(T.StringType())
def without_lines(texts: pd.Series, drops: pd.Series) -> pd.Series:
    """Texts without the lines numbered in ``drops``; null where there are none to drop."""

    def kept(text: str, drop: set[int]) -> str:
        return "\n".join(line for i, line in enumerate(text.split("\n")) if i not in drop)

    return pd.Series(
        [None if d is None else kept(t or "", set(d)) for t, d in zip(texts, drops, strict=True)], dtype=object
    )


def drop_shared_lines(
    docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, count_copies: bool = True
) -> DataFrame:
    """``docs`` (``doc_id, text``, any other columns) without the lines found in at least ``min_docs`` documents.

    Adds ``n_lines`` (before) and ``n_dropped``; columns of these names are replaced. Every row counts as a document; with
    ``count_copies`` off, equal texts count once, so that a text with many exact copies keeps its lines. Rows that repeat
    are kept. A null or empty text is one empty line and comes back as ``""``; lines with a key of fewer than
    ``min_chars`` code points are never dropped. doc_id may be null. An empty table gives no rows.

    Hashes are counted with map-side sums and only those over the threshold are kept. They meet the lines again in a join on the
    hash, broadcast when Spark's size check of the written table allows, else shuffled, where a line of a third of all
    documents is a skewed key that adaptive execution splits. Only line numbers travel; the text moves once.
    """
    row = common.text_key(F.col("text")) if not count_copies else None
    lines = docs.select(
        *[k.alias(f"_c{i}") for i, k in enumerate(row or [])], F.explode(line_keys(min_chars)).alias("_line")
    ).withColumn("_key", F.col("_line.key"))
    if not count_copies:
        lines = lines.select("_key", "_c0", "_c1").distinct()
    shared = lines.groupBy("_key").agg(F.count("*").alias("_n")).filter(F.col("_n") >= min_docs).select("_key")
    shared = common.settle(shared)

    ident = [F.xxhash64("doc_id", *common.text_key(F.col("text"))), *common.text_key(F.col("text"))]
    *names, at = (common.fresh(n, docs.columns) for n in ("_d0", "_d1", "_d2", "_at"))
    found = (
        docs.select(*[c.alias(n) for c, n in zip(ident, names, strict=True)], F.explode(line_keys(min_chars)).alias("_line"))
        .select(*names, F.col("_line.key").alias("_key"), F.col("_line.at").alias(at))
        .join(shared, "_key")
    )
    drops = found.groupBy(*names).agg(F.array_distinct(F.flatten(F.collect_list(at))).alias(at))
    joined = docs.withColumns(dict(zip(names, ident, strict=True))).join(drops, names, "left")
    text = F.coalesce("text", F.lit(""))
    touched = without_lines(F.when(F.col(at).isNotNull(), text), F.col(at))
    return joined.withColumns(
        {
            "n_lines": (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long"),
            "n_dropped": F.greatest(F.coalesce(F.size(at), F.lit(0)), F.lit(0)).cast("long"),
            "text": F.coalesce(touched, text),
        }
    ).drop(*names, at)
