"""Reading the elements of one very large JSON array file with many tasks.

Spark's text source reads a file in byte ranges, whatever ends its records, so the file is cut at every closing bracket: each piece is the
text up to one. What a piece means depends on all before it, because the bracket may stand in a string or close something inside an
element. As in a parallel parser, that is settled by summaries of the byte ranges:

1. inside a piece, unescaped quotes are counted, and the change of depth both for a start outside and for one inside a string;
2. a byte range is summed up in one row for both cases; the ranges of a file, one row each, are gone through in order, and each is told in which
   state it starts;
3. now every piece knows its depth, so it knows whether it ends an element, and elements are numbered in the same way;
4. the pieces of an element are put together. Nothing but an element is ever one row.

A byte range is bounded by ``spark.sql.files.maxPartitionBytes``, and so are the windows over one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# An escape is a backslash with what follows it; the quotes that are left begin and end strings. Brackets are written as char(...) or \x...,
# because braces stand for parameters in these statements.
PIECES = r"""
SELECT file, name, range, at, piece, quotes,
    size(filter(outside, c -> c IN (char(123), '['))) - size(filter(outside, c -> c IN (char(125), ']'))) AS deeper_outside,
    size(filter(inside, c -> c IN (char(123), '['))) - size(filter(inside, c -> c IN (char(125), ']'))) AS deeper_inside
FROM (
    SELECT *, size(parts) - 1 AS quotes,
        regexp_extract_all(array_join(filter(parts, (p, i) -> i % 2 = 0), ''), '[\\x5B\\x5D\\x7B\\x7D]', 0) AS outside,
        regexp_extract_all(array_join(filter(parts, (p, i) -> i % 2 = 1), ''), '[\\x5B\\x5D\\x7B\\x7D]', 0) AS inside
    FROM (SELECT *, split(regexp_replace(piece, '(?s)\\\\.', ''), '"', -1) AS parts FROM {raw}))
"""

# A piece or range starts inside a string after an odd number of quotes. The three statements are not one with named parts: rows are
# numbered by where they lie, and Spark would deal such a part out anew before each use.
PARITY = r"""
SELECT *,
    CASE WHEN quotes_before % 2 = 0 THEN deeper_outside ELSE deeper_inside END AS deeper_0,
    CASE WHEN quotes_before % 2 = 0 THEN deeper_inside ELSE deeper_outside END AS deeper_1
FROM (
    SELECT *, coalesce(sum(quotes) OVER (
        PARTITION BY file, range ORDER BY at ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS quotes_before
    FROM {pieces})
"""

DEPTH = r"""
WITH
ranges AS (
    SELECT file, range, sum(quotes) AS quotes, sum(deeper_0) AS deeper_0, sum(deeper_1) AS deeper_1 FROM {{pieces}} GROUP BY file, range),
entered AS (
    SELECT file, range, deeper_0, deeper_1, coalesce(sum(quotes) OVER before, 0) % 2 AS odd FROM ranges
    WINDOW before AS (PARTITION BY file ORDER BY range ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
started AS (
    SELECT file, range, odd,
        coalesce(sum(CASE WHEN odd = 0 THEN deeper_0 ELSE deeper_1 END) OVER before, 0) AS depth FROM entered
    WINDOW before AS (PARTITION BY file ORDER BY range ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT p.*, (quotes_before + quotes + odd) % 2 = 0 AND {depth} = s.depth + sum(CASE WHEN odd = 0 THEN deeper_0 ELSE deeper_1 END)
    OVER (PARTITION BY file, range ORDER BY at ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ends
FROM {{pieces}} p JOIN started s USING (file, range)
"""

ELEMENTS = r"""
WITH
counted AS (SELECT file, range, count_if(ends) AS n FROM {deep} GROUP BY file, range),
numbered AS (
    SELECT file, range, coalesce(sum(n) OVER (
        PARTITION BY file ORDER BY range ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first,
        sum(n) OVER (PARTITION BY file) AS total FROM counted),
placed AS (
    SELECT d.file, name, range, at, piece, total, first + coalesce(sum(CAST(ends AS INT)) OVER (
        PARTITION BY file, range ORDER BY at ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ordinal
    FROM {deep} d JOIN numbered USING (file, range))
SELECT file, first(name) AS name, ordinal,
    array_join(transform(array_sort(collect_list(named_struct('r', range, 'a', at, 'p', piece))), x -> x.p), '') AS element
FROM placed WHERE ordinal < total GROUP BY file, ordinal
"""


def read_elements(spark: SparkSession, path: str, glob: str = "*", close: str = "}", depth: int = 1) -> DataFrame:
    """``file, name, ordinal, element``: the elements of JSON arrays, numbered from 0 in the order of the file, as JSON text.

    ``close`` is the bracket that ends an element and ``depth`` how many brackets stand open around it: 0 for objects one after another
    (with or without commas), 1 for an array of objects, 2 for one in the first field of an object (``{"data": [...]}``), ``close="]"`` for
    arrays. Numbers and names between elements are left out and not numbered; strings between them must not hold the opening bracket. Folders are
    read recursively. A file may have any size and may be one line; an element has to fit into a row. An empty array or file
    has no elements; text after the last element is not looked at.
    """
    files = (
        spark.read.option("lineSep", close)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .text(path)
        .selectExpr(
            "_metadata.file_path AS file",
            "_metadata.file_name AS name",
            "_metadata.file_block_start AS range",
            # rows of a byte range come in the order of the file
            "monotonically_increasing_id() AS at",
            f"concat(value, '{close}') AS piece",
        )
    )
    pieces = spark.sql(PARITY, pieces=spark.sql(PIECES, raw=files))
    found = spark.sql(ELEMENTS, deep=spark.sql(DEPTH.format(depth=depth), pieces=pieces))
    # an element begins with the bracket that fits; the first one has the open brackets around it before that
    opener = {"}": r"\x7B", "]": r"\x5B"}[close]
    around = rf"^(?:[^\x5B\x7B]*[\x5B\x7B]){{{depth}}}[^{opener}]*"
    first = F.regexp_replace("element", around, "")
    later = F.regexp_replace("element", f"^[^{opener}]*", "")
    return found.withColumn("element", F.when(F.col("ordinal") == 0, first).otherwise(later))
