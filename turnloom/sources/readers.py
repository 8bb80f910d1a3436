"""File and table readers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnloom.sources.arrays import read_elements
from turnloom.sources.sinks import only_committed

SET_ASIDE = "\ue000\ufdd0\ue000"  # private-use and non-characters that no page has in this order
INSTRUCTION_ROW = "instruction string, input string, output string"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


SPREAD = "spark.turnloom.spread"


def spread(df: DataFrame) -> DataFrame:
    """Deal rows to as many partitions as the caller has asked for under ``spark.turnloom.spread``; unset, nothing moves.

    For small files on one machine: a table of one row group is read by one task however many cores there are.
    """
    parts = int(df.sparkSession.conf.get(SPREAD, None) or 0)
    return df.repartition(parts) if parts else df


def _file() -> list[Column]:
    return [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_name").alias("name")]


def whole_text(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """``file, name, value``: one row a file, folders searched recursively. The full path is the key; names repeat."""
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter=glob)
    return files.select(*_file(), "value")


def parse_turn_array(json: Column) -> Column:
    """Turn array of a JSON list of messages; ``from``/``value`` where ``role``/``content`` are absent."""
    items = F.from_json(json, "array<struct<role:string,content:string,from:string,value:string>>")
    return F.transform(
        items,
        lambda m: F.struct(
            F.coalesce(m["role"], m["from"], F.lit("")).alias("role"),
            F.coalesce(m["content"], m["value"], F.lit("")).alias("text"),
        ),
    )


def explode_turns(df: DataFrame, keys: list[str], json: str) -> DataFrame:
    """JSON lists of messages to ``keys, turn, role, text``; the turn is the list position."""
    return df.select(*keys, F.posexplode(parse_turn_array(F.col(json))).alias("turn", "t")).select(
        *keys, F.col("turn").cast("bigint").alias("turn"), "t.role", F.col("t.text").alias("text")
    )


def read_turns(spark: SparkSession, path: str) -> DataFrame:
    """``file, name, turn, role, text`` of JSON array files; list order is kept as the turn number."""
    return explode_turns(whole_text(spark, path, "*.json"), ["file", "name"], "value")


def read_turn_list(spark: SparkSession, path: str, depth: int = 1) -> DataFrame:
    """What ``read_turns`` gives, for lists too large for one row: every file is read in byte ranges by as many tasks as it has ranges.
    Without a list around the messages (``depth=0``) they may stand one after another."""
    found = read_elements(spark, path, "*.json" if depth else "*", depth=depth)
    turn = parse_turn_array(F.concat(F.lit("["), "element", F.lit("]")))
    return found.select("file", "name", F.col("ordinal").alias("turn"), F.get(turn, F.lit(0)).alias("t")).select(
        "file", "name", "turn", "t.role", "t.text"
    )


def read_instruction_list(spark: SparkSession, path: str, wrapped: bool = False) -> DataFrame:
    """What ``read_instructions`` gives for one array of objects, or a ``{"data": [...]}`` file, of any size."""
    found = read_elements(spark, path, "*.json", depth=2 if wrapped else 1)
    row = found.select(F.from_json("element", INSTRUCTION_ROW).alias("r"))
    return row.select(*[F.coalesce(f"r.{c}", F.lit("")).alias(c) for c in ("instruction", "input", "output")])


def read_instructions(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Instruction rows from JSON arrays, wrapped ``{"data": [...]}`` files, or (not ``multi_line``) JSON Lines."""
    raw = spark.read.schema(f"{INSTRUCTION_ROW}, data array<struct<{_fields()}>>").json(path, multiLine=multi_line)
    return unwrap_instructions(raw)


def _fields() -> str:
    return "instruction:string,input:string,output:string"


def unwrap_instructions(raw: DataFrame) -> DataFrame:
    own = F.array(F.struct("instruction", "input", "output"))
    rows = raw.select(F.inline(F.coalesce("data", own)))
    return rows.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("instruction", "input", "output")])


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """``file, name, html`` of all saved pages under a folder; undecodable bytes are dropped, U+FFFD in a file stays."""
    raw = whole_text(spark, path, "*.html")
    # a genuine U+FFFD is put aside while what decoding replaces is dropped
    kept = F.replace(F.col("value"), F.lit("\ufffd"), F.lit(SET_ASIDE))
    html = F.replace(F.replace(F.make_valid_utf8(kept), F.lit("\ufffd"), F.lit("")), F.lit(SET_ASIDE), F.lit("\ufffd"))
    return raw.select("file", "name", html.alias("html"))


def read_exports(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """``file, name, raw`` of raw export blobs."""
    return whole_text(spark, path, glob).withColumnRenamed("value", "raw")


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """Evaluation rows written line by line: ``prompt, expected, generated``; batches that ``append_json`` names count once."""
    names = ["prompt", "expected", "generated"]
    raw = spark.read.schema(", ".join(f"{n} string" for n in names)).option("recursiveFileLookup", True).json(path)
    return only_committed(raw.select(*names, _file()[0]), path, F.col("file")).drop("file")


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    """Training-log lines of one or more runs: ``run, name, step, loss, lr, eval_loss``; the run is the full path of its file. Batches that
    ``append_json`` names count once."""
    lines = spark.read.schema("step bigint, loss double, lr double, eval_loss double").option("recursiveFileLookup", True)
    raw = lines.json(path).select(_file()[0].alias("run"), _file()[1], "step", "loss", "lr", "eval_loss")
    return only_committed(raw, path, F.col("run"))
