"""Token counts of a SentencePiece BPE model, huge documents in parts.

A document up to ``whole`` characters is encoded by the library in one go. A longer one is cut into chunks of ``step`` characters that
run ``overlap`` characters into the next; the chunks are dealt over the cluster, encoded apart with the offsets of their token ends, and
spliced where two neighbours agree.

Why agreement proves the splice: BPE merges the best pair anywhere, leftmost first, until none is left. Let chunks A and B both
have token boundaries at offsets p < q of their common text. Follow the encoder over the joint text up to the first merge that crosses p or q.
Until then the text left of q and the text right of p each saw only merges of their own, in their own best-first order, which is the order
in which A alone works left of q (it never crosses q) and B alone right of p (it never crosses p). A merge across q, not across p, lies right of
p, so B would have made it too, but q is a boundary of B; one across p lies left of q, so A would have made it. So there is none, and the
joint encoding is A's up to q and B's after it. Two common boundaries in an overlap are therefore enough; one is not. Overlaps lie apart
(``overlap <= step``), so splices do not disturb each other.

Where some overlap of a document has no two common boundaries, its chunks and overlaps are widened fourfold and it is tried again, in the
end as one chunk, so every document gets its count.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnloom.llm import common

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
WHOLE = 32_768
STEP = 16_384
OVERLAP = 128
WIDEN = 4
SLICE = 500_000  # characters that are encoded at a time
SPACE = "▁"

CHUNKS = "key_a long, key_b long, part long, final boolean, chunk string"
ENCODED = (
    "key_a long, key_b long, part long, final boolean, n long, "
    "head_at array<int>, head_n array<int>, tail_at array<int>, tail_n array<int>"
)


def shipped(spark: SparkSession, model: str) -> Broadcast[bytes]:
    """The model file's bytes, read on the driver (a vocabulary file: its size does not depend on any table)."""
    with open(model, "rb") as file:
        content = file.read()
    probe = sentencepiece.SentencePieceProcessor(model_proto=content)
    # what the proof and the offsets rest on: BPE, whose normaliser leaves all but the space and adds one in front
    odd = "   Ａé  x\t\n "
    seen = probe.decode_pieces(probe.encode(odd, out_type=str))
    if seen != odd or probe.encode("a", out_type=str)[0][0] != SPACE or not probe.is_byte(probe.piece_to_id("<0x00>")):
        raise ValueError("the model normalises text, adds no space in front or has no byte pieces")
    return spark.sparkContext.broadcast(content)


def slices(texts: list[str], most: int = SLICE) -> Iterator[list[str]]:
    """``texts`` in runs of at most ``most`` characters (a longer text is a run of its own)."""
    run, size = [], 0
    for text in texts:
        if run and size + len(text) > most:
            yield run
            run, size = [], 0
        run.append(text)
        size += len(text)
    if run:
        yield run


def normal_bytes(text: str) -> int:
    """Bytes of a text after normalising: a space becomes U+2581."""
    return len(text.encode()) + 2 * text.count(" ")


def piece_bytes(model: sentencepiece.SentencePieceProcessor) -> np.ndarray:
    return np.array(
        [1 if model.is_byte(i) else len(model.id_to_piece(i).encode()) for i in range(model.get_piece_size())], dtype=np.int64
    )


def _cut(texts: DataFrame, step: int, overlap: int) -> DataFrame:
    """Chunks of every text, each with ``overlap`` characters of the next; a text is walked once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                a, b, text = (batch.column(i)[row].as_py() for i in range(3))
                starts = list(range(0, max(len(text) - overlap, 1), step))
                for part, at in enumerate(starts):
                    yield pa.RecordBatch.from_pylist(
                        [
                            {
                                "key_a": a,
                                "key_b": b,
                                "part": part,
                                "final": part == len(starts) - 1,
                                "chunk": text[at : at + step + overlap] if part < len(starts) - 1 else text[at:],
                            }
                        ],
                        schema=schema,
                    )

    schema = pa.schema(
        [("key_a", pa.int64()), ("key_b", pa.int64()), ("part", pa.int64()), ("final", pa.bool_()), ("chunk", pa.string())]
    )
    return texts.mapInArrow(run, CHUNKS)


def _encoded(chunks: DataFrame, model: Broadcast[bytes], step: int, overlap: int) -> DataFrame:
    """Tokens of every chunk, with the token ends inside its two overlaps: their offset there, and the tokens up to them."""
    ints = pa.list_(pa.int32())
    schema = pa.schema([("n", pa.int64()), ("head_at", ints), ("head_n", ints), ("tail_at", ints), ("tail_n", ints)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = sentencepiece.SentencePieceProcessor(model_proto=model.value)
        sizes = piece_bytes(library)

        def ends(chunk: str, part: int, final: bool) -> dict:
            ids = np.array(library.encode(chunk), dtype=np.int64)
            at = np.cumsum(sizes[ids]) - len(SPACE.encode())  # without the space that the library puts in front
            upto = np.arange(1, len(ids) + 1)
            none = np.zeros(len(ids), dtype=bool)
            head = none if part == 0 else (at >= 0) & (at <= normal_bytes(chunk[:overlap]))
            before = 0 if final else normal_bytes(chunk[:step])
            tail = none if final else at >= before
            return {
                "n": len(ids), "head_at": at[head], "head_n": upto[head], "tail_at": at[tail] - before, "tail_n": upto[tail]
            }

        for batch in batches:
            parts, finals = batch.column("part").to_pylist(), batch.column("final").to_pylist()
            made = [ends(c.as_py(), p, f) for c, p, f in zip(batch.column("chunk"), parts, finals, strict=True)]
            kept = [batch.column(c) for c in ("key_a", "key_b", "part", "final")]
            new = pa.RecordBatch.from_pylist(made, schema=schema)
            yield pa.RecordBatch.from_arrays([*kept, *new.columns], names=["key_a", "key_b", "part", "final", *schema.names])

    return chunks.mapInArrow(run, ENCODED)


def _spliced(encoded: DataFrame) -> DataFrame:
    """``key_a, key_b, n, whole``: tokens of every document, and whether all its overlaps agree.

    A chunk meets the next by (document, number), so the chunks of one document are dealt over all tasks.
    """
    key = ["key_a", "key_b", "part"]
    tails = encoded.filter("not final").select(*key, "tail_at", "tail_n")
    heads = encoded.filter("part > 0").select("key_a", "key_b", (F.col("part") - 1).alias("part"), "head_at", "head_n")
    common_ends = F.array_intersect("tail_at", "head_at")
    place = lambda at, n: F.element_at(n, F.array_position(at, F.col("_q")).cast("int"))
    met = (
        tails.join(heads, key)
        .withColumn("_both", common_ends)
        .withColumn("_q", F.when(F.size("_both") >= 2, F.array_max("_both")))
        .select("key_a", "key_b", (place("tail_at", "tail_n") - place("head_at", "head_n")).cast("long").alias("n"))
    )
    last = encoded.filter("final").select("key_a", "key_b", "n")
    return met.union(last).groupBy("key_a", "key_b").agg(
        F.sum("n").alias("n"), F.bool_and(F.col("n").isNotNull()).alias("whole")
    )


def _huge_counts(texts: DataFrame, model: Broadcast[bytes], step: int, overlap: int) -> DataFrame:
    """``key_a, key_b, n`` of every different text of ``key_a, key_b, text``."""
    done, left = [], texts
    while True:
        # copies of a text give the same chunks, which become one before they are shuffled
        chunks = _cut(left, step, overlap).groupBy("key_a", "key_b", "part", "final").agg(F.first("chunk").alias("chunk"))
        counted = common.settle(_spliced(common.settle(_encoded(chunks, model, step, overlap))))
        done.append(counted.filter("whole").select("key_a", "key_b", "n"))
        failed = counted.filter("not whole").select("key_a", "key_b")
        if failed.isEmpty():
            return reduce(DataFrame.union, done)
        left = texts.join(failed, ["key_a", "key_b"], "left_semi")
        step, overlap = WIDEN * step, WIDEN * overlap


def count_tokens(
    docs: DataFrame,
    text: str = "text",
    model: str = MODEL,
    whole: int = WHOLE,
    step: int = STEP,
    overlap: int = OVERLAP,
    n_bytes: str = "n_bytes",
    n_tokens: str = "n_tokens",
) -> DataFrame:
    """``docs`` with ``n_bytes`` (UTF-8) and ``n_tokens``, exactly the library's count for the whole text, without added tokens.

    A null text counts as empty: no bytes and no tokens. Special strings in a text are ordinary text. Repeated rows keep their own rows;
    columns named like the two outputs are replaced, all others kept; an empty table stays empty. Rows up to ``whole`` characters are never
    shuffled; of longer ones each different text is cut, dealt out and spliced once. Reads ``docs`` twice and runs the longer
    texts at once; the counts come lazily.
    """
    if not 0 < overlap <= step:
        raise ValueError("an overlap has at least one character and at most those of a step")
    shared = shipped(docs.sparkSession, model)

    @F.pandas_udf("long")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        library = sentencepiece.SentencePieceProcessor(model_proto=shared.value)
        for texts in batches:
            yield pd.Series([len(ids) for run in slices(texts.tolist()) for ids in library.encode(run, num_threads=1)], dtype="int64")

    kept = docs.drop(n_bytes, n_tokens)
    filled = F.coalesce(F.col(text), F.lit(""))
    size = F.octet_length(filled).cast("long")
    short = F.length(filled) <= whole
    rows = kept.filter(short).select("*", size.alias(n_bytes), counted(filled).alias(n_tokens))

    a, b, n = (common.fresh(name, kept.columns) for name in ("key_a", "key_b", "n"))
    keyed = kept.filter(~short).withColumns(dict(zip((a, b), common.text_key(F.col(text)), strict=True)))
    texts = keyed.select(F.col(a).alias("key_a"), F.col(b).alias("key_b"), F.col(text).alias("text"))
    counts = _huge_counts(texts, shared, step, overlap).toDF(a, b, n)
    long_rows = keyed.join(counts, [a, b]).select(*kept.columns, size.alias(n_bytes), F.col(n).alias(n_tokens))
    return rows.union(long_rows)
