"""SentencePiece (BPE with byte fallback) encoding and decoding by suffix-array matching.

The distinct units of a batch (a word with the space before it) are laid end to end and indexed by a suffix array. Every
piece of the vocabulary is looked up there by binary search, which yields all its occurrences as a range. The
occurrences are the edges of a graph over text positions; sorted by position they are relaxed from left to right:
an edge extends the encoding that ends where it starts if the two pieces stand next to each other in BPE. For every
position exactly one edge passes, so what arrives at the end of a unit is its BPE encoding. (Scores of a BPE model are
merge priorities, not weights of a path, so "passes" is this test and not a sum.)

Two neighbours are compatible when no merge across their border would have come before the merges that made them. Pieces hold
a space only at their start, so units are independent; runs of spaces, which share one priority, are merged last.
"""

from __future__ import annotations

import pickle
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import cached_property, lru_cache
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark import Broadcast, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
SLICE = 200_000  # characters indexed at a time
KNOWN = 600_000  # encoded units kept while a task goes on
NEVER = np.iinfo(np.int64).max


class Vocabulary:
    """What matching needs of a model: pieces, merge ranks, the last merge of each piece, ranks of mergeable pairs."""

    def __init__(self, path: str = MODEL) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.bytes = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], dtype=np.int32)
        plain = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        text = {i: model.id_to_piece(i) for i in plain}
        if any(SPACE in t.lstrip(SPACE) for t in text.values()):
            raise ValueError("a piece has a space after its start")
        self.size, self.unknown = size, size  # id of a character that is no piece
        self.spaces = {len(t): i for i, t in text.items() if not t.strip(SPACE)}
        self.space = self.spaces[1]
        self.of = {t: i for i, t in text.items() if len(t) == 1 or t.strip(SPACE)}
        merged = sorted((i for t, i in self.of.items() if len(t) > 1), key=model.get_score, reverse=True)
        self.rank = np.zeros(size + 1, dtype=np.int64)
        self.rank[merged] = np.arange(1, len(merged) + 1)
        self.left, self.right = np.arange(size + 1), np.arange(size + 1)
        for i in list(merged):
            split = self._last_merge(text[i])
            if split is None:
                del self.of[text[i]]
                self.rank[i] = 0
            else:
                self.left[i], self.right[i] = split
        pairs = {}
        for t, i in self.of.items():
            for k in range(1, len(t)):
                if t[:k] in self.of and t[k:] in self.of:
                    pairs[self.of[t[:k]] * (size + 1) + self.of[t[k:]]] = self.rank[i]
        self.pairs = np.array(sorted(pairs), dtype=np.int64)
        self.pair_rank = np.array([pairs[k] for k in self.pairs.tolist()] + [NEVER], dtype=np.int64)
        order = sorted(self.of)
        self.longest = max(map(len, order))
        self.text = np.array(order, dtype=f"U{self.longest + 1}")
        self.ids = np.array([self.of[t] for t in order], dtype=np.int64)
        self.lengths = np.char.str_len(self.text)
        breaks = "".join(c for c in "\n\t\r" if c not in self.of)
        self.unit = re.compile(f"{SPACE}?[^{SPACE}{breaks}]+|{SPACE}|[{breaks}]" if breaks else f"{SPACE}?[^{SPACE}]+|{SPACE}")
        table = [b"" for _ in range(size)]
        for i, t in text.items():
            table[i] = t.replace(SPACE, " ").encode()
        for b, i in enumerate(self.bytes.tolist()):
            table[i] = bytes([b])
        self.table = np.array(table, dtype=object)

    def _last_merge(self, piece: str) -> tuple[int, int] | None:
        """The two pieces that BPE merges last in making ``piece``; None if it makes something else of the characters."""
        parts = list(piece)
        while len(parts) > 1:
            ranks = [(self.rank[self.of[t]] if (t := a + b) in self.of else NEVER) for a, b in zip(parts, parts[1:], strict=False)]
            k = int(np.argmin(ranks))
            if ranks[k] == NEVER:
                return None
            if len(parts) == 2:
                return self.of[parts[0]], self.of[parts[1]]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return None

    def space_run(self, n: int) -> list[int]:
        """Encoding of ``n`` spaces no word took: merges of one priority, so leftmost first."""
        parts = [1] * n
        while True:
            k = next((k for k in range(len(parts) - 1) if parts[k] + parts[k + 1] in self.spaces), None)
            if k is None:
                return [self.spaces[p] for p in parts]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]

    @cached_property
    def single(self) -> np.ndarray:
        """Whether a character is a piece, by code point."""
        known = np.zeros(0x110000, dtype=bool)
        known[[ord(t) for t in self.of if len(t) == 1]] = True
        return known

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether BPE of the joined text of two pieces is these two pieces, for arrays of pairs.

        The merges that made the pair are undone, last first; at every stage the pieces at the border must not have a merge
        that would have come before the one undone. Of equal merges the left one comes first.
        """
        ok, open_ = np.ones(len(a), dtype=bool), np.arange(len(a))
        limit = np.full(len(a), NEVER)
        while len(open_):
            key = a * (self.size + 1) + b
            at = np.searchsorted(self.pairs, key)
            at[at == len(self.pairs)] = len(self.pairs) - 1
            across = np.where(self.pairs[at] == key, self.pair_rank[at], NEVER)
            bad = across < limit
            ok[open_[bad]] = False
            ra, rb = self.rank[a], self.rank[b]
            go = ~bad & ((ra > 0) | (rb > 0))
            open_, a, b, ra, rb = open_[go], a[go], b[go], ra[go], rb[go]
            first = ra > rb
            limit = np.where(first, ra, rb + 1)
            a, b = np.where(first, self.right[a], a), np.where(first, b, self.left[b])
        return ok


@lru_cache(maxsize=4)
def vocabulary_of(model: str) -> Vocabulary:
    return Vocabulary(model)


def shipped(spark: SparkSession, model: str) -> Broadcast[bytes]:
    """One model, a few MB, in a form that needs no installed package on the executors."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(vocabulary_of(model)))


def suffix_array(codes: np.ndarray, depth: int) -> np.ndarray:
    """Positions in the order of the ``depth`` characters from there on, by prefix doubling from as many characters as fit into a number."""
    n = len(codes)
    present = np.zeros(codes.max() + 1, dtype=np.int64)
    present[codes] = 1
    small = np.cumsum(present)[codes]  # from 1; 0 is past the end
    bits = int(small.max()).bit_length()
    step = min(depth, 62 // bits, n)  # a batch late in a task may have a few new characters only
    key = np.zeros(n, dtype=np.int64)
    for i in range(step):
        key <<= bits
        key[: n - i] |= small[i:]
    order = np.argsort(key)
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.cumsum(np.concatenate([[0], key[order][1:] != key[order][:-1]]))
    while step < depth and rank[order[-1]] < n - 1:
        key = rank * (n + 1)
        key[:-step] += rank[step:] + 1
        order = np.argsort(key)
        rank[order] = np.cumsum(np.concatenate([[0], key[order][1:] != key[order][:-1]]))
        step *= 2
    return order


def encode_units(vocabulary: Vocabulary, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of all units one after another, and how many each has. Every unit ends in a separator character."""
    v = vocabulary
    lengths = np.array([len(u) for u in units])
    codes = np.frombuffer("\0".join(units).encode("utf-32-le") + b"\0\0\0\0", dtype=np.int32).astype(np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths + 1)])[:-1]
    order = suffix_array(codes, v.longest)

    # every piece by binary search among the suffixes, cut to the longest piece
    padded = np.concatenate([codes, np.zeros(v.longest, dtype=np.int64)]).astype(np.uint32)
    windows = np.lib.stride_tricks.sliding_window_view(padded, v.longest)[order]
    suffixes = np.ascontiguousarray(windows).view(f"U{v.longest}").ravel()
    low = np.searchsorted(suffixes, v.text)
    high = np.searchsorted(suffixes, np.char.add(v.text, "\U0010ffff"))
    met = np.maximum(high - low, 0)
    which = np.repeat(np.arange(len(v.text)), met)
    begin = order[np.repeat(low - np.cumsum(met) + met, met) + np.arange(met.sum())]
    piece, end = v.ids[which], begin + v.lengths[which]

    # a character that is no piece is an edge of its own; so is a NUL, whatever the separators are
    unit_of = np.repeat(np.arange(len(units)), lengths + 1)
    inside = np.ones(len(codes), dtype=bool)
    inside[starts + lengths] = False
    odd = np.nonzero(inside & ~v.single[codes])[0]
    begin = np.concatenate([begin, odd])
    end = np.concatenate([end, odd + 1])
    piece = np.concatenate([piece, np.full(len(odd), v.unknown)])

    # relax edges by position: the n-th characters of all units together
    place = end - starts[unit_of[begin]]
    by_place = np.argsort(place, kind="stable")
    begin, end, piece = begin[by_place], end[by_place], piece[by_place]
    cuts = np.searchsorted(place[by_place], np.arange(1, lengths.max(initial=0) + 2))
    last = np.full(len(codes) + 1, -1)  # piece that ends the encoding up to a position; -1 at a unit's start
    come = np.zeros(len(codes) + 1, dtype=np.int64)
    for a, b in zip(cuts, cuts[1:], strict=False):
        before = last[begin[a:b]]
        ok = before < 0
        inner = np.nonzero(~ok)[0]
        ok[inner] = v.compatible(before[inner], piece[a:b][inner])
        ends = end[a:b][ok]
        last[ends], come[ends] = piece[a:b][ok], begin[a:b][ok]

    # walk back from the ends of all units at once
    at, owner, found = starts + lengths, np.arange(len(units)), []
    while True:
        open_ = at > starts[owner]
        at, owner = at[open_], owner[open_]
        if not len(at):
            break
        found.append((owner, come[at], last[at]))
        at = come[at]
    if not found:
        return np.empty(0, dtype=np.int64), np.zeros(len(units), dtype=np.int64)
    owner, place, ids = (np.concatenate(x) for x in zip(*found, strict=True))
    forward = np.argsort(place, kind="stable")
    owner, place, ids = owner[forward], place[forward], ids[forward]

    unknown = ids == v.unknown
    if unknown.any():  # the bytes of the character instead
        utf8 = [np.frombuffer(chr(c).encode(), dtype=np.uint8) for c in codes[place[unknown]].tolist()]
        times = np.ones(len(ids), dtype=np.int64)
        times[unknown] = [len(u) for u in utf8]
        ids, owner, unknown = np.repeat(ids, times), np.repeat(owner, times), np.repeat(unknown, times)
        ids[unknown] = v.bytes[np.concatenate(utf8)]
    return ids, np.bincount(owner, minlength=len(units))


class Encoder:
    """Encodes lists of texts; units met before in the task are taken from memory."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.v = vocabulary
        self.forget()

    def forget(self) -> None:
        self.index = defaultdict(count().__next__)  # unit -> its number; a new one gets the next
        self.flat, self.counts = np.empty(0, dtype=np.int32), np.empty(0, dtype=np.int64)

    def learn(self, units: list[str]) -> None:
        at = 0
        flats, counts = [self.flat], [self.counts]
        while at < len(units):
            upto, chars = at, 0
            while upto < len(units) and (upto == at or chars + len(units[upto]) < SLICE):
                chars += len(units[upto]) + 1
                upto += 1
            ids, n = encode_units(self.v, units[at:upto])
            flats.append(ids.astype(np.int32))
            counts.append(n)
            at = upto
        self.flat, self.counts = np.concatenate(flats), np.concatenate(counts)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and where each text's ids start and end."""
        if len(self.index) > KNOWN:
            self.forget()
        index, known = self.index, len(self.index)
        split, rows = self.v.unit.findall, []
        for text in texts:
            units = split(SPACE + text.replace(" ", SPACE)) if text else []
            rows.append(np.fromiter(map(index.__getitem__, units), dtype=np.int32, count=len(units)))
        if len(index) > known:
            self.learn(list(index)[known:])
        units = np.concatenate([np.empty(0, dtype=np.int32), *rows])
        starts = np.cumsum(self.counts) - self.counts
        n = self.counts[units]
        first = np.cumsum(n) - n
        ids = self.flat[np.repeat(starts[units] - first, n) + np.arange(n.sum())]
        bounds = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)
        bounds = np.concatenate([first, [len(ids)]])[bounds]
        return self._spaces(ids, bounds)

    def _spaces(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge runs of single spaces inside each text."""
        lone = np.concatenate([[False], ids == self.v.space, [False]])
        border = np.zeros(len(ids) + 1, dtype=bool)
        border[bounds] = True
        follows = lone[1:-1] & lone[:-2] & ~border[:-1]  # a space after a space of the same text
        if not follows.any():
            return ids, bounds
        heads = np.nonzero(follows & ~np.concatenate([[False], follows[:-1]]))[0] - 1
        tails = np.nonzero(follows & ~np.concatenate([follows[1:], [False]]))[0] + 1
        parts, at, saved = [], 0, np.zeros(len(ids) + 1, dtype=np.int64)
        for a, b in zip(heads.tolist(), tails.tolist(), strict=True):
            run = self.v.space_run(b - a)
            parts += [ids[at:a], np.array(run, dtype=ids.dtype)]
            saved[b] += b - a - len(run)
            at = b
        return np.concatenate([*parts, ids[at:]]), bounds - np.cumsum(saved)[bounds]


def in_steps(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``20 * SLICE`` bytes."""
    at, size = 0, 0
    for i, n in enumerate(pc.binary_length(texts).to_pylist()):
        size += n or 0
        if size >= 20 * SLICE:
            yield at, i + 1
            at, size = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


def joined(table: np.ndarray, ids: np.ndarray) -> str:
    """The text that piece ids stand for."""
    return b"".join(table[ids].tolist()).decode("utf-8", "replace").removeprefix(" ")


def encode(
    docs: DataFrame, text: str = "text", ids: str = "ids", model: str = MODEL, round_trip: str | None = None
) -> DataFrame:
    """``docs`` with ``ids`` (array<int>), exactly what SentencePiece's own encoder gives for the text.

    A null text has null ids, an empty one no ids. Whole texts are encoded, row by row, without a shuffle; a column named
    like ``ids`` is replaced, other columns, repeated rows and an empty table pass through. ``model`` is read on the driver.
    ``round_trip`` names a boolean column: whether the ids decode to the text again (with a space for U+2581; true for a null text),
    found by the worker that has both.
    """
    vocabulary = shipped(docs.sparkSession, model)
    kept = docs.drop(ids, *([round_trip] if round_trip else []))
    fields = [*kept.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType()))]
    schema = T.StructType(fields + ([T.StructField(round_trip, T.BooleanType())] if round_trip else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(pickle.loads(vocabulary.value))
        for batch in batches:
            for a, b in in_steps(batch.column(batch.schema.get_field_index(text))):
                part = batch.slice(a, b - a)
                texts = part.column(part.schema.get_field_index(text)).to_pylist()
                flat, bounds = encoder.encode([t or "" for t in texts])
                lists = pa.ListArray.from_arrays(
                    pa.array(bounds, pa.int32()), pa.array(flat, pa.int32()), mask=pa.array([t is None for t in texts])
                )
                columns, names = [*part.columns, lists], [*part.schema.names, ids]
                if round_trip:
                    table = encoder.v.table
                    pairs = zip(texts, bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)
                    same = [t is None or joined(table, flat[i:j]) == t.replace(SPACE, " ") for t, i, j in pairs]
                    columns, names = [*columns, pa.array(same, pa.bool_())], [*names, round_trip]
                yield pa.RecordBatch.from_arrays(columns, names)

    return kept.mapInArrow(run, schema)


def decode(docs: DataFrame, ids: str = "ids", text: str = "decoded", model: str = MODEL) -> DataFrame:
    """``docs`` with the text that the ids stand for; null ids give null, no ids an empty text, bytes that are no UTF-8
    U+FFFD, and a null id or one outside the vocabulary nothing. A text that has no U+2581 comes back as it was."""
    vocabulary = shipped(docs.sparkSession, model)
    size = vocabulary_of(model).size

    @F.pandas_udf("string")
    def join(lists: pd.Series) -> pd.Series:
        table = pickle.loads(vocabulary.value).table

        def one(values) -> str | None:
            if values is None:
                return None
            values = np.asarray(values, dtype=np.float64)
            values = values[(values >= 0) & (values < size)].astype(np.int64)
            return joined(table, values)

        return pd.Series([one(x) for x in lists], dtype=object)

    return docs.withColumn(text, join(ids))

