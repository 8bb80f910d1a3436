"""Folds over everything before a row in its group, for groups of any size and order values of any spread.

A plain window puts a whole group into one task. When one conversation (or run, or source) holds a third of the table that task
never ends, so rows are cut into blocks by their rank in (group, order), as a sample sort does:

1. cuts are taken from a bounded sample of the keys, so that blocks hold about equally many rows, whatever the order values are
   and however the rows are dealt over groups;
2. every row finds its block by binary search among the cuts, and one exchange deals the blocks over the tasks;
3. a window per (block, group) folds inside the block. Only groups that a cut falls into need more: the last row of each of
   their blocks is a summary, the summaries (at most two a cut) are folded over the blocks before, and what a block is to be told is joined back.

There is one plan for groups of any size. Cuts decide where rows go and never what comes out, so they may be taken from another, cheaper
table with keys alike (``sample``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

SPAN = 2_048  # rows below which no block is cut
PER_TASK = 32  # blocks a shuffle partition, so that tasks of hashed blocks are about even
PER_BLOCK = 16  # sampled keys a block
MOST = 65_536  # blocks of a table

# What is folded over the rows before one in a window {w}, and how an earlier result goes with a later one.
BEFORE = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
INSIDE = {
    "prev": "lag({v}) OVER ({w})",
    "last": f"last({{v}}, true) OVER ({{w}} {BEFORE})",
    "sum": f"sum({{v}}) OVER ({{w}} {BEFORE})",
    "min": f"min({{v}}) OVER ({{w}} {BEFORE})",
    "max": f"max({{v}}) OVER ({{w}} {BEFORE})",
}
JOINED = {
    "prev": "{later}",
    "last": "coalesce({later}, {earlier})",
    "sum": "coalesce({earlier} + {later}, {earlier}, {later})",
    "min": "least({earlier}, {later})",
    "max": "greatest({earlier}, {later})",
}

# One statement: it is also much quicker to build than its hundreds of column objects.
PLACED = """
WITH
keys AS (SELECT {key} AS k FROM {{sample}} WHERE {present}),
wanted AS (SELECT least(ceil(count(*) / {span}), {most}) AS blocks, count(*) AS n FROM keys),
share AS (SELECT {per_block} * 2147483648D * blocks / n AS bound FROM wanted),
-- a key is drawn by its hash, about {per_block} a block, so the array below is bounded by the number of blocks
drawn AS (
    SELECT array_sort(collect_list(k)) AS ks, (SELECT blocks FROM wanted) AS n
    FROM keys WHERE pmod(xxhash64(k), 2147483648) < (SELECT bound FROM share)),
cuts AS (
    SELECT CASE WHEN n > 1 THEN array_distinct(
        transform(sequence(1, CAST(n AS INT) - 1), i -> get(ks, CAST(floor(i * size(ks) / n) AS INT))))
        ELSE slice(ks, 1, 0) END AS cuts FROM drawn),
found AS (SELECT *, {key} AS _key, (SELECT cuts FROM cuts) AS _cuts FROM {{df}} WHERE {present}),
-- how many cuts are not above the key, by binary search
placed AS (
    SELECT *, aggregate(array({steps}), 0, (at, s) -> CASE WHEN get(_cuts, at + s - 1) <= _key THEN at + s ELSE at END) AS _block
    FROM found)"""
FOLD = PLACED + """,
-- edge: 1 where the group has begun in an earlier block, 2 where it may go on in a later one, 3 for both; one number, so that both
-- readers of this exchange need the same columns
dealt AS (
    SELECT /*+ REPARTITION(_block) */ {columns}, {values}, _block,
        CASE WHEN _block > 0 AND {begun} THEN 1 ELSE 0 END + CASE WHEN {goes_on} THEN 2 ELSE 0 END AS _edge
    FROM placed),
inside AS (
    SELECT *, {inside}, row_number() OVER ({own}) = 1 AS _first, lead(1) OVER ({own}) IS NULL AS _last FROM dealt),
-- what is compared at last is 0; it names every column, so that this branch reads the exchange of the other instead of making its own
ends AS (SELECT {group}, _block, _edge, {upto} FROM inside WHERE _last AND _edge > hash({columns}) % 1),
told AS (SELECT _edge, _block, {told} FROM ends),
-- at most one group of a block has begun in an earlier one
heard AS (SELECT _block, {heard} FROM told WHERE _edge % 2 = 1)
SELECT {columns}, {whole} FROM inside LEFT JOIN heard USING (_block)
"""
# the last block of the group: how many cuts are in no later group
SENT = PLACED + """,
ending AS (
    SELECT {columns}, _block,
        aggregate(array({steps}), 0, (at, s) -> CASE WHEN {not_later} THEN at + s ELSE at END) AS _upto
    FROM placed)
SELECT {columns}, _block = _reader AS _own, _reader FROM ending LATERAL VIEW explode(sequence(_block, _upto)) AS _reader
"""


def _quoted(name: str) -> str:
    return f"`{name}`"


def _placing(df: DataFrame, group: Sequence[str], order: str, span: int) -> dict[str, object]:
    """What PLACED has open, and the columns."""
    keys = [_quoted(c) for c in [*group, order]]
    return {
        "key": f"named_struct({', '.join(f'{chr(39)}k{i}{chr(39)}, {c}' for i, c in enumerate(keys))})",
        "present": " AND ".join(f"{c} IS NOT NULL" for c in keys),
        "span": span,
        "most": min(MOST, PER_TASK * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))),
        "per_block": PER_BLOCK,
        "steps": ", ".join(str(2**i) for i in reversed(range(MOST.bit_length()))),
        "columns": ", ".join(map(_quoted, df.columns)),
    }


def sent_on(
    df: DataFrame, group: Sequence[str], order: str, span: int = SPAN, sample: DataFrame | None = None
) -> DataFrame:
    """Rows for readers that want all earlier rows of a group at once: every row in its own block (``_reader``, a number; ``_own`` is
    true) and once more in every later block of its group, which a binary search among the cuts finds without a look at other rows.

    Blocks are those of ``fold_before``, and so are the arguments. A group within one block is not copied; one of n rows is copied about
    n / (2 * ``span``) times. The rows are not dealt out yet; a later block may turn out to have no row of its own.
    """
    given = _placing(df, group, order, span)
    fields = [(f"'k{i}'", f"k{i}", _quoted(c)) for i, c in enumerate(group)]
    cut = ", ".join(f"{name}, get(_cuts, at + s - 1).{k}" for name, k, _ in fields)
    row = ", ".join(f"{name}, {c}" for name, _, c in fields)
    # past the last cut there is none
    given["not_later"] = f"at + s <= size(_cuts) AND named_struct({cut}) <= named_struct({row})"
    return df.sparkSession.sql(SENT.format(**given), df=df, sample=df if sample is None else sample)


def fold_before(
    df: DataFrame,
    group: Sequence[str],
    order: str,
    folds: dict[str, tuple[str, Column]],
    span: int = SPAN,
    sample: DataFrame | None = None,
) -> DataFrame:
    """Add, per name, a fold over the earlier rows of the group: ``prev`` (the row before), ``last`` non-null, ``sum``,
    ``min`` or ``max``.

    ``order`` must be unique in its group. NULL where no earlier row counts. Rows without a group or order value have no place in
    any group and are left out. ``sample`` is a table with the columns of ``group`` and ``order`` to take cuts from instead of ``df``, for
    a ``df`` that is dear to compute: the keys are read twice before the rows are. Blocks have about ``span`` rows at least.
    """
    q, placing = _quoted, _placing(df, group, order, span)
    group = [q(c) for c in group]
    own = f"PARTITION BY _block, {', '.join(group)} ORDER BY {q(order)}"
    blocks = f"PARTITION BY {', '.join(group)} ORDER BY _block"
    given = {name: q(f"_v{i}") for i, name in enumerate(folds)}
    kinds = {name: kind for name, (kind, _) in folds.items()}
    same = lambda at: " AND ".join(f"coalesce(get(_cuts, {at}).k{i} = {c}, false)" for i, c in enumerate(group))

    def full(name: str, kind: str) -> str:
        earlier, later = f"CASE WHEN _edge % 2 = 1 THEN `_in_{name}` END", f"`_own_{name}`"
        if kind == "prev":
            return f"CASE WHEN _first THEN {earlier} ELSE {later} END AS {q(name)}"
        return f"{JOINED[kind].format(earlier=earlier, later=later)} AS {q(name)}"

    def upto(name: str, kind: str) -> str:
        earlier, later = f"`_own_{name}`", given[name]
        return f"{JOINED[kind].format(earlier=earlier, later=later)} AS `_at_{name}`"

    def over(name: str, kind: str, value: str, window: str) -> str:
        return INSIDE[kind].format(v=value, w=window)

    text = FOLD.format(
        **placing,
        values=", ".join(given.values()),
        begun=same("_block - 1"),
        goes_on=same("_block"),
        group=", ".join(group),
        own=own,
        inside=", ".join(f"{over(n, k, given[n], own)} AS `_own_{n}`" for n, k in kinds.items()),
        upto=", ".join(upto(n, k) for n, k in kinds.items()),
        told=", ".join(f"{over(n, k, f'`_at_{n}`', blocks)} AS `_in_{n}`" for n, k in kinds.items()),
        heard=", ".join(f"`_in_{n}`" for n in kinds),
        whole=", ".join(full(n, k) for n, k in kinds.items()),
    )
    valued = df.withColumns({f"_v{i}": value for i, (_, value) in enumerate(folds.values())})
    return df.sparkSession.sql(text, df=valued, sample=df if sample is None else sample)
