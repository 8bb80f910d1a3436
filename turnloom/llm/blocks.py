"""Folds over everything before a row in its group, for groups of any size.

A plain window puts a whole group into one task. When one conversation (or run, or source) holds a third
of the table that task never ends, so the group is cut into blocks of ``span`` order values:

1. a window per (group, block) folds inside the block;
2. the last row of every block, one row per block, is folded over the blocks of the group, again in blocks;
3. the carried value is joined back by (group, block), on the partitioning the first window already has.

With two levels the only window over a whole group sees one short row per ``span * span`` order values. There is one plan
for groups of any size; where no group has a second block, nothing is carried.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

SPAN = 16_384
LEVELS = 2


def _over(kind: str, value: Column, window: WindowSpec) -> Column:
    before = window.rowsBetween(Window.unboundedPreceding, -1)
    if kind == "prev":
        return F.lag(value).over(window)
    if kind == "last":
        return F.last(value, ignorenulls=True).over(before)
    return {"sum": F.sum, "min": F.min, "max": F.max}[kind](value).over(before)


def _join(kind: str, earlier: Column, later: Column) -> Column:
    if kind == "last":
        return F.coalesce(later, earlier)
    if kind == "sum":
        return F.coalesce(earlier + later, earlier, later)
    return {"min": F.least, "max": F.greatest}[kind](earlier, later)


def fold_before(
    df: DataFrame,
    group: Sequence[str],
    order: str,
    folds: dict[str, tuple[str, Column]],
    span: int = SPAN,
    levels: int = LEVELS,
) -> DataFrame:
    """Add, per name, a fold over the earlier rows of the group: ``prev`` (the row before), ``last`` non-null, ``sum``,
    ``min`` or ``max``.

    ``order`` must be an integer column, unique in its group. NULL where no earlier row counts. Rows without a group
    or order value have no place in any group and are left out.
    """
    group = list(group)
    df = df.filter(reduce(and_, [F.col(c).isNotNull() for c in [*group, order]]))

    in_block, starts, ends = f"_block{levels}", f"_starts{levels}", f"_ends{levels}"
    # both branches below read this one shuffle; a block that could be NULL would get a filter on one side only
    block = Window.partitionBy(*group, in_block).orderBy(order)
    inside = (
        df.withColumn(in_block, F.expr(f"coalesce(`{order}` div {span}, 0)"))
        .repartition(*group, in_block)
        .withColumns(
            {name: _over(kind, value, block) for name, (kind, value) in folds.items()}
            | {starts: F.lag(order).over(block).isNull(), ends: F.lead(order).over(block).isNull()}
        )
    )
    at_end = {
        name: value if kind == "prev" else _join(kind, F.col(name), value) for name, (kind, value) in folds.items()
    }
    carry = {f"_in{levels}_{name}": (kind, F.col(f"_at_{name}")) for name, (kind, _) in folds.items()}
    tails = inside.filter(ends).select(*group, in_block, *[value.alias(f"_at_{name}") for name, value in at_end.items()])
    if levels > 1:
        carried = fold_before(tails, group, in_block, carry, span, levels - 1)
    else:
        blocks = Window.partitionBy(*group).orderBy(in_block)
        carried = tails.withColumns({name: _over(kind, value, blocks) for name, (kind, value) in carry.items()})
    # the first block of a group is told nothing
    carried = carried.filter(reduce(or_, [F.col(name).isNotNull() for name in carry])).select(*group, in_block, *carry)

    def whole(name: str, kind: str) -> Column:
        earlier, later = F.col(f"_in{levels}_{name}"), F.col(name)
        return F.when(F.col(starts), earlier).otherwise(later) if kind == "prev" else _join(kind, earlier, later)

    return (
        inside.join(carried, [*group, in_block], "left")
        .withColumns({name: whole(name, kind) for name, (kind, _) in folds.items()})
        .drop(in_block, starts, ends, *carry)
    )
