"""Naming an intermediate value inside one expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body uses it.

    Columns are trees: a value used three times is written, and inside lambdas evaluated, three times.
    """
    return F.get(F.transform(F.array(value), lambda v: body(v)), F.lit(0))
