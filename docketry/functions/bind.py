"""Naming an intermediate value inside an expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once for each row, however often the body uses it.

    Expressions inside lambdas are not shared by the planner, so a long chain that is used five times there would run five times.
    """
    return F.get(F.transform(F.array(value), lambda v: body(v)), F.lit(0))
