"""Evaluate an expression once and use it often."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with the value computed once per row.

    An expression used within a lambda is computed again for every element; a lambda's own
    variable isn't, so the value is bound as the single element of an array.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
