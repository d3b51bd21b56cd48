"""Name an intermediate value inside an expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once.

    A lambda that refers to an outer expression computes it for every element;
    referring to a lambda variable does not.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
