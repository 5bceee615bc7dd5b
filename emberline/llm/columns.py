"""Column helpers of the operators that use DataFrame functions alone."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also where ``body`` uses it within a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
