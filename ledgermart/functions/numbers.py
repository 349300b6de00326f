"""Guarded arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double; NULL where the denominator is zero or missing."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def rounded(c: Column, digits: int | None) -> Column:
    return c if digits is None else F.round(c, digits)


def share_percent(hits: Column, rows: Column) -> Column:
    return ratio(F.lit(100.0) * hits, rows)
