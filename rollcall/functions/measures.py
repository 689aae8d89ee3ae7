"""Per-record measures handed to every member of the record."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def share_hundredths(size: Column | str) -> Column:
    """``1 / size`` rounded half up to two places, as a whole number of hundredths.

    Whole numbers keep later sums exact and independent of row order.
    """
    size = _as_column(size).cast("bigint")
    return F.call_function("div", F.lit(200) + size, F.lit(2) * size)


def mean_hundredths(total: Column, count: Column) -> Column:
    """``total / count`` rounded half up, both counts of hundredths."""
    return F.call_function("div", F.lit(2) * total + count, F.lit(2) * count)


def co_members(size: Column | str) -> Column:
    """How many other members the record has."""
    return _as_column(size).cast("bigint") - F.lit(1)
