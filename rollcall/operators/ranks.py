"""Places in a total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.plans.staging import written

# monotonically_increasing_id: the partition above, the row in it below
_ROW_BITS = 33


def with_rank(frame: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """The rows with their place, from 1, in a total order; equal rows in any order among themselves.

    A range-partitioned sort puts the rows in order, and each is written down with its
    partition and its place in there.  The counts of the partitions before, one row
    for each, are added to that.  No task sees more than its partition, and nothing but these
    counts is looked at together.
    """
    row = F.monotonically_increasing_id()
    placed = frame.orderBy(*order).select(
        F.struct(*[F.col(f"`{c}`") for c in frame.columns]).alias("own"),
        F.shiftright(row, _ROW_BITS).cast("int").alias("part"),
        row.bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("row"),
    )
    placed = written(placed)
    before = F.sum("rows").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = placed.groupBy("part").agg(F.count(F.lit(1)).alias("rows")).select("part", F.coalesce(before, F.lit(0)).alias("before"))
    ranked = placed.join(F.broadcast(parts), "part")  # one row for each sort task
    return ranked.select("own.*", (F.col("before") + F.col("row") + 1).alias(name))
