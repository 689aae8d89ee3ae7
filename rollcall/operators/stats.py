"""Per-member statistics of fellow-member counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollcall.functions.measures import co_members
from rollcall.operators.members import membership_counts


def member_stats(
    memberships: DataFrame, by: Sequence[str] = (), *, exact_mean: bool = False, times: str | None = None
) -> DataFrame:
    """Mean, median, minimum and maximum of ``n - 1`` per member (and ``by``).

    ``mean`` is the whole part of the mean, ``median`` the upper median; rows
    with a null in ``by`` do not count.  ``exact_mean`` adds ``mean_exact``.
    ``times`` names the column that says how many memberships a row stands for.

    Equal memberships are counted first, before the shuffle where they meet.  The
    counts of a member are then put in order of size and summed up on the way: the
    median is the first by which more than half have come.  A member's counts pass
    through a sort that can spill, and are never one value.
    """
    kept = memberships
    for name in by:
        kept = kept.where(F.col(name).isNotNull())
    key = ["member", *by]
    # what is counted already meets once: rows of one size may come in any number and order
    counted = kept.withColumn("times", F.col(times)) if times else membership_counts(kept, by)
    counted = counted.select(*key, co_members("n").alias("fellows"), "times")
    own = Window.partitionBy(*key).orderBy("fellows")
    so_far = own.rowsBetween(Window.unboundedPreceding, 0)
    whole = own.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    read = counted.select(
        "*",
        F.sum("times").over(so_far).alias("so_far"),
        F.sum("times").over(whole).alias("rows"),
        F.sum(F.col("fellows") * F.col("times")).over(whole).alias("total"),
        F.first("fellows").over(whole).alias("min"),
        F.last("fellows").over(whole).alias("max"),
    )
    half = F.call_function("div", F.col("rows"), F.lit(2).cast("bigint"))
    middle = read.where((F.col("so_far") > half) & (F.col("so_far") - F.col("times") <= half))
    columns = [
        F.call_function("div", F.col("total"), F.col("rows")).alias("mean"),
        F.col("fellows").alias("median"),
        "min",
        "max",
    ]
    if exact_mean:
        columns.append((F.col("total") / F.col("rows")).alias("mean_exact"))
    return middle.select(*key, *columns)
