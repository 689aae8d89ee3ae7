"""Contribution scores and rankings by score."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollcall.functions.measures import mean_hundredths, share_hundredths


def contribution_scores(memberships: DataFrame, *, times: str | None = None) -> DataFrame:
    """Mean of ``1/n`` over a member's records, shares and mean rounded to 2 places.

    A low score means large records, that is, many fellow members.  ``times`` names
    the column that says how many memberships a row stands for.
    """
    stands_for = F.col(times) if times else F.lit(1)
    totals = memberships.groupBy("member").agg(
        F.sum(share_hundredths("n") * stands_for).alias("total"),
        (F.sum(times) if times else F.count(F.lit(1))).alias("rows"),
    )
    hundredths = mean_hundredths(F.col("total"), F.col("rows"))
    return totals.select("member", (hundredths / F.lit(100)).alias("score"))


def sort_scores(scores: DataFrame, *, descending: bool = False) -> DataFrame:
    """Total order by score, ties by member: a range-partitioned sort."""
    direction = F.desc if descending else F.asc
    return scores.orderBy(direction("score"), direction("member"))


def top_bottom(scores: DataFrame, count: int = 100) -> DataFrame:
    """The ``count`` lowest scores beside the ``count`` highest, by rank.

    Lowest is most collaborative.  With fewer members than ``count`` both
    columns hold all of them, so the two lists always have the same ranks.
    The scores are read twice; over tables Spark reuses the shuffle they end in,
    over a record scan it cannot, so hand in a written table there.
    """
    most = _ranked(scores, count, descending=False, name="most_collaborative")
    least = _ranked(scores, count, descending=True, name="least_collaborative")
    return most.join(least, "rank").orderBy("rank")


def _ranked(scores: DataFrame, count: int, *, descending: bool, name: str) -> DataFrame:
    direction = F.desc if descending else F.asc
    order = [direction("score"), direction("member")]
    # the window sees the `count` rows that are the result, not the scores
    chosen = sort_scores(scores, descending=descending).limit(count)
    return chosen.select(
        F.row_number().over(Window.orderBy(*order)).alias("rank"), F.col("member").alias(name)
    )
