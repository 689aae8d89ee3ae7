"""Records and their members.

Two shapes feed every other operator: *records*, one row per record with its
size ``n``, and *memberships*, one row per member of a record, also with ``n``.
A table that holds members in an array column gives both without a shuffle
(``n`` is the array size).  A long table, one row per member, needs its sizes
counted and brought back to the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def explode_members(
    groups: DataFrame, keep: Sequence[str] = (), *, members: str = "members"
) -> DataFrame:
    """One row per member, repeats included, with the record size ``n`` and ``keep``."""
    return groups.select(
        *keep, F.size(members).alias("n"), F.explode(members).alias("member")
    )


def membership_counts(memberships: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(member, *by, n, times)``: how often a member has a record of that size.

    What scores and statistics need to know of the memberships, after one shuffle.
    """
    return memberships.groupBy("member", *by, "n").agg(F.count(F.lit(1)).alias("times"))


def record_sizes(rows: DataFrame, record: str, member: str) -> DataFrame:
    """Size of every record of a long table; records without a member do not appear."""
    return rows.where(F.col(member).isNotNull()).groupBy(record).agg(F.count(F.lit(1)).alias("n"))


def attach_records(rows: DataFrame, records: DataFrame, record: str) -> DataFrame:
    """Inner join of a long table with its records (one row each), safe for huge records.

    The key is wrapped, so neither side's earlier partitioning serves the join and
    both get an exchange of their own.  Adaptive execution can then split the rows
    of any record that is too large for a task, and hands each part the one row of
    that record.  The plan is the same for records of all sizes, and Spark decides
    about broadcasting the records by their measured size.
    """
    own = records.select(F.struct(F.col(record)).alias("_record"), *[c for c in records.columns if c != record])
    joined = rows.where(F.col(record).isNotNull()).withColumn("_record", F.struct(F.col(record))).join(own, "_record")
    return joined.drop("_record")
