"""How many records have how many members, exactly or in bins."""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.functions.specs import Bin


def size_histogram(records: DataFrame, by: Sequence[str] = (), *, size: str = "n") -> DataFrame:
    """Records per size, or per size and the ``by`` columns.

    Records without members, or with a null in ``by``, do not count.
    """
    kept = records.where(F.col(size) > 0)
    for name in by:
        kept = kept.where(F.col(name).isNotNull())
    return kept.groupBy(F.col(size).cast("bigint").alias("n"), *by).agg(
        F.count(F.lit(1)).alias("records")
    )


def size_histograms(records: DataFrame, keys: Sequence[str], *, size: str = "n") -> DataFrame:
    """The histogram by size alone and those by size and each of ``keys``, from one pass: ``(by, n, *keys, records)``.

    ``by`` names the key, ``""`` means size alone; :func:`histogram_by` takes one out.
    Records meet one shuffle, by size and all keys; the grouping sets add up its few rows.
    """
    cells = records.where(F.col(size) > 0).groupBy(F.col(size).cast("bigint").alias("n"), *keys)
    cells = cells.agg(F.count(F.lit(1)).alias("records"))
    sets = [["n"], *[["n", key] for key in keys]]
    by = F.lit("")
    for key in keys:
        by = F.when(F.grouping(key) == 0, key).otherwise(by)
    rolled = cells.groupingSets(sets, "n", *keys).agg(by.alias("by"), F.sum("records").alias("records"))
    kept = F.col("by") == ""
    for key in keys:
        kept = kept | ((F.col("by") == key) & F.col(key).isNotNull())
    return rolled.where(kept).select("by", "n", *keys, "records")


def histogram_by(histograms: DataFrame, key: str = "") -> DataFrame:
    """One of :func:`size_histograms`, as :func:`size_histogram` gives it."""
    return histograms.where(F.col("by") == key).select("n", *[key] * bool(key), "records")


def bin_sizes(histogram: DataFrame, bins: Sequence[Bin]) -> DataFrame:
    """Roll ``(n, records)`` up into bins; empty bins are kept with 0.

    Bins may overlap, and there may be thousands.  An open bin is labelled with the
    largest size seen, ``11-end`` becoming ``11-42``, or stays as written when nothing
    reaches it.
    """
    cells = _cells(histogram.withColumn("key", F.lit(0)), bins)
    return _table(_in_intervals(cells, bins, _numbers(histogram, 1)), bins, None, "")


def bin_by_category(
    histogram: DataFrame,
    bins: Sequence[Bin],
    categories: Sequence[str],
    *,
    category: str = "category",
) -> DataFrame:
    """Roll ``(n, category, records)`` up: every bin with every category, zeros included.

    Other categories do not count, but their sizes still set the label of an
    open bin.
    """
    names = list(dict.fromkeys(categories))
    at = F.nullif(F.array_position(_texts(names), F.col(category)), F.lit(0)) - 1
    cells = _cells(histogram.withColumn("key", at.cast("int")), bins)
    return _table(_in_intervals(cells, bins, _numbers(histogram, len(names))), bins, names, category)


def bin_by_range(
    histogram: DataFrame,
    bins: Sequence[Bin],
    ranges: Sequence[Bin],
    *,
    value: str = "year",
    range_name: str = "range",
) -> DataFrame:
    """Roll ``(n, value, records)`` up: every bin with every value range, zeros included.

    Values outside all ranges do not count, but their sizes still set the label
    of an open bin.
    """
    cells = _cells(histogram.withColumn("key", _segment(F.col(value), ranges)), bins)
    # first the ranges of each size segment, then the bins of each range
    by_size = cells.select(F.col("segment").alias("key"), F.col("key").alias("segment"), "records", "top")
    by_range = _in_intervals(by_size, ranges, _numbers(histogram, len(_bounds(bins)) + 1))
    by_range = by_range.select(F.col("key").alias("segment"), F.col("pos").alias("key"), "records", "top")
    found = _in_intervals(by_range, bins, _numbers(histogram, len(ranges)))
    return _table(found, bins, [item.label for item in ranges], range_name)


def _numbers(like: DataFrame, count: int) -> DataFrame:
    """``key``: the numbers from 0 below ``count``."""
    return like.sparkSession.range(0, count, 1, 1).select(F.col("id").cast("int").alias("key"))


def _texts(texts: Iterable[str]) -> Column:
    """An array that is one literal, however many there are."""
    return F.from_json(F.lit(json.dumps(list(texts))), "array<string>")


def _bounds(intervals: Sequence[Bin]) -> list[int]:
    """Where the intervals cut the numbers into segments, in which all are inside the same ones."""
    return sorted({b.lo for b in intervals} | {b.hi + 1 for b in intervals if b.hi is not None})


def _segment(value: Column, intervals: Sequence[Bin]) -> Column:
    """How many bounds are not above the value, by bisection in a sorted array that is one literal."""
    bounds = _bounds(intervals)
    array = F.split(F.lit(",".join(map(str, bounds))), ",").cast("array<bigint>") if bounds else F.array().cast("array<bigint>")
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(bounds).bit_length()))]).cast("array<int>")
    reached = lambda at, step: F.try_element_at(array, at + step) <= value
    found = F.aggregate(steps, F.lit(0), lambda at, step: F.when(reached(at, step), at + step).otherwise(at))
    return F.when(value.isNotNull(), found)


def _cells(histogram: DataFrame, bins: Sequence[Bin]) -> DataFrame:
    """Records for each key and segment of sizes, as few as settings allow; ``top`` is the largest size."""
    placed = histogram.select("key", _segment(F.col("n"), bins).alias("segment"), "n", "records")
    return placed.groupBy("key", "segment").agg(F.sum("records").alias("records"), F.max("n").alias("top"))


def _in_intervals(cells: DataFrame, intervals: Sequence[Bin], keys: DataFrame) -> DataFrame:
    """``(key, pos, records, top)``: records of each key in each interval, and the largest size of all cells.

    What lies in an interval is the difference of two running sums.  Marks at both
    ends of all intervals stand among the cells, and read the sums off there.  Cells and
    marks are bounded by settings, so they share one partition.
    """
    bounds = _bounds(intervals)
    at = {bound: place for place, bound in enumerate(bounds)}
    marks = [(b.pos, at[b.lo], -1) for b in intervals]
    # nothing is inside an interval that ends before it begins
    marks += [(b.pos, len(bounds) if b.hi is None else at[max(b.lo, b.hi + 1)], 1) for b in intervals]
    text = json.dumps([{"pos": pos, "segment": segment, "sign": sign} for pos, segment, sign in marks])
    marked = keys.select("key", F.inline(F.from_json(F.lit(text), "array<struct<pos: int, segment: int, sign: int>>")))
    both = cells.unionByName(marked, allowMissingColumns=True).coalesce(1)
    order = Window.partitionBy("key").orderBy("segment", F.col("pos").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    read = both.select("*", F.sum("records").over(order).alias("so_far"), F.max("top").over(Window.partitionBy(F.lit(0))).alias("most"))
    inside = F.sum(F.col("sign") * F.coalesce("so_far", F.lit(0)))
    return read.where("pos IS NOT NULL").groupBy("key", "pos").agg(inside.cast("bigint").alias("records"), F.max("most").alias("top"))


def _table(found: DataFrame, bins: Sequence[Bin], names: Sequence[str] | None, name: str) -> DataFrame:
    """Labels for positions: every bin, with ``names`` by key, in their order."""
    low = F.get(F.from_json(F.lit(json.dumps([b.lo if b.hi is None else None for b in bins])), "array<bigint>"), F.col("pos"))
    label = F.when(F.col("top") >= low, F.concat_ws("-", low, "top")).otherwise(F.get(_texts(b.label for b in bins), F.col("pos")))
    named = [F.get(_texts(names), F.col("key")).alias(name)] if names is not None else []
    return found.orderBy("pos", "key").select(label.alias("bin"), *named, "records")
