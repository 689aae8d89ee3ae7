"""Read results back that a sink of this package wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rollcall.plans.staging import written


def read_results(
    spark: SparkSession,
    directory: str,
    schema: str,
    *,
    header: bool = True,
    multi_line: bool = False,
) -> DataFrame:
    """Part files of one result as a typed DataFrame; blank lines are skipped.

    ``multi_line`` is for values that hold line breaks; files are then not split.
    """
    return (
        spark.read.schema(schema)
        .option("header", header)
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("pathGlobFilter", "part-*")
        .option("enforceSchema", True)
        .csv(directory)
    )


def read_in_order(spark: SparkSession, directory: str, schema: str, *, header: bool = False) -> DataFrame:
    """A result as :func:`read_results` gives it, with ``position``: the place of each line, from 1.

    Part files count in name order.  Lines are numbered as they are read, and shifted by
    the lines of the blocks and files before theirs, of which there is one row each.
    """
    table = read_results(spark, directory, schema, header=header)
    place = [F.col("_metadata.file_name").alias("_file"), F.col("_metadata.file_block_start").alias("_block")]
    lines = table.select("*", *place, F.monotonically_increasing_id().alias("_line"))
    # a block is read by one task, line by line: written down, since a task's number is its place in the plan
    lines = written(lines)
    before = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = lines.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_line").alias("_first"))
    shift = F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + 1
    numbered = lines.join(blocks.select("_file", "_block", shift.alias("_shift")), ["_file", "_block"])
    return numbered.select((F.col("_line") + F.col("_shift")).cast("bigint").alias("position"), *table.columns)
