"""Uniform shuffle of rows into shards of exact sizes (operator 6).

Rows stand in source blocks, shards are cut into target bins of known size.  How
many rows each block sends to each bin is drawn first, from the hypergeometric
law that a uniform shuffle of all rows would follow.  Then a random order inside
every block says which rows these are, they are exchanged, and a random order
inside every bin gives their places.  No sort or task ever sees more than a block
or a bin, and sizes are exact by construction.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.plans.staging import written

SHARDS = 40
SEED = 20240601
#: Rows of a block or bin, where that makes more of them than cores and shards ask for.
BLOCK_ROWS = 100_000
#: Most blocks, and about the most bins: the drawn matrix has a cell for each pair.  Beyond, they hold more rows.
MOST_BLOCKS = 1024


def communication_matrix(sources: list[int], targets: list[int], seed: int) -> np.ndarray:
    """Rows from each source to each target: a draw from the law of a uniform shuffle."""
    draws = np.random.default_rng(seed)
    left, matrix = np.array(targets, dtype=np.int64), []
    for size in sources:
        matrix.append(draws.multivariate_hypergeometric(left, size, method="marginals"))
        left = left - matrix[-1]
    return np.array(matrix, dtype=np.int64).reshape(len(sources), len(targets))


def _spread(total: int, parts: int) -> list[int]:
    return [total // parts + (i < total % parts) for i in range(parts)]


def _random(*columns: Column | str) -> Column:
    return F.xxhash64(*columns)


def shuffle_into_shards(rows: DataFrame, shards: int = SHARDS, seed: int = SEED, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """All rows with ``shard`` (int, from 0) and ``slot`` (long, gapless from 0 in each shard).

    Row counts of shards differ by one at most.  Rows are told apart by a number of
    their own, so equal rows, nulls and ties are rows like any other; an empty table
    gives an empty one.  Columns of ``rows`` named like those two are replaced.
    The input is written out once: its row numbers then stay, whichever task is lost.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    number = F.monotonically_increasing_id()
    numbered = written(rows.drop("shard", "slot").select(F.struct("*").alias("_own"), number.alias("_row")))
    total = numbered.count()
    spark = rows.sparkSession
    blocks = min(MOST_BLOCKS, max(2 * spark.sparkContext.defaultParallelism, math.ceil(total / block_rows)))
    bins_each = max(1, min(MOST_BLOCKS // shards, math.ceil(total / shards / block_rows)))
    block = F.pmod(_random(F.lit(seed), "_row"), F.lit(blocks)).cast("int")
    placed = numbered.withColumn("_block", block)

    # bounded by MOST_BLOCKS rows, whatever the table
    counts = {r["_block"]: r["n"] for r in placed.groupBy("_block").agg(F.count(F.lit(1)).alias("n")).collect()}
    sizes = [size for whole in _spread(total, shards) for size in _spread(whole, bins_each)]
    matrix = communication_matrix([counts.get(b, 0) for b in range(blocks)], sizes, seed)

    # for each block the ranks inside it where a bin's rows end
    ends = matrix.cumsum(1)
    table = spark.createDataFrame([(b, own.tolist()) for b, own in enumerate(ends)], "_block int, _ends array<bigint>")
    in_block = Window.partitionBy("_block").orderBy(_random(F.lit(seed + 1), "_row"), "_row")
    ranked = placed.withColumn("_rank", F.row_number().over(in_block) - 1)
    ranked = ranked.join(F.broadcast(table), "_block")  # MOST_BLOCKS rows
    binned = ranked.withColumn("_bin", F.size(F.filter("_ends", lambda end: end <= F.col("_rank"))))

    starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    starts = [int(s - starts[i - i % bins_each]) for i, s in enumerate(starts)]
    in_bin = Window.partitionBy("_bin").orderBy(_random(F.lit(seed + 2), "_row"), "_row")
    start = F.element_at(F.array(*[F.lit(s).cast("bigint") for s in starts]), F.col("_bin") + 1)
    return binned.select(
        "_own.*",
        F.floor(F.col("_bin") / bins_each).cast("int").alias("shard"),
        (start + F.row_number().over(in_bin) - 1).alias("slot"),
    )


def op6_sharding(spark, folder):
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 16
    rows = documents.select(
        "doc_id",
        size.cast("bigint").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
    )
    return shuffle_into_shards(rows).withColumn("grown_shard", F.lit(None).cast("int"))
