"""Exact top k by inner product, by distributed histogram selection (operator 11).

Every score is worked out, none is kept.  In each round all blocks count their scores
in equal bins of every asking row's window, from the top down to where their own count
is enough; the sum over blocks says which bin holds the kth score, and that bin is the
next round's window.  When bins are one wide, the kth score is known exactly.  A last
round keeps what is above it, and of the ties the ones with the least ids.

Each block reports at most k bins or rows for an asking row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.llm.score_blocks import BLOCK_BYTES, dealt, first_of, matrix, numbered_vectors, records, steps
from rollcall.plans.staging import written

#: Bins of a round.
BINS = 1024


def _exact(bound: int) -> type:
    """The quickest type of number that sums up to twice ``bound`` stay exact in."""
    return np.float32 if bound < 1 << 23 else np.float64 if bound < 1 << 52 else np.int64


def _holder(exact: type):
    def hold(rows: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        ids, numbers = rows.column("id").to_numpy(), rows.column("number").to_numpy()
        order = np.lexsort((numbers, ids))  # of equal scores the first ones count
        by_number = np.argsort(numbers[order])
        return ids[order], matrix(rows.column("vector")).astype(exact)[order], numbers[order][by_number], by_number

    return hold


def _scored(held: tuple[np.ndarray, ...], rows: pa.RecordBatch, exact: type, bound: int):
    """Scores of some asking rows at a time, with the rows' slice; a row's own place gets less than any score."""
    ids, vectors, numbers, by_number = held
    asked, own = matrix(rows.column("vector")).astype(exact), rows.column("number").to_numpy()
    for part in steps(len(own), len(ids)):
        scores = asked[part] @ vectors.T
        at = np.searchsorted(numbers, own[part])
        here = np.flatnonzero(numbers[np.minimum(at, len(numbers) - 1)] == own[part])
        scores[here, by_number[at[here]]] = -bound - 1
        yield part, scores


_COUNTS = "number bigint, bin bigint, n bigint"


def _counted(held, rows: pa.RecordBatch, exact: type, bound: int, bins: int, width: int):
    """Counts in bins ``width`` wide from ``low`` up, each row's highest until they reach ``need``."""
    lows, needs, numbers = (rows.column(c).to_numpy() for c in ("low", "need", "number"))
    span = min(bins * width, 2 * bound + 1)
    for part, scores in _scored(held, rows, exact, bound):
        need = needs[part]
        scores -= lows[part][:, None].astype(exact)
        scores[scores >= span] = -1
        # what the block has below its own kth score cannot matter
        spare = max(0, scores.shape[1] - int(need.max()))
        least = np.maximum(np.partition(scores, spare, axis=1)[:, spare], 0)
        row, place = np.nonzero(scores >= least[:, None])
        down = bins - 1 - scores[row, place].astype(np.int64) // width
        flat, n = np.unique(row * bins + down, return_counts=True)
        if not len(flat):
            continue
        row, down = flat // bins, flat % bins
        starts = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        before = np.cumsum(n) - n
        before -= np.repeat(before[starts], np.diff([*starts, len(row)]))
        kept = before < need[row]
        yield records(_COUNTS, numbers[part][row[kept]], bins - 1 - down[kept], n[kept])


_FOUND = "number bigint, query_id bigint, vec_id bigint, score bigint"


def _found(held, rows: pa.RecordBatch, exact: type, bound: int):
    """Scores above ``low``, and the first ``need`` of those equal to it."""
    ids = held[0]
    lows, needs, numbers, own = (rows.column(c).to_numpy() for c in ("low", "need", "number", "id"))
    for part, scores in _scored(held, rows, exact, bound):
        low = lows[part][:, None].astype(exact)
        above = np.nonzero(scores > low)
        tied = np.nonzero(scores == low)
        few = first_of(tied[0], needs[part][tied[0]]) if len(tied[0]) else np.empty(0, bool)
        row, place = (np.concatenate([a, t[few]]) for a, t in zip(above, tied))
        if len(row):
            yield records(_FOUND, numbers[part][row], own[part][row], ids[place], scores[row, place].astype(np.int64))


def exact_top_k(
    vectors: DataFrame,
    asks: str | Column,
    k: int = 5,
    scale: int = 256,
    key: str = "vec_id",
    vector: str = "embedding",
    bins: int = BINS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best rows for every row for which ``asks`` holds.

    Components become ``floor(scale * component)``, scores are their inner products as
    whole numbers, exact whatever their size.  Higher scores come first, ties by
    smaller id.  All other rows of the same vector length are candidates, repeated rows
    and other rows with the same id too; with fewer than ``k`` all are given.  Rows with a
    null id, a null vector, or null or non-finite components take no part; an empty
    vector scores 0 with other empty ones.  Columns of other names are not read.  An empty
    table gives an empty one; scores that might not fit a long raise ``ValueError``.
    """
    if k < 1 or bins < 2:
        raise ValueError("k must be positive, and bins at least two")
    condition = F.expr(asks) if isinstance(asks, str) else asks
    numbered = numbered_vectors(vectors, key, vector, scale, wanted=F.coalesce(condition, F.lit(False)))
    candidates = numbered.table.drop("wanted")
    asking = numbered.table.filter("wanted").drop("wanted")
    bound, blocks = numbered.bound, numbered.blocks(block_bytes=block_bytes)
    exact = _exact(bound)
    hold = _holder(exact)
    width = 1
    while width * bins < 2 * bound + 1:
        width *= bins
    state = asking.select("number", F.lit(-bound).cast("bigint").alias("low"), F.lit(k).cast("bigint").alias("need"))
    while True:
        counts = dealt(candidates, asking.join(state, "number"), blocks, hold, lambda h, r, w=width: _counted(h, r, exact, bound, bins, w), _COUNTS)
        counts = counts.groupBy("number", "bin").agg(F.sum("n").alias("n"))
        # at most `bins` rows for each asking row
        higher = Window.partitionBy("number").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, -1)
        counts = counts.withColumn("above", F.coalesce(F.sum("n").over(higher), F.lit(0)))
        chosen = counts.join(state, "number").filter("above < need and above + n >= need")
        chosen = chosen.select("number", (F.col("low") + F.col("bin") * width).alias("to"), (F.col("need") - F.col("above")).alias("left"))
        # where all candidates are too few, the window stays at the bottom
        state = state.join(chosen, "number", "left")
        state = written(state.select("number", F.coalesce("to", "low").alias("low"), F.coalesce("left", "need").alias("need")))
        if width == 1:
            break
        width //= bins
    found = dealt(candidates, asking.join(state, "number"), blocks, hold, lambda h, r: _found(h, r, exact, bound), _FOUND)
    best = Window.partitionBy("number").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op11_top_k(spark, folder):
    return exact_top_k(spark.read.parquet(f"{folder}/embeddings.parquet"), "vec_id % 50 = 0")


# All scores of the asking rows, ranked.
OP11_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scores AS (
  SELECT a.r, a.vec_id AS query_id, b.vec_id, CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.r <> b.r AND len(a.e) = len(b.e)
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scores
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
