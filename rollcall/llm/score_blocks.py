"""Scores of chosen vectors against all vectors, block by block (for operators 11 and 13).

Vectors become whole numbers once and are written to a table.  Its rows are dealt into
blocks of bounded size; every asking row goes to every block.  A task holds one block
and lets the asking rows pass by, a bounded number of scores at a time, so its memory
does not depend on how many rows ask or exist, and a lost task is done again from the
table.  What leaves a block is bounded for each asking row, never all its scores.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.plans.staging import written

#: Bytes of matrices that a block holds in its task, at four for each component.
BLOCK_BYTES = 64 << 20
#: Scores worked out at a time.
SCORES = 1 << 21


@dataclass(frozen=True)
class Numbered:
    """Vectors as whole numbers: ``number, id, vector`` and further columns, each row with its own number."""

    table: DataFrame
    rows: int
    #: No score of two vectors is beyond this.
    bound: int
    #: Components of all vectors, and of the longest.
    components: int
    longest: int

    def blocks(self, copies: int = 1, block_bytes: int = BLOCK_BYTES) -> int:
        """How many blocks there are, at least two for each core."""
        cores = self.table.sparkSession.sparkContext.defaultParallelism
        return max(2 * cores, math.ceil(4 * copies * self.components / block_bytes))


def numbered_vectors(rows: DataFrame, key: str, vector: str, scale: int, **others: Column) -> Numbered:
    """The rows that take part, with ``floor(scale * component)``, and ``others``.

    Left out are those whose id or vector is null, or whose vector holds null or
    non-finite components.  Raises ``ValueError`` where a score might not fit a long.
    """
    doubles = rows.select(
        F.col(f"`{key}`").cast("bigint").alias("id"),
        F.col(f"`{vector}`").cast("array<double>").alias("vector"),
        *[column.alias(name) for name, column in others.items()],
    )
    sound = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    floors = F.transform("vector", lambda x: F.floor(F.lit(float(scale)) * x))
    squares = F.aggregate("vector", F.lit(0.0), lambda total, x: total + F.pow(F.floor(F.lit(float(scale)) * x).cast("double"), F.lit(2.0)))
    kept = doubles.filter(F.col("id").isNotNull() & sound)
    kept = kept.select(F.monotonically_increasing_id().alias("number"), "id", floors.alias("vector"), squares.alias("square"), *others)
    table = written(kept)
    most = F.greatest(F.array_max("vector"), -1 - F.array_min("vector"))
    found = table.agg(F.count(F.lit(1)), F.max(most), F.max("square"), F.sum(F.size("vector").cast("bigint")), F.max(F.size("vector"))).first()
    bound = int(math.ceil((found[2] or 0.0) * (1 + 1e-9))) + 1
    if bound >= 1 << 62:
        raise ValueError(f"scores up to {bound} do not fit a long")
    numbers = next(t for t, bits in (("smallint", 15), ("int", 31), ("bigint", 63)) if (found[1] or 0) < 1 << bits)
    table = table.select("number", "id", F.col("vector").cast(f"array<{numbers}>").alias("vector"), *others)
    return Numbered(table, found[0], bound, found[3] or 0, found[4] or 0)


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column whose rows are equally long."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1) if len(values) else np.zeros((len(column), 0))


def by_size(batch: pa.RecordBatch, vector: str = "vector") -> Iterator[tuple[int, pa.RecordBatch]]:
    """The rows of each vector length."""
    sizes = batch.column(vector).value_lengths().to_numpy(zero_copy_only=False)
    for size in np.unique(sizes):
        yield int(size), batch if (sizes == size).all() else batch.filter(pa.array(sizes == size))


def dealt(
    candidates: DataFrame,
    asking: DataFrame,
    blocks: int,
    hold: Callable[[pa.RecordBatch], object],
    answer: Callable[[object, pa.RecordBatch], Iterable[pa.RecordBatch]],
    schema: str,
) -> DataFrame:
    """What ``answer`` gives for every block of candidates, all of one vector length, and every piece of asking rows of that length.

    ``hold`` makes of a block's candidates what ``answer`` gets.  Both tables have a
    ``vector`` column; the candidates also a ``number``.
    """
    own = candidates.withColumn("block", F.pmod(F.xxhash64("number"), F.lit(blocks)).cast("int")).withColumn("asks", F.lit(False))
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    others = asking.withColumn("block", every).withColumn("asks", F.lit(True))
    rows = own.unionByName(others, allowMissingColumns=True)
    rows = rows.repartitionById(blocks, "block").sortWithinPartitions("block", "asks")

    def run(batches):
        block, parts, held = None, [], {}
        for batch in batches:
            places, asks = batch.column("block").to_numpy(), batch.column("asks").to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((places[1:] != places[:-1]) | (asks[1:] != asks[:-1])) + 1
            for start, end in zip([0, *cuts], [*cuts, batch.num_rows]):
                if start == end:
                    continue
                if places[start] != block:
                    block, parts, held = places[start], [], {}
                piece = batch.slice(start, end - start)
                if not asks[start]:
                    parts.append(piece)
                    continue
                if parts:
                    held = {size: hold(own) for size, own in by_size(pa.Table.from_batches(parts).combine_chunks().to_batches()[0])}
                    parts = []
                for size, own in by_size(piece):
                    if size in held:
                        yield from answer(held[size], own)

    return rows.mapInArrow(run, schema)


def steps(asking: int, candidates: int) -> Iterator[slice]:
    """The asking rows, so many at a time that their scores are bounded."""
    step = max(1, SCORES // max(candidates, 1))
    for at in range(0, asking, step):
        yield slice(at, min(at + step, asking))


def records(schema: str, *columns: np.ndarray) -> pa.RecordBatch:
    """Columns of longs and ints under the names of a schema text."""
    names, types = zip(*(field.split() for field in schema.split(", ")))
    arrays = [pa.array(c, {"bigint": pa.int64(), "int": pa.int32()}[t]) for c, t in zip(columns, types)]
    return pa.RecordBatch.from_arrays(arrays, names=list(names))


def first_of(group: np.ndarray, size: int) -> np.ndarray:
    """Whether each row is among the first ``size`` of its group; groups lie together."""
    starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    lengths = np.diff(np.concatenate([starts, [len(group)]]))
    return np.arange(len(group)) - np.repeat(starts, lengths) < size
