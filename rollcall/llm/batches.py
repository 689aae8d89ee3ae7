"""Texts through Python in bounded pieces."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text that one call works on, unless one text alone is longer.
PIECE_BYTES = 2 << 20


def pieces(batches: Iterable[pa.RecordBatch], column: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that ``column`` holds about ``limit`` bytes in each."""
    for batch in batches:
        start, size = 0, 0
        lengths = pc.binary_length(batch.column(column)).to_pylist()
        for row, length in enumerate(lengths):
            if row > start and size + (length or 0) > limit:
                yield batch.slice(start, row - start)
                start, size = row, 0
            size += length or 0
        if len(lengths) > start:
            yield batch.slice(start)


_TYPES = {
    "bigint": pa.int64(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
    "string": pa.string(),
    "binary": pa.binary(),
    "array<int>": pa.list_(pa.int32()),
}


def map_texts(
    frame: DataFrame,
    keys: Sequence[str],
    text: str,
    outputs: str,
    work: Callable[[list[str | None]], list[Sequence]],
) -> DataFrame:
    """``keys`` and the columns that ``work`` makes of each text, one row for each row.

    ``work`` gets a list of texts and returns one list for each output column.
    Only the named columns are read, so others may have any name; an output
    takes the place of a key of its name.
    """
    names, types = zip(*(part.split() for part in outputs.split(", ")))
    keys = [k for k in keys if k not in names]
    texts, own = [], text
    if text not in keys or frame.schema[text].dataType.simpleString() != "string":
        own = "_text"
        while own in keys:
            own += "_"
        texts = [F.col(f"`{text}`").cast("string").alias(own)]
    kept = frame.select(*[F.col(f"`{k}`") for k in keys], *texts)
    schema = ", ".join([f"`{k}` {kept.schema[k].dataType.simpleString()}" for k in keys] + [outputs])

    def run(batches):
        for piece in pieces(batches, own):
            columns = work(piece.column(own).to_pylist())
            arrays = [piece.column(k) for k in keys] + [pa.array(c, _TYPES[t]) for c, t in zip(columns, types)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*keys, *names])

    return kept.mapInArrow(run, schema)
