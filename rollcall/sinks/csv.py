"""Comma separated output: quoted where needed, UTF-8, written by the executors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameWriter


def _writer(frame: DataFrame, mode: str, header: bool) -> DataFrameWriter:
    return (
        frame.write.mode(mode)
        .option("header", header)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )


def write_key_values(frame: DataFrame, directory: str, *, mode: str = "error") -> None:
    """``key,value`` part files without a header, one per task."""
    _writer(frame, mode, header=False).csv(directory)


def write_table(
    frame: DataFrame, directory: str, header: Sequence[str] | None = None, *, mode: str = "error"
) -> None:
    """Part files that each start with the header; for results of any size."""
    _writer(_named(frame, header), mode, header=True).csv(directory)


def write_report(
    frame: DataFrame, directory: str, header: Sequence[str] | None = None, *, mode: str = "error"
) -> None:
    """One part file with a header, rows in the frame's order.

    For results whose size a setting bounds (bins by categories, top N); the
    frame has to end in one partition, as the report operators do.
    """
    _writer(_named(frame, header).coalesce(1), mode, header=True).csv(directory)


def _named(frame: DataFrame, header: Sequence[str] | None) -> DataFrame:
    return frame if header is None else frame.toDF(*header)
