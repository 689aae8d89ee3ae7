"""Folders for tables that cut lineage, in the storage the cluster shares."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def staging_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where it is unset, a local session gets a temporary folder; a cluster has
    to name one, since a node's own folder is lost with the node.
    """
    context = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_DIR, None) or context.getCheckpointDir()
    if not root:
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all nodes share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="rollcall-"))
        root = context.getCheckpointDir()
    return root.rstrip("/")


def _path(spark: SparkSession, folder: str):
    """The folder's file system, and the folder for it."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(context._jsc.hadoopConfiguration()), path


@contextmanager
def staging_folder(spark: SparkSession) -> Iterator[str]:
    """A folder of its own for one run, removed afterwards."""
    folder = f"{staging_root(spark)}/rollcall-{uuid.uuid4().hex}"
    try:
        yield folder
    finally:
        files, path = _path(spark, folder)
        files.delete(path, True)


def passing_folder(spark: SparkSession, name: str = "table") -> str:
    """A new folder for what is read until the application ends; then it is removed."""
    folder = f"{staging_root(spark)}/rollcall-{name}-{uuid.uuid4().hex}"
    files, path = _path(spark, folder)
    files.mkdirs(path)
    files.deleteOnExit(path)
    return folder


def table_state(spark: SparkSession, folder: str) -> tuple[int, int]:
    """Bytes and last change of a table's files: another state, another table."""
    files, path = _path(spark, folder)
    return files.getContentSummary(path).getLength(), files.getFileStatus(path).getModificationTime()


def written(frame: DataFrame) -> DataFrame:
    """The frame as a table in the shared folder: later readers start from there.

    The folder outlives the call, since the table is read when the result is; it goes
    when the application ends.
    """
    folder = passing_folder(frame.sparkSession)
    frame.write.mode("append").parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)


def discard(table: DataFrame) -> None:
    """Removes a table that :func:`written` gave, when everything made of it is written as well."""
    for folder in {name.rpartition("/")[0] for name in table.inputFiles()}:
        files, path = _path(table.sparkSession, folder)
        files.delete(path, True)
