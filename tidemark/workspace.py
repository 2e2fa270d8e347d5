"""Folders for intermediate tables, checkpoints, stream state and stream output.

On a cluster every one of them lies below the shared folder named by
``spark.checkpoint.dir``, so a lost executor or driver can pick the work up
again. A local folder stands in only where Spark itself runs in one local
process (tests, a laptop).
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_local_root: str | None = None
#: Folders named within :func:`scratch`, innermost last.
_scopes: list[list[str]] = []


def shared_root(spark: SparkSession) -> str:
    global _local_root
    named = spark.conf.get(_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError(f"{_SETTING} must name a shared folder where the master is {master}")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="tidemark-")
    return _local_root


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path nobody has used yet below the shared folder."""
    path = f"{shared_root(spark)}/{purpose}-{uuid.uuid4().hex}"
    for scope in _scopes[-1:]:
        scope.append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove, at the end, every folder that was named inside.

    Results of this library are lazy and read intermediate tables: use them, or write
    them elsewhere, before the end.
    """
    own: list[str] = []
    _scopes.append(own)
    try:
        yield
    finally:
        _scopes.remove(own)
        for path in own:
            remove_folder(spark, path)


def write_table(df: DataFrame, purpose: str) -> tuple[DataFrame, str]:
    """``df`` as Parquet below the shared folder: the table read back, and its path."""
    path = new_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder that :func:`write_table` or :func:`new_folder` named."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def date_files(spark: SparkSession, path: str) -> None:
    """Date the files of a table in the order of the partitions they were written from."""
    top = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = top.getFileSystem(spark._jsc.hadoopConfiguration())
    found = sorted(
        (f for f in files.listStatus(top) if f.getPath().getName().startswith("part-")),
        key=lambda f: f.getPath().getName(),
    )
    newest = max((f.getModificationTime() for f in found), default=0)
    for number, file in enumerate(found):
        files.setTimes(file.getPath(), newest + 1000 * number, -1)


# Side tables up to this size are broadcast. Larger ones are joined by shuffle,
# where adaptive execution splits a key that holds too many rows.
BROADCAST_BYTES = 128 * 1024 * 1024


def may_broadcast(rows: int, row_bytes: int) -> bool:
    return rows * row_bytes <= BROADCAST_BYTES
