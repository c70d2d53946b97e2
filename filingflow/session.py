"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession, functions as F

SETTINGS = {
    # Java charset names and replace-on-error decoding: ``decode_document`` turns
    # a replacement character into a NULL
    "spark.sql.legacy.javaCharsets": "true",
    "spark.sql.legacy.codingErrorAction": "true",
    # split skewed joins also where an aggregate on the join key follows, which
    # then shuffles its partial rows
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # date=20240101 must stay the string it is in every other table
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # shuffle files go when the query that wrote them ends; a later run of the same plan writes them again
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # folders of many small files: listing takes this many tasks at most, not one per path, and a task reads some
    # hundreds of files, not 32
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "256",
    "spark.sql.files.openCostInBytes": str(256 << 10),
    # archives reach Python few at a time: a worker holds a batch several times over (taken in, unpacked, given back)
    "spark.sql.execution.arrow.maxBytesPerBatch": str(1 << 20),
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings every job of this package relies on."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir``.

    Where that is unset, in tests and on one machine, it is set to a folder below
    the warehouse, which the session's own configuration names.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        named = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return named


#: Folders made by this process and not removed yet, with the catalog table that reads each, if any.
_MADE: dict[str, str | None] = {}
#: Those made inside the innermost ``scratch`` of the running thread.
_INSIDE: ContextVar[dict[str, str | None] | None] = ContextVar("inside", default=None)


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new empty folder below the shared folder.

    The end of the ``scratch`` it is made in or ``release`` removes it with what was
    written there, or else the driver does when it ends.
    """
    folder = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    discard_later(spark, folder)
    return folder


def discard_later(spark: SparkSession, folder: str, table: str | None = None) -> None:
    """Make the folder and note that it is to be removed, with the catalog table that reads it."""
    path, files = _files(spark, folder)
    files.mkdirs(path)
    files.deleteOnExit(path)
    inside = _INSIDE.get()
    (_MADE if inside is None else inside)[folder] = table


def _remove(spark: SparkSession, made: dict[str, str | None]) -> None:
    while made:
        folder, table = made.popitem()
        if table is not None:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        clear(spark, folder)


def release(spark: SparkSession) -> None:
    """Remove all intermediate folders of this process, once their readers are done.

    A DataFrame is lazy, so only its user knows when that is; a job calls this at its end.
    """
    _remove(spark, _MADE)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove at the end the folders made inside; nothing lazy that reads them may be used after."""
    made: dict[str, str | None] = {}
    outer = _INSIDE.set(made)
    try:
        yield
    finally:
        _INSIDE.reset(outer)
        _remove(spark, made)


def _files(spark: SparkSession, folder: str):
    """The folder's Hadoop path and file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def make_dir(spark: SparkSession, folder: str) -> None:
    """Make a folder, which streams want to be there before anything lands."""
    path, files = _files(spark, folder)
    files.mkdirs(path)


def clear(spark: SparkSession, folder: str) -> None:
    path, files = _files(spark, folder)
    files.delete(path, True)


#: Rows of metadata, some hundred bytes each, that are broadcast at most.
BROADCAST_ROWS = 200_000


def if_small(table: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``table`` marked for broadcast if it has no more than ``limit`` rows, so that what it is joined with stays in place.

    The table should be stored, as its rows are counted.  A longer one is left to
    Spark's choice between the joins.
    """
    return F.broadcast(table) if table.limit(limit + 1).count() <= limit else table


def written(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back.

    For results that several branches of a job read: they are computed once,
    and a lost executor costs no more than its own task.
    """
    folder = folder or fresh_dir(df.sparkSession, name)
    df.write.mode("overwrite").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def settled(spark: SparkSession, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """``written(make(), name)``, without the folders that were made on the way."""
    folder = fresh_dir(spark, name)
    with scratch(spark):
        return written(make(), name, folder)
