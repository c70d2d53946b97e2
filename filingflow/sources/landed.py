"""Landed files, listed and read by tasks.

Layout: ``<root>/date=D/...``.  Spark's file sources list files on the driver, which keeps more than a kilobyte about
each and keeps it again for every query.  Here a task lists a date's folder, the listing is a table, and a file
is opened by the task that needs it.  The driver handles names of dates only.

As in ``objects``, folders are opened with ``pyarrow.fs``.  Files that Spark's sources pass over are passed over
here, too: empty ones and those with a hidden name.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from itertools import islice
from urllib.parse import unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import BinaryType

from ..operators.incremental import latest_per_key
from ..session import discard_later
from .objects import opened
from .store import dates_of, folders_of

#: ``path`` is relative to the root, ``modified`` in milliseconds.
LISTING = "path string, modified bigint, length bigint, date string"
LISTINGS = "_listings"
#: Rows of a batch of a listing, and bytes of contents a worker holds before it hands them on.
LISTED_ROWS, READ_BYTES = 10_000, 1 << 20
#: What a task lists and reads at most, about.
TASKS, TASK_FILES, TASK_BYTES = 256, 1_000, 32 << 20


def _visible(path: str) -> bool:
    return not any(
        part.startswith(".") or part.endswith("._COPYING_") or (part.startswith("_") and "=" not in part)
        for part in path.split("/")
    )


def files_below(root: str, folder: str) -> Iterator[tuple[str, int, int]]:
    """Path below ``root``, milliseconds of the last change and length of the files in one of its folders."""
    files, base = opened(root)
    start = len(base.rstrip("/")) + 1
    for info in files.get_file_info(fs.FileSelector(f"{base}/{folder}", allow_not_found=True, recursive=True)):
        path = info.path[start:]
        if info.type == fs.FileType.File and info.size and _visible(path):
            yield path, (info.mtime_ns or 0) // 1_000_000, info.size


def list_files(spark: SparkSession, root: str, dates: Iterable[str] | None = None) -> DataFrame:
    """The files of the given dates, or of all, as ``path, modified, length, date``; no other folder is listed."""
    root = root.rstrip("/")
    names = dates_of(spark, root, "date") if dates is None else [
        folder.rpartition("date=")[2] for folder in folders_of(spark, root, dates, "date")
    ]

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in batch.column(0).to_pylist():
                files, date = files_below(root, f"date={names[i]}"), unquote(names[i])
                while some := list(islice(files, LISTED_ROWS)):
                    path, modified, length = zip(*some)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(path, pa.string()), pa.array(modified, pa.int64()), pa.array(length, pa.int64()),
                         pa.array([date] * len(some), pa.string())],
                        ["path", "modified", "length", "date"],
                    )

    if not names:
        return spark.createDataFrame([], LISTING)
    return spark.range(0, len(names), 1, min(len(names), TASKS)).mapInArrow(listed, LISTING)


def newest_files(listed: DataFrame, keys: list[str], root: str) -> DataFrame:
    """The newest file of each key, ``date`` among them, as a table stored by date."""
    spark, folder = listed.sparkSession, f"{root.rstrip('/')}/{LISTINGS}/{uuid.uuid4().hex}"
    discard_later(spark, folder)
    rows = latest_per_key(listed, keys, ["modified", "path"])
    rows.hint("rebalance", "date").write.mode("overwrite").partitionBy("date").parquet(folder)
    paths = [f"{folder}/date={date}" for date in dates_of(spark, folder, "date")]
    if not paths:
        return spark.createDataFrame([], rows.schema)
    return spark.read.schema(rows.schema).option("basePath", folder).parquet(*paths)


def content(root: str, path: Column, unpack: bool = False) -> Column:
    """What is in the file at ``path`` below ``root``; ``unpack`` takes account of an ending such as ``.gz``."""

    @F.arrow_udf(BinaryType())
    def read(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        files, base = opened(root.rstrip("/"))
        for batch in batches:
            held, held_bytes = [], 0
            for name in batch.to_pylist():
                with files.open_input_stream(f"{base}/{name}", compression="detect" if unpack else None) as source:
                    held.append(source.read())
                held_bytes += len(held[-1])
                if held_bytes >= READ_BYTES:
                    yield pa.array(held, pa.binary())
                    held, held_bytes = [], 0
            yield pa.array(held, pa.binary())

    return read(path)


def dealt_files(rows: DataFrame, listing: DataFrame) -> DataFrame:
    """Rows with the ``path`` of files, dealt out in the order of paths to tasks that read about as much each.

    ``listing`` is a stored table of those files, or more.  A task gets files of few dates.
    """
    n, size = listing.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
    cores = rows.sparkSession.sparkContext.defaultParallelism
    tasks = max(-(-n // TASK_FILES), -(-size // TASK_BYTES), min(n, cores))
    return rows.repartitionByRange(tasks, "path") if tasks > 1 else rows
