"""A sink of real files: one object per row, below ``<root>/<object_key>``.

``write_objects`` takes ``object_key string, body binary``.  The same is a format, ``df.write.format("objects")
.mode("append").save(root)``, which ``register`` makes known to a session; it keeps some Python processes beside the driver.

A task stages what it writes in a folder of its own and moves each file to its place
at its end.  A move replaces, so a task that fails and runs again, or runs
twice at a time, leaves each object once, and no reader ever sees half a file.  The
driver removes the staging folder at the end, whether the write is committed or not;
it handles no list of objects.  Objects that finished tasks of a failed write put in
place stay: writing again replaces them.
"""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

#: Objects a task writes at most, about: making a file takes milliseconds, whatever its size.
TASK_OBJECTS = 2_000
STAGING = "_staging"  # names that begin with _ are hidden from Spark's file sources


@dataclass
class Placed(WriterCommitMessage):
    """What a task put in place."""

    objects: int


def opened(root: str) -> tuple[fs.FileSystem, str]:
    if root.startswith("file:"):
        root = "/" + root.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(root)


def _checked(key: str | None) -> str:
    """The key, if it names a file below the root."""
    parts = (key or "").split("/")
    if any(part in ("", ".", "..") for part in parts) or parts[0].startswith("_"):
        raise ValueError(f"no key of an object: {key!r}")
    return "/".join(parts)


class ObjectWriter(DataSourceArrowWriter):
    def __init__(self, root: str, names: list[str]):
        self.root = root.rstrip("/")
        self.staging = f"{self.root}/{STAGING}/{uuid.uuid4().hex}"
        self.columns = names.index("object_key"), names.index("body")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Placed:
        files, folder = opened(f"{self.staging}/{uuid.uuid4().hex}")
        root = opened(self.root)[1]
        files.create_dir(folder, recursive=True)
        staged: list[tuple[str, str]] = []
        for batch in iterator:
            keys, bodies = (batch.column(i) for i in self.columns)
            for key, body in zip(keys, bodies):
                at = f"{folder}/{len(staged)}"
                with files.open_output_stream(at) as out:
                    if body.is_valid:
                        out.write(body.as_buffer())
                staged.append((at, f"{root}/{_checked(key.as_py())}"))
        for parent in {posixpath.dirname(place) for _, place in staged}:
            files.create_dir(parent, recursive=True)
        for at, place in staged:
            files.move(at, place)
        return Placed(len(staged))

    def _clean(self) -> None:
        files, folder = opened(self.staging)
        if files.get_file_info(folder).type != fs.FileType.NotFound:
            files.delete_dir(folder)

    def commit(self, messages: list[Placed | None]) -> None:
        self._clean()

    def abort(self, messages: list[Placed | None]) -> None:
        self._clean()


class Objects(DataSource):
    @classmethod
    def name(cls) -> str:
        return "objects"

    def writer(self, schema: StructType, overwrite: bool) -> ObjectWriter:
        if overwrite:
            raise ValueError("objects are replaced one by one; write with mode append")
        return ObjectWriter(self.options["path"], schema.fieldNames())


def register(spark: SparkSession) -> None:
    spark.dataSource.register(Objects)


def dealt(rows: DataFrame) -> DataFrame:
    """Rows dealt out by key, so that no task writes more objects than others or more as the table grows."""
    n = rows.select("object_key").count()
    if n <= TASK_OBJECTS:
        return rows
    return rows.repartition(-(-n // TASK_OBJECTS), F.xxhash64("object_key"))


def write_objects(rows: DataFrame, root: str) -> None:
    """Put the ``body`` of each row at its ``object_key`` below ``root``.

    An object without a body is an empty file.  A key that is null, empty or would leave
    the root fails the write.  Of rows with one key, one's body stays.  The rows are counted first.
    """
    writer = ObjectWriter(root, ["object_key", "body"])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_pydict({"objects": pa.array([writer.write(batches).objects], pa.int64())})

    # the format would start five processes beside the driver, which stay
    try:
        dealt(rows.select("object_key", "body")).mapInArrow(place, "objects bigint").write.format("noop").mode("overwrite").save()
    except BaseException:
        writer.abort([])
        raise
    writer.commit([])
