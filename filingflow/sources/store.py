"""Tables of the job: Parquet below ``<root>/date_key=D/batch_id=N``, the date first.

A date's folder holds all that any batch said about its filings, so a poll loads the
folders of its own dates and never lists the others.  A batch that is run again
overwrites its own folders (dynamic partition overwrite) and drops those of dates it
no longer has.

A date that has grown many folders is compacted: its batches up to N are rewritten below
``<root>/_base/date_key=D/version=N``, and an empty file ``<root>/_versions/date_key=D/N``,
which exists or does not, makes that the date's version.  A version is its base and the
folders of later batches.  Readers list a version once and keep to its files; what a
version no longer needs is removed when the next but one is made.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.utils import AnalysisException

from ..schema import FILING_FIELDS

DOCUMENT_SCHEMA = (
    ", ".join(f"{name} string" for name in FILING_FIELDS)
    + ", polling_date string, n_listed bigint, outcome string, stage string, reason string, filename string,"
    " object_key string, content_type string, body binary, file_size bigint, used_enc string, summary string,"
    " date_key string, batch_id string"
)
# an empty date is valid, but no name of a folder
NO_DATE = "none"


def date_key(date: Column) -> Column:
    """The folder of a date."""
    return F.when(date.isNull() | (date == ""), NO_DATE).otherwise(date)


def or_empty(spark: SparkSession, load: Callable[[], DataFrame], schema: str) -> DataFrame:
    """What ``load`` reads, or no rows where its folder does not exist yet."""
    try:
        return load()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_table(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """A whole Parquet table that may not have been written yet."""
    dates = _names(spark, f"{root}/{_VERSIONS}", "date_key=")
    if dates:
        return read_dates(spark, root, {*dates, *_names(spark, root, "date_key=")}, schema)
    return or_empty(spark, lambda: spark.read.schema(schema).parquet(root), schema)


def folders_of(spark: SparkSession, root: str, dates: Iterable[str], key: str = "date_key") -> list[str]:
    """The existing folders of the given dates."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    made = spark._jvm.org.apache.hadoop.fs.Path
    paths = [f"{root}/{key}={date}" for date in sorted(set(dates))]
    return [p for p in paths if made(p).getFileSystem(conf).exists(made(p))]


def dates_of(spark: SparkSession, root: str, key: str = "date_key") -> list[str]:
    """The dates that have a folder."""
    return _names(spark, root, f"{key}=")


_BASE, _VERSIONS = "_base", "_versions"


def _path(spark: SparkSession, folder: str):
    """The folder's Hadoop path and file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _names(spark: SparkSession, folder: str, prefix: str = "") -> list[str]:
    """What comes after ``prefix`` in the names of a folder's children that begin with it."""
    path, files = _path(spark, folder)
    if not files.exists(path):
        return []
    names = [status.getPath().getName() for status in files.listStatus(path)]
    return sorted(n.removeprefix(prefix) for n in names if n.startswith(prefix))


def _delete(spark: SparkSession, folder: str) -> None:
    path, files = _path(spark, folder)
    files.delete(path, True)


@dataclass(frozen=True)
class Snapshot:
    """A version of some dates of a table: folders that hold exactly its rows."""

    root: str
    bases: tuple[str, ...]
    batches: tuple[str, ...]

    def read(self, spark: SparkSession, schema: str) -> DataFrame:
        empty = spark.createDataFrame([], schema)
        found = []
        if self.bases:
            # in a base the batch is a column, and the version comes from the folder
            found.append(spark.read.schema(f"{schema}, version string").option("basePath", f"{self.root}/{_BASE}").parquet(*self.bases))
        if self.batches:
            found.append(spark.read.schema(schema).option("basePath", self.root).parquet(*self.batches))
        rows = [df.select(*empty.columns) for df in found]
        return rows[0] if len(rows) == 1 else rows[0].unionByName(rows[1]) if rows else empty


def versions_of(spark: SparkSession, root: str, date: str) -> list[int]:
    """Versions made of a date, oldest first."""
    return sorted(int(n) for n in _names(spark, f"{root}/{_VERSIONS}/date_key={date}") if n.isdigit())


def _batches_after(spark: SparkSession, root: str, date: str, version: int) -> list[int]:
    return sorted(n for n in map(int, _names(spark, f"{root}/date_key={date}", "batch_id=")) if n > version)


def snapshot(spark: SparkSession, root: str, dates: Iterable[str], lasting: bool = True) -> Snapshot:
    """The present version of the given dates; no other folder is listed.

    One that is not ``lasting`` is for a table opened at once: a date that was never compacted is its whole folder then.
    """
    bases, batches = [], []
    for date in sorted(set(dates)):
        made = versions_of(spark, root, date)
        if not made and not lasting:
            batches += folders_of(spark, root, [date])
            continue
        if made:
            base = f"{root}/{_BASE}/date_key={date}/version={made[-1]}"
            path, files = _path(spark, base)
            bases += [base] if files.exists(path) else []  # none where no row was left
        batches += [f"{root}/date_key={date}/batch_id={n}" for n in _batches_after(spark, root, date, made[-1] if made else -1)]
    return Snapshot(root, tuple(bases), tuple(batches))


def read_dates(spark: SparkSession, root: str, dates: Iterable[str], schema: str) -> DataFrame:
    """The rows of the given dates; no other folder is listed."""
    return snapshot(spark, root, dates, lasting=False).read(spark, schema)


def write_base(spark: SparkSession, root: str, dates: Iterable[str], schema: str, upto: int, reduced: Callable[[DataFrame], DataFrame]) -> None:
    """Rewrite the dates' batches up to ``upto``; no reader sees it before ``swap``, and writing again replaces it."""
    rows = read_dates(spark, root, dates, schema).where(F.col("batch_id").cast("bigint") <= upto)
    # a date's rows come together in files of the advised size; a large date is several tasks
    rows = reduced(rows).withColumn("version", F.lit(str(upto))).hint("rebalance", "date_key")
    (
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("date_key", "version").parquet(f"{root}/{_BASE}")
    )


def swap(spark: SparkSession, root: str, dates: Iterable[str], upto: int) -> None:
    """Make the written bases the dates' versions, each by one file that appears at once."""
    for date in sorted(set(dates)):
        path, files = _path(spark, f"{root}/{_VERSIONS}/date_key={date}/{upto}")
        files.create(path, True).close()


def vacuum(spark: SparkSession, root: str, dates: Iterable[str]) -> None:
    """Remove what neither the present version of a date nor the one before it needs."""
    for date in sorted(set(dates)):
        made = versions_of(spark, root, date)
        if len(made) < 2:
            continue
        for n in _batches_after(spark, root, date, -1):
            if n <= made[-2]:
                _delete(spark, f"{root}/date_key={date}/batch_id={n}")
        for version in made[:-2]:
            _delete(spark, f"{root}/{_BASE}/date_key={date}/version={version}")
            _delete(spark, f"{root}/{_VERSIONS}/date_key={date}/{version}")


def compact_dates(
    spark: SparkSession, root: str, dates: Iterable[str], schema: str, upto: int, after: int,
    reduced: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> list[str]:
    """Compact those of the dates with ``after`` folders or more up to batch ``upto``; returns them.

    ``reduced`` leaves out rows that later ones replace.  A batch that may run again
    must be later than ``upto``.  After a crash anywhere in between, readers see the
    version before or the one after, which have the same rows, and the next call
    does what is left.
    """
    grown = []
    for date in sorted(set(dates)):
        made = versions_of(spark, root, date)
        folders = _batches_after(spark, root, date, made[-1] if made else -1)
        if sum(n <= upto for n in folders) >= after:
            grown.append(date)
    if grown:
        write_base(spark, root, grown, schema, upto, reduced)
        swap(spark, root, grown, upto)
        vacuum(spark, root, grown)
    return grown


def write_dates(rows: DataFrame, root: str, batch_id: int, dates: Iterable[str] = ()) -> None:
    """Write a batch's rows, which have ``date_key``; ``dates`` are those an earlier run of it may have left."""
    spark = rows.sparkSession
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    made = spark._jvm.org.apache.hadoop.fs.Path
    for folder in folders_of(spark, root, dates):
        old = made(f"{folder}/batch_id={batch_id}")
        old.getFileSystem(conf).delete(old, True)
    (
        rows.withColumn("batch_id", F.lit(str(batch_id))).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("date_key", "batch_id").parquet(root)
    )


def read_processed(spark: SparkSession, root: str, dates: Iterable[str] | None = None) -> DataFrame:
    """Every filing a poll dealt with, whatever became of it; of the given dates, or all."""
    if dates is None:
        return read_table(spark, root, DOCUMENT_SCHEMA)
    return read_dates(spark, root, dates, DOCUMENT_SCHEMA)


def read_documents(spark: SparkSession, root: str, dates: Iterable[str] | None = None) -> DataFrame:
    return read_processed(spark, root, dates).where(F.col("outcome") == "SUCCESS")


def stored_keys(documents: DataFrame) -> DataFrame:
    """The keys a listing is compared with; no other column is read."""
    return documents.select("rcept_dt", "rcept_no")
