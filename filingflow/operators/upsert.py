"""Create-or-update by filing id."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..sources.store import compact_dates, read_dates, read_table, write_dates
from .incremental import latest_per_key, without


def upsert(target: DataFrame, batch: DataFrame, order: list[str], keys: list[str] = ["rcept_no"]) -> DataFrame:
    """Target after the batch: the last row per key replaces the target's row."""
    latest = latest_per_key(batch, keys, order).select(*target.columns)
    return without(target, latest, keys).unionByName(latest)


def write_batch(batch: DataFrame, root: str, batch_id: int, order: list[str], dates: Iterable[str] = ()) -> None:
    """Store one micro-batch's changes; running a batch again replaces its folders.

    The table is laid out by the date that starts every id, and rows are ranked in that
    order, so that the writer sorts them no second time.
    """
    rows = batch.withColumn("date_key", id_date(F.col("rcept_no")))
    write_dates(latest_per_key(rows, ["date_key", "rcept_no"], order), root, batch_id, dates)


def id_date(rcept_no: Column) -> Column:
    return F.left(rcept_no, F.lit(8))


def current(spark: SparkSession, root: str, schema: str, dates: Iterable[str] | None = None) -> DataFrame:
    """Present state of the table, or of the given dates: the newest batch wins per id."""
    schema += ", date_key string, batch_id string"
    rows = read_table(spark, root, schema) if dates is None else read_dates(spark, root, dates, schema)
    return newest_rows(rows)


def newest_rows(rows: DataFrame) -> DataFrame:
    numbered = rows.withColumn("batch_id", F.col("batch_id").cast("bigint"))
    return latest_per_key(numbered, ["date_key", "rcept_no"], ["batch_id"])


def compact_upserts(spark: SparkSession, root: str, schema: str, dates: Iterable[str], upto: int, after: int) -> list[str]:
    """Compact the dates that have grown; rows that a batch up to ``upto`` has replaced go."""
    schema += ", date_key string, batch_id string"
    return compact_dates(
        spark, root, dates, schema, upto, after, lambda rows: newest_rows(rows).withColumn("batch_id", F.col("batch_id").cast("string"))
    )


def compact(spark: SparkSession, root: str, new_root: str, schema: str, batch_id: int) -> None:
    """Write the present state as one batch of a new table that replaces the old one."""
    write_dates(current(spark, root, schema).drop("batch_id"), new_root, batch_id)
