"""Stream operators that carry state from batch to batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.incremental import without
from ..operators.retry import OK, SKIP, counted_attempts
from ..schema import MAX_FAIL
from ..session import written
from ..sources.store import read_dates, write_dates


def first_seen(batch: DataFrame, seen: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of a micro-batch that the table of those seen does not hold, once each.

    There is no watermark: a row that comes late, by any measure, is still found
    or not found in the table.  Repeats within the batch are combined before the
    shuffle, so a key that dominates it is one row per task.
    """
    return without(batch.select(*keys).distinct(), seen, keys)


def note_first_seen(batch: DataFrame, batch_id: int, root: str, keys: list[str], date: Column) -> None:
    """Add the keys first seen in this micro-batch to the table at ``root``.

    ``date`` says by a key alone which day it belongs to; only the days of the
    batch are compared.  Running a batch again replaces its own folder.
    """
    spark = batch.sparkSession
    rows = written(batch.select(*keys).distinct().withColumn("date_key", date), "seen-keys")
    schema = ", ".join(f"{k} {t}" for k, t in rows.select(*keys).dtypes)
    days = [r[0] for r in rows.select("date_key").distinct().collect()]
    earlier = read_dates(spark, root, days, f"{schema}, date_key string, batch_id string")
    fresh = first_seen(rows, earlier.where(F.col("batch_id").cast("bigint") < batch_id), [*keys, "date_key"])
    write_dates(fresh, root, batch_id, days)


def advance_state(state: DataFrame, attempts: DataFrame, max_fail: int = MAX_FAIL) -> DataFrame:
    """Retry state of the ids in ``attempts`` after them.

    A filing that is done stays as it is.  An open one has ``fails`` failures
    behind it, so only its next ``max_fail - fails`` attempts can count; as in
    ``retry_state`` those are picked before the shuffle.
    """
    first = counted_attempts(attempts.select("rcept_no", "attempt_ts", "seq", "kind"), max_fail)

    def first_no(kind: str) -> Column:
        return F.min(F.when(F.col("kind") == kind, F.col("attempt_no")))

    batch = first.groupBy("rcept_no").agg(
        first_no(OK).alias("ok_no"), first_no(SKIP).alias("skip_no"), F.max("attempt_no").alias("n")
    )
    old = state.select("rcept_no", F.col("term").alias("old_term"), F.col("fails").alias("old_fails"))
    end_no = F.least("ok_no", "skip_no")
    before_end = F.coalesce(end_no - 1, F.col("n"))
    held = F.coalesce("old_fails", F.lit(0))
    permanent = held + before_end >= max_fail
    return batch.join(old, "rcept_no", "left").select(
        "rcept_no",
        F.when(F.col("old_term").isNotNull(), F.col("old_term"))
        .when(permanent, "PERM")
        .when(F.col("ok_no") == end_no, OK)
        .when(F.col("skip_no") == end_no, SKIP)
        .alias("term"),
        F.when(F.col("old_term").isNotNull(), held)
        .otherwise(F.least(held + before_end, F.lit(max_fail)))
        .cast("bigint")
        .alias("fails"),
    )
