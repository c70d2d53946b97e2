"""Retry state of filings, derived from the append-only attempt ledger.

A success or a skip ends a filing, and so does its ``max_fail``-th failure;
later attempts do not count.  A filing therefore ends within its first
``max_fail`` attempts, and its state is a function of those alone.  Spark keeps
just that many rows per id and input partition before the shuffle, so a filing
with a third of all attempts costs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.text import backoff_seconds
from ..schema import MAX_FAIL

OK, SKIP, FAIL = "OK", "SKIP", "FAIL"


def attempt_kind(outcome):
    """OK, SKIP or FAIL for a ledger outcome."""
    return (
        F.when(outcome.isin("SUCCESS"), OK)
        .when(outcome.isin("SKIPPED_EXISTS", "SKIPPED_TOO_SMALL"), SKIP)
        .otherwise(FAIL)
    )


def counted_attempts(attempts: DataFrame, max_fail: int = MAX_FAIL) -> DataFrame:
    """Attempts that can count, with ``attempt_no`` from 1."""
    order = Window.partitionBy("rcept_no").orderBy("attempt_ts", "seq")
    return (
        attempts.withColumn("attempt_no", F.row_number().over(order))
        .where(F.col("attempt_no") <= max_fail)
    )


def retry_state(attempts: DataFrame, max_fail: int = MAX_FAIL) -> DataFrame:
    """Per id: ``term`` (OK, SKIP, PERM or NULL) and ``fails``, the failures that counted.

    ``attempts`` has ``rcept_no, attempt_ts, seq, kind``.
    """
    slim = attempts.select("rcept_no", "attempt_ts", "seq", "kind")

    def first(kind):
        return F.min(F.when(F.col("kind") == kind, F.col("attempt_no")))

    per_id = counted_attempts(slim, max_fail).groupBy("rcept_no").agg(
        first(OK).alias("ok_no"), first(SKIP).alias("skip_no"), F.max("attempt_no").alias("n")
    )
    end_no = F.least("ok_no", "skip_no")
    return per_id.select(
        "rcept_no",
        F.when(F.col("ok_no") == end_no, OK)
        .when(F.col("skip_no") == end_no, SKIP)
        .when(F.col("n") >= max_fail, "PERM")
        .alias("term"),
        # every attempt before the end is a failure
        F.coalesce(end_no - 1, F.col("n")).cast("bigint").alias("fails"),
    )


def is_pending():
    """Failure count still held: a success clears it, a skip does not."""
    term = F.col("term")
    return (F.col("fails") > 0) & (term.isNull() | (term == SKIP))


def retry_stats(state: DataFrame) -> DataFrame:
    term = F.col("term")
    return state.agg(
        F.count("term").alias("processed_count"),
        F.count_if(term == OK).alias("success_count"),
        F.count_if(term == SKIP).alias("skip_count"),
        F.coalesce(F.sum("fails"), F.lit(0)).alias("error_count"),
        F.count_if(is_pending()).alias("pending_retry_count"),
        F.count_if(term == "PERM").alias("permanently_failed_count"),
    )


def finished_ids(state: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Ids processed by success or skip, and ids failed for good."""
    processed = state.where(F.col("term").isin(OK, SKIP)).select("rcept_no")
    failed = state.where(F.col("term") == "PERM").select("rcept_no")
    return processed, failed


def due_retries(listing: DataFrame, state: DataFrame) -> DataFrame:
    """Listed filings that failed before and are still open, with their failure count."""
    open_state = state.where(F.col("term").isNull() & (F.col("fails") > 0))
    return listing.join(open_state.select("rcept_no", "fails"), "rcept_no")


def with_prior_fails(filings: DataFrame, state: DataFrame) -> DataFrame:
    """Add ``prior_fails``, 0 for a filing never tried."""
    held = state.select("rcept_no", F.when(is_pending(), F.col("fails")).alias("prior_fails"))
    return filings.join(held, "rcept_no", "left").fillna({"prior_fails": 0})


def backoff_schedule(attempts: DataFrame, max_retries: int = 3) -> DataFrame:
    """When each failed attempt is tried again; the last one has no next time.

    ``attempts`` has ``attempt_no`` from 1 and ``attempt_ts``.
    """
    wait = F.when(F.col("attempt_no") < max_retries, backoff_seconds(F.col("attempt_no") - 1))
    return attempts.withColumn("wait_s", wait).withColumn(
        "next_attempt_ts",
        F.col("attempt_ts") + F.make_dt_interval(secs=F.col("wait_s").cast("decimal(18,6)")),
    )
