"""Failure records and outcome counts over the attempt ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .incremental import latest_per_key


def failure_records(attempts: DataFrame) -> DataFrame:
    """Attempts that left a reason, as nested failure records."""
    return attempts.where(F.col("reason").isNotNull()).select(
        "rcept_no",
        "seq",
        F.col("attempt_ts").alias("recorded_at"),
        F.col("reason").alias("failure_reason"),
        F.col("filing").alias("disclosure_details"),
    )


def latest_failures(records: DataFrame) -> DataFrame:
    """Last record per id; an earlier one is overwritten."""
    return latest_per_key(records, ["rcept_no"], ["recorded_at", "seq"])


def outcome_counts(attempts: DataFrame) -> DataFrame:
    return attempts.groupBy("outcome").agg(F.count("*").alias("n"))
