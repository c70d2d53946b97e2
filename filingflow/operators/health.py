"""Component health from an event table ``component, ts, seq, ok``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import written

SEVERITY = ["healthy", "degraded", "unhealthy"]
MANY_FAILURES = 5


def consecutive_failures(events: DataFrame) -> DataFrame:
    """Per component: last success and the failures after it.

    The last success is an aggregate with a partial step, one small row per
    component, and is written to the shared folder.  Its size is known then: it
    is broadcast if small, and otherwise AQE splits a component with most of
    the events, which it does not do for a join with an aggregate.
    """
    at = F.struct("ts", "seq")
    last = written(events.groupBy("component").agg(F.max(F.when(F.col("ok"), at)).alias("last")), "last-success")
    after = (
        events.where(~F.col("ok"))
        .select("component", at.alias("at"))
        .join(last, "component")
        .where(F.col("last").isNull() | (F.col("at") > F.col("last")))
        .groupBy("component")
        .agg(F.count("*").alias("failures"))
    )
    return last.join(after, "component", "left").select(
        "component",
        F.col("last.ts").alias("last_success"),
        F.coalesce("failures", F.lit(0)).alias("consecutive_failures"),
    )


def component_status(last_success: Column, failures: Column) -> Column:
    return (
        F.when(last_success.isNull(), "degraded")
        .when(failures > MANY_FAILURES, "unhealthy")
        .when(failures > 0, "degraded")
        .otherwise("healthy")
    )


def status_message(last_success: Column, failures: Column) -> Column:
    return (
        F.when(last_success.isNull(), F.lit("No successful API call yet"))
        .when(failures > MANY_FAILURES, F.concat(F.lit("Too many consecutive failures: "), failures))
        .when(failures > 0, F.concat(F.lit("Recent failures: "), failures))
        .otherwise(F.concat(F.lit("Last success: "), F.date_format(last_success, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")))
    )


def component_health(events: DataFrame) -> DataFrame:
    """Check result per component: status, message and a details map."""
    counted = consecutive_failures(events)
    last, failures = F.col("last_success"), F.col("consecutive_failures")
    return counted.select(
        "*",
        component_status(last, failures).alias("status"),
        status_message(last, failures).alias("message"),
        F.create_map(
            F.lit("last_success"), F.date_format(last, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
            F.lit("consecutive_failures"), failures.cast("string"),
        ).alias("details"),
    )


def severity(status: Column) -> Column:
    return F.array_position(F.array(*[F.lit(s) for s in SEVERITY]), status)


def rollup(checks: DataFrame, *by: str) -> DataFrame:
    """Overall status: the worst one; ready unless something is unhealthy."""
    worst = F.max(severity(F.col("status")))
    return checks.groupBy(*by).agg(
        F.element_at(F.array(*[F.lit(s) for s in SEVERITY]), worst.cast("int")).alias("status"),
        F.bool_and(F.col("status") != "unhealthy").alias("ready"),
        F.count("*").alias("checks"),
    )


def poll_metrics(events: DataFrame, *by: str) -> DataFrame:
    """Polls, processed filings, errors and the last poll from ``kind, ts, latency_ms``."""
    kind = F.col("kind")
    return events.groupBy(*by).agg(
        F.count_if(kind == "poll").alias("polls"),
        F.count_if(kind == "processed").alias("processed_count"),
        F.count_if(kind == "error").alias("error_count"),
        F.max(F.when(kind == "poll", F.col("ts"))).alias("last_poll"),
        F.round(F.max("latency_ms"), 2).alias("max_latency_ms"),
    )
