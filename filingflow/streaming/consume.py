"""Message stream: messages to the upsert table and to task results.

Delivery is at least once; writing by batch folder and keeping the newest row
per id make a repeated message or batch harmless.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.publish import REPORTED, task_results, upsert_columns, upsert_payload
from ..operators.upsert import compact_upserts, current, id_date, write_batch
from ..session import configure, scratch, written
from ..sources.messages import read_messages

UPSERT_SCHEMA = "rcept_no string, body string, published_at timestamp, published_seq bigint"


#: Folders of a date in the upsert table before they become one.
COMPACT_AFTER = 24


def consume_batch(
    batch: DataFrame, batch_id: int, table_root: str, results_root: str, compact_after: int = COMPACT_AFTER
) -> None:
    """Upsert a batch of messages and note what became of each.

    A message that cannot be read or has no valid date is an error row; it
    never stops the stream.  What cannot be read is kept whole in ``unreadable``.
    The lines are parsed once: the batch's payloads are written, and dates, table and
    results read their own columns of them.
    """
    spark = configure(batch.sparkSession)
    order = ["published_at", "published_seq"]
    with scratch(spark):
        columns = upsert_columns(batch, keep=["unreadable", *order, *REPORTED])
        read = written(columns.select("rcept_no", "unreadable", *order, *REPORTED, "date_error", upsert_payload(columns).alias("body")), "messages")
        broken = F.col("rcept_no").isNull()
        payloads = read.where(~broken)
        good = payloads.where(F.col("date_error").isNull()).select("rcept_no", "body", *order)
        dates = _noted_dates(good, table_root, batch_id)
        write_batch(good, table_root, batch_id, order, dates)
        unreadable = read.where(broken).select(
            F.lit("error").alias("status"),
            F.lit("unexpected_error").alias("error_type"),
            F.when(F.col("unreadable").isNull(), "message without an id").otherwise("unreadable message").alias("error_message"),
            "unreadable",
        )
        results = task_results(payloads).unionByName(unreadable, allowMissingColumns=True)
        results.write.mode("overwrite").parquet(f"{results_root}/batch_id={batch_id}")
    compact_upserts(spark, table_root, UPSERT_SCHEMA, dates, batch_id - 1, compact_after)


def _noted_dates(good: DataFrame, table_root: str, batch_id: int) -> list[str]:
    """Dates of a batch, whose folders an earlier run of it may have written."""
    return [r[0] for r in good.select(id_date(F.col("rcept_no"))).distinct().collect()]


def start_consume(
    spark: SparkSession, messages_root: str, table_root: str, results_root: str, checkpoint: str,
    interval: str | None = "10 seconds", max_files: int = 100, compact_after: int = COMPACT_AFTER,
) -> StreamingQuery:
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    stream = read_messages(spark, messages_root, stream=True, maxFilesPerTrigger=max_files)
    return (
        stream.writeStream.foreachBatch(
            lambda batch, batch_id: consume_batch(batch, batch_id, table_root, results_root, compact_after)
        )
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def upserted(spark: SparkSession, table_root: str) -> DataFrame:
    return current(spark, table_root, UPSERT_SCHEMA)
