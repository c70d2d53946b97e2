"""Batch writers.  Every batch owns its folders, so writing it again is harmless."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from ..functions.text import guess_content_type
from ..sources.objects import write_objects
from ..sources.store import date_key, write_dates
from .publish import message_json, object_key


def with_content_type(documents: DataFrame) -> DataFrame:
    """Fill an absent content type by the file extension."""
    return documents.withColumn(
        "content_type", F.coalesce("content_type", guess_content_type(F.col("filename")))
    )


def store_documents(documents: DataFrame, root: str, batch_id: int = 0, dates: Iterable[str] = ()) -> None:
    """Write documents by filing date and batch, under their object key.

    Failed filings lie beside the documents as rows without a body, so a poll
    writes every body once and reads its bookkeeping back from other columns.
    Rows are written where they are: payload files are landed by date, so a
    task holds few dates and bodies need not be shuffled for the layout.
    """
    if "outcome" not in documents.columns:
        documents = documents.withColumn("outcome", F.lit("SUCCESS"))
    stored = F.col("outcome") == "SUCCESS"
    rows = (
        with_content_type(documents)
        .withColumn("content_type", F.when(stored, F.col("content_type")))
        .withColumn("object_key", F.when(stored, object_key(F.col("rcept_dt"), F.col("filename"))))
        .withColumn("body", F.when(stored, F.col("body")))
        .withColumn("file_size", F.coalesce("file_size", F.octet_length("body").cast("bigint")))
        .withColumn("date_key", date_key(F.col("rcept_dt")))
    )
    write_dates(rows, root, batch_id, dates)


def export_objects(documents: DataFrame, root: str) -> None:
    """Put stored documents as files ``<root>/<filing date>/<file name>``, as other programs expect them."""
    stored = documents.where(F.col("outcome") == "SUCCESS") if "outcome" in documents.columns else documents
    key = object_key(F.col("rcept_dt"), F.col("filename"))
    write_objects(stored.withColumn("object_key", key), root)


def publish(rows: DataFrame, root: str, batch_id: int = 0) -> None:
    """Write messages as JSON lines for the message stream."""
    message_json(rows).write.mode("overwrite").text(f"{root}/batch_id={batch_id}")


def append_attempts(attempts: DataFrame, root: str, batch_id: int = 0, dates: Iterable[str] = ()) -> None:
    """Add a batch to the attempt ledger, by filing date."""
    write_dates(attempts.withColumn("date_key", date_key(F.col("filing.rcept_dt"))), root, batch_id, dates)
