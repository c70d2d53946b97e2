"""Published messages: JSON lines below ``<root>/batch_id=N``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schema import MESSAGE_FIELDS, MESSAGE_SCHEMA


def read_messages(spark: SparkSession, root: str, stream: bool = False, **options) -> DataFrame:
    """Messages with ``published_at`` and ``published_seq``, which order repeated ids.

    A line that is no message has its text in ``unreadable`` and NULLs elsewhere.
    """
    reader = spark.readStream if stream else spark.read
    schema = MESSAGE_SCHEMA + ", batch_id string, unreadable string"
    rows = reader.schema(schema).options(columnNameOfCorruptRecord="unreadable", **options).json(root)
    return rows.select(
        *MESSAGE_FIELDS,
        "unreadable",
        F.col("_metadata.file_modification_time").alias("published_at"),
        F.col("batch_id").cast("bigint").alias("published_seq"),
    )
