"""Messages, upsert payloads and task results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import backoff_seconds, reception_date, reception_date_error, strip, truncate
from ..schema import MESSAGE_FIELDS, MIN_BODY_BYTES, TOO_SMALL


def object_key(rcept_dt: Column, filename: Column) -> Column:
    return F.concat_ws("/", rcept_dt, filename)


def size_gate(documents: DataFrame, min_bytes: int = MIN_BODY_BYTES) -> DataFrame:
    """Add ``file_size`` and ``skip_reason``, set where the body is too small to keep."""
    return documents.withColumn("file_size", F.octet_length("body").cast("bigint")).withColumn(
        "skip_reason", F.when(F.col("file_size") < min_bytes, F.format_string(TOO_SMALL, F.col("file_size")))
    )


def messages(documents: DataFrame, polling_date: Column) -> DataFrame:
    """One message per stored document: the filing without its URL, and where it lies."""
    with_key = documents.withColumn("object_key", object_key(F.col("rcept_dt"), F.col("filename")))
    return with_key.withColumn("polling_date", polling_date).select(*MESSAGE_FIELDS)


def message_json(rows: DataFrame) -> DataFrame:
    """Messages as JSON text with every key present."""
    return rows.select(
        F.to_json(F.struct(*MESSAGE_FIELDS), {"ignoreNullFields": "false"}).alias("value")
    )


# Payload key, message field. The first group is sent even when null.
ALWAYS_SENT = {
    "reportName": "report_nm",
    "corpCode": "corp_code",
    "corpName": "corp_name",
    "corpCls": "corp_cls",
    "flrName": "flr_nm",
    "receptionDate": "rcept_dt",
}
SENT_IF_SET = {
    "stockCode": "stock_code",
    "remark": "rm",
    "minioObjectName": "object_key",
    "contentType": "content_type",
    "fileSize": "file_size",
    "tags": "tags",
}


def upsert_columns(rows: DataFrame, keep: list[str] = []) -> DataFrame:
    """Payload fields as columns next to ``rcept_no``, with ``date_error``.

    Texts are stripped; ``tags`` is taken along where the input has it.
    """
    present = dict(rows.dtypes)

    def field(source: str) -> Column:
        if source == "rcept_dt":
            return reception_date(F.col(source))
        return strip(F.col(source)) if present[source] == "string" else F.col(source)

    return rows.select(
        "rcept_no",
        *keep,
        *[field(source).alias(key) for key, source in (ALWAYS_SENT | SENT_IF_SET).items() if source in present],
        reception_date_error(F.col("rcept_dt")).alias("date_error"),
    )


def upsert_payload(columns: DataFrame) -> Column:
    """JSON body: the first six keys keep their nulls, the others drop them."""
    required = F.to_json(F.struct(*ALWAYS_SENT), {"ignoreNullFields": "false"})
    optional = F.to_json(F.struct(*[c for c in SENT_IF_SET if c in columns.columns]))
    return F.concat(
        F.left(required, F.length(required) - 1),
        F.when(optional == "{}", "}").otherwise(F.concat(F.lit(","), F.substring(optional, F.lit(2), F.length(optional)))),
    )


# Fixed value: how much of an answer the log line shows.
LOGGED_CHARS = 200

# message fields a success reports as they came
REPORTED = ["corp_code", "corp_name", "object_key"]


def task_results(payloads: DataFrame) -> DataFrame:
    """Result rows of the consumer, one table for what became of every message.

    ``payloads`` are ``upsert_columns`` that keep the ``REPORTED`` fields.  A bad
    date is an error that is not tried again.  Where they have the columns ``code``
    and ``response`` of the upsert, 4xx is the client's error, told whole; answers
    that are tried again have no result yet and are left out.
    """
    bad = F.col("date_error")
    answered = "code" in payloads.columns
    code = F.col("code") if answered else F.lit(200)
    refused = bad.isNull() & F.coalesce(code.between(400, 499), F.lit(False))
    done = bad.isNull() & F.coalesce(code.between(200, 299), F.lit(False))
    response = F.col("response") if answered else F.lit(None).cast("string")
    return payloads.where(bad.isNotNull() | refused | done).select(
        "rcept_no",
        F.when(done, "success").otherwise("error").alias("status"),
        F.when(bad.isNotNull(), "unexpected_error").when(refused, "client_error").alias("error_type"),
        F.when(refused, response).otherwise(bad).alias("error_message"),
        *[F.when(done, F.col(name)).alias(name) for name in REPORTED],
    )


def route_responses(responses: DataFrame, max_retries: int = 3) -> DataFrame:
    """What happens after each upsert response ``code, attempt_no, response``.

    2xx succeeds, 4xx is final, anything else (no code means no connection) is
    tried again with growing waits until the attempts are used up.
    """
    code = F.col("code")
    client_error = code.between(400, 499)
    success = code.between(200, 299)
    again = ~F.coalesce(success | client_error, F.lit(False)) & (F.col("attempt_no") < max_retries)
    return responses.select(
        "*",
        F.when(success, "success").when(client_error, "error").when(again, "retry").otherwise("exhausted").alias("status"),
        F.when(client_error, "client_error").alias("error_type"),
        F.when(client_error, F.col("response")).alias("error_message"),
        F.when(client_error, truncate(F.col("response"), LOGGED_CHARS)).alias("logged"),
        F.when(again, backoff_seconds(F.col("attempt_no") - 1)).alias("wait_s"),
    )
