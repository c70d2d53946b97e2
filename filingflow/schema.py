"""Table schemas and the fixed values the service contract prescribes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# --- fixed values: names of the listing fields -----------------------------
REQUIRED_FIELDS = ["corp_code", "corp_name", "corp_cls", "report_nm", "rcept_no", "rcept_dt"]
OPTIONAL_FIELDS = ["stock_code", "flr_nm", "rm"]
FILING_FIELDS = [
    "corp_code", "corp_name", "stock_code", "corp_cls", "report_nm",
    "rcept_no", "flr_nm", "rcept_dt", "rm", "url",
]
MESSAGE_FIELDS = [
    "corp_code", "corp_name", "stock_code", "corp_cls", "report_nm",
    "rcept_no", "flr_nm", "rcept_dt", "rm",
    "object_key", "content_type", "file_size", "polling_date",
]
VIEWER_URL = "https://dart.fss.or.kr/dsaf001/main.do?rcpNo="

# --- fixed values: limits --------------------------------------------------
MAX_PAGE_SIZE = 100
MAX_FAIL = 3
MIN_BODY_BYTES = 200
MAX_ARCHIVE_FILES = 200
MAX_ARCHIVE_BYTES = 200 * 1024 * 1024
ZIP_SIGNATURE = "504B0304"

# --- fixed values: service status codes ------------------------------------
# code, meaning, what pagination does, seconds to wait, what a document fetch does
STATUS_ROWS = [
    ("000", "ok", "accept", 0, "none"),
    ("010", "unregistered key", "key_error", 300, "critical"),
    ("011", "disabled key", "key_error", 300, "critical"),
    ("012", "address not allowed", "error", 0, "none"),
    ("013", "no data", "no_data", 0, "no_retry"),
    ("014", "file not found", "error", 0, "no_retry"),
    ("020", "request limit exceeded", "rate_limited", 3600, "none"),
    ("021", "too many companies", "error", 0, "none"),
    ("100", "invalid field value", "error", 0, "no_retry"),
    ("101", "invalid access", "error", 0, "none"),
    ("800", "maintenance", "maintenance", 300, "none"),
    ("900", "undefined error", "error", 0, "none"),
    ("901", "key expired", "error", 0, "critical"),
]

# --- fixed values: failure texts -------------------------------------------
NO_DOCUMENT = "Failed to download document from DART API."
CRITICAL_DOCUMENT = "DART API Error [%s]: %s"
TOO_SMALL = "Processed file too small (%d bytes)."
TOO_MANY_FILES = "Too many files in ZIP: %d (max: %d)"
TOO_LARGE = "ZIP too large: %d bytes (max: %d)"
NO_FILES = "Empty ZIP file"

PAGE_SCHEMA = "value string, date string, page_no int"
MESSAGE_SCHEMA = ", ".join(
    f"{name} {'bigint' if name == 'file_size' else 'string'}" for name in MESSAGE_FIELDS
)
ATTEMPT_SCHEMA = (
    "rcept_no string, attempt_ts timestamp, seq bigint, outcome string, stage string, reason string, filing struct<"
    + ", ".join(f"{name}: string" for name in FILING_FIELDS)
    + ">"
)


def status_dimension(spark: SparkSession, poll_interval: int = 300) -> DataFrame:
    """Status codes with their actions: thirteen rows, so always safe to broadcast.

    A key error waits one poll interval.
    """
    rows = ", ".join(f"('{c}', '{m}', '{a}', {w}, '{d}')" for c, m, a, w, d in STATUS_ROWS)
    dim = spark.sql(
        f"SELECT * FROM VALUES {rows} AS t(code, meaning, page_action, wait_s, doc_action)"
    )
    return dim.withColumn(
        "wait_s",
        F.when(F.col("page_action") == "key_error", F.lit(poll_interval)).otherwise(F.col("wait_s")),
    )
