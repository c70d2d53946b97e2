"""Downloaded documents and the XML error answers that come in their place.

Layout: ``<root>/date=YYYYMMDD/<rcept_no>.<ext>``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.kind import is_zip, well_formed_xml
from ..functions.once import computed_once
from ..functions.text import base_name
from ..schema import CRITICAL_DOCUMENT, NO_DOCUMENT, STATUS_ROWS
from . import arrivals
from .landed import content, dealt_files, list_files, newest_files


# a byte order mark and an XML declaration
_DECLARED = r"\A\uFEFF?(?:[ \t-\r]*<\?xml[^>]*\?>)?"


def list_payloads(spark: SparkSession, root: str, dates: Iterable[str] | None = None) -> DataFrame:
    """Payload files as a stored table with ``rcept_no, date, length, path``; with ``dates`` only their folders are listed.

    Of several files of a filing the newest counts, chosen by what the listing of
    the folder says about them.
    """
    listed = list_files(spark, root, dates).withColumn("rcept_no", base_name(F.col("path"), ascii_only=True))
    return newest_files(listed, ["date", "rcept_no"], root)


def read_payloads(spark: SparkSession, root: str, dates: Iterable[str] | None = None) -> DataFrame:
    """The newest payload files as ``rcept_no, date, length, content``.

    ``content`` is only read from storage where a query selects it.
    """
    listed = list_payloads(spark, root, dates)
    return dealt_files(listed, listed).select("rcept_no", "date", "length", content(root, F.col("path")).alias("content"))


def with_content(rows: DataFrame, listed: DataFrame, root: str) -> DataFrame:
    """Rows of ``list_payloads``, or of a join with them, with the file's ``content`` in place of its ``path``."""
    return computed_once(dealt_files(rows, listed), [c for c in rows.columns if c != "path"], content=content(root, F.col("path")))


def arrived_payloads(spark: SparkSession, log: str, most: int | None = None) -> DataFrame:
    """The stream of payload files that ``note_arrivals`` wrote to the log, as ``rcept_no, date``; it reads no content."""
    files = arrivals.logged_arrivals(spark, log, most)
    return files.select(base_name(F.col("path"), ascii_only=True).alias("rcept_no"), "date")


def error_answer(content: Column) -> Column:
    """``struct<status, message>`` of an XML error answer, NULL when it is none."""
    text = F.regexp_replace(F.try_validate_utf8(content.cast("string")), _DECLARED, "")
    answer = F.from_xml(text, "status string, message string, _corrupt_record string")
    return F.when(
        well_formed_xml(text) & answer.getField("status").isNotNull(),
        F.struct(
            answer.getField("status").alias("status"),
            F.coalesce(answer.getField("message"), F.lit("Unknown error")).alias("message"),
        ),
    )


def with_download_error(payloads: DataFrame, content: str = "content") -> DataFrame:
    """Add ``download_error``: why a payload is no archive, NULL for an archive.

    A critical status names itself; everything else counts as not downloaded.
    """
    critical = [code for code, *_, action in STATUS_ROWS if action == "critical"]
    archive = is_zip(F.col(content))
    answered = payloads.withColumn(
        "_answer", F.when(~archive, error_answer(F.col(content)))
    )
    status, message = F.col("_answer.status"), F.col("_answer.message")
    return answered.withColumn(
        "download_error",
        F.when(status.isin(critical), F.format_string(CRITICAL_DOCUMENT, status, message))
        .when(F.coalesce(archive, F.lit(False)), F.lit(None).cast("string"))
        .otherwise(F.lit(NO_DOCUMENT)),
    ).drop("_answer")
