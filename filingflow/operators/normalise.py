"""Bytes to UTF-8 documents, without moving a row to another task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import charset, kind as kinds
from ..functions.once import computed_once
from ..functions.rewrite import rewrite
from ..functions.text import base_name, safe_name
from ..schema import MAX_ARCHIVE_BYTES, MAX_ARCHIVE_FILES
from ..sources.archive import read_archive

# Content types of stored documents.
HTML_TYPE = "text/html; charset=UTF-8"
XML_TYPE = "application/xml; charset=UTF-8"
OTHER_TYPE = "application/octet-stream"


def decode_document(docs: DataFrame, data: str = "data", declared: str = "declared") -> DataFrame:
    """Add ``text`` and ``used_enc``: declared charset, else UTF-8, Korean, Latin-1.

    Each attempt is a column of its own and only computed where the ones before
    it failed, so no document is decoded twice with the same charset.
    """
    raw, name = F.col(data), F.col(declared)
    java = charset.java_charset(name)
    stated = F.when(java == "UTF-8", charset.utf8_text(raw)).when(java.isNotNull(), charset.loose_text(raw, java))
    malformed = F.col("_stated").rlike(charset.MALFORMED) & (java != "UTF-8") | (
        (java == "MS949") & F.col("_stated").rlike(charset.MALFORMED_KOREAN)
    )
    steps = (
        docs.withColumn("_stated", stated)
        .withColumn("_stated", F.when(malformed, None).otherwise(F.col("_stated")))
        .withColumn("_utf8", F.when(F.col("_stated").isNull(), charset.utf8_text(raw)))
        .withColumn(
            "_korean",
            F.when(
                F.col("_stated").isNull() & F.col("_utf8").isNull(),
                charset.loose_text(raw, F.lit("MS949")),
            ),
        )
        .withColumn(
            "_korean",
            F.when(~F.col("_korean").rlike(charset.MALFORMED_KOREAN), F.col("_korean")),
        )
    )
    return computed_once(
        steps,
        docs.columns,
        text=F.coalesce("_stated", "_utf8", "_korean", kinds.byte_text(raw)),
        used_enc=F.when(F.col("_stated").isNotNull(), name)
        .when(F.col("_utf8").isNotNull(), "utf-8-sig")
        .when(F.col("_korean").isNotNull(), "cp949")
        .when(raw.isNotNull(), "iso-8859-1"),
    )


def with_archive(
    payloads: DataFrame,
    content: str = "content",
    max_files: int = MAX_ARCHIVE_FILES,
    max_bytes: int = MAX_ARCHIVE_BYTES,
) -> DataFrame:
    """Add ``is_zip`` and ``archive``, whose ``best`` is the member to keep.

    Only archives are handed to Python, once.
    """
    zipped = F.coalesce(kinds.is_zip(F.col(content)), F.lit(False))
    scanned = payloads.withColumn("is_zip", zipped)
    return computed_once(
        scanned,
        scanned.columns,
        archive=read_archive(F.when(F.col("is_zip"), F.col(content)), max_files, max_bytes),
    )


def normalise(
    payloads: DataFrame,
    name: str = "rcept_no",
    content: str = "content",
    stem: str | None = None,
    keep_tail: bool = False,
    max_files: int = MAX_ARCHIVE_FILES,
    max_bytes: int = MAX_ARCHIVE_BYTES,
) -> DataFrame:
    """Add the document to keep from each payload.

    New columns: ``content_type``, ``body``, ``filename``, ``used_enc``,
    ``summary`` and ``error``, which is set where the filing has to fail.
    ``content`` is dropped.  ``stem`` names a column that already holds the safe
    file name made from ``name``.
    """
    others = [c for c in payloads.columns if c not in (content, stem)]
    kept = F.col("archive.failure").isNotNull()
    picked = (
        with_archive(payloads, content, max_files, max_bytes)
        .withColumn("data", F.when(F.col("archive.best").isNotNull(), F.col("archive.best.data")).otherwise(F.col(content)))
        .withColumn(
            "kind",
            F.when(~F.col("is_zip"), kinds.sniff_kind(F.col(content))).otherwise(F.coalesce("archive.best.kind", F.lit("bin"))),
        )
        .withColumn("_seen", F.when(F.col("kind") != "bin", kinds.byte_text(F.col("data"))))
        .withColumn("declared", charset.declared_charset(F.col("_seen"), F.col("kind")))
        .withColumn("error", F.coalesce("archive.fatal", charset.unknown_charset(F.col("declared"))))
        .withColumn("_readable", F.when((F.col("kind") != "bin") & F.col("error").isNull(), F.col("data")))
    )
    decoded = decode_document(picked, "_readable", "declared")
    file_stem = F.col(stem) if stem else safe_name(base_name(F.col(name)))
    kind = F.col("kind")
    extension = F.when(kind == "html", ".html").when(kind == "xml", ".xml").when(kept, ".zip").otherwise("")
    whole = F.coalesce(rewrite(F.col("text"), kind, keep_tail).cast("binary"), F.col("data"))
    return computed_once(
        decoded,
        others,
        content_type=F.when(kind == "html", HTML_TYPE).when(kind == "xml", XML_TYPE).otherwise(OTHER_TYPE),
        body=F.when(F.col("error").isNull(), whole),
        filename=F.concat(file_stem, extension),
        used_enc=F.col("used_enc"),
        summary=document_summary(F.col("archive"), F.col("archive.best.name"), kind, F.col("used_enc")),
        error=F.col("error"),
    )


def document_summary(archive: Column, member: Column, kind: Column, used_enc: Column) -> Column:
    """One line on what was kept and how it was read."""
    enc = F.when(used_enc.isNotNull(), F.concat(F.lit(" [enc: "), used_enc, F.lit("]"))).otherwise("")
    failure, n_files = archive.getField("failure"), archive.getField("n_files")
    return (
        F.when(failure.isNotNull(), F.concat(F.lit("ZIP(failed: "), failure, F.lit(")")))
        .when(member.isNotNull(), F.concat(F.format_string("ZIP(%d files) -> '%s' (%s)", n_files, member, kind), enc))
        .when(kind.isin("html", "xml"), F.concat(F.upper(kind), enc))
        .otherwise(F.lit("Detected as 'bin'"))
    )


def processing_line(filing_date: Column, polling_date: Column, corp_name: Column, report_nm: Column, filename: Column, summary: Column) -> Column:
    """The line logged for every processed document."""
    dates = F.when(
        polling_date != filing_date,
        F.concat(filing_date, F.lit(" (Polled on "), polling_date, F.lit(")")),
    ).otherwise(filing_date)
    return F.format_string(
        "Processed | %-30s | [%-15s] | %-50s | Saved as '%s' (%s)",
        dates, corp_name, report_nm, filename, summary,
    )
