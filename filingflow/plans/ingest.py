"""One poll as a set-based job: listing pages in, documents, messages and attempts out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import base_name, safe_name
from ..operators.incremental import listed_once, mark_stored, without
from ..operators.normalise import normalise
from ..operators.paging import counted_pages
from ..operators.parse import accepted, parse_items
from ..operators.placed_join import placed_join
from ..operators.publish import object_key, size_gate
from ..schema import FILING_FIELDS, MAX_ARCHIVE_BYTES, MAX_ARCHIVE_FILES, MAX_FAIL, MIN_BODY_BYTES, NO_DOCUMENT
from ..session import BROADCAST_ROWS, written
from ..sources.listing import page_fields, page_items
from ..sources.payloads import with_download_error

_DOCUMENT = ["content_type", "filename", "body", "file_size", "used_enc", "summary"]
_LISTED = [*FILING_FIELDS, "polling_date", "n_listed"]
_PROCESSED = [*_LISTED, "outcome", "stage", "reason", *_DOCUMENT]


def listed_items(pages: DataFrame) -> DataFrame:
    """Items on the pages that count, parsed, good and bad.

    The pages are taken apart once and written: deciding which of them count
    reads a few small columns of that table, and the items are read once.
    """
    fields = written(page_fields(pages).drop("page"), "pages")
    return parse_items(page_items(counted_pages(fields)))


def listed_filings(items: DataFrame) -> DataFrame:
    """Valid filings among parsed items, each id once, with the date polled."""
    return listed_once(accepted(items)).withColumnRenamed("date", "polling_date").select(*_LISTED)


def process_filings(
    filings: DataFrame,
    known: DataFrame,
    stored: DataFrame,
    payloads: DataFrame,
    keep_tail: bool = False,
    work_folder: str | None = None,
    min_bytes: int = MIN_BODY_BYTES,
    max_files: int = MAX_ARCHIVE_FILES,
    max_bytes: int = MAX_ARCHIVE_BYTES,
    broadcast_rows: int = BROADCAST_ROWS,
    fetch: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Every filing not known yet with its outcome and, on success, its document.

    Everything before the payload is metadata only; it is written to the shared
    folder, since three branches read it.  The payload meets the filings in an
    inner join that moves no payload: up to ``broadcast_rows`` filings are broadcast, a longer
    list in slices (see ``placed_join``).  Filings without a payload come from an
    anti-join that reads the payload's ids alone.  With ``fetch`` the payloads have the ``path``
    of a file; it turns that into ``content``, for files of these filings only.
    """
    todo = mark_stored(without(filings, known, ["rcept_no"]), stored)
    stem = safe_name(base_name(F.col("rcept_no"))).alias("stem")
    todo = written(todo.select(*_LISTED, "is_stored", stem), "todo", work_folder)
    fresh = todo.where(~F.col("is_stored")).drop("is_stored")
    none = F.lit(None)

    exists = _outcome(todo.where("is_stored"), "SKIPPED_EXISTS", "store", none)
    missing = _outcome(
        without(fresh, payloads, ["rcept_no"]), "FAILED", "download", F.lit(NO_DOCUMENT)
    )

    held = payloads.select("rcept_no", "path" if fetch else "content")
    found = placed_join(held, fresh, "rcept_no", broadcast_rows)
    fetched = with_download_error(fetch(found) if fetch else found)
    refused, unreadable, too_small = (F.col(c).isNotNull() for c in ("download_error", "error", "skip_reason"))
    documents = size_gate(
        normalise(
            fetched.withColumn("content", F.when(~refused, F.col("content"))), stem="stem", keep_tail=keep_tail,
            max_files=max_files, max_bytes=max_bytes,
        ),
        min_bytes,
    )
    done = (
        documents.withColumn(
            "outcome",
            F.when(refused | unreadable, "FAILED").when(too_small, "SKIPPED_TOO_SMALL").otherwise("SUCCESS"),
        )
        .withColumn(
            "stage",
            F.when(refused, "download").when(unreadable, "normalise").when(too_small, "size").otherwise("store"),
        )
        .withColumn("reason", F.coalesce("download_error", "error", "skip_reason"))
        .select(*_PROCESSED)
    )
    return exists.unionByName(missing).unionByName(done)


def _outcome(filings: DataFrame, outcome: str, stage: str, reason: Column) -> DataFrame:
    kinds = {"body": "binary", "file_size": "bigint"}
    return filings.select(
        *_LISTED,
        F.lit(outcome).alias("outcome"),
        F.lit(stage).alias("stage"),
        reason.cast("string").alias("reason"),
        *[F.lit(None).cast(kinds.get(c, "string")).alias(c) for c in _DOCUMENT],
    )


def stored_documents(processed: DataFrame) -> DataFrame:
    return processed.where(F.col("outcome") == "SUCCESS")


def attempts_of(processed: DataFrame, attempt_ts: Column, max_fail: int = MAX_FAIL) -> DataFrame:
    """Ledger rows of a poll.

    An id listed several times is tried again within the poll as long as it
    fails, up to the failure limit, and not again once it is done.
    """
    tries = F.when(F.col("outcome") == "FAILED", F.least(F.col("n_listed"), F.lit(max_fail))).otherwise(1)
    return processed.drop("body").select(
        "rcept_no",
        attempt_ts.alias("attempt_ts"),
        "outcome",
        "stage",
        "reason",
        F.struct(*FILING_FIELDS).alias("filing"),
        F.explode(F.sequence(F.lit(1).cast("bigint"), tries.cast("bigint"))).alias("seq"),
    )


def poll_counters() -> list[Column]:
    """Live numbers of a poll, for ``DataFrame.observe``."""
    outcome = F.col("outcome")
    return [
        F.count_if(outcome == "SUCCESS").alias("processed"),
        F.count_if(outcome.startswith("SKIPPED")).alias("skipped"),
        F.count_if(outcome == "FAILED").alias("errors"),
    ]


def outcome_report(processed: DataFrame) -> DataFrame:
    """One row per filing with a digest of its body, for reports and checks."""
    key = F.when(F.col("outcome") == "SUCCESS", object_key(F.col("rcept_dt"), F.col("filename")))
    return processed.select(
        "rcept_no", "outcome", "reason", key.alias("object_key"),
        F.when(F.col("outcome") == "SUCCESS", F.col("content_type")).alias("content_type"),
        "file_size", "used_enc",
        F.when(F.col("outcome") == "SUCCESS", F.md5("body")).alias("body_md5"),
    )
