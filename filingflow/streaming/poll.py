"""Poll stream: listing pages land; documents, messages, attempts and quarantined items come out.

Each micro-batch owns the folders ``batch_id=N`` of every output, so a batch
that is run again replaces what it wrote; dates with many folders of earlier batches are compacted.  State is read from earlier batches
only, and only the folders of the batch's dates are listed.  Bad items and failed filings are
rows, never exceptions, so data cannot stop the stream.
"""

from __future__ import annotations

import logging
import re
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.incremental import known_ids
from ..operators.ledger import failure_records, latest_failures
from ..operators.paging import counted_pages, page_actions
from ..operators.parse import parse_items, quarantined
from ..operators.publish import messages
from ..operators.retry import attempt_kind, finished_ids, retry_state
from ..operators.sinks import append_attempts, publish, store_documents
from ..plans.ingest import attempts_of, listed_filings, poll_counters, process_filings, stored_documents
from ..schema import ATTEMPT_SCHEMA, MAX_ARCHIVE_BYTES, MAX_ARCHIVE_FILES, MAX_FAIL, MIN_BODY_BYTES
from ..session import clear, configure, make_dir, scratch, written
from ..sources.arrivals import keep_noting, note_arrivals
from ..sources.landed import content, dealt_files, list_files, newest_files
from ..sources.listing import page_fields, page_items, poll_date_today, read_pages, scan_predicate, valid_poll_date
from ..sources.payloads import arrived_payloads, list_payloads, with_content
from ..sources.store import (
    DOCUMENT_SCHEMA, compact_dates, date_key, read_dates, read_documents, read_processed, read_table, stored_keys,
)


LOG = logging.getLogger(__name__)


@dataclass(frozen=True)
class Folders:
    """Where a deployment lands its input and keeps its tables."""

    root: str

    def __getattr__(self, name: str) -> str:
        if name.startswith("_"):
            raise AttributeError(name)
        return f"{self.root}/{name}"


def _before(table: DataFrame, batch_id: int) -> DataFrame:
    return table.where(F.col("batch_id").cast("bigint") < batch_id)


LEDGER_SCHEMA = ATTEMPT_SCHEMA + ", date_key string, batch_id string"


def ledger(spark: SparkSession, folders: Folders, dates: list[str] | None = None) -> DataFrame:
    """Attempts of the given filing dates, or all."""
    if dates is None:
        return read_table(spark, folders.ledger, LEDGER_SCHEMA)
    return read_dates(spark, folders.ledger, dates, LEDGER_SCHEMA)


def state_of(attempts: DataFrame, max_fail: int = MAX_FAIL) -> DataFrame:
    """Retry state from ledger rows."""
    return retry_state(attempts.withColumn("kind", attempt_kind(F.col("outcome"))), max_fail)


def failures(spark: SparkSession, folders: Folders) -> DataFrame:
    """Last failure record of every filing that has one."""
    return latest_failures(failure_records(ledger(spark, folders)))


def landed_pages(spark: SparkSession, folders: Folders, dates: list[str]) -> DataFrame:
    """Newest landed copy of every page of the given dates."""
    numbered = list_files(spark, folders.pages, dates).withColumn(
        "page_no", F.regexp_extract("path", "/page_no=([^/]*)/", 1).cast("int")
    )
    newest = newest_files(numbered, ["date", "page_no"], folders.pages)
    text = content(folders.pages, F.col("path"), unpack=True).cast("string")
    return dealt_files(newest, newest).select("date", "page_no", F.try_parse_json(text).alias("page"))


@dataclass(frozen=True)
class Limits:
    """What the poll refuses: attempts per filing, least bytes of a document, files and bytes of an archive.

    ``compact_after`` is the number of folders a date may have before they become one.
    """

    max_fail: int = MAX_FAIL
    min_bytes: int = MIN_BODY_BYTES
    max_files: int = MAX_ARCHIVE_FILES
    max_bytes: int = MAX_ARCHIVE_BYTES
    compact_after: int = 24


def _listed(rows: DataFrame, column: str) -> list[str]:
    """Distinct dates: as many as days were listed, however many filings there are."""
    return [r[0] for r in rows.select(column).distinct().collect()]


def run_batch(
    batch: DataFrame, batch_id: int, folders: Folders, limits: Limits = Limits(), payloads: DataFrame | None = None
) -> dict:
    """Ingest the dates that appear in one micro-batch of landed pages.

    Rows with a ``rcept_no`` are payload files that arrived: of a date with no page in
    the batch only those filings are tried, once, as listed before.
    ``payloads`` takes the place of the landed payload files.

    Returns what the batch did: filings processed, skipped and failed.
    """
    spark = configure(batch.sparkSession)
    with scratch(spark):
        return _run_batch(spark, batch, batch_id, folders, limits, payloads)


def _run_batch(
    spark: SparkSession, batch: DataFrame, batch_id: int, folders: Folders, limits: Limits, payloads: DataFrame | None
) -> dict:
    def kept(df: DataFrame, name: str) -> DataFrame:
        # A table on disk has a known size, so Spark broadcasts it only if small.
        return written(df, name, f"{folders.root}/work/batch_id={batch_id}/{name}")

    batch = batch.where(valid_poll_date(F.col("date")))
    dates = _listed(batch, "date")
    fields = kept(page_fields(landed_pages(spark, folders, dates)).drop("page"), "pages")
    # what the status of each page asks for: waits and key errors are rows, too
    statuses = page_actions(fields.select("date", "page_no", "status", "message", "n_items"))
    statuses.write.mode("overwrite").json(f"{folders.page_status}/batch_id={batch_id}")
    items = kept(parse_items(page_items(counted_pages(fields))), "items")
    quarantined(items).write.mode("overwrite").json(f"{folders.quarantine}/batch_id={batch_id}")
    due = listed_filings(items)
    if "rcept_no" in batch.columns:
        due = _due(due, kept(batch.select("date", "rcept_no"), "arrived"))
    filings = kept(due.withColumn("date_key", date_key(F.col("rcept_dt"))), "listing")
    filed = _listed(filings, "date_key")
    filed_before = _dates_of_run(spark, folders, batch_id, filed)

    known = known_ids(*finished_ids(state_of(_before(ledger(spark, folders, filed), batch_id), limits.max_fail)))
    documents = _before(read_documents(spark, folders.documents, filed), batch_id)
    listed = list_payloads(spark, folders.payloads, dates) if payloads is None else None
    processed = process_filings(
        filings.drop("date_key"), known, stored_keys(documents), listed if payloads is None else payloads,
        fetch=(lambda found: with_content(found, listed, folders.payloads)) if payloads is None else None,
        work_folder=f"{folders.root}/work/batch_id={batch_id}/todo",
        min_bytes=limits.min_bytes, max_files=limits.max_files, max_bytes=limits.max_bytes,
    )
    counters = Observation(f"poll {batch_id}")
    store_documents(processed.observe(counters, *poll_counters()), folders.documents, batch_id, filed_before)
    # What follows reads the stored batch, without its bodies: the expensive
    # part runs once, and lineage ends in the shared folder.
    done = read_processed(spark, folders.documents, filed).where(F.col("batch_id") == str(batch_id))
    publish(messages(stored_documents(done), F.col("polling_date")), folders.messages, batch_id)
    append_attempts(attempts_of(done, F.current_timestamp(), limits.max_fail), folders.ledger, batch_id, filed_before)
    for row in done.groupBy("outcome").count().collect():
        LOG.info("poll batch %s: %s %s", batch_id, row["count"], row["outcome"])
    # this batch may run again, those before it do not
    compact_dates(spark, folders.documents, filed, DOCUMENT_SCHEMA, batch_id - 1, limits.compact_after)
    compact_dates(spark, folders.ledger, filed, LEDGER_SCHEMA, batch_id - 1, limits.compact_after)
    clear(spark, f"{folders.root}/work/batch_id={batch_id}")
    return counters.get


def _due(filings: DataFrame, arrived: DataFrame) -> DataFrame:
    """Filings of the dates listed in a batch, and those whose payload arrived for other dates."""
    listed = _listed(arrived.where("rcept_no IS NULL"), "date")
    was_listed = F.col("polling_date").isin(listed) if listed else F.lit(False)
    ids = arrived.where("rcept_no IS NOT NULL").select("rcept_no").distinct()
    late = filings.where(~was_listed).join(ids, "rcept_no", "left_semi").withColumn("n_listed", F.lit(1).cast("bigint"))
    return filings.where(was_listed).unionByName(late)


def _dates_of_run(spark: SparkSession, folders: Folders, batch_id: int, filed: list[str]) -> list[str]:
    """Filing dates an earlier run of this batch wrote; notes those of this run."""
    folder = f"{folders.batch_dates}/batch_id={batch_id}"
    before = [r[0] for r in read_table(spark, folder, "date_key string").collect()]
    rows = spark.createDataFrame([(d,) for d in {*filed, *before}], "date_key string")
    rows.coalesce(1).write.mode("overwrite").parquet(folder)
    return before


def start_poll(
    spark: SparkSession,
    folders: Folders,
    interval: str | None = "300 seconds",
    max_files: int | None = 1000,
    limits: Limits = Limits(),
    target_date: str | tuple[str, str] | None = None,
    arrivals: bool = False,
) -> StreamingQuery:
    """Start the poll stream; ``interval=None`` works off what has landed and ends.

    The pages of ``target_date`` are polled, by default those of today's date in the
    service's zone, whatever day that is when a batch runs; two dates are the first and
    last of those to work off.  With ``arrivals`` a payload file that lands after
    its filing was listed starts a batch, too, and its filing is tried without a new listing.
    A batch takes up ``max_files`` pages and about as many payload files, or with None all that landed.
    """
    for date in [target_date] if isinstance(target_date, str) else target_date or ():
        if not re.fullmatch("[0-9]{8}", date):
            raise ValueError(f"target date must be YYYYMMDD: {date!r}")
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    limit = {} if max_files is None else {"maxFilesPerTrigger": max_files}
    pages = read_pages(spark, folders.pages, stream=True, **limit)
    if target_date is None:
        polled = F.col("date") == poll_date_today()
    elif isinstance(target_date, str):
        polled = scan_predicate(date=target_date)
    else:
        polled = F.col("date").between(*target_date)
    landed = pages.select("date")
    if arrivals:
        make_dir(spark, folders.payloads)
        log = f"{folders.checkpoint_poll}/arrivals"
        note = partial(note_arrivals, spark, folders.payloads, log, max_files)
        note()
        files = arrived_payloads(spark, log, max_files)
        landed = landed.withColumn("rcept_no", F.lit(None).cast("string")).unionByName(files.select("date", "rcept_no"))
    query = (
        landed.where(polled)
        .writeStream.foreachBatch(lambda batch, batch_id: run_batch(batch, batch_id, folders, limits))
        .option("checkpointLocation", folders.checkpoint_poll)
        .trigger(**trigger)
        .start()
    )
    if arrivals and interval:
        keep_noting(query, note, _seconds(spark, interval))
    return query


def _seconds(spark: SparkSession, interval: str) -> float:
    later = F.unix_millis(F.timestamp_seconds(F.lit(0)) + F.lit(interval).cast("interval"))
    return spark.range(1).select(later).first()[0] / 1000
