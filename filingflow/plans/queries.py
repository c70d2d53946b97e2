"""Queries over the driver tables, one or more for every operator.

Each takes the session and a folder of Parquet tables and reads them whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions import charset, kind as kinds, rewrite as rewriting, text
from ..functions.once import computed_once
from ..operators import (
    health, incremental, ledger, normalise as content, paging, parse, publish, retry, sinks, upsert as upserts,
)
from ..schema import FILING_FIELDS, MAX_FAIL, MESSAGE_FIELDS, MESSAGE_SCHEMA
from ..session import configure, fresh_dir, written
from ..sources import landed, listing, messages as message_source, objects, payloads as payload_source, store
from ..streaming import consume, incremental as stateful, poll
from . import ingest, views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(configure(spark), sf_dir)

    QUERIES[function.__name__] = run
    return function


def iso(ts):
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")


# --- listing ---------------------------------------------------------------

@query
def filing_parse(spark, sf):
    """Listed items to typed filings."""
    parsed = parse.parse_items(views.items(spark, sf))
    return parse.accepted(parsed).select(*FILING_FIELDS)


@query
def filing_quarantine(spark, sf):
    """Items that break the contract, with the first reason."""
    parsed = parse.parse_items(views.items(spark, sf)).where(F.col("reject_reason").isNotNull())
    return parsed.select("k", "rcept_no", "reject_reason")


@query
def scan_predicates(spark, sf):
    """Page plan per date for one company class."""
    wanted = listing.scan_predicate(corp_cls="K") & listing.valid_poll_date(F.col("rcept_dt"))
    days = views.filings(spark, sf).where(wanted).groupBy("rcept_dt").agg(F.count("*").alias("n"))
    return days.select(
        "rcept_dt", "n",
        text.page_count(F.col("n"), F.lit(100)).alias("pages_of_100"),
        text.page_count(F.col("n"), F.lit(250)).alias("pages_of_250"),
        text.page_count(F.col("n"), F.lit(2)).alias("pages_of_2"),
    )


def _stored_pages(spark, sf) -> DataFrame:
    """The pages taken apart, written once without their items: limits and counts read them again."""
    return written(listing.page_fields(views.pages(spark, sf)).drop("page", "items"), "page-fields")


@query
def page_prefix(spark, sf):
    """Pages that count, with their items."""
    return paging.counted_pages(_stored_pages(spark, sf)).select("date", "page_no", "n_items", "total_page_text")


@query
def page_routing(spark, sf):
    """What the status of each landed page asks for."""
    pages = listing.page_fields(views.pages(spark, sf))
    routed = paging.page_actions(pages)
    return routed.groupBy("status", "meaning", "page_action", "wait_s").agg(
        F.count("*").alias("pages"), F.sum("n_items").cast("bigint").alias("items")
    )


@query
def day_totals(spark, sf):
    """Declared against counted totals per day."""
    pages = _stored_pages(spark, sf)
    limits = written(paging.day_limits(pages), "page-limits")
    seen = paging.counted_pages(pages, limits).groupBy("date").agg(
        F.count("*").alias("pages_seen"), F.sum("n_items").cast("bigint").alias("items_seen")
    )
    return limits.join(seen, "date", "left").select(
        "date", "declared_pages", "declared_count",
        F.coalesce("pages_seen", F.lit(0)).alias("pages_seen"),
        F.coalesce("items_seen", F.lit(0)).alias("items_seen"),
    )


# --- what is new -----------------------------------------------------------

def _listing(spark, sf) -> DataFrame:
    """Filings; every fifth is listed a second time."""
    once = views.filings(spark, sf).withColumn("url", parse.viewer_url(F.col("rcept_no")))
    page = (F.floor(F.col("k") / 100) + 1).cast("int")
    placed = once.select("k", *FILING_FIELDS, F.col("rcept_dt").alias("date"), page.alias("page_no"), F.lit(0).alias("pos"))
    return placed.unionByName(placed.where(F.col("k") % 5 == 0).withColumn("page_no", F.lit(1_000_000_000)))


def _known_and_stored(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Done are class Y and urgent reports; stored are filings with remark F."""
    ids = views.filings(spark, sf)
    known = incremental.known_ids(ids.where("corp_cls = 'Y'"), ids.where("report_nm = '1-URGENT'"))
    return known, store.stored_keys(ids.where("rm = 'F'"))


@query
def new_filings(spark, sf):
    """Filings neither known nor stored, once each."""
    known, stored = _known_and_stored(spark, sf)
    fresh = incremental.new_filings(incremental.listed_once(_listing(spark, sf)), known, stored)
    return fresh.select("rcept_no", "rcept_dt", "n_listed")


@query
def stored_filings(spark, sf):
    """Every open filing with the mark whether its document is stored."""
    _, stored = _known_and_stored(spark, sf)
    marked = incremental.mark_stored(views.filings(spark, sf).select("rcept_no", "rcept_dt"), stored)
    return marked.groupBy("rcept_dt", "is_stored").agg(F.count("*").alias("n"))


@query
def known_ids(spark, sf):
    """Distinct ids that are done, per month."""
    log = views.attempts(spark, sf)
    done = log.where(F.col("kind") != "FAIL")
    failed = log.where(F.col("kind") == "FAIL")
    ids = incremental.known_ids(done, failed)
    return ids.groupBy(F.left("rcept_no", F.lit(8)).alias("day")).agg(F.count("*").alias("ids"))


@query
def document_join(spark, sf):
    """Filings with what was downloaded for them; the payload is measured before the join."""
    payload = views.table(spark, sf, "documents").select(
        F.col("doc_id").alias("k"),
        F.concat(F.when(F.col("doc_id") % 2 == 0, F.unhex(F.lit("504B0304"))).otherwise(F.unhex(F.lit(""))),
                 F.col("text").cast("binary")).alias("content"),
    )
    measured = payload.select("k", kinds.is_zip(F.col("content")).alias("is_zip"), F.octet_length("content").alias("length"))
    state = F.when(F.col("is_zip"), "archive").when(~F.col("is_zip"), "other").otherwise("missing")
    return views.filings(spark, sf).join(measured, "k", "left").select("rcept_no", state.alias("state"), "length")


@query
def error_answers(spark, sf):
    """Why a download is no archive."""
    answers = payload_source.with_download_error(views.payloads(spark, sf))
    return answers.groupBy("download_error").agg(F.count("*").alias("n"))


@query
def doc_error_routing(spark, sf):
    """XML answers with the code's consequence for a document download."""
    from ..schema import STATUS_ROWS, status_dimension

    codes = [row[0] for row in STATUS_ROWS]
    code = F.element_at(F.array(*[F.lit(c) for c in codes]), (F.col("event_id") % len(codes) + 1).cast("int"))
    xml = F.concat(
        F.lit("<?xml version='1.0' encoding='utf-8'?><result><status>"), code, F.lit("</status>"),
        F.when(F.col("event_id") % 3 == 0, "").otherwise(F.concat(F.lit("<message>"), F.col("event_type"), F.lit("</message>"))),
        F.lit("</result>"),
    )
    body = F.when(F.col("event_id") % 10 == 0, F.lit("no xml")).otherwise(xml)
    answers = views.table(spark, sf, "events").select(
        "event_id", payload_source.error_answer(body.cast("binary")).alias("answer")
    ).select("event_id", "answer.status", "answer.message")
    dim = status_dimension(spark).select("code", "doc_action")
    routed = answers.join(F.broadcast(dim), answers["status"] == dim["code"], "left")
    return routed.select(
        "event_id", "status", "message", F.coalesce("doc_action", F.lit("unreadable")).alias("doc_action")
    )


# --- publishing ------------------------------------------------------------

@query
def message_projection(spark, sf):
    return views.messages(spark, sf)


@query
def upsert_payload(spark, sf):
    """Payload fields and JSON body of untidy messages."""
    columns = publish.upsert_columns(views.untidy_messages(spark, sf))
    return columns.withColumn("body", publish.upsert_payload(columns))


@query
def task_results(spark, sf):
    """Result of every consumer task."""
    code = F.when(F.col("file_size") % 5 == 0, 422).when(F.col("file_size") % 5 == 1, 503).otherwise(201)
    answered = views.untidy_messages(spark, sf).withColumn("code", code).withColumn(
        "response", F.repeat(F.concat(F.lit("no "), "rcept_no", F.lit("; ")), F.lit(20))
    )
    return publish.task_results(publish.upsert_columns(answered, keep=[*publish.REPORTED, "code", "response"]))


@query
def reception_dates(spark, sf):
    rows = views.untidy_messages(spark, sf)
    day = F.col("rcept_dt")
    return rows.groupBy(
        text.reception_date(day).alias("reception_date"), text.reception_date_error(day).alias("refused")
    ).agg(F.count("*").alias("n"))


@query
def object_store_write(spark, sf):
    """Normalised documents written to the store and read back."""
    root = fresh_dir(spark, "documents")
    docs = views.wrapped_documents(spark, sf).select(
        F.lpad(F.col("doc_id").cast("string"), 10, "0").alias("rcept_no"),
        F.concat(F.lit("200201"), F.lpad((F.col("doc_id") % 28 + 1).cast("string"), 2, "0")).alias("rcept_dt"),
        F.col("body").cast("binary").alias("content"),
    )
    sized = publish.size_gate(content.normalise(docs)).where("skip_reason IS NULL")
    named = sized.withColumn("content_type", F.when(F.col("content_type") != content.HTML_TYPE, F.col("content_type")))
    sinks.store_documents(named.drop("error", "skip_reason"), root)
    return store.read_documents(spark, root).select("rcept_no", "rcept_dt", "object_key", "content_type", "file_size", F.md5("body").alias("body_md5"))


@query
def publish_roundtrip(spark, sf):
    """Messages written by the publisher and taken in by a stream."""
    root, out = fresh_dir(spark, "messages"), fresh_dir(spark, "received")
    rows = views.messages(spark, sf).repartition(8, "rcept_no")
    sinks.publish(rows, root)
    stream = message_source.read_messages(spark, root, stream=True, maxFilesPerTrigger=4)
    running = (
        stream.select(*MESSAGE_FIELDS).writeStream.format("parquet").option("path", out)
        .option("checkpointLocation", fresh_dir(spark, "checkpoint")).trigger(availableNow=True).start()
    )
    running.awaitTermination()
    return spark.read.schema(MESSAGE_SCHEMA).parquet(out)


@query
def response_routing(spark, sf):
    """What follows from every upsert response."""
    routed = publish.route_responses(views.responses(spark, sf))
    return routed.select("event_id", "status", "error_type", "error_message", "logged", "wait_s")


@query
def url_masking(spark, sf):
    number = F.col("c_custkey") % 4
    url = (
        F.when(number == 0, F.concat(F.lit("amqp://"), "c_name", F.lit(":p@ss"), F.col("c_custkey"), F.lit("@mq:5672/")))
        .when(number == 1, F.concat(F.lit("http://mq:5672/"), "c_name"))
        .when(number == 2, F.concat(F.lit("amqp://"), "c_name", F.lit("@mq")))
        .otherwise("")
    )
    return views.table(spark, sf, "customer").select(
        "c_custkey", text.mask_url(url).alias("masked"), text.key_prefix(F.col("c_name")).alias("key")
    )


@query
def content_type_default(spark, sf):
    """Content type guessed from the file name."""
    names = ["html", "XML", "zip", "txt", "pdf", "json", "unknown9"]
    ext = F.element_at(F.array(*[F.lit(n) for n in names]), (F.col("k") % len(names) + 1).cast("int"))
    name = F.when(F.col("k") % 9 == 0, F.col("rcept_no")).otherwise(F.concat("rcept_no", F.lit("."), ext))
    return views.filings(spark, sf).groupBy(text.guess_content_type(name).alias("content_type")).agg(F.count("*").alias("n"))


@query
def upsert_latest(spark, sf):
    """Latest event per user in the second half of the month replaces the first half's."""
    log = views.attempts(spark, sf).select("rcept_no", "attempt_ts", "seq", "event_type", "value")
    old = log.where(F.col("attempt_ts") < F.lit("2024-01-15").cast("timestamp_ntz"))
    new = log.where(F.col("attempt_ts") >= F.lit("2024-01-15").cast("timestamp_ntz"))
    by_user = [rows.withColumn("rcept_no", F.substring("rcept_no", 9, 100)) for rows in (old, new)]
    target = upserts.latest_per_key(by_user[0], ["rcept_no"], ["attempt_ts", "seq"])
    merged = upserts.upsert(target, by_user[1], ["attempt_ts", "seq"])
    return merged.select("rcept_no", "seq", "event_type", "value")


# --- retry state and ledger ------------------------------------------------

@query
def retry_state(spark, sf):
    return retry.retry_state(views.attempts(spark, sf))


@query
def retry_stats(spark, sf):
    return retry.retry_stats(retry.retry_state(views.attempts(spark, sf)))


@query
def attempt_numbers(spark, sf):
    """Attempts that can count, numbered per filing."""
    return retry.counted_attempts(views.attempts(spark, sf), MAX_FAIL).select("seq", "rcept_no", "kind", "attempt_no")


@query
def backoff_schedule(spark, sf):
    numbered = retry.counted_attempts(views.attempts(spark, sf), MAX_FAIL).where(F.col("kind") == "FAIL")
    schedule = retry.backoff_schedule(numbered)
    return schedule.select("seq", "attempt_no", "wait_s", iso("next_attempt_ts").alias("next_attempt_ts"))


@query
def due_retries(spark, sf):
    """Failed filings to try again, with and without counts held."""
    log = views.attempts(spark, sf)
    state = retry.retry_state(log)
    ids = log.select("rcept_no").distinct()
    due = retry.due_retries(ids, state).select("rcept_no", F.col("fails").alias("due_fails"))
    return retry.with_prior_fails(ids, state).join(due, "rcept_no", "left")


def _ledger(spark, sf) -> DataFrame:
    log = views.attempts(spark, sf)
    kind = F.col("event_type")
    outcome = (
        F.when(kind == "purchase", "SUCCESS").when(kind == "signup", "SKIPPED_TOO_SMALL")
        .when(kind == "view", "SKIPPED_EXISTS").otherwise("FAILED")
    )
    return log.select(
        "rcept_no", "attempt_ts", "seq", outcome.alias("outcome"),
        F.when(outcome.isin("FAILED", "SKIPPED_TOO_SMALL"), F.concat(kind, F.lit(" at "), F.col("value"))).alias("reason"),
        F.struct(
            *[F.lit(None).cast("string").alias(c) if c != "rcept_no" else F.col("rcept_no") for c in FILING_FIELDS]
        ).alias("filing"),
    )


@query
def failure_latest(spark, sf):
    """Last failure record per filing."""
    latest = ledger.latest_failures(ledger.failure_records(_ledger(spark, sf)))
    return latest.select(
        F.col("disclosure_details.rcept_no").alias("rcept_no"), iso("recorded_at").alias("recorded_at"), "failure_reason"
    )


@query
def outcome_counts(spark, sf):
    return ledger.outcome_counts(_ledger(spark, sf))


# --- content ---------------------------------------------------------------

def _marked_documents(spark, sf) -> DataFrame:
    """Documents in every shape the kind test tells apart, by id modulo 12.

    From 8 on: text after the root, a second root, a long document, and a marker far behind.
    """
    k, body = F.col("doc_id") % 12, F.col("text")
    long = F.repeat(F.lit("<p>x</p>"), F.lit(20_000))
    mark = F.lit("\uFEFF")
    shaped = (
        F.when(k == 1, F.concat(F.lit("<html>"), body))
        .when(k == 2, F.concat(F.lit(" <!doctype\nHTML>"), body))
        .when(k == 3, F.concat(F.lit('<?xml version="1.0"?><r>'), body, F.lit("</r>")))
        .when(k == 4, F.concat(F.lit("\n<r><p>"), body, F.lit("</p></r>")))
        .when(k == 5, F.concat(F.lit("<r><div>"), body, F.lit("</div></r")))
        .when(k == 6, F.concat(body, F.lit("<HEAD>")))
        .when(k == 7, F.concat(mark, F.lit("<?xml version='1.0'?><r/>"), body))
        .when(k == 8, F.concat(F.lit("<div>a</div>"), body))
        .when(k == 9, F.concat(F.lit("<div>"), body, F.lit("</div><div>b</div>")))
        .when(k == 10, F.concat(F.lit("<div>"), long, F.lit("</div>")))
        .when(k == 11, F.concat(body, F.repeat(F.lit("far "), F.lit(40_000)), F.lit("<meta name=x charset=utf-8>")))
        .otherwise(body)
    )
    return views.table(spark, sf, "documents").select("doc_id", shaped.cast("binary").alias("data"))


@query
def sniff_kind(spark, sf):
    docs = _marked_documents(spark, sf).select(
        F.concat(F.lit("document "), F.col("doc_id")).alias("id"), kinds.sniff_kind(F.col("data")).alias("kind")
    )
    pages = views.table(spark, sf, "pages").select(
        F.concat(F.lit("page "), F.col("page_id")).alias("id"),
        kinds.sniff_kind(F.col("html").cast("binary")).alias("kind"),
    )
    return docs.unionByName(pages)


def _declaring_pages(spark, sf) -> DataFrame:
    """Pages that state their charset in different ways, by id modulo 6."""
    k = F.col("page_id") % 6
    stated = (
        F.when(k == 1, '<meta http-equiv="Content-Type" content="text/html; charset=EUC_KR">')
        .when(k == 2, "<META name=x CHARSET='KS_C_5601-1987'>")
        .when(k == 3, "")
        .when(k == 4, "<meta charset=UTF8>")
        .otherwise('<meta charset="utf-8">')
    )
    html = F.replace("html", F.lit('<meta charset="utf-8">'), stated)
    xml = F.concat(F.lit('<?xml version="1.0" encoding="Windows-949"?><doc>'), F.length("html"), F.lit("</doc>"))
    return views.table(spark, sf, "pages").select(
        "page_id", F.when(k == 5, xml).otherwise(html).alias("text"), F.when(k == 5, "xml").otherwise("html").alias("kind")
    )


@query
def declared_encoding(spark, sf):
    whole = kinds.byte_text(F.col("text").cast("binary"))
    pages = _declaring_pages(spark, sf).withColumn("head", whole)
    name = charset.declared_charset(F.col("head"), F.col("kind"))
    return pages.select("page_id", name.alias("declared"), charset.java_charset(name).alias("charset"))


@query
def charset_ladder(spark, sf):
    """Documents encoded in five ways and read back."""
    k = F.col("doc_id") % 5
    hangul = F.lit("가나다라마")
    korean = F.regexp_replace(
        F.translate("text", "aeiou", "가나다라마"), r"[^\x00-\x7F\x{AC00}-\x{D7A3}]", "?"
    )
    data = (
        F.when(k == 0, F.encode("text", "ISO-8859-1"))
        .when(k == 1, F.encode("text", "windows-1252"))
        .when(k == 2, F.concat(F.unhex(F.lit("EFBBBF")), F.col("text").cast("binary")))
        .when(k == 3, F.encode(korean, "MS949"))
        .otherwise(F.encode(korean, "EUC-KR"))
    )
    declared = F.when(k == 0, "iso-8859-1").when(k == 1, "windows-1252").when(k == 4, "euc-kr")
    docs = views.table(spark, sf, "documents").select("doc_id", data.alias("data"), declared.alias("declared"))
    return content.decode_document(docs).select(
        "doc_id", "used_enc", F.length("text").alias("n_chars"), F.md5(F.col("text").cast("binary")).alias("text_md5")
    )


@query
def utf8_validity(spark, sf):
    """Which encoded documents are valid UTF-8."""
    data = F.when(F.col("doc_id") % 2 == 0, F.col("text").cast("binary")).otherwise(F.encode("text", "ISO-8859-1"))
    return views.table(spark, sf, "documents").select("doc_id", charset.valid_utf8(data).alias("valid"))


@query
def html_rewrite(spark, sf):
    """Pages with and without head and doctype, stated to be UTF-8."""
    shaped = (
        F.when(F.col("page_id") % 4 == 1, F.regexp_replace("text", "(?i)</?head[^>]*>", ""))
        .when(F.col("page_id") % 4 == 2, F.regexp_replace("text", "(?i)<!doctype[^>]*>|</?head[^>]*>", ""))
        .otherwise(F.col("text"))
    )
    pages = _declaring_pages(spark, sf).withColumn("text", shaped)
    out = computed_once(pages, ["page_id"], out=rewriting.rewrite(F.col("text"), F.col("kind")))
    return out.select("page_id", F.length("out").alias("n_chars"), F.md5(F.col("out").cast("binary")).alias("text_md5"))


@query
def xml_rewrite(spark, sf):
    docs = computed_once(views.wrapped_documents(spark, sf), ["doc_id"], out=rewriting.rewrite_xml(F.col("body")))
    return docs.select("doc_id", F.octet_length("out").alias("n_bytes"), F.md5(F.col("out").cast("binary")).alias("text_md5"))


@query
def safe_name(spark, sf):
    """File names from page addresses and customer names."""
    pages = views.table(spark, sf, "pages").select(F.col("url").alias("name"))
    people = views.table(spark, sf, "customer").select(
        F.concat(F.lit("dir.x/"), F.col("c_name"), F.when(F.col("c_custkey") % 2 == 0, " .tar.gz").otherwise("é")).alias("name")
    )
    names = pages.unionByName(people)
    return names.select("name", text.safe_name(text.base_name(F.col("name"))).alias("safe"))


@query
def archive_best(spark, sf):
    """Every document zipped line by line; the best member, normalised."""
    named = views.archives(spark, sf).withColumn("rcept_no", F.lpad(F.col("doc_id").cast("string"), 10, "0"))
    docs = content.normalise(named)
    return docs.select(
        "doc_id", "content_type", "filename", "used_enc", "summary",
        F.octet_length("body").alias("n_bytes"), F.md5("body").alias("body_md5"),
    ).withColumns({
        # the bytes of an archive kept whole depend on the compressor, so SQL cannot tell them
        c: F.when(~F.col("filename").endswith(".zip"), F.col(c)) for c in ("n_bytes", "body_md5")
    })


@query
def archive_guard(spark, sf):
    """Archives against limits of 20 files and 5,000 bytes."""
    scanned = content.with_archive(views.archives(spark, sf), max_files=20, max_bytes=5000)
    return scanned.select("doc_id", "archive.n_files", "archive.total_bytes", "archive.failure", F.col("archive.best.name").alias("best"))


@query
def archive_names(spark, sf):
    """Names of members, stored in UTF-8 or in Korean without a flag."""
    scanned = content.with_archive(views.korean_archives(spark, sf))
    return scanned.select("doc_id", F.col("archive.best.name").alias("name"), F.col("archive.best.size").alias("size"))


@query
def size_gate(spark, sf):
    docs = views.table(spark, sf, "documents").select("doc_id", F.col("text").cast("binary").alias("body"))
    return publish.size_gate(docs, min_bytes=2000).select("doc_id", "file_size", "skip_reason")


@query
def processing_summary(spark, sf):
    """The line logged for each filing's document."""
    k = F.col("k") % 4
    rows = views.filings(spark, sf).select(
        "rcept_no", "rcept_dt", "corp_name", "report_nm",
        F.when(k == 0, F.col("rcept_dt")).otherwise("20020101").alias("polling_date"),
        F.concat(F.col("rcept_no"), F.lit(".html")).alias("filename"),
        F.struct(
            F.when(k == 1, "Empty ZIP file").alias("failure"),
            (F.col("k") % 9 + 1).cast("int").alias("n_files"),
        ).alias("archive"),
        F.when(k == 2, F.concat(F.lit("m"), F.col("k"), F.lit(".xml"))).alias("member"),
        F.when(k == 3, "html").when(k == 2, "xml").otherwise("bin").alias("kind"),
        F.when(k >= 2, "cp949").alias("enc"),
    )
    summary = content.document_summary(F.col("archive"), F.col("member"), F.col("kind"), F.col("enc"))
    line = content.processing_line(
        F.col("rcept_dt"), F.col("polling_date"), F.col("corp_name"), F.col("report_nm"), F.col("filename"), F.col("summary")
    )
    return rows.withColumn("summary", summary).select("rcept_no", "summary", line.alias("line"), text.truncate(F.col("report_nm"), 5).alias("short_name"))


# --- health ----------------------------------------------------------------

@query
def consecutive_failures(spark, sf):
    checks = health.component_health(views.health_events(spark, sf))
    return checks.select("component", iso("last_success").alias("last_success"), "consecutive_failures", "status", "message")


@query
def health_rollup(spark, sf):
    """Worst status per group of ten components."""
    checks = health.component_health(views.health_events(spark, sf))
    return health.rollup(checks.withColumn("service", F.floor(F.col("component") / 10)), "service")


@query
def poll_metrics(spark, sf):
    """Polling counters per day."""
    kind = F.col("event_type")
    events = views.table(spark, sf, "events").select(
        F.date_format("ts", "yyyyMMdd").alias("day"), "ts",
        F.when(kind == "view", "poll").when(kind == "purchase", "processed").when(kind == "error", "error").alias("kind"),
        (F.col("value") / 7).alias("latency_ms"),
    )
    return health.poll_metrics(events, "day").withColumn("last_poll", iso("last_poll"))


# --- streams ---------------------------------------------------------------

def _run_in_parts(spark, log: DataFrame, n_parts: int, part, start) -> None:
    """Land ``log`` in parts and run the stream after each, from its checkpoint."""
    source, checkpoint = fresh_dir(spark, "source"), fresh_dir(spark, "checkpoint")
    for number in range(n_parts):
        log.where(part == number).write.mode("append").parquet(source)
        stream = spark.readStream.schema(log.schema).parquet(source)
        running = start(stream).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        running.awaitTermination()


@query
def stream_dedup(spark, sf):
    """Each filing once, over a stream whose second part is older than any watermark of the first."""
    root = fresh_dir(spark, "seen")
    log = views.attempts(spark, sf).select("rcept_no", "attempt_ts")

    def note(batch: DataFrame, batch_id: int) -> None:
        stateful.note_first_seen(batch, batch_id, root, ["rcept_no"], F.left("rcept_no", F.lit(8)))

    late = F.when(F.dayofmonth("attempt_ts") > 15, 0).otherwise(1)
    _run_in_parts(spark, log, 2, late, lambda stream: stream.writeStream.foreachBatch(note))
    return store.read_table(spark, root, "rcept_no string, date_key string, batch_id string").select("rcept_no")


def _days(batch: DataFrame) -> list[str]:
    """The dates a batch touches; nothing else of a table is read."""
    return [r[0] for r in batch.select(upserts.id_date(F.col("rcept_no"))).distinct().collect()]


@query
def stream_upsert(spark, sf):
    """Upserts batch by batch; the newest attempt per filing wins."""
    root = fresh_dir(spark, "upserts")
    log = views.attempts(spark, sf).select("rcept_no", "attempt_ts", "seq", "event_type")
    schema = "rcept_no string, attempt_ts timestamp_ntz, seq bigint, event_type string"

    def merge(batch: DataFrame, batch_id: int) -> None:
        # attempts arrive out of order here, so the row in the table competes too
        days = _days(batch)
        table = upserts.current(spark, root, schema, days).where(F.col("batch_id") < batch_id)
        ids = batch.select("rcept_no").distinct()
        touched = table.join(ids, "rcept_no", "left_semi").select(*batch.columns)
        upserts.write_batch(batch.unionByName(touched), root, batch_id, ["attempt_ts", "seq"], days)

    _run_in_parts(spark, log, 2, F.col("seq") % 2, lambda stream: stream.writeStream.foreachBatch(merge))
    return upserts.current(spark, root, schema).select("rcept_no", "seq", "event_type")


@query
def stream_retry(spark, sf):
    """Retry state carried from batch to batch, eight hours at a time."""
    root = fresh_dir(spark, "state")
    log = views.attempts(spark, sf).select("rcept_no", "attempt_ts", "seq", "kind")
    schema = "rcept_no string, term string, fails bigint"

    def advance(batch: DataFrame, batch_id: int) -> None:
        days = _days(batch)
        before = upserts.current(spark, root, schema, days).where(F.col("batch_id") < batch_id)
        upserts.write_batch(stateful.advance_state(before, batch), root, batch_id, ["fails"], days)

    part = F.floor(F.hour("attempt_ts") / 8)
    _run_in_parts(spark, log, 3, part, lambda stream: stream.writeStream.foreachBatch(advance))
    return upserts.current(spark, root, schema).select("rcept_no", "term", "fails")


# --- the whole poll --------------------------------------------------------

def _ingested(spark, sf, **options) -> DataFrame:
    known, stored = _known_and_stored(spark, sf)
    processed = ingest.process_filings(
        ingest.listed_filings(ingest.listed_items(views.pages(spark, sf))), known, stored, views.payloads(spark, sf), **options
    )
    # the size of an archive kept whole depends on the compressor, so SQL cannot tell it
    size = F.when(~F.coalesce(F.col("object_key").endswith(".zip"), F.lit(False)), F.col("file_size"))
    report = ingest.outcome_report(processed)
    return report.withColumns({"file_size": size, "body_md5": F.when(size.isNotNull(), F.col("body_md5"))})


@query
def filing_ingest(spark, sf):
    """Listing pages to stored documents: every new filing with its outcome."""
    return _ingested(spark, sf)


@query
def filing_ingest_sliced(spark, sf):
    """The same with a list longer than what is broadcast: the payloads meet it in slices, behind a Bloom filter."""
    return _ingested(spark, sf, broadcast_rows=2_000)


def _polled(spark, sf, batches: tuple[int, ...], limits: poll.Limits = poll.Limits()) -> DataFrame:
    folders = poll.Folders(fresh_dir(spark, "poll"))
    pages = views.pages(spark, sf, views.MONTH).select("date", "page_no", F.to_json("page").alias("value"))
    _land_pages(written(pages, "landing"), folders)
    payloads = written(views.payloads(spark, sf, views.MONTH), "payloads")
    dates = landed.list_files(spark, folders.pages).select("date")
    for batch_id in batches:
        poll.run_batch(dates, batch_id, folders, limits, payloads=payloads)
    attempts = poll.ledger(spark, folders)
    state = poll.state_of(attempts)
    return attempts.join(state, "rcept_no").select(
        "rcept_no", F.col("batch_id").cast("int").alias("batch_id"), "seq", "outcome", "stage", "reason", "term", "fails"
    )


@query
def poll_twice(spark, sf):
    """The job itself: pages land, are polled twice, and the second poll is run again; ledger and state come out."""
    return _polled(spark, sf, (0, 1, 1))


@query
def poll_compacted(spark, sf):
    """The same over three polls, which compact documents and ledger as they go, up to the last failure that counts."""
    return _polled(spark, sf, (0, 1, 1, 2), poll.Limits(compact_after=1))


def _land_pages(pages: DataFrame, folders: poll.Folders) -> None:
    """Land a file per page, by the sink for files: Spark's partitioned writer takes ten times as long for each."""
    key = F.concat(F.lit("date="), "date", F.lit("/page_no="), "page_no", F.lit("/page.json"))
    objects.write_objects(pages.select(key.alias("object_key"), F.col("value").cast("binary").alias("body")), folders.pages)


def _land(pages: DataFrame, payloads: DataFrame, folders: poll.Folders, date: Column) -> None:
    """Land pages and payloads as files, as the downloaders would."""
    _land_pages(pages, folders)
    key = F.concat(F.lit("date="), date, F.lit("/"), F.col("rcept_no"), F.lit(".zip"))
    objects.write_objects(payloads.select(key.alias("object_key"), F.col("content").alias("body")), folders.payloads)


#: The filings of this year are listed under today's date in ``poll_stream``.
THIS_YEAR = "19990101"


@query
def poll_stream(spark, sf):
    """The job as it runs: files land in three turns, and the stream takes them up from its checkpoint.

    First the pages before 1997 and every other payload of those days, then all other pages and payloads,
    so that late payloads meet filings listed before, then a year's filings under today's date.
    Some items break the contract, some files are no JSON and some archives no archives.
    """
    folders = poll.Folders(fresh_dir(spark, "poll"))
    body = F.replace(F.to_json("page"), F.lit('"report_nm":"1-URGENT"'), F.lit('"report_nm":1'))
    pages = written(views.pages(spark, sf, views.YEAR).select("date", "page_no", body.alias("value")), "landing")
    damaged = pages.select("date", F.lit(1_000_000).alias("page_no"), F.lit("{ damaged").alias("value")).distinct()
    pages = pages.unionByName(damaged)
    doc_id = F.substring("rcept_no", 9, 20).cast("bigint")
    texts = views.table(spark, sf, "documents").where(F.col("doc_id") % 8 == 3).select("doc_id", "text")
    whole = views.payloads(spark, sf, views.YEAR).withColumn("doc_id", doc_id)
    broken = whole.where(F.col("doc_id") % 8 == 3).drop("content").join(texts, "doc_id").select(
        "rcept_no", F.concat(F.lit("PK\x03\x04"), "text").cast("binary").alias("content"), "doc_id"
    )
    payloads = written(whole.where(F.col("doc_id") % 8 != 3).unionByName(broken), "payloads")
    day = F.left("rcept_no", F.lit(8))
    late = day >= "19970101"
    early_file = (F.col("doc_id") % 2 == 0) & ~late
    today = spark.range(1).select(listing.poll_date_today()).first()[0]

    def poll_until_done(**options):
        poll.start_poll(spark, folders, interval=None, max_files=None, **options).awaitTermination()

    turns = [
        (F.col("date") < "19970101", early_file, {"target_date": ("19920101", "20201231"), "arrivals": True}),
        (
            (F.col("date") >= "19970101") & (F.col("date") != THIS_YEAR), ~early_file & (day != THIS_YEAR),
            {"target_date": ("19920101", "20201231"), "arrivals": True},
        ),
    ]
    for landed, files, options in turns:
        _land(pages.where(landed), payloads.where(files), folders, day)
        poll_until_done(**options)
    last = pages.where(F.col("date") == THIS_YEAR).withColumn("date", F.lit(today))
    _land(last, payloads.where(day == THIS_YEAR), folders, F.lit(today))
    poll_until_done(arrivals=True)
    attempts = poll.ledger(spark, folders)
    size = F.when(~F.col("object_key").endswith(".zip") | (doc_id % 8 == 3), F.col("file_size"))
    documents = store.read_documents(spark, folders.documents).select(
        "rcept_no", "object_key", F.when(size.isNotNull(), F.md5("body")).alias("body_md5")
    )
    return attempts.join(poll.state_of(attempts), "rcept_no").join(documents, "rcept_no", "left").select(
        "rcept_no", F.col("batch_id").cast("int").alias("batch_id"), "seq", "outcome", "stage", "reason", "term", "fails",
        "object_key", "body_md5",
    )


@query
def object_files(spark, sf):
    """Stored documents as files of their own, written twice and read back as files."""
    root = fresh_dir(spark, "objects")
    docs = views.wrapped_documents(spark, sf).select(
        F.concat(F.lit("200201"), F.lpad((F.col("doc_id") % 28 + 1).cast("string"), 2, "0")).alias("rcept_dt"),
        F.concat(F.lpad(F.col("doc_id").cast("string"), 10, "0"), F.lit(".txt")).alias("filename"),
        F.col("body").cast("binary").alias("body"),
    )
    for _ in range(2):
        sinks.export_objects(docs, root)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return files.select(
        F.array_join(F.slice(F.split("path", "/"), -2, 2), "/").alias("object_key"), F.col("length").alias("file_size"),
        F.md5("content").alias("body_md5"),
    )


@query
def upsert_compacted(spark, sf):
    """Upserts in eight batches, the table being compacted after each; the last one runs again."""
    root = fresh_dir(spark, "upserts")
    log = written(views.attempts(spark, sf).select("rcept_no", "attempt_ts", "seq", "event_type"), "attempts")
    schema = "rcept_no string, attempt_ts timestamp_ntz, seq bigint, event_type string"
    rank = F.row_number().over(Window.partitionBy("rcept_no").orderBy("attempt_ts", "seq"))
    turn = F.pmod(F.least(rank, F.lit(8)) - 1, F.lit(8))
    parts = written(log.withColumn("turn", turn), "turns")
    for batch_id in (*range(8), 7):
        batch = parts.where(F.col("turn") == batch_id).drop("turn")
        days = _days(batch)
        upserts.write_batch(batch, root, batch_id, ["attempt_ts", "seq"], days)
        upserts.compact_upserts(spark, root, schema, days, batch_id - 1, 2)
    return upserts.current(spark, root, schema).select("rcept_no", "seq", "event_type")


@query
def consume_messages(spark, sf):
    """Published messages through the consumer's stream; the upsert table and the results come out."""
    root = fresh_dir(spark, "consume")
    sinks.publish(views.messages(spark, sf, views.MONTH).repartition(8, "rcept_no"), f"{root}/messages")
    consume.start_consume(
        spark, f"{root}/messages", f"{root}/table", f"{root}/results", f"{root}/checkpoint", interval=None, max_files=4
    ).awaitTermination()
    schema = "rcept_no string, status string, error_type string, error_message string, corp_code string, batch_id string"
    results = store.read_table(spark, f"{root}/results", schema).drop("batch_id")
    return results.join(consume.upserted(spark, f"{root}/table").select("rcept_no", "body"), "rcept_no", "left")
