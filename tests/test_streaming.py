"""Streams: equal to the batch result, safe to restart and to replay."""

import json
import os

from pyspark.sql import functions as F

from filingflow.operators.retry import retry_state
from filingflow.operators.upsert import compact
from filingflow.schema import FILING_FIELDS
from filingflow.sources.store import read_documents
from filingflow.sources.messages import read_messages
from filingflow.streaming.consume import UPSERT_SCHEMA, consume_batch, start_consume, upserted
from filingflow.streaming.incremental import advance_state, note_first_seen
from filingflow.streaming.poll import Folders, Limits, failures, landed_pages, ledger, run_batch, start_poll, state_of
from zips import make_zip

HTML = b"<html><head></head><body>" + b"text " * 60 + b"</body></html>"


def item(no, date="20240102", **changes):
    base = dict(corp_code="00126380", corp_name="corp", stock_code="", corp_cls="Y", report_nm="report",
                rcept_no=f"{date}{no:06d}", flr_nm="", rcept_dt=date, rm="")
    return {**base, **changes}


def land_page(root, items, page_no=1, date="20240102", name="a", total_page=1, status="000"):
    folder = f"{root}/pages/date={date}/page_no={page_no}"
    os.makedirs(folder, exist_ok=True)
    page = {"status": status, "total_page": total_page, "total_count": len(items), "list": items}
    with open(f"{folder}/{name}.json", "w") as out:
        out.write(json.dumps(page, indent=1))


def land_payload(root, no, blob, date="20240102"):
    folder = f"{root}/payloads/date={date}"
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{date}{no:06d}.zip", "wb") as out:
        out.write(blob)


def poll(spark, folders, target="20240102"):
    query = start_poll(spark, folders, interval=None, target_date=target)
    query.awaitTermination()


def outcomes(spark, folders):
    rows = ledger(spark, folders).orderBy("batch_id", "rcept_no", "seq").collect()
    return [(r["batch_id"], int(r["rcept_no"][8:]), r["outcome"]) for r in rows]


def test_poll_stream(spark, folder):
    folders = Folders(folder)
    doc = make_zip([("a.html", HTML)])
    land_page(folder, [item(1), item(2), item(3), item(4, corp_name=5)], total_page=2)
    land_page(folder, [item(5), item(1)], page_no=2)
    land_page(folder, [item(9)], page_no=3)
    land_payload(folder, 1, doc)
    land_payload(folder, 2, make_zip([("a.html", b"<html>")]))
    land_payload(folder, 5, doc)
    poll(spark, folders)
    assert outcomes(spark, folders) == [
        ("0", 1, "SUCCESS"), ("0", 2, "SKIPPED_TOO_SMALL"), ("0", 3, "FAILED"), ("0", 5, "SUCCESS"),
    ]
    stored = read_documents(spark, folders.documents).orderBy("rcept_no").collect()
    assert [r["object_key"] for r in stored] == ["20240102/20240102000001.html", "20240102/20240102000005.html"]
    assert stored[0]["polling_date"] == "20240102"
    assert stored[0]["body"] == HTML.replace(b"<head>", b'<head>\n<meta charset="UTF-8">')

    (bad,) = spark.read.json(folders.quarantine).collect()
    assert bad["reject_reason"] == "Field 'corp_name' must be a string." and json.loads(bad["item_json"])["corp_name"] == 5
    reasons = {r["rcept_no"][8:]: r["failure_reason"] for r in failures(spark, folders).collect()}
    assert reasons["000003"] == "Failed to download document from DART API."
    assert reasons["000002"].startswith("Processed file too small") and set(reasons) == {"000002", "000003"}

    # the next poll lists the same day again; the failed filing has arrived
    land_payload(folder, 3, doc)
    land_page(folder, [item(1), item(2), item(3), item(6), item(7), item(7)], name="b")
    poll(spark, folders)
    later = [("1", 3, "SUCCESS"), ("1", 6, "FAILED"), ("1", 7, "FAILED"), ("1", 7, "FAILED")]
    assert outcomes(spark, folders)[4:] == later

    # a batch that runs again replaces its own output only
    run_batch(spark.createDataFrame([("20240102",)], "date string"), 1, folders)
    assert outcomes(spark, folders)[4:] == later
    assert read_documents(spark, folders.documents).count() == 3

    for name in "cde":
        land_page(folder, [item(6), item(8)], name=name)
        poll(spark, folders)
    state = {r["rcept_no"][8:]: (r["term"], r["fails"]) for r in state_of(ledger(spark, folders)).collect()}
    assert state["000006"] == ("PERM", 3) and state["000008"] == ("PERM", 3)
    assert state["000007"] == (None, 2) and state["000002"] == ("SKIP", 0)
    assert [o for b, n, o in outcomes(spark, folders) if n == 6] == ["FAILED"] * 3

    table, results = f"{folder}/table", f"{folder}/results"
    query = start_consume(spark, folders.messages, table, results, f"{folder}/checkpoint-consume", interval=None, max_files=1)
    query.awaitTermination()
    rows = upserted(spark, table).orderBy("rcept_no").collect()
    assert [r["rcept_no"][8:] for r in rows] == ["000001", "000003", "000005"]
    body = json.loads(rows[0]["body"])
    assert body["receptionDate"] == "2024-01-02T00:00:00Z" and body["flrName"] is None
    assert "stockCode" not in body and body["minioObjectName"] == "20240102/20240102000001.html"
    assert spark.read.parquet(results).where("status = 'success'").count() == 3


def test_poll_before_anything_is_downloaded(spark, folder):
    folders = Folders(folder)
    land_page(folder, [item(1)])
    land_page(folder, [], date="20240103", status="020")
    days = spark.createDataFrame([("20240102",), ("20240103",), ("not a day",)], "date string")
    assert run_batch(days, 0, folders, Limits(max_fail=1)) == {"processed": 0, "skipped": 0, "errors": 1}
    assert run_batch(days, 1, folders, Limits(max_fail=1)) == {"processed": 0, "skipped": 0, "errors": 0}
    assert outcomes(spark, folders) == [("0", 1, "FAILED")]
    assert [tuple(r) for r in state_of(ledger(spark, folders), 1).select("term", "fails").collect()] == [("PERM", 1)]


MESSAGE = dict(corp_code="c", corp_name=" n ", stock_code="", corp_cls="Y", report_nm="r", rcept_no="20240102000001",
               flr_nm=None, rcept_dt="20240102", rm=None, object_key="k", content_type="t", file_size=5, polling_date="p")


def message_frame(spark, rows):
    from filingflow.schema import MESSAGE_SCHEMA

    df = spark.createDataFrame([{**MESSAGE, **r} for r in rows], MESSAGE_SCHEMA + ", published_seq bigint, unreadable string")
    return df.withColumn("published_at", F.lit("2024-01-01").cast("timestamp"))


def test_upserts_are_idempotent(spark, folder):
    table, results = f"{folder}/table", f"{folder}/results"
    first = message_frame(spark, [
        dict(corp_name="old", published_seq=1), dict(corp_name="new", published_seq=2),
        dict(rcept_no="20240102000002", published_seq=1, rcept_dt="20241332"),
    ])
    second = message_frame(spark, [dict(corp_name="newest", published_seq=3)])
    for batch_id, batch in ((0, first), (1, second), (0, first), (1, second)):
        consume_batch(batch, batch_id, table, results)
    rows = upserted(spark, table).collect()
    assert [(r["rcept_no"], json.loads(r["body"])["corpName"]) for r in rows] == [("20240102000001", "newest")]
    errors = spark.read.parquet(results).where("status = 'error'").collect()
    assert [(r["rcept_no"], r["error_type"]) for r in errors] == [("20240102000002", "unexpected_error")]
    compact(spark, table, f"{folder}/table2", UPSERT_SCHEMA, 1)
    assert upserted(spark, f"{folder}/table2").count() == 1


def test_unreadable_messages_are_error_rows(spark, folder):
    broken = "{ broken " * 500
    os.makedirs(f"{folder}/messages/batch_id=0")
    with open(f"{folder}/messages/batch_id=0/part.txt", "w") as out:
        out.write(json.dumps(MESSAGE) + f"\n{broken}\n" + json.dumps({"corp_name": "no id"}) + "\n")
    table, results = f"{folder}/table", f"{folder}/results"
    start_consume(spark, f"{folder}/messages", table, results, f"{folder}/checkpoint", interval=None).awaitTermination()
    assert [r["rcept_no"] for r in upserted(spark, table).collect()] == ["20240102000001"]
    rows = spark.read.parquet(results).orderBy("error_message").collect()
    assert [(r["error_message"], r["unreadable"]) for r in rows] == [
        (None, None), ("message without an id", None), ("unreadable message", broken),
    ]


def test_first_seen_has_no_watermark(spark, folder):
    def note(days, batch_id):
        rows = spark.createDataFrame([(f"{d}000001",) for d in days], "rcept_no string")
        note_first_seen(rows, batch_id, f"{folder}/seen", ["rcept_no"], F.left("rcept_no", F.lit(8)))

    for batch_id, days in [(0, ["20240105", "20240105"]), (1, ["20240105", "20240106"]), (2, ["19990101"]), (1, ["20240106"])]:
        note(days, batch_id)
    got = [r["rcept_no"][:8] for r in spark.read.parquet(f"{folder}/seen").collect()]
    assert sorted(got) == ["19990101", "20240105", "20240106"]


def test_poll_polls_today_or_a_proper_date(spark, folder):
    import datetime
    import zoneinfo

    import pytest

    folders = Folders(folder)
    today = datetime.datetime.now(zoneinfo.ZoneInfo("Asia/Seoul")).strftime("%Y%m%d")
    land_page(folder, [item(1)])
    land_page(folder, [item(2, date=today)], date=today)
    poll(spark, folders, None)
    assert [r["rcept_no"] for r in ledger(spark, folders).collect()] == [f"{today}000002"]
    for wrong in ("2024-01-02", "2024010", ""):
        with pytest.raises(ValueError):
            start_poll(spark, folders, interval=None, target_date=wrong)


def test_an_empty_filing_date_is_dealt_with_once(spark, folder):
    folders = Folders(folder)
    land_page(folder, [item(1, rcept_dt=""), item(2, rcept_dt="")])
    land_payload(folder, 1, make_zip([("a.html", HTML)]))
    day = spark.createDataFrame([("20240102",)], "date string")
    for batch_id in range(4):
        run_batch(day, batch_id, folders)
    found = [(r["rcept_no"][8:], r["outcome"]) for r in ledger(spark, folders).collect()]
    assert sorted(found) == [("000001", "SUCCESS")] + [("000002", "FAILED")] * 3


def test_the_newest_payload_of_a_filing_counts(spark, folder):
    folders = Folders(folder)
    land_page(folder, [item(1)])
    land_payload(folder, 1, make_zip([("a.html", HTML)]))
    old = f"{folder}/payloads/date=20240102/20240102000001.xml"
    with open(old, "w") as out:
        out.write("<r><status>013</status></r>")
    os.utime(old, (1_000_000_000, 1_000_000_000))
    run_batch(spark.createDataFrame([("20240102",)], "date string"), 0, folders)
    assert outcomes(spark, folders) == [("0", 1, "SUCCESS")]


def test_a_poll_lists_only_its_dates(spark, folder):
    folders = Folders(folder)
    for day in range(1, 6):
        date = f"2024010{day}"
        land_page(folder, [item(1, date=date)], date=date)
        land_payload(folder, 1, make_zip([("a.html", HTML)]), date=date)
    run_batch(spark.createDataFrame([(f"2024010{d}",) for d in range(1, 6)], "date string"), 0, folders)
    from filingflow.sources.payloads import read_payloads

    for frame in (
        landed_pages(spark, folders, ["20240103"]), ledger(spark, folders, ["20240103"]),
        read_documents(spark, folders.documents, ["20240103"]), read_payloads(spark, folders.payloads, dates=["20240103"]),
    ):
        leaves = frame._jdf.queryExecution().analyzed().collectLeaves()
        roots = [leaves.apply(i).relation().location().rootPaths().mkString(",") for i in range(leaves.size())]
        own = [r for r in roots if folder in r]
        assert own and all("," not in r and r.endswith("=20240103") for r in own)


def test_page_statuses_are_rows(spark, folder):
    folders = Folders(folder)
    land_page(folder, [], status="010")
    land_page(folder, [item(1)], date="20240103", total_page=None)
    run_batch(spark.createDataFrame([("20240102",), ("20240103",)], "date string"), 0, folders)
    rows = spark.read.json(folders.page_status).orderBy("date").collect()
    assert [(r["page_action"], r["wait_s"]) for r in rows] == [("key_error", 300), ("accept", 0)]
    assert ledger(spark, folders).count() == 0  # a null total rejects the day


def test_limits_reach_the_job(spark, folder):
    folders = Folders(folder)
    land_page(folder, [item(1), item(2)])
    land_payload(folder, 1, make_zip([("a.html", b"<html>")]))
    land_payload(folder, 2, make_zip([("a.html", HTML), ("b.html", HTML)]))
    run_batch(spark.createDataFrame([("20240102",)], "date string"), 0, folders, Limits(min_bytes=1, max_files=1))
    names = [r["filename"] for r in read_documents(spark, folders.documents).orderBy("rcept_no").collect()]
    assert names == ["20240102000001.html", "20240102000002.zip"]


def test_state_by_batches_is_state_at_once(spark):
    import random

    rng = random.Random(5)
    rows = [(f"{rng.randrange(60):03d}", i, i, rng.choice(["FAIL", "FAIL", "FAIL", "OK", "SKIP"])) for i in range(400)]
    schema = "rcept_no string, attempt_ts bigint, seq bigint, kind string"
    state = spark.createDataFrame([], "rcept_no string, term string, fails bigint")
    for start in range(0, 400, 100):
        batch = spark.createDataFrame(rows[start:start + 100], schema)
        changed = advance_state(state, batch)
        kept = state.join(changed, "rcept_no", "left_anti")
        state = spark.createDataFrame(kept.unionByName(changed).collect(), state.schema)
    whole = retry_state(spark.createDataFrame(rows, schema))
    assert sorted(map(tuple, state.collect())) == sorted(map(tuple, whole.collect()))


def test_filing_fields_cover_the_record():
    assert len(FILING_FIELDS) == 10


def test_late_payloads_need_no_new_listing(spark, folder):
    folders = Folders(folder)
    doc = make_zip([("a.html", HTML)])

    def poll_arrivals():
        start_poll(spark, folders, interval=None, target_date=("20240101", "20240103"), arrivals=True).awaitTermination()

    land_page(folder, [item(1), item(2), item(2), item(3)])
    land_page(folder, [item(5, date="20240104")], date="20240104")
    land_payload(folder, 1, doc)
    poll_arrivals()
    first = [("0", 1, "SUCCESS"), ("0", 2, "FAILED"), ("0", 2, "FAILED"), ("0", 3, "FAILED")]
    assert outcomes(spark, folders) == first
    # one comes late, one comes again, one was never listed, one is of another date
    for no in (2, 1, 9):
        land_payload(folder, no, doc)
    land_payload(folder, 5, doc, date="20240104")
    poll_arrivals()
    assert outcomes(spark, folders) == [*first, ("1", 2, "SUCCESS")]
    poll_arrivals()  # nothing landed
    # the batch runs again after a crash
    arrived = spark.createDataFrame([("20240102", f"20240102{n:06d}") for n in (2, 1, 9)], "date string, rcept_no string")
    run_batch(arrived, 1, folders)
    assert outcomes(spark, folders) == [*first, ("1", 2, "SUCCESS")]
    # a payload that is no archive counts as a failed try
    land_payload(folder, 3, b"gone")
    poll_arrivals()
    assert outcomes(spark, folders)[5:] == [("2", 3, "FAILED")]
    # a new listing tries all that is open
    land_page(folder, [item(3), item(4)], name="b")
    poll_arrivals()
    assert outcomes(spark, folders)[6:] == [("3", 3, "FAILED"), ("3", 4, "FAILED")]
    state = {r["rcept_no"][8:]: (r["term"], r["fails"]) for r in state_of(ledger(spark, folders)).collect()}
    assert state == {"000001": ("OK", 0), "000002": ("OK", 2), "000003": ("PERM", 3), "000004": (None, 1)}


def test_all_that_landed_is_one_batch(spark, folder):
    folders = Folders(folder)
    for day in (2, 3):
        land_page(folder, [item(day, date=f"2024010{day}")], date=f"2024010{day}")
        for name in "abc":
            land_payload(folder, day, make_zip([("a.html", HTML)]), date=f"2024010{day}")
    start_poll(
        spark, folders, interval=None, target_date=("20240101", "20240103"), arrivals=True, max_files=None
    ).awaitTermination()
    assert outcomes(spark, folders) == [("0", 2, "SUCCESS"), ("0", 3, "SUCCESS")]


def test_a_batch_of_messages_is_read_once(spark, folder):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    text = "named_struct('rcept_no', concat('19950101', lpad(id, 6, '0')), 'rcept_dt', '19950101', 'corp_name', ' x ')"
    spark.range(50).selectExpr(f"to_json({text}) AS value").coalesce(1).write.text(f"{folder}/messages/batch_id=0")
    rows = read_messages(spark, f"{folder}/messages")
    consume_batch(rows.mapInArrow(counted, rows.schema), 0, f"{folder}/table", f"{folder}/results")
    assert seen.value == 50
    assert upserted(spark, f"{folder}/table").count() == spark.read.parquet(f"{folder}/results").count() == 50
