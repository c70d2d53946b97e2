"""Operators on literal rows and against plain sequential loops."""

import json
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from filingflow.operators import health, incremental, ledger, paging, parse, publish, retry
from filingflow.sources import listing, messages, payloads
from filingflow.operators import sinks
from filingflow.session import written


def variants(spark, texts):
    rows = [(i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "pos int, t string").select("pos", F.try_parse_json("t").alias("item"))


ITEM = dict(corp_code="00126380", corp_name="삼성전자", stock_code="005930", corp_cls="Y", report_nm="사업보고서",
            rcept_no="20241229000001", flr_nm="삼성전자", rcept_dt="20241229", rm="")


def test_parse_items(spark):
    missing = {k: v for k, v in ITEM.items() if k != "corp_name"}
    texts = [
        json.dumps(ITEM), json.dumps({**ITEM, "stock_code": "", "corp_name": ""}), json.dumps(missing),
        json.dumps({**ITEM, "corp_cls": None}), json.dumps({**ITEM, "rcept_no": 20241229000001}),
        json.dumps({**missing, "report_nm": 1}), '"text"', "5", json.dumps({**ITEM, "rcept_dt": ["x"]}),
        json.dumps({k: ITEM[k] for k in ITEM if k not in ("stock_code", "flr_nm", "rm")}),
    ]
    parsed = parse.parse_items(variants(spark, texts))
    reasons = [r["reject_reason"] for r in parsed.orderBy("pos").collect()]
    assert reasons == [
        None, None, "Required key 'corp_name' is missing.", "Field 'corp_cls' must be a string.",
        "Field 'rcept_no' must be a string.", "Required key 'corp_name' is missing.",
        "Required key 'corp_code' is missing.", "Required key 'corp_code' is missing.",
        "Field 'rcept_dt' must be a string.", None,
    ]
    good = parse.accepted(parsed).orderBy("pos").collect()
    assert good[0]["corp_name"] == "삼성전자" and good[0]["rm"] is None
    assert good[0]["url"] == "https://dart.fss.or.kr/dsaf001/main.do?rcpNo=20241229000001"
    assert good[1]["stock_code"] is None and good[1]["corp_name"] == ""
    assert (good[2]["stock_code"], good[2]["flr_nm"], good[2]["rm"]) == (None, None, None)
    bad = parse.quarantined(parsed).orderBy("pos").collect()
    assert len(bad) == 7 and json.loads(bad[0]["item_json"]) == missing


def pages_read(pages):
    """The polling loop: pages that are read, as a plain loop over a dict."""
    read, page, total = [], 1, 1
    while page <= total:
        if page not in pages:
            break
        status, n_items, declared, count = pages[page]
        if status != "000":
            break
        if page == 1:
            try:
                total, _ = int(declared), int(count)
            except ValueError:
                return []
        if n_items == 0 and page > 1:
            break
        read.append(page)
        page += 1
    return read


def test_page_prefix_is_the_loop(spark):
    rng = random.Random(3)
    rows, want = [], {}
    for day in range(400):
        date = f"{day:08d}"
        pages = {}
        for page in range(1, rng.randrange(1, 8)):
            if rng.random() < 0.9:
                status = rng.choices(["000", "013", "020", "999"], [20, 1, 1, 1])[0]
                declared = rng.choice(["0", "1", "2", "3", "5", " 4 ", "many"])
                pages[page] = (status, rng.choice([0, 1, 2, 3, 3, 3]), declared, rng.choice(["7"] * 9 + ["?"]))
        want[date] = pages_read(pages)
        rows += [(date, page, *p) for page, p in pages.items()]
    schema = "date string, page_no int, status string, n_items int, total_page_text string, total_count_text string"
    got = defaultdict(list)
    for r in paging.counted_pages(spark.createDataFrame(rows, schema)).collect():
        got[r["date"]].append(r["page_no"])
    assert {d: sorted(p) for d, p in got.items()} == {d: p for d, p in want.items() if p}


def test_page_files(spark, folder):
    import os

    def land(date, page, text):
        os.makedirs(f"{folder}/date={date}/page_no={page}")
        open(f"{folder}/date={date}/page_no={page}/p.json", "w").write(text)

    land("20240101", 1, json.dumps({"status": "000", "total_page": "2", "total_count": 3, "list": [ITEM, ITEM]}, indent=2))
    land("20240101", 2, json.dumps({"status": "000", "list": [ITEM]}))
    land("20240102", 1, "{ no json")
    land("20240103", 1, json.dumps({"status": "020", "message": "later"}))
    pages = listing.page_fields(listing.read_pages(spark, folder))
    rows = {(r["date"], r["page_no"]): r for r in pages.collect()}
    assert rows["20240101", 1]["n_items"] == 2 and rows["20240101", 1]["total_page_text"] == "2"
    assert rows["20240102", 1]["status"] == "" and rows["20240103", 1]["message"] == "later"
    assert listing.page_items(paging.counted_pages(pages)).count() == 3
    actions = {r["date"]: (r["page_action"], r["wait_s"]) for r in paging.page_actions(pages, 60).collect()}
    assert actions["20240102"] == ("error", 0) and actions["20240103"] == ("rate_limited", 3600)
    only = pages.where(listing.scan_predicate(date="20240103", corp_cls=""))
    assert only.count() == 1
    plan = only._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_poll_date(spark):
    today = spark.range(1).select(listing.poll_date_today().alias("d"), listing.valid_poll_date(listing.poll_date_today()).alias("ok")).first()
    assert today["ok"] and len(today["d"]) == 8


def fold(attempts, max_fail):
    """Retry state by replaying the attempts one after the other."""
    fails, term = defaultdict(int), {}
    for key, _, _, kind in sorted(attempts, key=lambda a: (a[1], a[2])):
        if key in term:
            continue
        if kind == "FAIL":
            fails[key] += 1
            if fails[key] >= max_fail:
                term[key] = "PERM"
        else:
            term[key] = kind
    return {k: (term.get(k), fails[k]) for k in {a[0] for a in attempts}}


@pytest.mark.parametrize("max_fail", [1, 3, 5])
def test_retry_state_is_the_fold(spark, max_fail):
    rng = random.Random(max_fail)
    # one id holds a third of all attempts
    keys = ["hot" if rng.random() < 0.33 else f"{rng.randrange(200):04d}" for _ in range(2000)]
    rows = [(k, rng.randrange(500), i, rng.choices(["FAIL", "OK", "SKIP"], [8, 1, 1])[0]) for i, k in enumerate(keys)]
    state = retry.retry_state(spark.createDataFrame(rows, "rcept_no string, attempt_ts int, seq int, kind string"), max_fail)
    want = fold(rows, max_fail)
    assert {r["rcept_no"]: (r["term"], r["fails"]) for r in state.collect()} == want
    stats = retry.retry_stats(state).first()
    assert stats["processed_count"] == sum(t is not None for t, _ in want.values())
    assert stats["error_count"] == sum(f for _, f in want.values())
    assert stats["pending_retry_count"] == sum(f > 0 and t in (None, "SKIP") for t, f in want.values())


@pytest.mark.parametrize("kinds,term,fails", [
    ("FFS", "OK", 2), ("FFFS", "PERM", 3), ("Fk", "SKIP", 1), ("SF", "OK", 0), ("FF", None, 2), ("kS", "SKIP", 0),
])
def test_retry_literals(spark, kinds, term, fails):
    names = {"F": "FAIL", "S": "OK", "k": "SKIP"}
    rows = [("a", i, i, names[c]) for i, c in enumerate(kinds)]
    got = retry.retry_state(spark.createDataFrame(rows, "rcept_no string, attempt_ts int, seq int, kind string")).first()
    assert (got["term"], got["fails"]) == (term, fails)


def test_expected_counters(spark):
    from filingflow.plans.queries import QUERIES

    got = QUERIES["retry_stats"](spark, "/root/testdata/sf0.01").first().asDict()
    assert list(got.values()) == [2941, 1251, 1298, 3835, 1545, 392]


def test_new_filings(spark):
    rows = [("20240101", 1, 0, "a", "d1"), ("20240101", 1, 1, "b", "d1"), ("20240101", 2, 0, "a", "d2"), ("20240101", 2, 1, "c", "d2")]
    filings = spark.createDataFrame(rows, "date string, page_no int, pos int, rcept_no string, rcept_dt string")
    once = incremental.listed_once(filings)
    assert sorted((r["rcept_no"], r["rcept_dt"], r["n_listed"]) for r in once.collect()) == [("a", "d1", 2), ("b", "d1", 1), ("c", "d2", 1)]
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "rcept_no string")
    known = incremental.known_ids(ids("b", "z"), ids("z"))
    assert known.count() == 2
    stored = spark.createDataFrame([("d1", "c"), ("d1", "a")], "rcept_dt string, rcept_no string")
    assert [r["rcept_no"] for r in incremental.new_filings(once, known, stored).collect()] == ["c"]
    marks = {r["rcept_no"]: r["is_stored"] for r in incremental.mark_stored(once, stored).collect()}
    assert marks == {"a": True, "b": False, "c": False}


def test_upsert_payload(spark):
    message = {**ITEM, "rm": None, "stock_code": " ", "flr_nm": None, "corp_name": "\t삼성전자　", "object_key": "k",
               "content_type": None, "file_size": 5, "tags": ["t"], "report_nm": 'a"b'}
    schema = "corp_code string, corp_name string, stock_code string, corp_cls string, report_nm string, rcept_no string, flr_nm string, rcept_dt string, rm string, object_key string, content_type string, file_size bigint, tags array<string>"
    columns = publish.upsert_columns(spark.createDataFrame([message], schema))
    body = json.loads(columns.select(publish.upsert_payload(columns).alias("b")).first()["b"])
    assert body == {
        "reportName": 'a"b', "corpCode": "00126380", "corpName": "삼성전자", "corpCls": "Y", "flrName": None,
        "receptionDate": "2024-12-29T00:00:00Z", "stockCode": "", "minioObjectName": "k", "fileSize": 5, "tags": ["t"],
    }
    none = columns.select(*publish.ALWAYS_SENT, F.lit(None).cast("bigint").alias("fileSize"))
    assert set(json.loads(none.select(publish.upsert_payload(none).alias("b")).first()["b"])) == set(publish.ALWAYS_SENT)


def test_response_routing(spark):
    rows = [(200, 1, "r"), (404, 1, "x" * 300), (500, 1, "r"), (503, 2, "r"), (500, 3, "r"), (None, 1, None), (301, 3, "r")]
    out = publish.route_responses(spark.createDataFrame(rows, "code int, attempt_no int, response string")).collect()
    assert [(r["status"], r["error_type"], r["wait_s"]) for r in out] == [
        ("success", None, None), ("error", "client_error", None), ("retry", None, 0.5), ("retry", None, 1.0),
        ("exhausted", None, None), ("retry", None, 0.5), ("exhausted", None, None),
    ]
    assert len(out[1]["error_message"]) == 300 and len(out[1]["logged"]) == 200


def test_message_files(spark, folder):
    rows = spark.createDataFrame([("c", "n", None, "Y", "r", "1", None, "d", None, "k", "t", 5, "p")], publish_schema())
    sinks.publish(rows, folder, 3)
    text = spark.read.text(folder).first()["value"]
    assert json.loads(text)["stock_code"] is None and list(json.loads(text)) == publish.MESSAGE_FIELDS
    back = messages.read_messages(spark, folder).first()
    assert back["file_size"] == 5 and back["published_seq"] == 3


def publish_schema():
    from filingflow.schema import MESSAGE_SCHEMA

    return MESSAGE_SCHEMA


def test_size_gate(spark):
    df = spark.createDataFrame([(bytearray(199),), (bytearray(200),)], "body binary")
    assert [r["skip_reason"] for r in publish.size_gate(df).collect()] == ["Processed file too small (199 bytes).", None]


def test_failure_records(spark):
    rows = [("a", 1, 1, "FAILED", "first", ("a",)), ("a", 2, 2, "FAILED", "second", ("a",)), ("b", 1, 3, "SUCCESS", None, ("b",))]
    schema = "rcept_no string, attempt_ts int, seq int, outcome string, reason string, filing struct<rcept_no: string>"
    attempts = spark.createDataFrame(rows, schema)
    latest = ledger.latest_failures(ledger.failure_records(attempts)).collect()
    assert [(r["failure_reason"], r["disclosure_details"]["rcept_no"]) for r in latest] == [("second", "a")]
    assert {r["outcome"]: r["n"] for r in ledger.outcome_counts(attempts).collect()} == {"FAILED": 2, "SUCCESS": 1}


def test_health(spark):
    rows = [("never", 1, 1, False), ("ok", 1, 1, False), ("ok", 2, 2, True)]
    rows += [(f"f{n}", 0, 0, True) for n in (1, 5, 6)] + [(f"f{n}", 1, i, False) for n in (1, 5, 6) for i in range(n)]
    rows += [("tie", 1, 1, False), ("tie", 1, 2, True), ("tie", 1, 3, False)]
    events = spark.createDataFrame(rows, "component string, ts int, seq int, ok boolean").withColumn("ts", F.timestamp_seconds("ts"))
    checks = health.component_health(events)
    got = {r["component"]: (r["status"], r["consecutive_failures"]) for r in checks.collect()}
    assert got == {"never": ("degraded", 1), "ok": ("healthy", 0), "f1": ("degraded", 1), "f5": ("degraded", 5),
                   "f6": ("unhealthy", 6), "tie": ("degraded", 1)}
    message = {r["component"]: r["message"] for r in checks.collect()}
    assert message["never"] == "No successful API call yet" and message["f6"] == "Too many consecutive failures: 6"
    total = health.rollup(checks).first()
    assert (total["status"], total["ready"]) == ("unhealthy", False)
    calm = health.rollup(checks.where("component <> 'f6'")).first()
    assert (calm["status"], calm["ready"]) == ("degraded", True)


def test_a_hot_component_is_split(spark):
    tight = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in tight}
    try:
        for key, value in tight.items():
            spark.conf.set(key, value)
        n = F.col("id")
        events = spark.range(0, 200_000, 1, 8).select(
            F.when(n % 3 == 0, 0).otherwise(n).alias("component"), F.timestamp_seconds(n).alias("ts"),
            n.alias("seq"), (n == 99_999).alias("ok"),
        )
        result = health.consecutive_failures(events)
        hot = [r for r in result.collect() if r["component"] == 0]
        assert [r["consecutive_failures"] for r in hot] == [sum(i % 3 == 0 for i in range(100_000, 200_000))]
        assert "SortMergeJoin(skew=true)" in result._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_payload_files(spark, folder):
    import os

    os.makedirs(f"{folder}/date=20240101")
    open(f"{folder}/date=20240101/20240101000001.zip", "wb").write(b"PK")
    files = payloads.read_payloads(spark, folder)
    assert files.select("rcept_no", "date", "length").first() == ("20240101000001", "20240101", 2)
    plan = files.select("rcept_no", "date")._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan
    assert payloads.read_payloads(spark, folder, dates=["20240101", "20240102"]).count() == 1
    assert payloads.read_payloads(spark, folder, dates=["20240102"]).count() == 0
    assert payloads.read_payloads(spark, f"{folder}/none").count() == 0
