"""Landed files: listed and read by tasks, the driver holds none of them."""

import gzip
import os
import time

import pytest
from pyspark.sql import functions as F

from filingflow.plans import views
from filingflow.plans.queries import QUERIES
from filingflow.sources import landed
from filingflow.sources.arrivals import note_arrivals
from filingflow.sources.payloads import arrived_payloads, list_payloads, read_payloads, with_content
from filingflow.streaming import poll
from filingflow.streaming.poll import Folders, landed_pages, start_poll
from test_streaming import HTML, item, land_page, land_payload, outcomes
from zips import make_zip


def put(root, path, blob, at=None):
    os.makedirs(os.path.dirname(f"{root}/{path}"), exist_ok=True)
    with open(f"{root}/{path}", "wb") as out:
        out.write(blob)
    if at is not None:
        os.utime(f"{root}/{path}", (at, at))


def test_the_driver_lists_no_landed_file(spark, folder):
    for no in range(1, 31):
        for date in ("20240102", "20240103"):
            land_page(folder, [item(no, date=date)], page_no=no, date=date)
            land_payload(folder, no, b"PK", date=date)
    pages = landed_pages(spark, Folders(folder), ["20240102", "20240103"])
    payloads = read_payloads(spark, f"{folder}/payloads", dates=["20240102", "20240103"])
    assert len(pages.inputFiles()) <= 2 and len(payloads.inputFiles()) <= 2
    assert pages.count() == payloads.where("content = 'PK'").count() == 60
    assert [r["page_no"] for r in pages.where("date = '20240102'").orderBy("page_no").collect()] == list(range(1, 31))


@pytest.mark.parametrize("name, runs", [("poll_twice", 3), ("poll_compacted", 4)])
def test_polls_list_pages_by_tasks(spark, sf_dir, monkeypatch, name, runs):
    batches = []
    monkeypatch.setattr(views, "payloads", lambda s, *a: s.createDataFrame([], "rcept_no string, content binary"))
    monkeypatch.setattr(poll, "run_batch", lambda dates, *a, **k: batches.append((len(dates.inputFiles()), dates.count())))
    QUERIES[name](spark, sf_dir).schema
    assert [n for n, _ in batches] == [0] * runs and all(n > 50 for _, n in batches)  # files the driver knows, pages


def test_files_that_spark_passes_over(spark, folder):
    day = "date=20240102"
    put(folder, f"{day}/a.zip", b"old", 1_000)
    put(folder, f"{day}/a.xml", b"", 2_000)  # newer, but empty
    put(folder, f"{day}/_b.zip", b"hidden")
    put(folder, f"{day}/.c.zip", b"hidden")
    put(folder, f"{day}/d.zip._COPYING_", b"hidden")
    put(folder, f"{day}/_part/e.zip", b"hidden")
    put(folder, f"{day}/deeper/f.zip", b"found")
    put(folder, "_staging/date=20240102/g.zip", b"hidden")
    put(folder, "date=20240103/a.zip", b"other day")
    rows = read_payloads(spark, folder).orderBy("date", "rcept_no").collect()
    assert [(r["date"], r["rcept_no"], r["length"], bytes(r["content"])) for r in rows] == [
        ("20240102", "a", 3, b"old"), ("20240102", "f", 5, b"found"), ("20240103", "a", 9, b"other day"),
    ]
    # the newest of several, then the last name
    put(folder, f"{day}/a.pdf", b"newest", 3_000)
    put(folder, f"{day}/a.rtf", b"last name", 3_000)
    listed = list_payloads(spark, folder, ["20240102"])
    wanted = listed.where("rcept_no = 'a'")
    assert [bytes(r["content"]) for r in with_content(wanted, listed, folder).collect()] == [b"last name"]


def test_packed_pages_are_unpacked(spark, folder):
    put(folder, "pages/date=20240102/page_no=1/p.json.gz", gzip.compress(b'{"status":"000"}'))
    put(folder, "pages/date=20240102/page_no=2/p.json", b"{ broken \xff")
    rows = landed_pages(spark, Folders(folder), ["20240102"]).select("page_no", F.to_json("page").alias("page")).collect()
    assert sorted(map(tuple, rows)) == [(1, '{"status":"000"}'), (2, None)]


def test_large_files_leave_python_one_by_one(spark, folder):
    for no in range(6):
        put(folder, f"date=20240102/{no}.zip", bytes([no]) * (landed.READ_BYTES + 1))
    rows = read_payloads(spark, folder).select("rcept_no", F.md5("content").alias("sum"), F.octet_length("content").alias("n"))
    found = rows.collect()
    assert len({r["sum"] for r in found}) == 6 and {r["n"] for r in found} == {landed.READ_BYTES + 1}


def logged(spark, log):
    return sorted(r["path"] for r in spark.read.parquet(log).collect())


def test_a_file_arrives_once(spark, folder):
    root, log = f"{folder}/in", f"{folder}/log"
    assert note_arrivals(spark, root, log) == 0  # nothing is there yet
    for no in range(3):
        put(root, f"date=2024010{no}/{no}.zip", b"x")
    put(root, "date=20240101/empty.zip", b"")
    put(root, "date=20240101/_hidden.zip", b"x")
    assert note_arrivals(spark, root, log) == 3
    assert logged(spark, log) == [f"date=2024010{no}/{no}.zip" for no in range(3)]
    put(root, "date=20240101/1.zip", b"again")
    files = sorted(os.listdir(log))
    assert note_arrivals(spark, root, log) == 0 and sorted(os.listdir(log)) == files  # no file, so no batch
    put(root, "date=20240101/empty.zip", b"no more")
    put(root, "date=20240102/1.zip", b"a name of another date")
    put(root, "date=20240101/old.zip", b"x", 1_000)  # lands now, was changed long ago
    assert note_arrivals(spark, root, log) == 3 and len(logged(spark, log)) == 6
    assert {"date=20240101/empty.zip", "date=20240101/old.zip", "date=20240102/1.zip"} < set(logged(spark, log))


def test_a_file_of_the_log_is_a_batch(spark, folder):
    root, log = f"{folder}/in", f"{folder}/log"
    names = sorted(f"date=2024010{no % 2}/{no}.zip" for no in range(25))
    for name in names:
        put(root, name, b"x")
    assert note_arrivals(spark, root, log, 10) == 25 and logged(spark, log) == names
    files = [f for f in os.listdir(log) if f.endswith(".parquet")]
    sizes = [spark.read.parquet(f"{log}/{f}").count() for f in files]
    assert 3 <= len(sizes) <= 6 and max(sizes) <= 10
    for most, batches in ((10, len(sizes)), (None, 1)):
        taken = []
        arrived_payloads(spark, log, most).writeStream.foreachBatch(
            lambda batch, n: taken.append([tuple(r) for r in batch.select("date", "rcept_no").collect()])
        ).option("checkpointLocation", f"{folder}/checkpoint-{most}").trigger(availableNow=True).start().awaitTermination()
        assert len(taken) == batches
        assert sorted(f"date={date}/{no}.zip" for batch in taken for date, no in batch) == names


def test_a_running_poll_finds_what_lands(spark, folder):
    folders = Folders(folder)
    land_page(folder, [item(1), item(2)])
    query = start_poll(spark, folders, interval="1 second", target_date="20240102", arrivals=True)
    try:
        for no, batches in ((1, 2), (2, 3)):
            assert wait_for(lambda: len({b for b, *_ in outcomes(spark, folders)}) == batches - 1)
            land_payload(folder, no, make_zip([("a.html", HTML)]))
        assert wait_for(lambda: len(outcomes(spark, folders)) == 4)
    finally:
        query.stop()
    assert outcomes(spark, folders) == [("0", 1, "FAILED"), ("0", 2, "FAILED"), ("1", 1, "SUCCESS"), ("2", 2, "SUCCESS")]


def wait_for(done, seconds=90):
    end = time.time() + seconds
    while time.time() < end:
        try:
            if done():
                return True
        except Exception:  # a table that is being written
            pass
        time.sleep(0.5)
    return False


def test_the_poll_keeps_no_listing_of_payloads(spark, folder):
    folders = Folders(folder)
    land_page(folder, [item(no) for no in range(1, 5)])
    for no in range(1, 4):
        land_payload(folder, no, make_zip([("a.html", HTML)]))
    query = start_poll(spark, folders, interval=None, target_date="20240102", arrivals=True)
    query.awaitTermination()
    sources = [s["description"] for s in query.lastProgress["sources"]]
    assert len(sources) == 2 and not any(f"{folder}/payloads" in s for s in sources)
    assert outcomes(spark, folders) == [("0", 1, "SUCCESS"), ("0", 2, "SUCCESS"), ("0", 3, "SUCCESS"), ("0", 4, "FAILED")]
    assert logged(spark, f"{folder}/checkpoint_poll/arrivals") == [f"date=20240102/20240102{no:06d}.zip" for no in range(1, 4)]
    # a batch leaves nothing it wrote on the way
    assert os.listdir(f"{folder}/pages/_listings") == os.listdir(f"{folder}/payloads/_listings") == []
