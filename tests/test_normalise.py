"""Archives and whole payloads."""

import zipfile

from pyspark.sql import functions as F

from filingflow.operators.normalise import normalise, processing_line, with_archive
from filingflow.sources.payloads import with_download_error
from zips import make_zip, without_utf8_flag

META = b'<meta charset="UTF-8">'
DECL = b'<?xml version="1.0" encoding="UTF-8"?>'
HTML = b"<html><head></head><body>x</body></html>"
XML = b"<?xml version='1.0'?><a>" + b"y" * 500 + b"</a>"


def payloads(spark, contents):
    rows = [(f"{i:04d}", c) for i, c in enumerate(contents)]
    return spark.createDataFrame(rows, "rcept_no string, content binary")


def run(spark, contents, **options):
    out = normalise(payloads(spark, contents), **options).orderBy("rcept_no").collect()
    return [r.asDict() for r in out]


def test_best_member(spark):
    broken = bytearray(make_zip([("a.html", HTML)], zipfile.ZIP_STORED))
    broken[broken.index(b"<html>")] = ord("?")
    archives = [
        make_zip([("big.xml", XML), ("small.html", HTML)]),
        make_zip([("1.html", HTML), ("2.html", HTML + b"longer")]),
        make_zip([("1.html", HTML + b"a"), ("2.html", HTML + b"b")]),
        make_zip([("a.bin", b"\x00\x01"), ("b.bin", b"\x00" * 9)]),
        make_zip([("d/x.xml", XML)], directories=["d/"]),
        make_zip([]),
        b"PK\x03\x04 broken",
        bytes(broken),
        without_utf8_flag("보고서.html", HTML),
        make_zip([("보고서.html", HTML)]),
    ]
    got = run(spark, archives)
    assert [r["summary"] for r in got[:5]] == [
        "ZIP(2 files) -> 'small.html' (html) [enc: utf-8-sig]",
        "ZIP(2 files) -> '2.html' (html) [enc: utf-8-sig]",
        "ZIP(2 files) -> '1.html' (html) [enc: utf-8-sig]",
        "ZIP(2 files) -> 'b.bin' (bin)",
        "ZIP(1 files) -> 'x.xml' (xml) [enc: utf-8-sig]",
    ]
    assert got[0]["body"] == HTML.replace(b"<head>", b"<head>\n" + META)
    assert got[3]["body"] == b"\x00" * 9 and got[3]["filename"] == "0003"
    assert got[4]["body"] == XML.replace(b"<?xml version='1.0'?>", DECL)
    assert got[4]["content_type"] == "application/xml; charset=UTF-8" and got[4]["filename"] == "0004.xml"
    for i, said in ((6, "not a zip"), (7, "Bad CRC-32")):
        assert got[i]["body"] == archives[i] and got[i]["filename"] == f"{i:04d}.zip"
        assert got[i]["summary"].startswith("ZIP(failed: ") and said in got[i]["summary"]
        assert got[i]["content_type"] == "application/octet-stream" and got[i]["error"] is None
    # an archive without entries does not start with the entry signature
    assert got[5]["summary"] == "Detected as 'bin'"
    assert "'보고서.html'" in got[8]["summary"] and "'보고서.html'" in got[9]["summary"]


def test_guards(spark):
    many = make_zip([(f"{i}.txt", b"x") for i in range(201)])
    large = make_zip([("a.html", HTML * 100)])
    assert run(spark, [many])[0]["summary"] == "ZIP(failed: Too many files in ZIP: 201 (max: 200))"
    got = run(spark, [large], max_bytes=1000)[0]
    assert got["summary"] == f"ZIP(failed: ZIP too large: {len(HTML) * 100} bytes (max: 1000))"
    only_dirs = make_zip([], directories=["d/"])
    assert run(spark, [only_dirs])[0]["summary"] == "ZIP(failed: Empty ZIP file)"
    totals = with_archive(payloads(spark, [make_zip([("a", b"12"), ("b", b"345")])])).first()["archive"]
    assert (totals["n_files"], totals["total_bytes"]) == (2, 5)


def test_member_heads_decide_and_whole_members_are_kept(spark):
    member = b"<html>" + "가나다".encode("cp949") * 100_000
    got = run(spark, [make_zip([("a.html", member)])] * 3)
    for r in got:
        assert r["used_enc"] == "cp949"
        assert r["body"] == META + b"\n" + member.decode("cp949").encode()


def test_large_results_leave_python_in_several_batches(spark):
    members = [b"<html>%03d " % i + b"x" * 1_000_000 for i in range(40)]
    frame = payloads(spark, [make_zip([("a.html", m)]) for m in members]).coalesce(1)
    got = normalise(frame).orderBy("rcept_no").collect()
    assert [r["body"] for r in got] == [META + b"\n" + m for m in members]


def test_broken_stream_fails_the_filing(spark):
    blob = bytearray(make_zip([("a.html", HTML * 20)]))
    start = blob.index(b"a.html") + 6
    blob[start:start + 4] = b"\xff\xff\xff\xff"
    got = run(spark, [bytes(blob)])[0]
    assert got["error"] and got["body"] is None


def test_plain_payloads(spark):
    got = run(spark, [HTML, XML, b"text", "<html>가".encode("cp949"), b"<html><meta charset='bogus-9'>"])
    assert [r["summary"] for r in got[:4]] == [
        "HTML [enc: utf-8-sig]", "XML [enc: utf-8-sig]", "Detected as 'bin'", "HTML [enc: cp949]",
    ]
    assert got[2]["body"] == b"text" and got[2]["used_enc"] is None
    assert got[3]["body"] == META + "\n<html>가".encode()
    assert got[4]["error"] == "unknown encoding: bogus-9" and got[4]["body"] is None


def test_download_errors(spark):
    answer = b'<?xml version="1.0" encoding="utf-8"?><result><status>%s</status><message>m</message></result>'
    contents = [
        make_zip([("a", b"1")]), answer % b"013", answer % b"010", answer % b"901", answer % b"900",
        b"<r><status>011</status></r>", b"junk", None, b"",
    ]
    got = with_download_error(payloads(spark, contents)).orderBy("rcept_no").collect()
    none = "Failed to download document from DART API."
    assert [r["download_error"] for r in got] == [
        None, none, "DART API Error [010]: m", "DART API Error [901]: m", none,
        "DART API Error [011]: Unknown error", none, none, none,
    ]


def test_payload_is_not_shuffled_by_normalise(spark):
    plan = normalise(payloads(spark, [HTML]))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_processing_line(spark):
    cols = [F.lit(x) for x in ("20240101", "20240102", "corp", "report", "f.html", "HTML [enc: cp949]")]
    line = spark.range(1).select(processing_line(*cols)).first()[0]
    assert line == (
        "Processed | 20240101 (Polled on 20240102)  | [corp           ] | "
        + "report".ljust(50) + " | Saved as 'f.html' (HTML [enc: cp949])"
    )
