"""Filings, attempts, payloads and events derived from the driver tables.

``oracle.py`` states the same views in SQL.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import BinaryType

from ..operators import publish
from ..session import if_small, written

DAY, MONTH, YEAR = "yyyyMMdd", "yyyyMM'01'", "yyyy'0101'"


SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_acctbal double, c_mktsegment string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
}

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _padded(number: Column, width: int) -> Column:
    """Zero-padded number; longer numbers keep all their digits."""
    text = number.cast("string")
    return F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit("0"))


def filings(spark: SparkSession, sf_dir: str, day: str = DAY) -> DataFrame:
    """Listing fields as strings, one row per order, plus the order key ``k``.

    ``day`` is the pattern of the filing date; ``MONTH`` and ``YEAR`` file all at the first day of those.
    """
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    rcept_dt = F.date_format("o_orderdate", day)
    segment = F.col("c_mktsegment")
    return orders.join(customer, orders["o_custkey"] == customer["c_custkey"]).select(
        F.col("o_orderkey").alias("k"),
        _padded(F.col("c_custkey"), 8).alias("corp_code"),
        F.col("c_name").alias("corp_name"),
        F.when(F.col("c_acctbal") < 0, "").otherwise(_padded(F.col("c_custkey"), 6)).alias("stock_code"),
        F.when(segment == "AUTOMOBILE", "Y").when(segment == "BUILDING", "K").when(segment == "FURNITURE", "N")
        .otherwise("E").alias("corp_cls"),
        F.col("o_orderpriority").alias("report_nm"),
        F.concat(rcept_dt, _padded(F.col("o_orderkey"), 6)).alias("rcept_no"),
        F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("c_name")).alias("flr_nm"),
        rcept_dt.alias("rcept_dt"),
        F.when(F.col("o_orderstatus") == "O", "").otherwise(F.col("o_orderstatus")).alias("rm"),
    )


LISTED = ["corp_code", "corp_name", "stock_code", "corp_cls", "report_nm", "rcept_no", "flr_nm", "rcept_dt", "rm"]


def item_json() -> Column:
    return F.to_json(F.struct(*LISTED))


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed items as VARIANT; some break the contract, by key modulo."""
    k = F.col("k")

    def quoted(name: str) -> Column:
        return F.concat(F.lit('"'), F.col(name), F.lit('"'))

    def pair(name: str, value: Column) -> Column:
        return F.concat(F.lit(f'"{name}":'), value)

    broken = {
        "corp_cls": F.when(k % 11 == 0, "12").otherwise(quoted("corp_cls")),
        "report_nm": F.when(k % 13 == 0, "null").otherwise(quoted("report_nm")),
    }
    pairs = [pair(name, broken.get(name, quoted(name))) for name in LISTED]
    at = LISTED.index("corp_name")
    pairs[at] = F.when(k % 7 != 0, pairs[at])  # concat_ws leaves a NULL out
    text = F.concat(F.lit("{"), F.concat_ws(",", *pairs), F.lit("}"))
    return filings(spark, sf_dir).select("k", F.parse_json(text).alias("item"))


def pages(spark: SparkSession, sf_dir: str, day_pattern: str = DAY) -> DataFrame:
    """Landed listing pages: a page holds a day's filings from a range of 10,000 keys.

    Statuses, empty pages and wrong totals are set by day and page number.
    """
    day = F.day(F.to_date("date", "yyyyMMdd"))
    mark = (day * 31 + F.col("page_no")) % 17
    listed = filings(spark, sf_dir, day_pattern).select(
        F.col("rcept_dt").alias("date"),
        (F.floor(F.col("k") / 10000) + 1).cast("int").alias("page_no"),
        "k",
        item_json().alias("item"),
    )
    paged = listed.groupBy("date", "page_no").agg(F.array_sort(F.collect_list(F.struct("k", "item"))).alias("listed"))
    totals = listed.groupBy("date").agg(F.max("page_no").alias("n_pages"), F.count("*").alias("n_items"))
    status = (
        F.when(mark == 0, "020").when(mark == 1, "013").when(mark == 2, "800").when(mark == 3, "010").otherwise("000")
    )
    entries = F.when(
        (status == "000") & ((day * 7 + F.col("page_no")) % 19 != 0),
        F.concat_ws(",", F.transform("listed", lambda x: x["item"])),
    ).otherwise("")
    declared = F.col("n_pages") - (day % 5 == 0).cast("int")
    total_page = (
        F.when(day == 27, "null").when(day % 2 == 0, F.concat(F.lit('"'), declared, F.lit('"'))).otherwise(declared.cast("string"))
    )
    body = F.concat(
        F.lit('{"status":"'), status, F.lit('","total_page":'), total_page,
        F.lit(',"total_count":'), F.col("n_items"), F.lit(',"list":['), entries, F.lit("]}"),
    )
    return paged.join(written(totals, "day-totals"), "date").select("date", "page_no", F.parse_json(body).alias("page"))


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attempt log: a user's events of a day are the attempts at one filing."""
    kind = F.when(F.col("event_type") == "purchase", "OK").when(F.col("event_type") == "signup", "SKIP").otherwise("FAIL")
    return table(spark, sf_dir, "events").select(
        attempt_key().alias("rcept_no"), F.col("ts").alias("attempt_ts"), F.col("event_id").alias("seq"),
        kind.alias("kind"), "event_type", "value",
    )


def attempt_key() -> Column:
    return F.concat(F.date_format("ts", "yyyyMMdd"), _padded(F.col("user_id"), 6))


def health_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user is a component that succeeds when a purchase happens."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("component"), "ts", F.col("event_id").alias("seq"),
        (F.col("event_type") == "purchase").alias("ok"),
    )


def wrapped_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as html, xml or plain text, by id modulo 3."""
    k, text = F.col("doc_id") % 3, F.col("text")
    body = (
        F.when(k == 0, F.concat(F.lit("<html><head></head><body>"), text, F.lit("</body></html>")))
        .when(k == 1, F.concat(F.lit("<?xml version='1.0'?><doc>"), text, F.lit("</doc>")))
        .otherwise(text)
    )
    return table(spark, sf_dir, "documents").select("doc_id", body.alias("body"))


@F.arrow_udf(BinaryType())
def _zip_lines(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    def pack(names: list[str], parts: list[str]) -> bytes:
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
            for name, part in zip(names, parts):
                archive.writestr(zipfile.ZipInfo(name), part.encode())
        return out.getvalue()

    for names, parts in batches:
        yield pa.array([pack(n, p) for n, p in zip(names.to_pylist(), parts.to_pylist())], pa.binary())


class _KoreanEntry(zipfile.ZipInfo):
    """An entry whose name is stored in cp949 without the UTF-8 flag, as old packers do."""

    def _encodeFilenameFlags(self) -> tuple[bytes, int]:
        return self.filename.encode("cp949"), self.flag_bits & ~(1 << 11)


@F.arrow_udf(BinaryType())
def _zip_one(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    def pack(name: str, text: str, flagged: bool) -> bytes:
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as archive:
            archive.writestr((zipfile.ZipInfo if flagged else _KoreanEntry)(name), text.encode())
        return out.getvalue()

    for batch in batches:
        rows = zip(*(column.to_pylist() for column in batch), strict=True)
        yield pa.array([pack(*row) for row in rows], pa.binary())


def korean_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as an archive of one member with a Korean name, by id with and without the UTF-8 flag."""
    name = F.concat(F.lit("공시/ 사업보고서_"), F.col("doc_id"), F.lit(".txt"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", _zip_one(name, F.col("text"), F.col("doc_id") % 2 == 0).alias("content")
    )


def archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as an archive with one member per line of text.

    Lines are plain, or html and xml by line number, depending on the id.
    """
    k = F.col("doc_id") % 3

    def member(line: Column, j: Column) -> Column:
        html = F.concat(F.lit("<html><body>"), line, F.lit("</body></html>"))
        xml = F.concat(F.lit("<doc><p>"), line, F.lit("</p></doc>"))
        return F.when((k == 2) & (j % 4 == 0), html).when((k >= 1) & (j % 4 == 1), xml).otherwise(line)

    lines = F.split("text", "\n")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        _zip_lines(
            F.transform(lines, lambda line, j: F.concat(F.lit("part_"), j)),
            F.transform(lines, member),
        ).alias("content"),
    )


def payloads(spark: SparkSession, sf_dir: str, day: str = DAY) -> DataFrame:
    """A download for every document; every eighth is an error answer.

    The filing is the one whose key is the document's id, if there is one.
    """
    ids = if_small(written(filings(spark, sf_dir, day).select("k", "rcept_no"), "payload-ids"))
    zipped = archives(spark, sf_dir)
    answer = F.concat(
        F.lit("<?xml version='1.0'?><result><status>"),
        F.when(F.col("doc_id") % 16 == 0, "010").otherwise("013"),
        F.lit("</status><message>none</message></result>"),
    )
    content = F.when(F.col("doc_id") % 8 == 0, answer.cast("binary")).otherwise(F.col("content"))
    rcept_no = F.coalesce("rcept_no", F.concat(F.lit("00000000"), _padded(F.col("doc_id"), 6)))
    return zipped.join(ids, zipped["doc_id"] == ids["k"], "left").select(rcept_no.alias("rcept_no"), content.alias("content"))


def messages(spark: SparkSession, sf_dir: str, day: str = DAY) -> DataFrame:
    """Published messages for all filings."""
    k = F.col("k")
    kind = k % 3
    documents = filings(spark, sf_dir, day).select(
        "*",
        F.when(kind == 0, "text/html; charset=UTF-8").when(kind == 1, "application/xml; charset=UTF-8")
        .otherwise("application/octet-stream").alias("content_type"),
        F.concat(F.col("rcept_no"), F.when(kind == 0, ".html").when(kind == 1, ".xml").otherwise("")).alias("filename"),
        (k * 37 % 5000 + 200).alias("file_size"),
    )
    for name in ("stock_code", "flr_nm", "rm"):
        documents = documents.withColumn(name, F.nullif(F.col(name), F.lit("")))
    return publish.messages(documents, F.lit("20020101"))


def untidy_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages with white space to strip and dates in every accepted and refused form."""
    key = F.col("file_size") % 7
    day = F.col("rcept_dt")
    dashed = F.concat(F.left(day, F.lit(4)), F.lit("-"), F.substring(day, 5, 2), F.lit("-"), F.substring(day, 7, 2))
    odd = (
        F.when(key == 0, dashed).when(key == 1, F.concat(F.left(day, F.lit(4)), F.lit("1332")))
        .when(key == 2, "  ").when(key == 3, "29 Dec").when(key == 4, F.concat(F.lit(" "), day, F.lit("\t"))).otherwise(day)
    )
    return messages(spark, sf_dir).select(
        "rcept_no",
        F.concat(F.lit("\t "), F.col("corp_name"), F.lit("\u3000")).alias("corp_name"),
        F.when(F.col("stock_code").isNull(), " ").otherwise(F.col("stock_code")).alias("stock_code"),
        odd.alias("rcept_dt"),
        "corp_code", "corp_cls", "report_nm", "flr_nm", "rm", "object_key", "content_type", "file_size",
    )


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upsert responses: one per event, numbered attempts 1 to 4."""
    kind = F.col("event_type")
    code = (
        F.when(kind == "purchase", 200).when(kind == "signup", 201).when(kind == "error", 500).when(kind == "view", 404)
    )
    return table(spark, sf_dir, "events").select(
        "event_id", code.alias("code"), (F.col("event_id") % 4 + 1).cast("int").alias("attempt_no"),
        F.repeat(F.col("props"), F.lit(30)).alias("response"),
    )
