"""Filing-list pages: one JSON envelope per landed file.

Layout: ``<root>/date=YYYYMMDD/page_no=N/<file>.json``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..schema import PAGE_SCHEMA


def read_pages(spark: SparkSession, root: str, stream: bool = False, **options) -> DataFrame:
    """Landed pages as ``date, page_no, page`` with the envelope as VARIANT.

    A file that is no JSON has a NULL ``page``.  ``options`` go to the reader,
    for instance ``maxFilesPerTrigger`` for a stream.
    """
    reader = spark.readStream if stream else spark.read
    files = reader.format("text").schema(PAGE_SCHEMA).options(wholetext=True, **options).load(root)
    return files.select("date", "page_no", F.try_parse_json("value").alias("page"))


def page_fields(pages: DataFrame) -> DataFrame:
    """Split the envelope: status, message, declared totals as text, items."""
    def get(path: str, kind: str) -> Column:
        return F.try_variant_get("page", path, kind)

    def stated(path: str) -> Column:
        # an absent total has a default, a JSON null is no number
        return F.coalesce(get(path, "string"), F.when(F.is_variant_null(get(path, "variant")), "null"))

    return pages.select(
        "*",
        F.coalesce(get("$.status", "string"), F.lit("")).alias("status"),
        F.coalesce(get("$.message", "string"), F.lit("Unknown error")).alias("message"),
        stated("$.total_page").alias("total_page_text"),
        stated("$.total_count").alias("total_count_text"),
        get("$.list", "array<variant>").alias("items"),
    ).withColumn("n_items", F.coalesce(F.size("items"), F.lit(0)))


def page_items(pages: DataFrame) -> DataFrame:
    """One row per listed item of ``page_fields`` rows, with its place on the page."""
    return pages.select("date", "page_no", F.posexplode("items").alias("pos", "item"))


def scan_predicate(
    date: str | None = None,
    corp_code: str | None = None,
    corp_cls: str | None = None,
    report_type: str | None = None,
    date_column: str = "date",
) -> Column:
    """Conjunction of the given list conditions; an empty or missing one is no condition."""
    given = {
        date_column: date,
        "corp_code": corp_code,
        "corp_cls": corp_cls,
        "report_type": report_type,
    }
    terms = [F.col(name) == F.lit(value) for name, value in given.items() if value]
    return reduce(lambda a, b: a & b, terms, F.lit(True))


def valid_poll_date(col: Column) -> Column:
    return col.rlike(r"\A[0-9]{8}\z")


def poll_date_today(zone: str = "Asia/Seoul") -> Column:
    """Today's date in the service's zone, as ``YYYYMMDD``."""
    return F.date_format(F.convert_timezone(None, F.lit(zone), F.localtimestamp()), "yyyyMMdd")
