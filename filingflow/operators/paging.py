"""Which pages of a day count.

A day's pages are read in order until the first page that is absent, has a
status other than 000, or is empty (after page 1), and never past the number of
pages that page 1 declares.  All of that is decided by aggregates on
``(date, page_no)`` and then ``date``, both combined before the shuffle, so a
day with a third of all pages needs no large task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..schema import status_dimension
from ..session import written


def page_actions(pages: DataFrame, poll_interval: int = 300) -> DataFrame:
    """Add meaning, action and wait of each page's status; unknown codes are errors."""
    dim = status_dimension(pages.sparkSession, poll_interval).select("code", "meaning", "page_action", "wait_s")
    return (
        pages.join(F.broadcast(dim), pages["status"] == dim["code"], "left")
        .drop("code")
        .fillna({"meaning": "unknown", "page_action": "error", "wait_s": 0})
    )



def day_limits(pages: DataFrame) -> DataFrame:
    """Per date: ``last_page``, the last page that counts, 0 when none does.

    ``rejected`` marks a date whose page 1 declares totals that are no numbers;
    no page of such a date counts.
    """
    pages = pages.select("date", "page_no", "status", "n_items", "total_page_text", "total_count_text")
    declared_pages = F.coalesce(F.col("total_page_text"), F.lit("1")).try_cast("bigint")
    declared_count = F.coalesce(F.col("total_count_text"), F.lit("0")).try_cast("bigint")
    first_ok = (F.col("page_no") == 1) & (F.col("status") == "000")
    here = F.col("back") == 0
    stops = (F.col("status") != "000") | ((F.col("n_items") == 0) & (F.col("page_no") > 1))
    # every page also vouches that the page before it has a successor
    said = pages.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("back")).select(
        "date",
        (F.col("page_no") - F.col("back")).alias("page_no"),
        here.cast("int").alias("present"),
        F.col("back").alias("followed"),
        (here & stops).cast("int").alias("stops"),
        F.when(here & first_ok, F.greatest(declared_pages, F.lit(1))).alias("declared_pages"),
        F.when(here & first_ok, declared_count).alias("declared_count"),
        F.when(here & first_ok, (declared_pages.isNull() | declared_count.isNull()).cast("int")).alias("rejected"),
    )
    per_page = (
        said.groupBy("date", "page_no")
        .agg(
            *[F.max(c).alias(c) for c in ("present", "followed", "stops", "declared_pages", "declared_count", "rejected")]
        )
        .where((F.col("present") == 1) & (F.col("page_no") >= 1))
    )
    per_day = per_page.groupBy("date").agg(
        F.max("declared_pages").alias("declared_pages"),
        F.max("declared_count").alias("declared_count"),
        F.coalesce(F.max("rejected"), F.lit(0)).alias("rejected"),
        F.min("page_no").alias("first_page"),
        F.min(F.when(F.col("followed") == 0, F.col("page_no"))).alias("run_end"),
        F.min(F.when(F.col("stops") == 1, F.col("page_no"))).alias("first_stop"),
    )
    counted = F.least(F.col("run_end"), F.col("first_stop") - 1, F.col("declared_pages"))
    return per_day.select(
        "date",
        (F.col("rejected") == 1).alias("rejected"),
        F.when((F.col("rejected") == 1) | (F.col("first_page") != 1), F.lit(0))
        .otherwise(F.greatest(counted, F.lit(0)))
        .cast("int")
        .alias("last_page"),
        "declared_pages",
        "declared_count",
    )


def counted_pages(pages: DataFrame, limits: DataFrame | None = None) -> DataFrame:
    """The pages that count, whole.

    ``pages`` should be a table that is stored, as it is read twice.  The limits, one small row per date, are written to the shared folder.  Their
    size is known then: they are broadcast if small, so that no page is
    shuffled, and otherwise AQE splits a day with most of the pages.
    """
    limits = written(day_limits(pages), "page-limits") if limits is None else limits
    return (
        pages.join(limits.select("date", "last_page"), "date")
        .where((F.col("page_no") >= 1) & (F.col("page_no") <= F.col("last_page")))
        .drop("last_page")
    )
