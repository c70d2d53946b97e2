"""Keep the filings that have not been dealt with yet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def first_per_key(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row per key in the given order, which should be total.

    Spark keeps at most one row per key and input partition before the shuffle
    (window group limit), so repeated keys do not pile up in one task.
    """
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_rank", F.row_number().over(ranked)).where("_rank = 1").drop("_rank")


def latest_per_key(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Last row per key by the given columns."""
    return first_per_key(rows, keys, [F.col(c).desc() for c in order])


def listed_once(filings: DataFrame) -> DataFrame:
    """First listing of every id, with ``n_listed``, how often it was listed.

    One aggregate that is combined before its shuffle, so an id listed very
    often arrives as one row per input partition.
    """
    place = ["date", "page_no", "pos"]
    rest = [c for c in filings.columns if c != "rcept_no"]
    first = filings.groupBy("rcept_no").agg(
        F.min_by(F.struct(*rest), F.struct(*place)).alias("_first"), F.count("*").alias("n_listed")
    )
    return first.select("rcept_no", "_first.*", "n_listed")


def known_ids(processed: DataFrame, failed_for_good: DataFrame) -> DataFrame:
    """Ids that are done: processed or permanently failed."""
    return processed.select("rcept_no").union(failed_for_good.select("rcept_no")).distinct()


def without(rows: DataFrame, others: DataFrame, keys: list[str]) -> DataFrame:
    return rows.join(others.select(*keys), keys, "left_anti")


def mark_stored(filings: DataFrame, stored: DataFrame) -> DataFrame:
    """Add ``is_stored``: a document of this date and id is in the store.

    Ids have a fixed width, so the service's prefix test is an equality here.
    The distinct keys are partitioned as the join needs them.
    """
    keys = ["rcept_dt", "rcept_no"]
    known = stored.select(*keys).distinct().withColumn("is_stored", F.lit(True))
    return filings.join(known, keys, "left").fillna({"is_stored": False})


def new_filings(filings: DataFrame, known: DataFrame, stored: DataFrame) -> DataFrame:
    """Filings neither dealt with nor stored."""
    return without(without(filings, known, ["rcept_no"]), stored, ["rcept_dt", "rcept_no"])
