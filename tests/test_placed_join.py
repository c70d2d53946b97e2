"""Joins of payloads with lists of any length."""

import re

import pytest
from pyspark.sql import functions as F

from filingflow.operators.normalise import normalise
from filingflow.operators.placed_join import bloom_filter, likely, placed_join
from filingflow.plans.ingest import process_filings
from filingflow.schema import FILING_FIELDS
from filingflow.session import written


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_the_filter_loses_no_key_and_lets_few_others_through(spark):
    keys = spark.range(0, 50_000).select(F.col("id").cast("string").alias("k"))
    rows = spark.range(0, 200_000).select(F.col("id").cast("string").alias("k"))
    kept = likely(rows, keys, "k", 50_000)
    assert kept.join(keys, "k", "left_semi").count() == 50_000
    assert kept.count() < 50_000 + 0.05 * 150_000
    held, words = bloom_filter(keys, "k", 50_000)
    assert held.count() <= words


def test_slices_join_like_a_join(spark):
    table = written(spark.range(0, 3000, 3).select(F.col("id").cast("string").alias("k"), (F.col("id") * 2).alias("v")), "table")
    rows = spark.range(0, 5000).select((F.col("id") % 2500).cast("string").alias("k"), F.col("id").alias("content"))
    rows = rows.unionByName(spark.createDataFrame([(None, 1)], "k string, content long"))
    want = sorted(rows.join(table, "k").collect())
    assert sorted(placed_join(rows, table, "k", 100).select("k", "content", "v").collect()) == want
    assert sorted(placed_join(rows, table, "k").select("k", "content", "v").collect()) == want
    assert placed_join(rows, written(table.limit(0), "none"), "k", 100).count() == 0


def test_three_hundred_thousand_filings_move_no_payload(spark, no_broadcast):
    filled = {c: F.lit("x") for c in FILING_FIELDS} | {"rcept_no": F.format_string("20240101%06d", F.col("id"))}
    filings = spark.range(0, 300_000, 1, 8).select(
        *[filled[c].alias(c) for c in FILING_FIELDS], F.lit("20240101").alias("polling_date"), F.lit(1).cast("long").alias("n_listed")
    )
    none = filings.limit(0)
    payloads = written(
        spark.range(299_000, 301_000, 1, 4).select(
            F.format_string("20240101%06d", F.col("id")).alias("rcept_no"), F.lit("<a/>").cast("binary").alias("content")
        ),
        "payloads",
    )
    done = process_filings(filings, none.select("rcept_no"), none.select("rcept_dt", "rcept_no"), payloads)
    for node in re.findall(r"Exchange (?:hash|range|Round)[^\n]*\n[^\n]*", plan_of(done)):
        assert "content" not in node and "body" not in node, node
    got = {(r["stage"], r["count"]) for r in done.groupBy("stage").count().collect()}
    assert sum(n for _, n in got) == 300_000 and done.where("reason like '%DART%' OR stage = 'download'").count() == 300_000
