"""Intermediate folders, tables and shuffle files."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from filingflow import session


def _folders(spark) -> set[str]:
    root = session.shared_dir(spark).removeprefix("file:")
    return set(os.listdir(root)) if os.path.isdir(root) else set()


def test_settled_leaves_one_folder(spark):
    before = _folders(spark)

    def make():
        half = session.written(spark.range(100).filter("id % 2 = 0"), "half")
        nested = session.settled(spark, "nested", lambda: session.written(half.filter("id % 4 = 0"), "quarter"))
        return half.join(nested, "id")

    rows = session.settled(spark, "kept", make)
    assert rows.count() == 25
    assert [name.split("-")[0] for name in _folders(spark) - before] == ["kept"]


def test_scratch_drops_tables_and_survives_an_error(spark):
    before = _folders(spark)
    with pytest.raises(ZeroDivisionError), session.scratch(spark):
        folder = session.fresh_dir(spark, "named")
        session.discard_later(spark, folder, "scratch_named")
        spark.range(3).write.option("path", f"{folder}/table").saveAsTable("scratch_named")
        1 / 0
    assert not spark.catalog.tableExists("scratch_named")
    assert _folders(spark) == before


def test_a_plan_runs_again_after_its_shuffle_files_went(spark):
    session.configure(spark)
    sums = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.sum("id").alias("s"))
    assert sorted(sums.collect()) == sorted(sums.collect())
    assert sums.join(sums.withColumnRenamed("s", "t"), "k").filter("s = t").count() == 7
