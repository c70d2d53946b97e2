"""Versions of a table: readers, replays and crashes around a compaction."""

import glob

import pytest
from pyspark.sql import functions as F

from filingflow.operators.upsert import compact_upserts, current, write_batch
from filingflow.sources import store

SCHEMA = "rcept_no string, value bigint"
STORED = SCHEMA + ", date_key string, batch_id string"
DATES = ["20240101", "20240102"]


def batch_of(spark, batch_id):
    ids = spark.range(20).select(
        F.format_string("2024010%d%06d", F.col("id") % 2 + 1, F.col("id") % (10 + batch_id)).alias("rcept_no"), F.lit(batch_id * 100).cast("long").alias("value")
    )
    return ids.distinct()


def write(spark, root, batch_id):
    write_batch(batch_of(spark, batch_id), root, batch_id, ["value"], DATES)


def rows(df):
    return sorted(tuple(r) for r in df.select("rcept_no", "value").collect())


def folders(root):
    return sorted(f.removeprefix(root) for f in glob.glob(f"{root}/date_key=*/batch_id=*"))


def test_the_present_state_survives_compactions(spark, folder):
    for batch_id in range(7):
        write(spark, folder, batch_id)
        before = rows(current(spark, folder, SCHEMA))
        compact_upserts(spark, folder, SCHEMA, DATES, batch_id - 1, 2)
        assert rows(current(spark, folder, SCHEMA)) == before == rows(current(spark, folder, SCHEMA, DATES))
    assert store.versions_of(spark, folder, DATES[0]) == [3, 5]
    assert {f.rpartition("=")[2] for f in folders(folder)} == {"4", "5", "6"}  # older ones are gone
    assert len(glob.glob(f"{folder}/_base/date_key=20240101/version=*")) == 2


def test_a_reader_keeps_its_version_while_the_table_is_compacted(spark, folder):
    for batch_id in range(3):
        write(spark, folder, batch_id)
    pinned = store.snapshot(spark, folder, DATES)
    opened = store.read_dates(spark, folder, DATES, STORED)
    want = rows(opened)
    write(spark, folder, 3)
    assert store.compact_dates(spark, folder, DATES, STORED, 3, 2) == DATES
    assert rows(opened) == want == rows(pinned.read(spark, STORED))
    assert rows(store.read_dates(spark, folder, DATES, STORED)) == sorted(want + rows(batch_of(spark, 3)))


@pytest.mark.parametrize("crash", ["write", "swap", "vacuum"])
def test_a_crash_in_a_compaction_changes_nothing(spark, folder, monkeypatch, crash):
    for batch_id in range(4):
        write(spark, folder, batch_id)
    want, kept = rows(current(spark, folder, SCHEMA)), folders(folder)

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(store, {"write": "write_base", "swap": "swap", "vacuum": "vacuum"}[crash], dies)
        with pytest.raises(RuntimeError):
            compact_upserts(spark, folder, SCHEMA, DATES, 2, 2)
    assert rows(current(spark, folder, SCHEMA)) == want and folders(folder) == kept
    write(spark, folder, 3)  # the batch runs again
    assert rows(current(spark, folder, SCHEMA)) == want
    compact_upserts(spark, folder, SCHEMA, DATES, 2, 2)
    assert rows(current(spark, folder, SCHEMA)) == want
    assert store.versions_of(spark, folder, DATES[0]) == [2]


def test_a_replay_may_drop_a_date_after_a_compaction(spark, folder):
    for batch_id in range(4):
        write(spark, folder, batch_id)
    compact_upserts(spark, folder, SCHEMA, DATES, 2, 2)
    write_batch(batch_of(spark, 3).where("rcept_no < '20240102'"), folder, 3, ["value"], DATES)
    second = store.read_dates(spark, folder, DATES[1:], STORED)
    assert second.where("batch_id = '3'").isEmpty() and not second.isEmpty()


def test_dates_without_rows_or_folders(spark, folder):
    assert store.compact_dates(spark, folder, DATES, STORED, 5, 1) == []
    assert store.read_dates(spark, folder, DATES, STORED).isEmpty()
    write(spark, folder, 0)
    assert store.compact_dates(spark, folder, ["20240109", *DATES], STORED, 0, 1) == DATES
    assert rows(store.read_table(spark, folder, STORED)) == rows(batch_of(spark, 0))
