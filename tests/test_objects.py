"""Objects as files: once each, whatever happens to the tasks that write them."""

import os

import pyarrow as pa
import pytest

from filingflow.operators.sinks import export_objects
from filingflow.sources.objects import ObjectWriter, write_objects


def files_below(root):
    return sorted(os.path.relpath(os.path.join(at, n), root) for at, _, names in os.walk(root) for n in names)


def batch(*rows):
    return pa.RecordBatch.from_arrays(
        [pa.array([k for k, _ in rows], pa.string()), pa.array([b for _, b in rows], pa.binary())], ["object_key", "body"]
    )


def test_a_row_is_a_file(spark, folder):
    rows = [("20240102", "a.html", b"one"), ("20240102", "b.xml", b""), ("20240103", "a.html", None)]
    docs = spark.createDataFrame([(*r, "SUCCESS", "x") for r in rows] + [("20240103", "c.html", b"no", "FAILED", "x")],
                                 "rcept_dt string, filename string, body binary, outcome string, object_key string")
    for _ in range(2):
        export_objects(docs.repartition(3), folder)
    assert files_below(folder) == ["20240102/a.html", "20240102/b.xml", "20240103/a.html"]
    # Spark's file sources pass over empty files
    read = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).collect()
    assert [(os.path.relpath(r["path"].removeprefix("file:"), folder), bytes(r["content"])) for r in read] == [("20240102/a.html", b"one")]
    assert [os.path.getsize(f"{folder}/{name}") for name in files_below(folder)] == [3, 0, 0]
    write_objects(docs.limit(0), folder)
    assert len(files_below(folder)) == 3


@pytest.mark.parametrize("key", [None, "", "../up", "a//b", "a/../b", "/root", "_staging/x"])
def test_keys_stay_below_the_root(spark, folder, key):
    with pytest.raises(Exception, match="no key of an object"):
        write_objects(spark.createDataFrame([("a/b", b"1"), (key, b"2")], "object_key string, body binary").coalesce(1), folder)
    assert files_below(folder) == []


def test_a_task_that_fails_leaves_nothing_and_its_retry_all(folder):
    writer = ObjectWriter(folder, ["object_key", "body"])

    def fails():
        yield batch(("d/1", b"half"), ("d/2", b"half"))
        raise OSError("executor lost")

    with pytest.raises(OSError):
        writer.write(fails())
    assert all(name.startswith("_staging/") for name in files_below(folder))  # readers see none of it
    # the retry and a second attempt beside it
    done = [writer.write(iter([batch(("d/1", b"whole")), batch(("d/2", b"whole"))])) for _ in range(2)]
    assert [message.objects for message in done] == [2, 2]
    writer.commit(done)
    assert files_below(folder) == ["d/1", "d/2"] and open(f"{folder}/d/1", "rb").read() == b"whole"
    # aborted: what its finished tasks placed stays whole
    other = ObjectWriter(folder, ["object_key", "body"])
    other.write(iter([batch(("d/3", b"whole"))]))
    other.abort([None])
    other.abort([None])
    assert files_below(folder) == ["d/1", "d/2", "d/3"]


def test_objects_of_one_split_are_dealt_to_tasks(spark, monkeypatch):
    from filingflow.sources import objects

    monkeypatch.setattr(objects, "TASK_OBJECTS", 50)
    rows = spark.range(1000).coalesce(1).selectExpr("CAST(id AS STRING) AS object_key", "CAST('x' AS BINARY) AS body")
    sizes = objects.dealt(rows).rdd.glom().map(len).collect()
    assert len(sizes) == 20 and sum(sizes) == 1000 and max(sizes) < 100
    assert objects.dealt(rows.limit(50)).rdd.getNumPartitions() == 1


def test_small_files_share_tasks(spark, folder):
    rows = spark.range(300).coalesce(1).selectExpr("concat('a/', id) AS object_key", "CAST('x' AS BINARY) AS body")
    write_objects(rows, folder)
    read = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    assert read.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism + 1
