"""What a Python worker holds at a time."""

import tracemalloc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from filingflow.llm import phrases
from filingflow.sources import archive

from zips import make_zip


def test_archives_reach_python_in_small_batches(spark):
    @F.arrow_udf("long")
    def size(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([batch.nbytes] * len(batch), pa.int64())

    rows = spark.range(0, 400, 1, 1).select(F.repeat(F.lit("x"), F.lit(20_000)).cast("binary").alias("content"))
    most = rows.select(size("content").alias("size")).agg(F.max("size"), F.count("size")).first()
    assert most[0] <= 1.25 * (1 << 20) and most[1] == 400


def test_best_members_leave_python_in_small_batches():
    rows = [archive.scan_archive(make_zip([(f"m{i}", b"x" * 50_000)]), 10, 1 << 20) for i in range(200)]
    batches = list(archive._in_small_batches(iter([*rows, None])))
    assert max(batch.nbytes for batch in batches) <= 2.25 * (1 << 20)
    assert [r for batch in batches for r in batch.to_pylist()] == [*rows, None]


def test_occurrences_are_tested_in_blocks():
    rng = np.random.default_rng(0)
    places, ids = rng.integers(-1, 5_000, 1_400_000).astype(np.int32), rng.permutation(5_000).astype(np.int64)
    held = rng.integers(0, 1 << 62, 1 << 12).astype(np.uint64)
    row = dict(chunk=1, lang="x", places=phrases.squeeze(places), ids=phrases.squeeze(ids))
    kept = phrases._kept(3, held)
    tracemalloc.start()
    found = [r for batch in kept(iter([pa.RecordBatch.from_pylist([row])])) for r in batch.to_pylist()]
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    at = phrases._starts(places, 3)
    passing = set(phrases._passing(at, places, ids, 3, held).tolist())
    left = phrases.unsqueeze(found[0]["places"], "<i4")
    assert most < 64 << 20 and 0 < len(passing) < len(at)
    assert len(phrases._starts(left, 3)) == len(passing)
