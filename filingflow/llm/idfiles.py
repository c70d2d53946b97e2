"""Token ids in binary files, in ascending order of documents.

Texts are dealt out by ranges of ``doc_id`` and sorted, encoded in that order, some
megabytes at a time, and written as segments of about ``SEGMENT`` ids.  A segment holds Simple-8b words, the
first word of each block, the document ids and their lengths, and its place: the range
and the number of ids before it in the range.  What lies before a range is the sum of
the ranges before it, a row per range; so no task counts all documents.

Defined cases: a null text is empty and has the end id alone; null ids come first;
rows with the same id are next to each other in any order; an empty table gives empty
files; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from ..session import fresh_dir
from . import simple8b
from .chunks import parts_for
from .tokens import encoder, large_batches, public_path

END = 2
#: Ids after which a segment is closed.
SEGMENT = 1 << 20
#: Bytes of input files per range.
RANGE_BYTES = 16 << 20

SEGMENT_SCHEMA = (
    "part int, before long, n_ids long, words binary, blocks binary, doc_ids binary, null_ids binary, lengths binary"
)


def _segments(path: str, end: int, segment: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_all = encoder(path).encode_all
        before = 0
        for docs in large_batches(batches, 2):
            lengths, ids = encode_all(docs.column(2))
            ends = np.cumsum(lengths + 1)
            values = np.insert(ids, np.cumsum(lengths), end)
            part, doc_ids = docs.column(0)[0].as_py(), docs.column(1)
            first = start = 0
            while first < docs.num_rows:
                last = min(int(np.searchsorted(ends, start + segment)) + 1, docs.num_rows)
                own, stop = doc_ids.slice(first, last - first), int(ends[last - 1])
                words, blocks = simple8b.encode(values[start:stop])
                row = {
                    "part": part, "before": before, "n_ids": stop - start,
                    "words": words.tobytes(), "blocks": blocks.tobytes(),
                    "doc_ids": own.fill_null(0).to_numpy().astype("<i8").tobytes(),
                    "null_ids": np.packbits(own.is_null().to_numpy(zero_copy_only=False)).tobytes(),
                    "lengths": (lengths[first:last] + 1).astype("<u4").tobytes(),
                }
                types = [pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 5]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v], t) for v, t in zip(row.values(), types, strict=True)], list(row)
                )
                before, first, start = before + stop - start, last, stop

    return run


def write_ids(docs: DataFrame, folder: str, path: str | None = None, end: int = END, ranges: int | None = None) -> None:
    """Encode the texts and write them to ``folder`` in ascending order of ``doc_id``."""
    rows = docs.select("doc_id", "text")
    if ranges is None:
        ranges = parts_for(rows, RANGE_BYTES)
    sorted_rows = rows.repartitionByRange(ranges, "doc_id").sortWithinPartitions("doc_id")
    located = sorted_rows.select(F.spark_partition_id().alias("part"), "doc_id", "text")
    located.mapInArrow(_segments(path or public_path("byte_bpe_50k.json"), end, SEGMENT), SEGMENT_SCHEMA).write.mode(
        "errorifexists"
    ).option("compression", "zstd").parquet(folder)


def segment_ids(row: dict) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Document ids, lengths and the token ids of a segment."""
    doc_ids = np.frombuffer(row["doc_ids"], "<i8")
    null = np.unpackbits(np.frombuffer(row["null_ids"], np.uint8))[: len(doc_ids)]
    ids = simple8b.decode(
        np.frombuffer(row["words"], "<u8"), np.frombuffer(row["blocks"], "<u4"), row["n_ids"]
    )
    named = [None if empty else int(d) for d, empty in zip(doc_ids, null, strict=True)]
    return named, np.frombuffer(row["lengths"], "<u4").astype(np.int64), ids.astype("<u4")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            doc_ids, lengths, ids = segment_ids(row)
            starts = np.cumsum(lengths) - lengths
            crcs = [zlib.crc32(ids[a : a + n].tobytes()) for a, n in zip(starts, lengths, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row["part"]] * len(doc_ids), pa.int32()),
                    pa.array(doc_ids, pa.int64()),
                    pa.array(starts + row["before"], pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array(crcs, pa.int64()),
                ],
                ["part", "doc_id", "within", "n_tokens", "ids_crc32"],
            )


def read_segments(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(SEGMENT_SCHEMA).parquet(folder)


def read_digests(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files."""
    segments = read_segments(spark, folder)
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # a row per range
    bases = segments.groupBy("part").agg(F.sum("n_ids").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")
    )
    docs = segments.mapInArrow(_digests, "part int, doc_id long, within long, n_tokens long, ids_crc32 long")
    joined = docs.join(bases, "part")
    return joined.select("doc_id", (F.col("base") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, path: str | None = None, end: int = END) -> DataFrame:
    """Write the ids to a new folder and read their digests back."""
    folder = fresh_dir(docs.sparkSession, "token-ids") + "/segments"
    write_ids(docs, folder, path, end)
    return read_digests(docs.sparkSession, folder)
