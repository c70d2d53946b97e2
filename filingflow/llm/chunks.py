"""Chunks of documents, and an exchange of keys between them.

A chunk holds some megabytes of neighbouring documents with all their columns, packed
as one Arrow stream.  Chunks are written once to a table bucketed by chunk, so that
later joins on the chunk do not move texts again.

Operators that must know what other documents hold of the same keys (word windows,
words) do not ship a row per key.  Each chunk offers its distinct keys, sorted and
compressed, to a bucket by the keys' leading bits; the bucket answers with one small
array per chunk, in the order of the offer.  A key a third of all documents have is
offered once per chunk.  The number of buckets follows the size of the input, so a
bucket's memory stays the same.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import zstandard
from pyspark.sql import DataFrame, functions as F

from ..session import discard_later, fresh_dir

#: Bytes of text after which a chunk is closed; a longer document is a chunk of its own.
CHUNK_BYTES = 2 << 20
#: Bytes of text whose keys one bucket takes, about.
BUCKET_BYTES = 8 << 20
#: Bytes of packed chunks per bucket of the chunk table.
TABLE_BYTES = 8 << 20


def squeeze(values: np.ndarray) -> bytes:
    """Numbers, byte plane by byte plane, compressed."""
    width = values.dtype.itemsize
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, width).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unsqueeze(data: bytes, dtype: str) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(dtype)


def squeeze_sorted(keys: np.ndarray) -> bytes:
    return squeeze(np.diff(keys, prepend=np.uint64(0)))


def unsqueeze_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unsqueeze(data, "<u8"), dtype=np.uint64)


def pack(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpack(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


#: An estimate above this means that Spark does not know.
UNKNOWN_BYTES = 1 << 60


def parts_for(docs: DataFrame, part_bytes: int) -> int:
    """Partitions of about ``part_bytes`` by Spark's estimate of the table's size."""
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size > UNKNOWN_BYTES:
        return docs.sparkSession.sparkContext.defaultParallelism
    return max(1, -(-size // part_bytes))


class Chunks:
    """The chunk table of ``docs``; ``columns`` are those of the packed documents."""

    def __init__(self, docs: DataFrame, text: str = "text") -> None:
        self.spark = docs.sparkSession
        self.columns = docs.columns
        self.schema = docs.schema
        part = "chunk_part"
        while part in self.columns:
            part = "_" + part
        at = self.columns.index(text)

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[pa.RecordBatch] = []
            held_bytes = made = origin = 0

            def close() -> pa.RecordBatch:
                nonlocal made, held_bytes
                whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held.clear()
                row = [(origin << 24) | made], [whole.num_rows], [held_bytes], [pack(whole)]
                made, held_bytes = made + 1, 0
                types = pa.int64(), pa.int64(), pa.int64(), pa.binary()
                return pa.RecordBatch.from_arrays(
                    [pa.array(v, t) for v, t in zip(row, types, strict=True)], ["chunk", "n_docs", "n_bytes", "packed"]
                )

            for batch in batches:
                if not batch.num_rows:
                    continue
                origin = batch.column(batch.num_columns - 1)[0].as_py()
                batch = batch.select(range(batch.num_columns - 1))
                lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(at)), 0)
                ends = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
                first = 0
                while first < batch.num_rows:
                    before = ends[first - 1] if first else 0
                    last = int(np.searchsorted(ends, before + CHUNK_BYTES - held_bytes, "right"))
                    last = min(max(last, first + 1), batch.num_rows)
                    held.append(batch.slice(first, last - first))
                    held_bytes += int(ends[last - 1] - before)
                    first = last
                    if first < batch.num_rows or held_bytes >= CHUNK_BYTES:
                        yield close()
            if held:
                yield close()

        rows = docs.withColumn(part, F.spark_partition_id().cast("long")).mapInArrow(
            cut, "chunk long, n_docs long, n_bytes long, packed binary"
        )
        self.n_buckets = parts_for(docs, TABLE_BYTES)
        self.name = f"chunks_{uuid.uuid4().hex}"
        folder = fresh_dir(self.spark, "chunks")
        discard_later(self.spark, folder, self.name)
        rows.repartition(self.n_buckets, "chunk").write.bucketBy(self.n_buckets, "chunk").option("path", f"{folder}/table").saveAsTable(self.name)
        self.table = self.spark.table(self.name)
        total = self.table.agg(F.sum("n_bytes")).first()[0] or 0
        #: Leading bits of a key that name its bucket.
        self.bits = max(0, (max(1, total // BUCKET_BYTES) - 1).bit_length())

    def offers(self, make: Callable[..., dict[str, np.ndarray]], answers: DataFrame | None = None) -> DataFrame:
        """(bucket, chunk, keys, values): each chunk's offer, cut by bucket.

        ``make(documents, answers)`` returns sorted distinct 64-bit ``keys`` and, as
        ``values``, an integer for each.
        """
        bits = self.bits
        rows = self.table if answers is None else self.joined(answers)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    made = make(unpack(row["packed"]), row)
                    keys, values = made["keys"], made["values"]
                    if not len(keys):
                        continue
                    bucket = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
                    found, first = np.unique(bucket, return_index=True)
                    last = np.append(first[1:], len(keys))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(found, pa.int32()),
                            pa.array([row["chunk"]] * len(found), pa.int64()),
                            pa.array([squeeze_sorted(keys[a:b]) for a, b in zip(first, last, strict=True)], pa.binary()),
                            pa.array([squeeze(values[a:b]) for a, b in zip(first, last, strict=True)], pa.binary()),
                        ],
                        ["bucket", "chunk", "keys", "values"],
                    )

        return rows.mapInArrow(run, "bucket int, chunk long, keys binary, values binary")

    def answers(
        self, offers: DataFrame, dtype: str, answer: Callable[[np.ndarray, np.ndarray, int], np.ndarray], name: str,
        totals: Callable[[np.ndarray, np.ndarray, int], tuple[int, int]] | None = None,
    ) -> DataFrame:
        """(chunk, name): what the buckets answer, an array of (bucket, bytes) per chunk.

        ``answer(group, values, n)`` gets for all offers of a bucket the number of each
        key among the bucket's ``n`` distinct keys and the values, and returns one
        number per offer.  No more than a bucket is in memory at a time.  With ``totals``,
        two numbers per bucket, a row of chunk -1 has their sums in ``total`` and ``second_total``.
        """

        def run(table: pa.Table) -> pa.Table:
            keys = [unsqueeze_sorted(k) for k in table.column("keys").to_pylist()]
            values = [unsqueeze(v, dtype) for v in table.column("values").to_pylist()]
            sizes = np.array([len(k) for k in keys], np.int64)
            distinct, group = np.unique(np.concatenate(keys), return_inverse=True)
            del keys
            found = answer(group, np.concatenate(values), len(distinct))
            ends = np.cumsum(sizes)
            cut = [squeeze(found[e - s : e]) for e, s in zip(ends, sizes, strict=True)]
            chunk, bucket = table.column("chunk").to_pylist(), table.column("bucket").to_pylist()
            first, second = [0] * len(cut), [0] * len(cut)
            if totals is not None:
                chunk, bucket, cut = [*chunk, -1], [*bucket, bucket[0]], [*cut, b""]
                one, two = totals(group, np.concatenate(values), len(distinct))
                first, second = [*first, one], [*second, two]
            types = {
                "chunk": pa.int64(), "bucket": pa.int32(), name: pa.binary(), "total": pa.int64(), "second_total": pa.int64()
            }
            columns = zip(types.items(), (chunk, bucket, cut, first, second), strict=True)
            return pa.table({n: pa.array(c, t) for (n, t), c in columns})

        rows = offers.groupBy("bucket").applyInArrow(run, f"chunk long, bucket int, {name} binary, total long, second_total long")
        found = rows.groupBy("chunk").agg(
            F.sort_array(F.collect_list(F.struct("bucket", name))).alias(name), F.sum("total").alias("total"),
            F.sum("second_total").alias("second_total"),
        )
        return found if totals is not None else found.drop("total", "second_total")

    def joined(self, *answers: DataFrame) -> DataFrame:
        rows = self.table
        for answer in answers:
            rows = rows.join(answer.hint("shuffle_hash"), "chunk", "left")
        return rows



def answered(row: dict, name: str, dtype: str, n: int) -> np.ndarray:
    """All answers to a chunk's ``n`` offered keys, in their order."""
    parts = [unsqueeze(a[name], dtype) for a in row[name] or []]
    found = np.concatenate(parts) if parts else np.zeros(0, dtype)
    if len(found) != n:
        raise ValueError(f"{len(found)} answers to {n} keys")
    return found
