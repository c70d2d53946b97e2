"""Best-fit packing of token sequences with exact complements.

Documents are encoded, ended by id 0 and cut into pieces of at most ``size`` tokens.
What can be packed together depends on the pieces' lengths alone, so the plan is made
from the histogram of lengths, which has ``size`` entries however large the corpus is.
The plan takes the longest pieces first and looks for an exact complement of the gap:
one length, then a pair of lengths, then a triple, found in indexes of the lengths
that are left; a combination is used as often as its scarcest length allows.  Lengths
without an exact complement are best-fit, longest first, into the fullest open gap
that takes them.  The plan is a list of patterns (lengths and a repeat count).

Pieces are then numbered within their length, in two steps so that a length a third
of all pieces have is numbered by many tasks, and the number says which repeat of
which pattern the piece goes to.

Defined cases: a null text is empty and becomes the end id alone; rows with the same
id are documents of their own; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from ..session import written
from .tokens import encoder, public_path

SIZE = 2048
END = 0
#: Groups in which pieces of one length are numbered apart.
SALTS = 64

PIECES = (
    "doc_id long, copy long, piece int, start long, length long, ids_crc32 long, place long"
)


def pieces_of(docs: DataFrame, path: str, size: int = SIZE) -> DataFrame:
    """(doc_id, copy, piece, start, length, ids_crc32, place) per piece; ``copy`` tells rows of the same id apart."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        end = np.array([END], "<u4")
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, copy, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                ids = np.concatenate([np.frombuffer(encode(text or ""), "<u2").astype("<u4"), end])
                for piece, at in enumerate(range(0, len(ids), size)):
                    part = ids[at : at + size]
                    crc = zlib.crc32(part.tobytes())
                    place = zlib.crc32(f"{doc_id}:{copy}:{piece}".encode())
                    rows.append((doc_id, copy, piece, at, len(part), crc, place))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 7
            types = [pa.int64(), pa.int64(), pa.int32(), *[pa.int64()] * 4]
            names = ["doc_id", "copy", "piece", "start", "length", "ids_crc32", "place"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("copy"), "text")
    return rows.mapInArrow(cut, PIECES)


class Lengths:
    """Lengths that are left, with lookups of exact complements."""

    def __init__(self, counts: np.ndarray) -> None:
        self.left = counts.astype(np.int64).copy()
        self.there = self.left > 0

    def take(self, lengths: list[int]) -> int:
        """Use the combination as often as it can be; the number of times."""
        need = np.bincount(lengths, minlength=len(self.left))
        used = need > 0
        times = int((self.left[used] // need[used]).min())
        self.left -= need * times
        self.there[used] = self.left[used] > 0
        return times

    def enough(self, lengths: list[int], more: int) -> bool:
        """Whether the combination is there once, together with one piece of length ``more``."""
        return all(self.left[n] >= [*lengths, more].count(n) for n in lengths)

    def pair(self, gap: int, more: int) -> list[int] | None:
        """Two lengths that fill ``gap``; the most uneven one, so that small lengths stay for later."""
        if gap < 2:
            return None
        half = np.arange(1, gap // 2 + 1)
        for low in half[self.there[half] & self.there[gap - half]]:
            if self.enough([int(low), gap - int(low)], more):
                return [gap - int(low), int(low)]
        return None

    def triple(self, gap: int, more: int, pairs: np.ndarray) -> list[int] | None:
        if gap < 3:
            return None
        first = np.arange(gap - 2, 0, -1)
        for one in first[self.there[first] & (pairs[gap - first] > 0)]:
            two = self.pair(gap - int(one), more)
            if two and self.enough([int(one), *two], more):
                return [int(one), *two]
        return None

    def pair_sums(self) -> np.ndarray:
        """How many pairs of present lengths have each sum."""
        present = self.there.astype(np.float64)
        wide = 1 << (2 * len(present)).bit_length()
        found = np.fft.irfft(np.fft.rfft(present, wide) ** 2, wide)[: len(present)]
        return np.rint(found)


def plan(counts: np.ndarray, size: int = SIZE) -> list[tuple[list[int], int]]:
    """Patterns of lengths, each with the number of sequences that have it.

    ``counts[n]`` pieces have length n; the work depends on ``size`` only.
    """
    lengths = Lengths(counts)
    patterns: list[tuple[list[int], int]] = []
    residual: list[tuple[int, int]] = []
    sums, stale = lengths.pair_sums(), 0
    for n in range(size, 0, -1):
        while lengths.left[n] > 0:
            gap = size - n
            found = [] if gap == 0 else None
            if found is None and gap < len(lengths.left) and lengths.there[gap] and lengths.enough([gap], n):
                found = [gap]
            found = lengths.pair(gap, n) if found is None else found
            if found is None:
                if stale:
                    sums, stale = lengths.pair_sums(), 0
                found = lengths.triple(gap, n, sums)
            if found is None:
                residual.append((n, int(lengths.left[n])))
                lengths.left[n], lengths.there[n] = 0, False
            else:
                patterns.append(([n, *found], lengths.take([n, *found])))
            stale += 1
    return patterns + best_fit(residual, size)


def best_fit(residual: list[tuple[int, int]], size: int) -> list[tuple[list[int], int]]:
    """Best fit of (length, count) from the longest down; equal open sequences are kept as one entry."""
    by_gap: dict[int, list[tuple[list[int], int]]] = {}
    for n, count in residual:
        while count > 0:
            fits = [gap for gap in by_gap if gap >= n]
            if fits:
                gap = min(fits)
                pattern, times = by_gap[gap].pop()
                if not by_gap[gap]:
                    del by_gap[gap]
            else:  # empty sequences, as many as are filled, or one that is not
                gap, pattern = size, []
                times = max(1, count // (size // n))
            each = min(gap // n, max(1, count // times))
            filled = min(times, count // each)
            by_gap.setdefault(gap - n * each, []).append((pattern + [n] * each, filled))
            if pattern and times > filled:
                by_gap.setdefault(gap, []).append((pattern, times - filled))
            count -= filled * each
    return [entry for entries in by_gap.values() for entry in entries]


def slots(patterns: list[tuple[list[int], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first, last, sequence_id, offset): which numbers of a length go where.

    Piece ``first + i`` of a length lies in sequence ``sequence_id + i``; ``last`` is exclusive.
    """
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for lengths, times in patterns:
        offset = 0
        for n in lengths:
            at = used.get(n, 0)
            rows.append((n, at, at + times, sequence, offset))
            used[n] = at + times
            offset += n
        sequence += times
    return rows


def numbered(pieces: DataFrame, salts: int) -> DataFrame:
    """``pieces`` with ``number``, from 0 within each length, given by many tasks."""
    salted = pieces.withColumn("salt", F.pmod("place", F.lit(salts)).cast("int"))
    inner = W.partitionBy("length", "salt").orderBy("place", "doc_id", "copy", "piece")
    before = W.partitionBy("length").orderBy("salt").rowsBetween(W.unboundedPreceding, -1)
    bases = (
        salted.groupBy("length", "salt").count()
        .select("length", "salt", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    )
    ranked = salted.withColumn("rank", F.row_number().over(inner) - 1)
    return ranked.join(bases, ["length", "salt"]).withColumn("number", F.col("base") + F.col("rank"))


def pack(docs: DataFrame, path: str | None = None, size: int = SIZE) -> DataFrame:
    """Place every piece of every document.

    Returns (doc_id, copy, piece, start, length, ids_crc32, sequence_id, offset).
    """
    spark = docs.sparkSession
    pieces = written(pieces_of(docs, path or public_path("word_bpe_49k.json"), size), "pieces")
    counts = np.zeros(size + 1, np.int64)
    for row in pieces.groupBy("length").count().collect():  # ``size`` rows at most
        counts[row["length"]] = row["count"]
    placed = slots(plan(counts, size))
    table = spark.createDataFrame(
        placed, "slot_length long, first long, last long, sequence_base long, offset long"
    )
    salts = max(SALTS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = numbered(pieces, salts).join(  # a few slots per length, whatever the corpus
        F.broadcast(table),
        (F.col("length") == F.col("slot_length")) & (F.col("number") >= F.col("first")) & (F.col("number") < F.col("last")),
    )
    return rows.select(
        "doc_id", "copy", "piece", "start", "length", "ids_crc32",
        (F.col("sequence_base") + F.col("number") - F.col("first")).alias("sequence_id"), "offset",
    )
