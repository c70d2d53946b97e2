"""Approximate nearest neighbours by an adaptive scan over rotated dimensions.

Vectors are put into lists around centres (k-means on a bounded sample); every vector
is in one list.  A query probes the lists of its nearest centres.  Inside a list the
vectors are rotated by one random orthogonal matrix and scanned in blocks of columns:
after d of D dimensions a candidate is given up when its partial squared distance
exceeds what a vector at the current k-th distance would have, with a margin for
chance (a test of the hypothesis that it is nearer).  Those left are measured exactly,
in double precision on the original vectors.

A list is cut into parts of about ``PART`` vectors, and the queries that probe it into
parts of about ``QUERY_PART``, both by hash; so a list that holds a third of all
vectors is many tasks.  Only the best k of a part go on.

Defined cases: vectors that are null, empty, all zero, or hold null or non-finite
numbers take no part, nor do null ids or vectors of another length than most have;
equal distances are ordered by id; rows with the same id are candidates each, but not
for a query of that id; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..session import written

K = 10
#: Vectors the centres are fitted on, at most about.
SAMPLE = 20_000
MAX_LISTS = 4096
#: Share of the lists a query probes, and the least number.
PROBED, MIN_PROBED = 0.6, 16
PART, QUERY_PART = 8192, 2048
#: Columns scanned between two tests, and the margin of the test.
COLUMNS, MARGIN = 16, 2.1
#: Squared distances this far apart, as a share of the query's squared norm, are not told apart: rotating rounds.
ROUNDING = 1e-12
SEED = 7


def usable(vector: Column) -> Column:
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~odd & F.exists(vector, lambda x: x != 0)


def _array(column: pa.Array, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.asarray(flat, np.float32 if flat.dtype == np.float32 else np.float64).reshape(-1, dim)


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * a).sum(1)[:, None] - 2 * a @ b.T + (b * b).sum(1)[None, :]


def centres(sample: np.ndarray, n_lists: int, rounds: int = 8, seed: int = SEED) -> np.ndarray:
    """k-means; a centre that loses all its vectors moves to a random one."""
    rng = np.random.default_rng(seed)
    found = sample[rng.choice(len(sample), min(n_lists, len(sample)), replace=False)].astype(np.float64)
    for _ in range(rounds):
        nearest = np.concatenate([_squares(s, found).argmin(1) for s in np.array_split(sample, 1 + len(sample) // 4096)])
        sums = np.zeros_like(found)
        np.add.at(sums, nearest, sample)
        n = np.bincount(nearest, minlength=len(found))
        found = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], sample[rng.integers(0, len(sample), len(found))])
    return found


def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def scan(query: np.ndarray, rotated: np.ndarray, k: int, columns: int = COLUMNS, margin: float = MARGIN) -> np.ndarray:
    """Rows of ``rotated`` (dimensions first) that may be among the k nearest to the rotated query."""
    dim, n = rotated.shape
    if n <= 4 * k:
        return np.arange(n)
    head = ((rotated[:, : 4 * k] - query[:, None]) ** 2).sum(0)
    bound = np.partition(head, k - 1)[k - 1]
    slack = ROUNDING * (query @ query)
    left = np.arange(n)
    partial = np.zeros(n)
    for first in range(0, dim, columns):
        block = slice(first, min(first + columns, dim))
        rows = rotated[block] if len(left) == n else rotated[block][:, left]
        partial = partial + ((rows - query[block, None]) ** 2).sum(0)
        done = block.stop
        if done < dim:
            keep = partial <= bound * done / dim * (1 + margin / np.sqrt(done)) ** 2 + slack
        else:
            if len(partial) > k:
                bound = min(bound, np.partition(partial, k - 1)[k - 1])
            keep = partial <= bound * (1 + 1e-9) + slack
        left, partial = left[keep], partial[keep]
    return left


def _search(dim: int, k: int):
    turn = rotation(dim)

    def run(queries: pa.Table, vectors: pa.Table) -> pa.Table:
        rows: list[tuple[int, int, float]] = []
        if queries.num_rows and vectors.num_rows:
            ids = vectors.column("vec_id").to_numpy()
            own = _array(vectors.column("embedding"), dim).astype(np.float64)
            rotated = np.ascontiguousarray((own @ turn).T)
            asked = _array(queries.column("query"), dim).astype(np.float64)
            for query_id, q, turned in zip(queries.column("query_id").to_pylist(), asked, asked @ turn, strict=True):
                near = scan(turned, rotated, k + int((ids == query_id).sum()))
                near = near[ids[near] != query_id]
                exact = np.sqrt(((own[near] - q) ** 2).sum(1))
                best = np.lexsort((ids[near], exact))[:k]
                rows += [(query_id, int(ids[near[i]]), float(exact[i])) for i in best]
        columns = list(zip(*rows, strict=True)) if rows else [[], [], []]
        types = pa.int64(), pa.int64(), pa.float64()
        names = "query_id", "vec_id", "score"
        return pa.table({n: pa.array(c, t) for n, c, t in zip(names, columns, types, strict=True)})

    return run


def nearest(vectors: DataFrame, is_query: Column, k: int = K, probed: float = PROBED) -> DataFrame:
    """(query_id, rank, vec_id, score) for each row of ``vectors`` for which ``is_query`` holds."""
    spark = vectors.sparkSession
    good = vectors.filter(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sizes = good.groupBy(F.size("embedding").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    if sizes is None:
        return empty
    dim, n = sizes["dim"], sizes["count"]
    good = good.filter(F.size("embedding") == dim)
    n_lists = max(1, min(MAX_LISTS, int(n**0.5)))
    share = F.lit(min(1.0, SAMPLE / n))
    place = F.pmod(F.xxhash64(F.col("vec_id"), F.lit(SEED)), F.lit(1_000_003)) / F.lit(1_000_003)
    drawn = good.filter(place <= share).select("vec_id", "embedding").toArrow().sort_by("vec_id")
    if drawn.num_rows == 0:  # a handful of rows, none of them drawn
        drawn = good.select("vec_id", "embedding").limit(1).toArrow()
    middle = centres(_array(drawn.column("embedding"), dim).astype(np.float64), n_lists)
    probes = min(len(middle), max(MIN_PROBED, round(len(middle) * probed)))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            flags = batch.column(2).to_pylist()
            squares = _squares(_array(batch.column(1), dim).astype(np.float64), middle)
            lists = [
                np.argpartition(s, probes - 1)[:probes].tolist() if flag and probes < len(middle)
                else list(range(len(middle))) if flag else []
                for s, flag in zip(squares, flags, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(squares.argmin(1), pa.int32()), pa.array(lists, pa.list_(pa.int32()))],
                ["vec_id", "embedding", "list", "probes"],
            )

    kind = good.schema["embedding"].dataType.simpleString()
    located = good.select("vec_id", "embedding", F.coalesce(is_query, F.lit(False)).alias("is_query")).mapInArrow(
        assign, f"vec_id long, embedding {kind}, list int, probes array<int>"
    )
    located = written(located, "vectors")
    asked = located.filter(F.size("probes") > 0).select(
        F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"), F.explode("probes").alias("list")
    )
    parts = located.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("parts"))
    query_parts = asked.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / QUERY_PART).cast("int").alias("query_parts"))
    cuts = F.broadcast(written(parts.join(query_parts, "list"), "list-parts"))  # MAX_LISTS rows at most
    right = located.join(cuts, "list").select(
        "list", F.pmod(F.xxhash64("vec_id"), F.col("parts")).alias("part"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("query_parts") - F.lit(1).cast("long"))).alias("query_part"), "vec_id", "embedding",
    )
    left = asked.join(cuts, "list").select(
        "list", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - F.lit(1).cast("long"))).alias("part"),
        F.pmod(F.xxhash64("query_id"), F.col("query_parts")).alias("query_part"), "query_id", "query",
    )
    keys = ["list", "part", "query_part"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        _search(dim, k), "query_id long, vec_id long, score double"
    )
    rank = F.row_number().over(W.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
