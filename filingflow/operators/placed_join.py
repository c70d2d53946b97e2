"""Joins that leave rows with large columns where they are, however long the other side is.

A side of up to ``BROADCAST_ROWS`` rows is broadcast.  Beyond that

1. a Bloom filter of its keys, of bounded size, is broadcast and tested next to the scan,
   so that only rows which are likely to have a partner go on (no row with one is lost);
2. these are written once, divided by a hash of the key into slices; writing by slice
   moves no row to another task;
3. each slice meets its share of the other side, which is small enough to broadcast.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..session import BROADCAST_ROWS, fresh_dir

#: Bits per key, and the most 64-bit words of a filter (16 MB with their numbers).
BITS, MOST_WORDS = 12, 1 << 20
_PLACE, _MASK, _SLICE = "_filter_word", "_filter_mask", "_slice"


def _hashed(rows: DataFrame, key: str, words: int) -> DataFrame:
    """The filter's word for a key and the four bits it sets there."""
    bits = " | ".join(f"shiftleft(1L, CAST(shiftrightunsigned(h, {20 + 6 * j}) & 63L AS INT))" for j in range(4))
    hashed = F.xxhash64(F.col(key))
    return rows.withColumns({
        _PLACE: hashed.bitwiseAND(F.lit(words - 1)), _MASK: F.expr(f"transform(array(xxhash64(`{key}`)), h -> {bits})[0]"),
    })


def bloom_filter(keys: DataFrame, key: str, n: int) -> tuple[DataFrame, int]:
    """(word, bits) of a Bloom filter over about ``n`` keys, and its number of words; an aggregate with a partial step."""
    words = 1 << 6
    while words * 64 < BITS * n and words < MOST_WORDS:
        words *= 2
    return _hashed(keys.select(key), key, words).groupBy(_PLACE).agg(F.bit_or(_MASK).alias("_filter_bits")), words


def likely(rows: DataFrame, keys: DataFrame, key: str, n: int) -> DataFrame:
    """The rows whose key may be among ``keys``: all that are, and about one in a hundred of the others.

    A filter at its greatest size lets more rows through.
    """
    held, words = bloom_filter(keys, key, n)
    tested = _hashed(rows, key, words).join(F.broadcast(held), _PLACE)
    return tested.where(F.col("_filter_bits").bitwiseAND(F.col(_MASK)) == F.col(_MASK)).select(*rows.columns)


def _slice(key: str, slices: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key), F.lit(slices)), F.lit(slices))


def placed_join(rows: DataFrame, table: DataFrame, key: str, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Inner join of ``rows`` with ``table``, a stored table of unique keys, without moving ``rows``."""
    n = table.limit(limit + 1).count()
    if n <= limit:
        return rows.join(F.broadcast(table), key)
    n = table.count()
    slices = 2
    while table.groupBy(_slice(key, slices)).count().where(F.col("count") > limit).limit(1).count():
        slices *= 2
    spark, folder = rows.sparkSession, fresh_dir(rows.sparkSession, "slices")
    found = likely(rows, table, key, n).withColumn(_SLICE, _slice(key, slices).cast("string"))
    found.write.mode("overwrite").partitionBy(_SLICE).parquet(folder)
    kept = spark.read.schema(found.schema).parquet(folder)

    def part(i: int) -> DataFrame:
        own = table.where(_slice(key, slices) == i)
        return kept.where(F.col(_SLICE) == str(i)).select(*rows.columns).join(F.broadcast(own), key)

    return reduce(DataFrame.unionByName, map(part, range(slices)))
