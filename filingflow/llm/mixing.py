"""Mixing sources to target weights by Poisson replication.

A source gets the rate (target share x rows out) / rows in.  Every document of it
is repeated as often as a Poisson variable of that mean says, found by inverting
the distribution at a number made from the seed and the document's id; so the
result does not depend on partitions or on the run.  The copies are then ordered by
another hash, which shuffles them globally.

Source sizes come from one partial aggregate.  The table of rates (a row per
source) is written before the join: it is broadcast if it is small and otherwise
joined by a sort-merge join whose hot sources Spark can split.

Defined cases: a null source is a source of its own; a null id counts as the text
``null``; rows with the same id get the same count; a source without a weight has
weight 0; an empty table gives an empty result; input columns are kept, those named
``copy``, ``rate`` or ``shuffle_key`` are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import written
from .text import unused

SEED = 17
#: Target share of a source: its rows to this power, over the sum of all.
ALPHA = 0.5
#: A rate above this is split into equal parts with a draw each, so that exp(-rate) stays a number.
PART = 16.0

ADDED = ["copy", "rate", "shuffle_key"]


def _digits(*parts: Column) -> Column:
    """52 bits of a hash of the parts, joined by colons."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13), 16, 10).cast("long")


def tempered_weights(docs: DataFrame, key: str = "source", alpha: float = ALPHA) -> DataFrame:
    """(key, weight): rows per source to the power ``alpha``."""
    return docs.groupBy(key).agg(F.pow(F.count(F.lit(1)).cast("double"), F.lit(alpha)).alias("weight"))


def _cdf(mean: Column) -> Column:
    """Poisson distribution function at 0, 1, ... until nothing is left."""
    last = F.ceil(mean + 12 * F.sqrt(mean) + 25).cast("int")
    first = F.exp(-mean)
    return F.aggregate(
        F.sequence(F.lit(1), last),
        F.struct(F.array(first).alias("cdf"), first.alias("p")),
        lambda a, k: F.struct(
            F.concat(a["cdf"], F.array(F.element_at(a["cdf"], -1) + a["p"] * mean / k)).alias("cdf"),
            (a["p"] * mean / k).alias("p"),
        ),
        lambda a: a["cdf"],
    )


def rates(docs: DataFrame, weights: DataFrame, key: str = "source", rows_out: float | None = None) -> DataFrame:
    """(key, rate, parts, cdf) per source; by default as many rows are expected out as come in."""
    sizes = docs.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    both = sizes.alias("s").join(weights.alias("w"), F.col(f"s.{key}").eqNullSafe(F.col(f"w.{key}")), "left")
    both = both.select(F.col(f"s.{key}").alias(key), "n", F.coalesce("weight", F.lit(0.0)).alias("weight"))
    sums = both.agg(F.struct(F.sum("weight").alias("weight"), F.sum("n").alias("n")).alias("sums"))
    total = sums.scalar()
    out = F.lit(rows_out) if rows_out is not None else total["n"].cast("double")
    rate = F.when(total["weight"] > 0, F.col("weight") / total["weight"] * out / F.col("n")).otherwise(F.lit(0.0))
    parts = F.greatest(F.ceil(F.col("rate") / PART), F.lit(1)).cast("int")
    return (
        both.select(key, rate.alias("rate"))
        .withColumn("parts", parts)
        .withColumn("cdf", _cdf(F.col("rate") / F.col("parts")))
    )


def mix(
    docs: DataFrame,
    weights: DataFrame | None = None,
    key: str = "source",
    rows_out: float | None = None,
    seed: int = SEED,
) -> DataFrame:
    """Repeat and shuffle ``docs``; adds ``copy`` (from 1), ``rate`` and ``shuffle_key``."""
    docs = docs.select([c for c in docs.columns if c.lower() not in ADDED])
    weights = weights if weights is not None else tempered_weights(docs, key)
    source, parts, cdf, count = (unused(n, docs.columns) for n in ("mix_source", "parts", "cdf", "count"))
    table = written(rates(docs, weights, key, rows_out), "mix-rates")
    table = table.select(F.col(key).alias(source), "rate", F.col("parts").alias(parts), F.col("cdf").alias(cdf))
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    joined = docs.join(table, F.col(key).eqNullSafe(F.col(source)))

    def draw(part: Column) -> Column:
        u = _digits(F.lit(str(seed)), name, part.cast("string")) / F.lit(float(1 << 52))
        return F.size(F.filter(cdf, lambda c: c <= u))

    counted = joined.withColumn(
        count, F.aggregate(F.sequence(F.lit(1), F.col(parts)), F.lit(0), lambda a, part: a + draw(part))
    ).filter(F.col(count) > 0)
    copies = counted.select(
        *docs.columns, "rate", F.explode(F.sequence(F.lit(1), F.col(count))).alias("copy")
    )
    place = _digits(F.lit(f"{seed}-order"), name, F.col("copy").cast("string"))
    return copies.withColumn("shuffle_key", place).orderBy("shuffle_key", "doc_id", "copy")
