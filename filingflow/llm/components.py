"""Connected components of a graph, as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import written

MAX_ROUNDS = 60


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, component): the smallest node that can be reached, for every node of ``links`` (a, b).

    Each round hangs nodes below the smallest neighbour of their whole star and the
    stars below each other (large-star, small-star), so a chain of n nodes takes about
    log n rounds.  Only minima per node are shuffled besides the links.
    """
    links = written(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), name
    )
    for _ in range(MAX_ROUNDS):
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), name)
        large = written(
            both.filter(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(),
            name,
        )
        low = written(large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")), name)
        small = (
            large.join(low, "u").filter(F.col("v") > F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        )
        after = written(small, name)
        # done when every node hangs below one that hangs below none
        roots = low.select("u")
        if low.filter("n > 1").isEmpty() and after.join(roots, after.v == roots.u, "left_semi").isEmpty():
            links = after
            break
        links = after
    else:
        raise RuntimeError(f"no end after {MAX_ROUNDS} rounds")
    top = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(top)
