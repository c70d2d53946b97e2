"""Quality rules: hashed n-gram log-likelihood ratio of trusted text against the raw corpus.

Words and word pairs are hashed into a fixed number of buckets.  Two multinomials
over the buckets are counted: one over every document, one over the trusted
documents.  The trusted one is smoothed towards the raw one (a Dirichlet prior),
so a bucket says nothing where the trusted text is too small to tell.  A
document's score is the mean log ratio of its n-grams; it is kept when the score
reaches the threshold and the base rules do not fail it.

Counting is one aggregate with a row per bucket and task; scoring needs no
shuffle, the bucket table comes in as a scalar subquery.

Defined cases: a null text has no words and fails the base rules; a document
without n-grams scores 0; repeated rows are scored each; a table without rows, or
without trusted rows, gives ratio 0 everywhere; input columns are kept, a computed
column takes the place of one of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.once import computed_once
from .text import is_blank, replaced, text_of, unused, words_of

#: A power of two.
BUCKETS = 1 << 13
#: Weight of the prior, in n-grams.
PRIOR = 100_000
#: Trusted documents that are used at most, chosen by hash; their ids are broadcast.
TRUSTED_LIMIT = 50_000
#: Least mean log ratio of a kept document.
THRESHOLD = -0.06
# The base rules.
MIN_WORDS, MAX_REPEATED_PERCENT = 50, 50
SYMBOLS = "#*$%&|<>"

FEATURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def trusted_ids(labels: DataFrame, limit: int = TRUSTED_LIMIT) -> DataFrame:
    """Ids of documents labelled good: all of them, or about ``limit`` chosen by hash of the id."""
    good = labels.filter((F.col("quality") == 1) & F.col("doc_id").isNotNull())
    good = good.select(F.col("doc_id").alias("trusted_id")).distinct()
    share = good.agg((F.lit(limit) / F.greatest(F.count(F.lit(1)), F.lit(1))).alias("share"))
    place = F.pmod(F.xxhash64("trusted_id"), F.lit(1_000_003)) / F.lit(1_000_003)
    return good.filter(place < share.scalar())


def word_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _ngram_buckets(hashes: Column, buckets: int) -> Column:
    """Bucket numbers of all words and of all pairs of neighbours; ``hashes`` must be a plain column.

    ``buckets`` is a power of two, so that a bucket is some low bits of the hash.
    """
    low = F.lit(buckets - 1).cast("long")
    single = F.transform(hashes, lambda h: h.bitwiseAND(low))
    pairs = F.transform(hashes, lambda h, i: F.xxhash64(h, F.get(hashes, i + 1)).bitwiseAND(low))
    return F.concat(single, F.slice(pairs, 1, F.greatest(F.size(hashes) - 1, F.lit(0))))


def bucket_ratios(
    docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, prior: float = PRIOR
) -> DataFrame:
    """One row with the array ``ratios``: log of trusted over raw probability per bucket."""
    flagged = docs.select("doc_id", "text").join(F.broadcast(trusted), F.col("doc_id") == F.col("trusted_id"), "left")
    hashed = computed_once(flagged, ["trusted_id"], hashes=word_hashes(words_of(F.col("text"))))
    hashed = computed_once(hashed, ["trusted_id"], found=_ngram_buckets(F.col("hashes"), buckets))
    grams = hashed.select(
        F.explode("found").alias("bucket"),
        F.lit(1).cast("long").alias("raw"),
        F.col("trusted_id").isNotNull().cast("long").alias("good"),
    )
    none = F.lit(0).cast("long")
    every = docs.sparkSession.range(0, buckets, 1, 1).select(
        F.col("id").alias("bucket"), none.alias("raw"), none.alias("good")
    )
    counts = grams.unionByName(every).groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("good").alias("good"))
    table = counts.agg(  # one row per bucket comes here, however large the corpus
        F.sort_array(F.collect_list(F.struct("bucket", "raw", "good"))).alias("rows"),
        F.sum("raw").alias("n_raw"),
        F.sum("good").alias("n_good"),
    )

    def ratio(row: Column) -> Column:
        raw = row["raw"] / F.col("n_raw")
        good = (row["good"] + F.lit(prior) * raw) / (F.col("n_good") + F.lit(prior))
        return F.when(row["raw"] > 0, F.log(good / raw)).otherwise(F.lit(0.0))

    return table.select(F.transform("rows", ratio).alias("ratios"))


def _repeat_words(windows: Column, ranked: Column) -> Column:
    """Words in 3-word windows found twice or more; ``ranked``: (window hash, place) in order."""
    again = F.filter(
        ranked,
        lambda p, i: (F.get(ranked, i - 1)["h"] == p["h"]) | (F.get(ranked, i + 1)["h"] == p["h"]),
    )
    places = F.sort_array(F.transform(again, lambda p: p["i"]))
    covered = F.aggregate(
        places,
        F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n")),
        lambda a: a["n"],
    )
    return F.when(windows, covered).otherwise(F.lit(0).cast("long"))


def _long(column: Column) -> Column:
    return column.cast("long")


def measured(docs: DataFrame, ratios: DataFrame, buckets: int = BUCKETS, threshold: float = THRESHOLD) -> DataFrame:
    """All rows and columns of ``docs`` with the base measures, ``base_failed``, ``score`` and ``kept``."""
    new = [*FEATURES, "base_failed", "score", "kept"]
    keep = [c for c in docs.columns if c.lower() not in new]
    model = unused("ratios", docs.columns)
    text = text_of(F.col("text"))
    one = F.col("text").isNotNull() | F.col("text").isNull()  # every row; keeps the subquery out of lambdas
    own = [unused(n, docs.columns) for n in ("words", "word_hashes", "windows", "ranked", "line_list")]
    words, hashes, windows, ranked, lines = own
    rows = computed_once(docs, docs.columns, **{words: words_of(text)})
    rows = computed_once(
        rows,
        rows.columns,
        **{
            hashes: word_hashes(F.col(words)),
            lines: F.filter(F.split(text, "\n"), lambda line: ~is_blank(line)),
        },
    )
    h = F.col(hashes)
    rows = computed_once(
        rows,
        rows.columns,
        **{
            windows: F.when(
                F.size(h) >= 3,
                F.transform(
                    F.slice(h, 1, F.greatest(F.size(h) - 2, F.lit(1))),
                    lambda x, i: F.xxhash64(x, F.get(h, i + 1), F.get(h, i + 2)),
                ),
            ).otherwise(F.expr("array()").cast("array<bigint>"))
        },
    )
    w = F.col(windows)
    repeated = F.size(F.array_distinct(w)) < F.size(w)
    rows = computed_once(
        rows,
        rows.columns,
        **{
            model: F.when(one, ratios.scalar()),
            ranked: F.when(
                repeated,
                F.sort_array(F.transform(w, lambda x, i: F.struct(x.alias("h"), i.alias("i")))),
            )
        },
    )
    m = F.col(model)
    grams = F.size(h) + F.greatest(F.size(h) - 1, F.lit(0))
    total = F.aggregate(
        _ngram_buckets(h, buckets), F.lit(0.0), lambda a, b: a + F.get(m, b.cast("int"))
    )
    measures = {
        "n_words": _long(F.size(h)),
        "word_chars": _long(F.length(F.array_join(words, ""))),
        "n_symbols": _long(F.length(text) - F.length(replaced(text, SYMBOLS, ""))),
        "n_dup_lines": _long(F.size(lines) - F.size(F.array_distinct(lines))),
        "n_repeat_words": _repeat_words(F.col(ranked).isNotNull(), F.col(ranked)),
        "score": F.when(F.size(h) > 0, total / grams).otherwise(F.lit(0.0)),
    }
    rows = computed_once(rows, keep, **measures)
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    )
    return rows.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("score") >= F.lit(threshold))
    )


def quality(
    docs: DataFrame,
    labels: DataFrame,
    buckets: int = BUCKETS,
    prior: float = PRIOR,
    threshold: float = THRESHOLD,
    trusted_limit: int = TRUSTED_LIMIT,
) -> DataFrame:
    """Score every document against the trusted ones; see the module's text."""
    ratios = bucket_ratios(docs, trusted_ids(labels, trusted_limit), buckets, prior)
    return measured(docs, ratios, buckets, threshold)
