"""Toxicity grades by cumulative-link ordinal regression on sparse text features.

Features are hashed words (A-Z folded, cut at ASCII punctuation) and the first four
and five bytes of words.  From a bounded sample of labelled documents those are chosen
that stand far more often in toxic documents than in others.  A document's grade is 0
if it is not labelled toxic; otherwise 1 to 3 by how many chosen features it has per
hundred words (cuts at the thirds of the toxic documents), unless the labels have
grades of their own.  One weight per feature is shared by all thresholds:
P(grade <= j) = sigmoid(threshold_j - weights . x).  Every document is scored; the
result is the expected grade and a verdict.

Defined cases: a null or empty text has no features; without labels of both kinds all
documents are graded 0; repeated labels of an id count once, toxic if any says so;
rows with the same id are scored each; columns other than doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import written
from .words import Words, portions, prefix_hashes

#: Labelled documents the model is fitted on, at most about.
SAMPLE = 20_000
MAX_FEATURES = 512
GRADES = 4
#: A feature is chosen if its share of toxic documents is this much above the overall one, in standard errors.
LEAST_Z, LEAST_SHARE = 6.0, 0.5
PREFIXES = (4, 5)


def _features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of every word and word prefix."""
    found = [words.hashes, *(prefix_hashes(words, n) for n in PREFIXES)]
    return np.concatenate(found), np.tile(words.doc, len(found))


def _sampled(docs: DataFrame, labels: DataFrame, limit: int) -> DataFrame:
    grade = F.max(F.col("grade")) if "grade" in labels.columns else F.lit(None).cast("int")
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(
        F.max("toxic").cast("int").alias("toxic"), grade.alias("grade")
    )
    share = known.agg((F.lit(limit) / F.greatest(F.count(F.lit(1)), F.lit(1))).alias("share"))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) / F.lit(1_000_003)
    chosen = known.filter(place < share.scalar())  # about ``limit`` rows
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (part for whole in batches for part in portions(whole)):
        words = Words(batch.column("text").to_pylist(), fold=True, punctuation=True)
        found, doc = _features(words)
        order = np.lexsort((found, doc))
        found, doc = found[order], doc[order]
        first = np.append(True, (found[1:] != found[:-1]) | (doc[1:] != doc[:-1])) if len(found) else np.zeros(0, bool)
        at = np.flatnonzero(first)
        times = np.diff(np.append(at, len(found)))
        offsets = np.searchsorted(doc[at], np.arange(batch.num_rows + 1)).astype(np.int32)
        lists = [pa.ListArray.from_arrays(offsets, pa.array(v, pa.int64())) for v in (found[at].view(np.int64), times)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("toxic"), batch.column("grade"), pa.array(words.counts, pa.int64()), *lists],
            ["doc_id", "toxic", "grade", "n_words", "features", "times"],
        )


def _matched(chosen: np.ndarray):
    """(found, hits): which chosen features a document has, and how often all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("features")
            doc = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
            keys = lists.flatten().to_numpy().view(np.uint64)
            times = batch.column("times").flatten().to_numpy()
            at = np.searchsorted(chosen, keys)
            known = at < len(chosen)
            known[known] = chosen[at[known]] == keys[known]
            doc, at, times = doc[known], at[known], times[known]
            offsets = np.searchsorted(doc, np.arange(batch.num_rows + 1)).astype(np.int32)
            found = pa.ListArray.from_arrays(offsets, pa.array(at, pa.int32()))
            hits = np.bincount(doc, weights=times, minlength=batch.num_rows).astype(np.int64)
            own = ["doc_id", "toxic", "grade", "n_words"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in own], found, pa.array(hits)], [*own, "found", "hits"])

    return run


class Model:
    """Chosen features in order of their hash, their weights, the weight of their density, and the thresholds."""

    def __init__(self, features: np.ndarray, weights: np.ndarray, thresholds: np.ndarray) -> None:
        self.features, self.weights, self.thresholds = features, weights, thresholds

    def above(self, x: np.ndarray) -> np.ndarray:
        """P(grade > j) for each threshold j."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - (x @ self.weights)[:, None], -60, 60)))


def _inputs(present: np.ndarray, hits: np.ndarray, n_words: np.ndarray) -> np.ndarray:
    """One column per feature (present or not) and the logarithm of hits per hundred words."""
    return np.column_stack([present, np.log1p(100 * hits / np.maximum(n_words, 1))])


def fit(x: np.ndarray, grades: np.ndarray, steps: int = 300, rate: float = 0.1, decay: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds of greatest likelihood, by Adam on all rows.

    Thresholds are a first one and logarithms of the steps between them, so they stay in order.
    """
    levels = GRADES - 1
    params = np.zeros(x.shape[1] + levels)
    params[x.shape[1]] = np.log((grades == 0).mean() / max((grades > 0).mean(), 1e-3) + 1e-3)
    moment, square = np.zeros_like(params), np.zeros_like(params)
    rows = np.arange(len(grades))
    for step in range(1, steps + 1):
        w, t = params[: x.shape[1]], params[x.shape[1] :]
        thresholds = t[0] + np.concatenate([[0], np.cumsum(np.exp(t[1:]))])
        edge = np.column_stack([np.full(len(x), -60.0), thresholds[None, :] - (x @ w)[:, None], np.full(len(x), 60.0)])
        below = 1 / (1 + np.exp(-np.clip(edge, -60, 60)))
        high, low = below[rows, grades + 1], below[rows, grades]
        p = np.maximum(high - low, 1e-9)
        d_high, d_low = high * (1 - high) / p, low * (1 - low) / p
        slope_w = x.T @ (d_high - d_low) / len(x) + decay * w
        at = np.zeros((len(x), levels + 2))
        at[rows, grades + 1] -= d_high
        at[rows, grades] += d_low
        slope_t = at[:, 1:-1].mean(0)
        tail = np.cumsum(slope_t[::-1])[::-1]
        slope = np.concatenate([slope_w, [tail[0]], tail[1:] * np.exp(t[1:])])
        moment = 0.9 * moment + 0.1 * slope
        square = 0.999 * square + 0.001 * slope**2
        params = params - rate * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    t = params[x.shape[1] :]
    return params[: x.shape[1]], t[0] + np.concatenate([[0], np.cumsum(np.exp(t[1:]))])


def train(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE) -> Model:
    sample = _sampled(docs, labels, limit)
    listed = written(
        sample.select("doc_id", "text", "toxic", "grade").mapInArrow(
            _listed, "doc_id long, toxic int, grade int, n_words long, features array<long>, times array<long>"
        ),
        "toxic-features",
    )
    totals = listed.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("toxic")).first()
    n, toxic = totals["n"], totals["toxic"] or 0
    none = Model(np.zeros(0, np.uint64), np.zeros(1), np.full(GRADES - 1, 60.0))
    if not 0 < toxic < n:
        return none
    base = toxic / n
    counts = listed.select("toxic", F.explode("features").alias("feature")).groupBy("feature").agg(
        F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("toxic")
    )
    share = F.col("toxic") / F.col("n")
    z = (share - base) / F.sqrt(F.lit(base * (1 - base)) / F.col("n"))
    chosen = (
        counts.withColumn("z", z).filter((F.col("z") >= LEAST_Z) & (share >= LEAST_SHARE))
        .orderBy(F.desc("z"), "feature").limit(MAX_FEATURES).select("feature")
    )
    features = np.sort(np.array([r["feature"] for r in chosen.collect()], np.int64).view(np.uint64))
    if not len(features):
        return none
    matched = listed.mapInArrow(
        _matched(features), "doc_id long, toxic int, grade int, n_words long, found array<int>, hits long"
    )
    rows = matched.orderBy("doc_id").collect()  # about ``limit`` rows
    present = np.zeros((len(rows), len(features)))
    hits = np.array([r["hits"] for r in rows], np.float64)
    for i, row in enumerate(rows):
        present[i, row["found"]] = 1
    words = np.array([r["n_words"] for r in rows], np.float64)
    is_toxic = np.array([r["toxic"] for r in rows]) > 0
    density = hits / np.maximum(words, 1)
    cuts = np.quantile(density[is_toxic], [1 / 3, 2 / 3])
    grades = np.where(is_toxic, 1 + np.searchsorted(cuts, density, "right"), 0)
    stated = [r["grade"] for r in rows]
    grades = np.array([g if s is None else min(max(s, 0), GRADES - 1) for g, s in zip(grades, stated, strict=True)])
    weights, thresholds = fit(_inputs(present, hits, words), grades)
    return Model(features, weights, thresholds)


def grade(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, severity, grade, toxic): expected grade, likeliest grade, P(grade > 0) >= 1/2."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in portions(whole)):
            n = batch.num_rows
            words = Words(batch.column("text").to_pylist(), fold=True, punctuation=True)
            found, doc = _features(words)
            at = np.searchsorted(model.features, found)
            known = at < len(model.features)
            known[known] = model.features[at[known]] == found[known]
            present = np.zeros((n, len(model.features)))
            present[doc[known], at[known]] = 1
            hits = np.bincount(doc[known], minlength=n).astype(np.float64)
            above = model.above(_inputs(present, hits, words.counts.astype(np.float64)))
            each = -np.diff(np.column_stack([np.ones(n), above, np.zeros(n)]), axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(above.sum(1)), pa.array(each.argmax(1), pa.int32()),
                    pa.array(above[:, 0] >= 0.5),
                ],
                ["doc_id", "severity", "grade", "toxic"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, severity double, grade int, toxic boolean")


def toxicity(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE) -> DataFrame:
    return grade(docs, train(docs, labels, limit))
