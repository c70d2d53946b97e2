"""Chosen paths, cover trees and phrase mining against plain versions, on odd rows and on empty tables."""

import random
from collections import Counter

import numpy as np
import plain
import pytest
from pyspark.sql import functions as F

from filingflow.llm import chosen_path, chunks, hard_negatives, language_model, phrases
from filingflow.llm.queries import QUERIES
from filingflow.session import written


def rows(df):
    return Counter(tuple(r) for r in df.collect())


# --- chosen paths ------------------------------------------------------------------

LINKED = ["doc_id", "n_shingles", "component_id", "kept"]


def near_docs():
    """Near copies in chains, a large group around one text, and texts that share a passage."""
    rng = random.Random(4)

    def text(n):
        return [f"w{rng.randrange(100_000)}" for _ in range(n)]

    docs, base = [], text(120)
    for _ in range(70):  # near copies of one text
        own = list(base)
        own[rng.randrange(120)] = f"x{rng.random()}"
        docs.append(own)
    step = text(200)
    for i in range(12):  # a chain: neighbours are similar, its ends are not
        docs.append(list(step))
        step[i * 15 : i * 15 + 8] = text(8)
    common = text(60)
    for _ in range(90):  # not similar, but with many tokens in common
        docs.append(common + text(rng.randrange(20, 90)))
    docs += [docs[0], docs[75], text(4), text(4)[:3]]
    rng.shuffle(docs)
    return [(i * 3 + 1, " ".join(d)) for i, d in enumerate(docs)]


def test_chosen_path_on_the_small_table(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert rows(QUERIES["op11_chosen_path"](spark, sf_dir)) == plain.linked_groups(docs)


@pytest.mark.parametrize("small,levels", [(256, 4), (4, 4), (4, 2)])
def test_chosen_path_branches_down_to_blocks(spark, monkeypatch, small, levels):
    monkeypatch.setattr(chosen_path, "SMALL", small)
    monkeypatch.setattr(chosen_path, "LEVELS", levels)
    docs = near_docs()
    got = chosen_path.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string").repartition(3))
    assert rows(got.select(LINKED)) == plain.linked_groups(docs)


def test_texts_that_share_a_passage_seldom_share_a_node(spark):
    def text(n):
        return [f"w{rng.randrange(1_000_000)}" for _ in range(n)]

    rng = random.Random(9)
    common = text(30)
    docs = [(i, " ".join(common + text(90))) for i in range(600)]
    sets = chosen_path.features(spark.createDataFrame(docs, "doc_id long, text string")).withColumnRenamed("doc_id", "id")
    times = [r["count"] for r in chosen_path.roots(sets).groupBy("node").count().collect()]
    assert max(times) <= 60  # a token of the passage is in up to 469 of the texts
    docs += [(600 + i, docs[i][1] + " more") for i in range(5)]
    got = chosen_path.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string").repartition(3))
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == {i: i - 600 if i >= 600 else i for i, _ in docs}


def test_chosen_path_on_odd_rows(spark, odd, empty):
    docs = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    assert rows(chosen_path.near_duplicates(odd).select(LINKED)) == plain.linked_groups(docs)
    assert chosen_path.near_duplicates(empty).count() == 0


def test_rows_of_one_id_are_one_node(spark):
    one, two, three = (" ".join(f"{c}{i}" for i in range(60)) for c in "abc")
    docs = [(5, one), (5, two), (7, one), (9, two + " z"), (2, three), (2, two), (None, one)]
    got = chosen_path.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"))
    assert rows(got.select(LINKED)) == plain.linked_groups(docs)


def test_a_tree_meets_similar_sets_as_often_as_it_says():
    rng = np.random.default_rng(3)
    met = 0
    for _ in range(200):
        shared = rng.integers(0, 1 << 63, 160).astype(np.uint64)
        a, b = (np.concatenate([shared, rng.integers(0, 1 << 63, 20).astype(np.uint64)]) for _ in range(2))  # 160 / 200
        met += (chosen_path.minwise(a) == chosen_path.minwise(b)).sum()
    assert met / 200 / chosen_path.COORDINATES == pytest.approx(0.8, abs=0.02)


# --- cover trees -------------------------------------------------------------------

NEGATIVES = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def mined(df):
    return rows(hard_negatives.hard_negatives(df, F.col("vec_id") % 100 == 0).select(NEGATIVES))


@pytest.mark.parametrize("part,query_part,cells", [(4096, 1024, 1024), (40, 2, 5), (10, 1024, 1)])
def test_hard_negatives(spark, sf_dir, monkeypatch, part, query_part, cells):
    for name, value in (("PART", part), ("QUERY_PART", query_part), ("MAX_CELLS", cells)):
        monkeypatch.setattr(hard_negatives, name, value)
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    want = plain.negatives([(r["vec_id"], r["label"], r["embedding"]) for r in table.collect()])
    assert want and mined(table) == want


def test_hard_negatives_on_odd_rows(spark):
    rng = np.random.default_rng(5)
    some = [(i, int(i) % 3, [float(x) for x in np.round(rng.standard_normal(6) + (i % 3), 2)]) for i in range(1, 400)]
    some += [(i, 1, [1.0] * 6) for i in range(500, 560)]  # a hot group of equal vectors
    some += [
        (600, None, [1.0] * 6), (601, 1, None), (602, 1, []), (603, 1, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (604, 1, [float("nan")] * 6),
        (605, 1, [float("inf")] * 6), (700, 2, [0.0] * 6), (None, 1, [1.0] * 6), (800, -4, [2.0] * 6), (900, 4, [1e6] * 6), (901, 4, [-1e6] * 6),
    ]
    schema = "vec_id long, label int, embedding array<double>"
    clash = spark.createDataFrame(some, schema).withColumns({"Rank": F.lit(1), "v": F.lit("x"), "score": F.lit(0)}).repartition(3)
    assert mined(clash) == plain.negatives(some)
    assert mined(clash.limit(0)) == Counter()
    repeated = clash.unionByName(clash)  # each row counts as a candidate of its own
    assert mined(repeated.filter("vec_id = 100 OR label = 2")).total() > 0
    other = clash.unionByName(clash.filter("vec_id = 5").withColumn("embedding", F.expr("array(1D, 2D)")).withColumn("vec_id", F.lit(5000).cast("long")))
    assert mined(other) == plain.negatives(some)  # another length


def test_bounds_hold_for_all_points_below_a_node():
    rng = np.random.default_rng(9)
    x = np.floor(rng.standard_normal((700, 12)) * 300)
    most = np.sqrt((x * x).sum(1).max())
    tree = hard_negatives.CoverTree(np.arange(700), np.arange(700) % 3, x, most)
    q = np.floor(rng.standard_normal((20, 12)) * 200)
    norms = np.sqrt((q * q).sum(1))

    def points(node):
        a, b = tree.first[node], tree.last[node]
        return tree._order[a:b].tolist() if tree.leaf[node] else [p for c in range(a, b) for p in points(c)]

    assert sorted(p for r in tree.roots for p in points(r)) == list(range(700))
    for node in range(len(tree.first)):
        below = q @ tree.x[points(node)].T
        least, greatest = tree.bounds(node, q, norms)
        assert (below.min(1) >= least).all() and (below.max(1) <= greatest).all()
        lifted = hard_negatives.augmented(tree.x, most)
        reach = np.sqrt(((lifted[points(node)] - lifted[tree.centre[node]]) ** 2).sum(1))
        assert reach.max() <= tree.radius[node] * (1 + 1e-9)


# --- phrases -------------------------------------------------------------------------

PHRASES = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def texts_of(df):
    return [(r["lang"], r["text"]) for r in df.select("lang", "text").collect()]


@pytest.mark.parametrize("chunk", [32 << 20, 20_000])
def test_phrases(spark, sf_dir, monkeypatch, chunk):
    monkeypatch.setattr(phrases, "CHUNK_BYTES", chunk)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(3)
    for least, top in ((30, 2000), (3, 2000), (2, 7)):
        want = plain.phrase_rows(texts_of(docs), least, top=top)
        assert want and rows(phrases.phrases(docs, least, top=top).select(PHRASES)) == want


def test_phrases_on_odd_rows(spark, odd, empty, monkeypatch):
    monkeypatch.setattr(phrases, "SLICE", 500)  # long texts are cut between words
    more = spark.createDataFrame(
        [(None, None, "a b. a b, A B\x0ba b cé\tcé !! a b " * 5, 1)] * 3 + [("", None, "İx İx . y " * 9, 2), ("fr", None, None, 3)],
        "lang string, source string, text string, rank int",
    )
    both = odd.unionByName(more, allowMissingColumns=True)
    for least in (2, 5):
        assert rows(phrases.phrases(both, least).select(PHRASES)) == plain.phrase_rows(texts_of(both), least)
    assert phrases.phrases(empty).count() == 0


def test_a_full_filter_changes_no_result(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = rows(phrases.phrases(docs, 3))
    monkeypatch.setattr(phrases, "MOST_BITS", 1 << 12)
    assert rows(phrases.phrases(docs, 3)) == want
    held = phrases.filter_of(written(spark.range(5000).select(F.col("id").alias("w1"), F.col("id").alias("w2")), "pairs"), 2)
    assert len(held) == 64


def test_a_filter_is_gathered_in_pages(spark):
    n = 20_000
    pairs = written(spark.range(n, numPartitions=3).select(F.col("id").alias("w1"), (F.col("id") * 7).alias("w2")), "pairs")
    held = phrases.filter_of(pairs, 2)
    assert phrases.filter_pages(pairs, 2, len(held) << 6).count() <= 3 * phrases.PAGES
    want = np.zeros(len(held), np.uint64)
    for at in phrases._places_in_filter([np.arange(n), np.arange(n) * 7], len(held) << 6):
        np.bitwise_or.at(want, (at >> np.uint64(6)).astype(int), np.uint64(1) << (at & np.uint64(63)))
    assert (held == want).all() and want.any()


# --- attention scores ------------------------------------------------------------------


@pytest.mark.parametrize("scale", [0.2, 5.0, 50.0])
def test_attention_is_finite_and_causal_with_any_weights(scale):
    rng = np.random.default_rng(6)
    model = language_model.Model(rng.poisson(0.01, language_model.IDS * language_model.KINDS).astype(float))
    model.set_prior(rng.integers(0, 50, language_model.CLASSES**2).astype(float))
    model.weights = rng.standard_normal(len(model.weights)) * scale
    w = model.parts(model.weights)
    ids = rng.integers(0, 50_000, 24).astype("<u2")
    own = language_model.Sequences(
        {"lengths": chunks.squeeze(np.array([24], "<u4")), "training": np.packbits([True]).tobytes(), "ids": chunks.squeeze(ids)}
    )
    batch = own.batch(*own.windows())
    assert np.isfinite(model.slope(model.weights, *batch)).all()
    score = model.scores(w, *batch)
    assert np.isfinite(score).all() and (score < 0).all()
    one = model.forward(w, batch[0][:1], batch[3][:1])
    changed = batch[0][:1].copy()
    changed[:, -1] = 5
    two = model.forward(w, changed, batch[3][:1])
    assert np.array_equal(one["p"][:-1], two["p"][:-1])
