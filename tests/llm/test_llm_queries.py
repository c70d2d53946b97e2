"""Queries against SQL where there is some, and the pipeline."""

import pytest
from compare import difference, duck
from pyspark.sql import functions as F

import corpus_pipeline
import __spark_entry__ as contract
from filingflow.llm.oracle import ORACLE
from filingflow.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf_dir, name):
    assert difference(QUERIES[name](spark, sf_dir), duck(sf_dir), ORACLE[name]) is None


def test_one_query_per_operator():
    names = set(contract.queries())
    assert all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 11)) and "pipeline" in names


@pytest.mark.parametrize("name", ["op3_poisson_mixing", "op5_quality_rules", "op10_license_scan"])
def test_native_operators_run_no_python(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, sf_dir).cache()
        assert after.columns == docs.columns and dict(after.dtypes) == dict(docs.dtypes)
        assert after.join(before, "doc_id", "left_anti").isEmpty()
        before = after
    placed = corpus_pipeline.STAGES[-1][1](spark, before, sf_dir)
    assert placed.filter("piece = 0").count() == before.count()
    kept = QUERIES["op5_quality_rules"](spark, sf_dir).filter("kept").count()
    assert kept >= before.select("doc_id").distinct().count()


def test_pipeline_stages_on_odd_rows(spark, sf_dir, odd):
    docs = odd.withColumn("n_chars", F.length("text").cast("long")).drop("N_Words")
    for _, stage in corpus_pipeline.STAGES[1:-1]:
        assert set(stage(spark, docs, sf_dir).columns) == set(docs.columns)
        assert stage(spark, docs.limit(0), sf_dir).count() == 0
    assert corpus_pipeline.STAGES[1][1](spark, docs, sf_dir).filter("doc_id = 3").count() == 1


def test_near_duplicates_keep_different_texts_of_an_id(spark, sf_dir):
    one, two, three = (" ".join(f"{c}{i}" for i in range(100)) for c in "abc")
    rows = [(1, one), (2, two), (2, three), (2, three + " end"), (2, " "), (3, one + " end"), (3, two), (4, " "), (4, None), (5, three), (None, one)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [(r["doc_id"], (r["text"] or " ").removesuffix(" end")) for r in corpus_pipeline.near_duplicates(spark, df, sf_dir).collect()]
    assert sorted(got, key=str) == sorted([(1, one), (2, two), (2, three), (4, " "), (None, one)], key=str)


def test_pipeline_runs(spark, sf_dir):
    assert corpus_pipeline.run(spark, sf_dir).count() > 0
