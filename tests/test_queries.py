"""Every query against its SQL, and the shape of the plans."""

import re

import pytest

import __spark_entry__ as contract
from compare import difference, duck
from filingflow.plans.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, con, name):
    assert difference(contract.queries()[name](spark, sf_dir), con, contract.oracle_sql()[name]) is None


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


NOT_PLANNED_HERE = {"stream_dedup", "stream_upsert", "stream_retry", "publish_roundtrip", "object_store_write", "poll_twice", "poll_compacted", "poll_stream", "object_files", "upsert_compacted", "consume_messages"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - NOT_PLANNED_HERE))
def test_no_query_pairs_all_rows_or_sorts_in_one_task(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    # only a total without groups may end in one task, after partial aggregates
    assert not re.search(r"(Sort|Window)[^\n]*\n[^\n]*Exchange SinglePartition", plan)


@pytest.mark.parametrize("name", ["retry_state", "attempt_numbers", "failure_latest", "upsert_latest"])
def test_ranked_rows_are_cut_before_the_shuffle(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    below_exchange = plan[plan.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in below_exchange and "Partial" in below_exchange


def test_retry_state_shuffles_once(spark, sf_dir):
    assert plan_of(QUERIES["retry_state"](spark, sf_dir)).count("Exchange hashpartitioning") == 1


def test_scans_read_the_columns_they_need(spark, sf_dir):
    plan = QUERIES["outcome_counts"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_type:string>" in plan


def test_payloads_are_in_no_exchange(spark, sf_dir):
    """Also where Spark itself would broadcast nothing."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(QUERIES["filing_ingest"](spark, sf_dir))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for node in re.findall(r"Exchange hashpartitioning[^\n]*\n[^\n]*", plan):
        assert "content" not in node and "body" not in node, node


def test_nothing_is_left_behind(spark, sf_dir):
    import glob

    from filingflow.session import release, shared_dir

    release(spark)
    root = shared_dir(spark).removeprefix("file:")
    before = set(glob.glob(f"{root}/*"))
    QUERIES["page_prefix"](spark, sf_dir).count()
    assert set(glob.glob(f"{root}/*")) > before
    release(spark)
    assert set(glob.glob(f"{root}/*")) <= before
