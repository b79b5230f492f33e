"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as entry_point
from shelfmark.plans.queries import REGISTRY
from tests.oracle import connect, differences

SKEWED = (
    "held_per_issue",
    "remote_reconcile",
    "upload_candidates",
    "issue_articles_inner",
    "issue_articles_semi",
    "missing_issues",
    "collect_queue",
    "job_doi_list",
    "job_doi_list_distinct",
    "job_work_queue",
    "job_work_queue_positions",
)


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_sql(spark, sf_dir, duck, name):
    query = REGISTRY[name]
    assert differences(duck, query.run(spark, sf_dir), query.sql) == []


@pytest.mark.parametrize("name", SKEWED)
def test_split_keys_change_nothing(spark, sf_dir, duck, skewed, name):
    query = REGISTRY[name]
    assert differences(duck, query.run(spark, sf_dir), query.sql) == []


def test_entry_point(spark):
    assert entry_point.entry(spark).columns == [
        "year",
        "no_docs",
        "issue_url",
        "expected",
        "downloaded",
    ]
    assert REGISTRY.keys() <= entry_point.queries().keys()
    assert REGISTRY.keys() <= entry_point.oracle_sql().keys() <= entry_point.queries().keys()


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_no_query_compares_all_pairs(spark, sf_dir, name):
    if name == "stream_exports":
        return
    plan = REGISTRY[name].run(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "NestedLoopJoin" not in plan
