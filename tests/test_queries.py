"""Every registered query against its SQL on the smallest tables, and properties of the plans."""

import pytest

import __spark_entry__ as entry_points
from compare import compare
from workload import registry

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_matches_its_sql(spark, name):
    assert name in entry_points.oracle_sql()
    assert compare(spark, FOLDER, [name]) == []


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_no_join_without_a_key(spark, name):
    if name in ("incremental_stream", "two_runs_stored"):
        return
    plan = entry_points.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name,calls", [("source_crawl", 1), ("page_articles", 1), ("rejected_pages", 1), ("page_scores", 1)])
def test_python_runs_once_per_row(spark, name, calls):
    plan = entry_points.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython [") == calls


@pytest.mark.parametrize("name,column", [("score_articles", "text"), ("url_hashes", "url")])
def test_scans_read_only_what_is_needed(spark, name, column):
    plan = entry_points.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert column in plan and "n_chars" not in plan and "html" not in plan


def test_language_counts_read_no_text(spark):
    plan = entry_points.queries()["language_report"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "regexp_extract" not in plan and "text#" not in plan


def test_only_the_newest_are_scored(spark):
    plan = entry_points.queries()["newest_articles"](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.rindex("GlobalLimit 10"):]
    assert "regexp_extract_all" in plan and "regexp_extract_all" not in below
