"""What must reach the scan, and how key lists of different sizes are joined."""

import datetime as dt

from pyspark.sql import functions as F

from newsmill.operators import captures as cap
from newsmill.operators import discovery, matching, ordering, search
from newsmill.session import cut_lineage
from newsmill.sources.config import NEWS_SOURCES, sections, source_table


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def stored(spark, tmp_path, rows, schema):
    spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(str(tmp_path))
    return spark.read.parquet(str(tmp_path))


def test_capture_range_reaches_the_scan(spark, tmp_path):
    captures = stored(spark, tmp_path, [("u", "20240701000000", 200)], "url string, ts string, statuscode int")
    plan = plan_of(cap.daily(cap.in_range(captures)))
    pushed = plan[plan.index("PushedFilters"):]
    assert "GreaterThanOrEqual(ts,20240601000000)" in pushed and "EqualTo(statuscode,200)" in pushed


def test_publication_range_reaches_the_scan(spark, tmp_path):
    rows = stored(spark, tmp_path, [("u", "x", None)], "url string, text string, published_date date")
    first, last = F.lit("2024-06-01").cast("date"), F.lit("2024-06-30").cast("date")
    assert "LessThanOrEqual(published_date" in plan_of(rows.filter(F.col("published_date").between(first, last)))
    plan = plan_of(search.search(
        search.published_between(rows, dt.date(2024, 6, 1), dt.date(2024, 6, 30)), F.col("text"), (("a",),)))
    assert "GreaterThanOrEqual(published_date" in plan[plan.index("PushedFilters"):]


def test_section_urls_reach_the_scan(spark, tmp_path):
    pages = stored(spark, tmp_path, [("u", "<p>")], "url string, html string")
    plan = plan_of(discovery.section_pages(pages, sections(source_table(spark, NEWS_SOURCES))))
    assert "In(url, [" in plan[plan.index("PushedFilters"):]
    assert "BroadcastHashJoin" in plan


def test_key_lists_by_size(spark, tmp_path, monkeypatch):
    pages = stored(spark, tmp_path, [(f"u{i}", "x") for i in range(50)], "url string, html string")
    keys = cut_lineage(spark.createDataFrame([("u1",), ("u2",), ("gone",)], "url string"))
    few = ordering.narrowed_to(pages, keys, ["url"])
    assert "In(url, [" in plan_of(few) and few.count() == 2
    monkeypatch.setattr(ordering, "FILTER_VALUES", 2)
    medium = ordering.narrowed_to(pages, keys, ["url"])
    assert "In(url, [" not in plan_of(medium) and "BroadcastHashJoin" in plan_of(medium) and medium.count() == 2
    monkeypatch.setattr(ordering, "BROADCAST_BYTES", 3)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        long = ordering.narrowed_to(pages, keys, ["url"])
        assert "BroadcastHashJoin" not in plan_of(long) and long.count() == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_top_n_is_trimmed_before_the_shuffle(spark, tmp_path):
    links = stored(spark, tmp_path, [("s", 0, 0, "u", True)],
                   "source string, section_ord int, pos int, url string, is_valid boolean")
    plan = plan_of(discovery.crawl(links, 10))
    partial = plan[plan.index("WindowGroupLimit"):]
    assert "10, Partial" in partial and "partial_min" in plan and "SortAggregate" not in plan


def test_matches_need_no_shuffle(spark, tmp_path):
    from newsmill.functions import scoring
    rows = stored(spark, tmp_path, [("u", "heat death")], "url_hash string, text string")
    scored = scoring.score_text(rows, F.col("text"))
    for frame in (matching.match_rows(scored), matching.category_breakdown(scored), scored.filter("heat_score >= 10")):
        plan = plan_of(frame)
        assert "Exchange" not in plan
        assert plan.count("named_struct(pattern_ord, 0,") + plan.count("struct(pattern_ord, 0,") <= 2
