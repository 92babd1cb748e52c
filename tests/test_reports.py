import pytest
from pyspark.sql import functions as F

from newsmill.operators import counters, reports
from newsmill.sources import writers

SCHEMA = "source string, language string, title string, heat_score double, category string, url_hash string, published_date string"


@pytest.mark.parametrize("value", [12.25, 12.75, 0.35, 0.25, 2.5, 1234567.05, 0.0, 33.333, 8.95])
def test_one_decimal_rounds_like_printf(spark, value):
    assert spark.range(1).select(reports.one_decimal(F.lit(value)).alias("r")).first().r == f"{value:.1f}"


def lines_of(articles):
    return [r.line for r in reports.report_lines(articles).collect()]


def test_report(spark):
    rows = spark.createDataFrame([
        ("S1", "en", "x" * 90, 12.0, "MODERATELY_RELEVANT", "h1", None),
        ("S1", "es", None, 12.5, "MODERATELY_RELEVANT", "h2", None),
        ("S2", "en", "t", 60.0, "EXTREMELY_RELEVANT", "h3", None)], SCHEMA)
    rule = "=" * 80
    assert lines_of(rows) == [
        "", rule, "SCRAPING SUMMARY REPORT", rule, "", "Total Articles in Database: 3",
        "", "By Relevance Category:",
        f"  {'EXTREMELY_RELEVANT':25} {1:4} articles (avg score: 60.0)",
        f"  {'MODERATELY_RELEVANT':25} {2:4} articles (avg score: 12.2)",
        "", "By Source:", f"  {'S1':30} {2:4} articles (avg score: 12.2)", f"  {'S2':30} {1:4} articles (avg score: 60.0)",
        "", "By Language:", f"  {'English':30} {2:4} articles", f"  {'Spanish':30} {1:4} articles",
        "", "Top 10 Most Relevant Articles:",
        "", "  1. [60.0] t", "     Source: S2 | Category: EXTREMELY_RELEVANT",
        "", "  2. [12.5] ", "     Source: S1 | Category: MODERATELY_RELEVANT",
        "", "  3. [12.0] " + "x" * 70, "     Source: S1 | Category: MODERATELY_RELEVANT",
        "", rule]


def test_empty_report(spark):
    lines = lines_of(spark.createDataFrame([], SCHEMA))
    assert "!!!No articles were saved." in lines and "By Source:" not in lines
    assert lines[5] == "Total Articles in Database: 0" and len(lines) == 16


def test_files(spark, tmp_path):
    rows = spark.createDataFrame([
        ("S", "en", 'say "hi", all', 12.0, "c", "h1", "2024-07-01"), ("S", "en", "zero", 0.0, "c", "h2", None)], SCHEMA)
    writers.write_export(rows, str(tmp_path / "csv"))
    parts = [p.read_text().splitlines() for p in sorted((tmp_path / "csv").glob("part-*.csv"))]
    assert {lines[0] for lines in parts if lines} == {"Title,Source,Score,Date"}
    assert [line for lines in parts for line in lines[1:]] == ['"say ""hi"", all",S,12.0,2024-07-01']
    writers.write_report(reports.report_lines(rows), str(tmp_path / "txt"))
    report = "".join(p.read_text() for p in (tmp_path / "txt").glob("part-*"))
    assert "Total Articles in Database: 2" in report.splitlines()
    urls = spark.createDataFrame([("b",), ("a",), ("b",), ("c",)], "url string")
    writers.write_url_list(urls, str(tmp_path / "urls"))
    listed = "".join(p.read_text() for p in sorted((tmp_path / "urls").glob("part-*")))
    assert listed.split() == ["a", "b", "c"]


def test_hit_rate_of_nothing(spark):
    rows = spark.createDataFrame([], "outcome string, copies bigint")
    row = counters.run_counters(rows, "copies").first()
    assert row.total == 0 and row.hit_rate == 0.0
