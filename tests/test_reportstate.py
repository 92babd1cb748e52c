import random

import pytest
from pyspark.sql import functions as F

from newsmill.operators import reports
from newsmill.plans import processing
from newsmill.sources import reportstate, writers

COLUMNS = "title string, source string, language string, category string, heat_score double, url_hash string"


def made(spark, n, seed=0):
    rng = random.Random(seed)
    rows = [(rng.choice([None, f"T{i}"]), rng.choice("abc"), rng.choice(["en", "es", None]), rng.choice("XYZ"),
             float(rng.choice([0, 1, 5, 5, 60])), f"h{i:03d}") for i in range(n)]
    return spark.createDataFrame(rows, COLUMNS)


def listed(df):
    return [tuple(r) for r in df.collect()]


def everything(spark, root):
    return [listed(f(spark, root)) for f in (reportstate.report, reportstate.total, reportstate.by_relevance, reportstate.by_source)]


def plain(rows):
    return [listed(f(rows)) for f in (reports.report_lines, reports.total_articles, reports.by_relevance, reports.by_source)]


@pytest.mark.parametrize("n,batches", [(0, 1), (7, 3), (90, 4)])
def test_parts_add_up(spark, tmp_path, n, batches):
    """Any split into batches gives the report of all rows, an empty batch and ties at the tenth place included."""
    rows = made(spark, n, n)
    for b in range(batches):
        part = rows.filter(F.pmod(F.xxhash64("url_hash"), F.lit(batches)) == b)
        reportstate.write_state(part, str(tmp_path), f"run-{b}")
    assert everything(spark, str(tmp_path)) == plain(rows)
    assert sorted(listed(reportstate.by_language(spark, str(tmp_path))), key=str) == sorted(listed(reports.by_language(rows)), key=str)


def test_a_repeated_batch_replaces_its_part(spark, tmp_path):
    first, second = made(spark, 30, 1), made(spark, 12, 2)
    reportstate.write_state(first, str(tmp_path), 0)
    reportstate.write_state(made(spark, 50, 3), str(tmp_path), 1)
    reportstate.write_state(second.withColumn("url_hash", F.concat(F.lit("x"), "url_hash")), str(tmp_path), 1)
    assert everything(spark, str(tmp_path)) == plain(first.unionByName(second.withColumn("url_hash", F.concat(F.lit("x"), "url_hash"))))


def test_no_state(spark, tmp_path):
    assert everything(spark, str(tmp_path / "none")) == plain(made(spark, 0))


def test_runs_keep_the_state(spark, tmp_path):
    """A stored batch leaves its part of the report, which then reads no text of any article."""
    root, at = str(tmp_path), F.lit("2024-10-01 00:00:00").cast("timestamp")
    writers.create_store(spark, root)
    for number in range(2):
        rows = spark.createDataFrame(
            [(f"http://x/{number}/{i}", "s", f"t{i}", f"heat death {i} " * (i + 1), "en") for i in range(12)],
            "url string, source string, title string, text string, language string")
        candidates = rows.select("url", "source", "language")
        done = processing.evaluate(candidates, rows.select("url", "title", "text"), processing.stored_before(spark, root, number), extract=None)
        processing.store_outcomes(done, root, number, at, report=True)
    articles = writers.read_table(spark, root, "articles")
    assert articles.count() > 12
    assert everything(spark, root) == plain(articles)
    assert "text_content" not in reportstate.report(spark, root)._jdf.queryExecution().executedPlan().toString()
