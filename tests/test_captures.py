import json
import random

import pytest
from pyspark.sql import functions as F

from newsmill.operators import captures as cap
from newsmill.sources import readers


@pytest.mark.parametrize("n", [1, 49, 50, 51, 99, 100, 149, 150, 151])
def test_even_sample_like_a_list_slice(spark, n):
    rows = [(i % 3, f"{20240601000000 + i:014d}", f"u{i}") for i in range(n)]
    random.Random(n).shuffle(rows)
    got = cap.even_sample(spark.createDataFrame(rows, "section_ord int, ts string, url string")).collect()
    ordered = sorted(rows)
    kept = ordered[::len(ordered) // 50][:50] if len(ordered) > 50 else ordered
    assert [(r.section_ord, r.ts, r.url) for r in sorted(got, key=lambda r: r.capture_ord)] == kept
    assert sorted(r.capture_ord for r in got) == list(range(len(kept)))


CAPTURES = [
    ("u", "20240531235959", 200), ("u", "20240601000000", 500), ("u", "20240601080000", 200), ("u", "20240601070000", 200),
    ("u", "20240930235959", 200), ("u", "20241001000000", 200), ("v", "20240701000000", 404), ("w", "20240702000000", 200)]


def test_range_daily_and_first(spark):
    captures = spark.createDataFrame(CAPTURES, "url string, ts string, statuscode int")
    inside = cap.in_range(captures)
    assert inside.count() == 4
    assert sorted((r.url, r.ts) for r in cap.daily(inside).collect()) == [
        ("u", "20240601070000"), ("u", "20240930235959"), ("w", "20240702000000")]
    urls = spark.createDataFrame([(0, "u"), (1, "v"), (2, "x"), (3, "u")], "n int, url string")
    got = {r.n: (r.ts, r.archive_url) for r in cap.first_capture(urls, captures).collect()}
    first = ("20240601070000", "https://web.archive.org/web/20240601070000/u")
    assert got == {0: first, 1: (None, None), 2: (None, None), 3: first}
    plan = inside._jdf.queryExecution().optimizedPlan().toString()
    assert "statuscode" in plan


def test_index_answers(spark):
    answers = [("u", json.dumps([["timestamp"], ["20240601"], ["20240602"]])), ("v", "[]"), ("w", json.dumps([["timestamp"]]))]
    rows = readers.parse_capture_index(spark.createDataFrame(answers, "url string, value string")).collect()
    assert sorted((r.url, r.ts) for r in rows) == [("u", "20240601"), ("u", "20240602")]


def test_url_list(spark, tmp_path):
    path = tmp_path / "urls.txt"
    path.write_text("  https://a/1 \n\n\t\nhttps://a/2\nhttps://a/1\n \u00a0https://a/3\x1c\n", encoding="utf-8")
    rows = readers.read_url_list(spark, str(path)).orderBy("file", "block", "row").collect()
    assert [r.url for r in rows] == ["https://a/1", "https://a/2", "https://a/1", "https://a/3"]


def test_new_urls_and_preview(spark):
    captures = spark.createDataFrame([(i, f"s{i}") for i in range(4)], "capture_ord bigint, section string")
    found = [(0, "a"), (0, "b"), (0, "a"), (2, "b"), (2, "c"), (3, "a")]
    got = cap.new_urls_per_capture(captures, spark.createDataFrame(found, "capture_ord bigint, url string"))
    assert [(r.capture_ord, r.new_urls, r.total_urls) for r in got.orderBy("capture_ord").collect()] == [
        (0, 2, 2), (1, 0, 2), (2, 1, 3), (3, 0, 3)]
    many = spark.createDataFrame([(f"u{i:02d}",) for i in range(13)], "url string")
    rows = [r.entry for r in cap.preview(many).orderBy("pos").collect()]
    assert rows == [f"u{i:02d}" for i in range(10)] + ["... and 3 more"]
    assert cap.preview(many.limit(3)).count() == 3


def test_capture_links(spark):
    page = ('<a href="/web/20240701/https://www.ivpressonline.com/a/article_1.html">x</a>'
            '<a href="https://www.ivpressonline.com/article_2.html">y</a><a href="//ivpressonline.com/article_3.html">'
            '<a href="/web/20240701/https://other.org/article_4.html"><a href="https://ivpressonline.com/about.html">')
    pages = spark.createDataFrame([(5, page)], "capture_ord int, html string")
    got = {(r.capture_ord, r.url) for r in cap.capture_article_urls(pages).collect()}
    assert got == {(5, "https://www.ivpressonline.com/a/article_1.html"), (5, "https://www.ivpressonline.com/article_2.html"),
                   (5, "https://ivpressonline.com/article_3.html")}
    assert F is not None
