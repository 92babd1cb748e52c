import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from newsmill.operators import discovery, ordering
from newsmill.sources.config import NEWS_SOURCES, sections, source_table


def link_rows(rng, n):
    """Random links in which one source and one URL hold a large part of the rows."""
    rows = []
    for i in range(n):
        source = rng.choice(["hot"] * 5 + ["b", "c"])
        url = rng.choice(["u0"] * 3 + [f"u{k}" for k in range(40)])
        rows.append((source, i // 7, i % 7, url, rng.random() < 0.7))
    return rows


SCHEMA = "source string, section_ord int, pos int, url string, is_valid boolean"


def crawl_by_loop(rows, cap):
    found = {}
    for source, section, pos, url, valid in sorted(rows, key=lambda r: (r[1], r[2])):
        if valid and url not in found.setdefault(source, {}):
            found[source][url] = (section, pos)
    return {(s, u, *at) for s, urls in found.items() for u, at in list(urls.items())[:cap]}


@pytest.mark.parametrize("cap,trim", [(3, 1000), (10, 2), (1000, 1000)])
def test_crawl(spark, monkeypatch, cap, trim):
    monkeypatch.setattr(ordering, "TRIMMED_BEFORE_SHUFFLE", trim)
    rows = link_rows(random.Random(cap), 400)
    links = spark.createDataFrame(rows, SCHEMA)
    got = {(r.source, r.url, r.section_ord, r.pos) for r in discovery.crawl(links, cap).collect()}
    assert got == crawl_by_loop(rows, cap)


def test_counters_include_silent_sources(spark):
    rows = link_rows(random.Random(1), 200)
    sources = spark.createDataFrame([("hot",), ("b",), ("c",), ("silent",)], "source string")
    got = {r.source: (r.total_links, r.valid_links)
           for r in discovery.crawl_counters(spark.createDataFrame(rows, SCHEMA), sources).collect()}
    for name in ("hot", "b", "c"):
        mine = [r for r in rows if r[0] == name]
        assert got[name] == (len(mine), len({r[3] for r in mine if r[4]}))
    assert got["silent"] == (0, 0)


def test_section_pages_and_links(spark):
    sources = source_table(spark, NEWS_SOURCES)
    pages = spark.createDataFrame([
        ("https://www.ivpressonline.com/news/local/", '<a href="/news/local/article_1.html"><a href="/about">'),
        ("https://www.ivpressonline.com/news/", '<a href="/news/local/article_1.html"><a href="/x/article_2.html">'),
        ("https://www.ivpressonline.com/adelante-valle/", '<a href="/av/article_3.html">'),
        ("https://calexicochronicle.com/", '<a href="/2024/07/01/a-story-of-the-town/">'),
        ("https://unrelated.org/", '<a href="/article_9.html">')], "url string, html string")
    listing = discovery.section_pages(pages, sections(sources))
    found = discovery.crawl(discovery.section_links(listing))
    got = {(r.source, r.url, r.section_ord) for r in found.collect()}
    assert got == {
        ("Imperial Valley Press", "https://www.ivpressonline.com/news/local/article_1.html", 0),
        ("Imperial Valley Press", "https://www.ivpressonline.com/x/article_2.html", 1),
        ("Adelante Valle", "https://www.ivpressonline.com/av/article_3.html", 0),
        ("Calexico Chronicle", "https://calexicochronicle.com/2024/07/01/a-story-of-the-town/", 0)}
    named = {r.source: (r.language, r.source_bias, r.source_ord)
             for r in discovery.with_attributes(found, sources).collect()}
    assert named["Adelante Valle"] == ("es", "LOCAL-UNRATED", 4)


def test_date_range(spark):
    def frame(rows):
        return spark.createDataFrame(rows, SCHEMA)
    u = "https://calexicochronicle.com/2024/07/{:02d}/s/"
    archive = frame([("a", 0, 0, "plain", True), ("a", 0, 1, u.format(31), True), ("a", 0, 2, "plain", True)])
    browse = frame([("a", 0, 0, u.format(2), True), ("b", 0, 0, u.format(3), True), ("b", 0, 1, u.format(9), True),
                    ("b", 1, 0, "undated", True), ("b", 1, 1, u.format(5), True), ("b", 1, 2, "bad", False)])
    found = discovery.discover_in_range(archive, browse, dt.date(2024, 7, 1), dt.date(2024, 7, 5))
    ordered = found.withColumn("source_ord", F.when(F.col("source") == "a", 0).otherwise(1))
    rows = ordered.orderBy(*discovery.newest_first()).collect()
    assert [(r.source, r.url, r.via) for r in rows] == [
        ("a", u.format(31), "archive"), ("a", "plain", "archive"),
        ("b", u.format(5), "section"), ("b", u.format(3), "section"), ("b", "undated", "section")]
    assert [(r.source, r.articles) for r in discovery.found_per_source(found).collect()] == [("b", 3), ("a", 2)]


@pytest.mark.parametrize("selection,size", [
    (None, 120), ("", 120), (" ", 120), ("500", 120), ("7", 7), (7, 7), ("0", 20), ("-3", 20), ("many", 50), ("7.5", 50)])
def test_selection(spark, selection, size):
    rows = spark.range(120).withColumnRenamed("id", "k")
    got = discovery.select_articles(rows, selection, [F.col("k").desc()])
    assert sorted(r.k for r in got.collect()) == list(range(120 - size, 120))


def test_global_index_and_running_total(spark, monkeypatch):
    monkeypatch.setattr(ordering, "BLOCK_ROWS", 7)
    values = random.Random(3).sample(range(1000), 333)
    rows = spark.createDataFrame([(v, v % 5) for v in values], "v int, w int").repartition(8)
    indexed = ordering.with_global_index(rows, [F.col("v").desc()], "i")
    assert {r.v: r.i for r in indexed.collect()} == {v: i for i, v in enumerate(sorted(values, reverse=True))}
    total = {r.i: r.t for r in ordering.running_total(indexed, "i", "w", "t").collect()}
    running = 0
    for i, v in enumerate(sorted(values, reverse=True)):
        running += v % 5
        assert total[i] == running
    monkeypatch.setattr(ordering, "SMALL_LIMIT", 10)
    assert sorted(r.v for r in ordering.first_n(rows, [F.col("v")], 40).collect()) == sorted(values)[:40]
