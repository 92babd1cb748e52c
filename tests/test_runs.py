import datetime as dt

import pytest
from pyspark.sql import functions as F

from newsmill.functions import urls
from newsmill.functions.lexicon import SEARCH_TERMS
from newsmill.operators import counters
from newsmill.plans import processing, runs
from newsmill.session import fresh_folder
from newsmill.sources import writers
from newsmill.sources.config import DATE_RANGE_SOURCES, NEWS_SOURCES, source_table
from newsmill.streaming import incremental

FILL = " filler" * 20
HEAT = "heat death and heat wave"


def at():
    return F.lit("2024-10-01 00:00:00").cast("timestamp")


def page(title, body):
    return f"<html><h1>{title}</h1><article>{body}{FILL}</article></html>"


def page_table(spark, rows):
    return spark.createDataFrame(rows, "url string, html string")


def no_store(spark):
    return spark.createDataFrame([], "url_hash string")


def hashes(spark, given):
    return spark.createDataFrame([(u,) for u in given], "url string").select(urls.url_hash(F.col("url")).alias("url_hash"))


LISTED = [("a/hit",), ("a/low",), ("a/short",), ("a/gone",), ("a/known",), ("a/hit",), ("a/hit",), ("a/low",), ("a/gate",)]


def list_run(spark):
    pages = page_table(spark, [
        ("a/hit", page("T", HEAT)), ("a/low", page("T", "heat wave")), ("a/short", "<article>x</article>"),
        ("a/known", page("T", HEAT)), ("a/gate", page("heated debate", HEAT)), ("a/other", page("T", HEAT)),
        ("a/hit", page("T", HEAT))])
    rows = spark.createDataFrame([(u[0], i) for i, u in enumerate(LISTED)], "url string, n int")
    return runs.url_list_run(rows, pages, hashes(spark, ["a/known"]))


def test_url_list_run(spark):
    out = list_run(spark)
    got = {r.url: (r.outcome, r.copies) for r in out.collect()}
    assert got == {"a/hit": ("saved", 3), "a/low": ("score_too_low", 2), "a/short": ("score_too_low", 1),
                   "a/gone": ("errors", 1), "a/known": ("already_scraped", 1), "a/gate": ("score_too_low", 1)}
    row = counters.run_counters(out, "copies").first()
    assert (row.total, row.processed, row.saved, row.score_too_low, row.already_scraped, row.errors) == (9, 5, 1, 4, 3, 1)
    assert row.hit_rate == 20.0


def test_store_is_written_once_and_repeats_are_ignored(spark):
    root = fresh_folder(spark, "store")
    writers.create_store(spark, root)
    writers.create_store(spark, root)
    sources = spark.createDataFrame([(runs.SINGLE_SOURCE,), ("silent",)], "source string")
    for _ in range(2):  # the same batch again replaces itself
        assert processing.stored_before(spark, root, 0).count() == 0
        processing.store_outcomes(list_run(spark), root, 0, at(), sources)
    counts = {t: writers.read_table(spark, root, t).count() for t in ("articles", "keyword_matches", "error_log", "scrape_sessions")}
    assert counts == {"articles": 1, "keyword_matches": 2, "error_log": 1, "scrape_sessions": 2}
    article = writers.read_table(spark, root, "articles").first()
    assert (article.url, article.heat_score, article.category) == ("a/hit", 12.0, "MODERATELY_RELEVANT")
    assert [m.keyword for m in article.keywords_matched] == ["heat death", "heat wave"]
    # A later batch finds the article stored.
    pages = page_table(spark, [("a/hit", page("T", HEAT))])
    again = runs.url_list_run(spark.createDataFrame([("a/hit", 0)], "url string, n int"), pages,
                              processing.stored_before(spark, root, 1))
    processing.store_outcomes(again, root, 1, at())
    assert writers.read_table(spark, root, "articles").count() == 1
    assert again.first().outcome == "already_scraped"


def test_authors_and_days_reach_the_store(spark):
    root = fresh_folder(spark, "store")
    writers.create_store(spark, root)
    pages = spark.createDataFrame([
        ("a/two", page("T", HEAT), ["Ann", "Bob"], dt.datetime(2024, 7, 1, 23, 59)), ("a/none", page("T", HEAT), [], None),
        ("a/null", page("T", HEAT), None, dt.datetime(2024, 7, 2))], "url string, html string, authors array<string>, published_date timestamp")
    out = runs.url_list_run(pages.select("url"), pages, no_store(spark))
    processing.store_outcomes(out, root, 0, at())
    got = {r.url: (r.authors, r.published_date) for r in writers.read_table(spark, root, "articles").collect()}
    assert got == {"a/two": ("Ann, Bob", dt.date(2024, 7, 1)), "a/none": (None, None), "a/null": (None, dt.date(2024, 7, 2))}


def test_catalog_tables(spark):
    root = fresh_folder(spark, "store")
    writers.create_store(spark, root)
    spark.sql("CREATE DATABASE IF NOT EXISTS news")
    writers.create_catalog_tables(spark, root, "news")
    writers.create_catalog_tables(spark, root, "news")
    assert {r.tableName for r in spark.sql("SHOW TABLES IN news").collect()} == {
        "articles", "keyword_matches", "scrape_sessions", "error_log"}
    assert "batch_id" in spark.table("news.articles").columns


IV = "https://www.ivpressonline.com"


def site(spark):
    """Sections of three sources; one article is linked from an English and a Spanish one."""
    both = "Murió por calor en la ola de calor"
    return page_table(spark, [
        (IV + "/news/local/", '<a href="/n/article_1.html"><a href="/n/article_2.html"><a href="/n/article_es.html">'),
        (IV + "/adelante-valle/", '<a href="/n/article_es.html"><a href="/n/article_1.html">'),
        ("https://calexicochronicle.com/", '<a href="/2024/07/01/a-story-of-the-town/"><a href="/2024/09/01/a-later-story/">'),
        (IV + "/n/article_1.html", page("One", HEAT)), (IV + "/n/article_2.html", page("Two", "nothing")),
        (IV + "/n/article_es.html", page("Tres", both)),
        ("https://calexicochronicle.com/2024/07/01/a-story-of-the-town/", page("Four", "heat advisory"))])


def test_crawl_run(spark):
    sources = source_table(spark, NEWS_SOURCES)
    out = runs.crawl_run(site(spark), sources, no_store(spark))
    got = {(r.source, r.url.strip("/").rsplit("/", 1)[1]): (r.outcome, r.heat_score) for r in out.collect()}
    assert got == {
        ("Imperial Valley Press", "article_1.html"): ("saved", 12.0),
        ("Imperial Valley Press", "article_2.html"): ("score_too_low", 0.0),
        ("Imperial Valley Press", "article_es.html"): ("score_too_low", 0.0),
        ("Adelante Valle", "article_es.html"): ("saved", 12.0),
        ("Adelante Valle", "article_1.html"): ("already_scraped", 0.0),
        ("Calexico Chronicle", "a-story-of-the-town"): ("saved", 2.0),
        ("Calexico Chronicle", "a-later-story"): ("errors", 0.0)}
    stats = {r.source: (r.articles_found, r.articles_new, r.articles_scraped, r.errors, r.status)
             for r in counters.session_stats(out, sources, at(), at()).collect()}
    assert stats["Imperial Valley Press"] == (3, 3, 1, 0, "COMPLETED")
    assert stats["Adelante Valle"] == (2, 1, 1, 0, "COMPLETED")
    assert stats["Calexico Chronicle"] == (2, 2, 1, 1, "COMPLETED")
    assert stats["Holtville Tribune"] == (0, 0, 0, 0, "COMPLETED")


def test_date_range_run(spark):
    sources = source_table(spark, DATE_RANGE_SOURCES)
    listing = spark.createDataFrame(
        [("Imperial Valley Press", IV, 0, '<a href="/n/article_1.html"><a href="/n/article_1.html">')],
        "source string, base string, section_ord int, html string")
    pages = site(spark)
    start, end = dt.date(2024, 6, 1), dt.date(2024, 7, 31)
    out = runs.date_range_run(listing, pages, sources, no_store(spark), start, end)
    assert {(r.source, r.via, r.outcome) for r in out.collect()} == {
        ("Imperial Valley Press", "archive", "saved"), ("Calexico Chronicle", "section", "score_too_low")}
    one = runs.date_range_run(listing, pages, sources, no_store(spark), start, end, selection=1)
    assert [r.source for r in one.collect()] == ["Imperial Valley Press"]
    with pytest.raises(ValueError):
        runs.date_range_run(listing, pages, sources, no_store(spark), end, start)


def test_search_runs(spark):
    day = dt.date(2024, 7, 1)
    articles = spark.createDataFrame([
        ("u1", "Title", "a heat death", day), ("u2", "Farm worker", "heat and death", day), ("u3", "Heat wave", "x", day),
        ("u4", "heat wave", "heat death", dt.date(2023, 1, 1)), ("u5", "No", "nothing", day)],
        "url string, title string, text string, published_date date")
    text = F.concat_ws("\n\n", "title", "text")
    out = runs.search_run(articles, text, hashes(spark, ["u3"]), day, day)
    assert {(r.url, r.outcome, r.search_keywords) for r in out.collect()} == {
        ("u1", "saved", 'heat death OR "heat stroke" OR "heat wave"'),
        ("u2", "score_too_low", 'heat death OR "heat stroke" OR "heat wave"'),
        ("u3", "already_scraped", 'heat death OR "heat stroke" OR "heat wave"')}
    out = runs.priority_run(articles, text, no_store(spark), day, day, SEARCH_TERMS)
    assert {(r.url, r.search_priority, r.search_keywords) for r in out.collect()} == {
        ("u1", 1, '"heat death"'), ("u2", 2, '"farm worker" heat death'), ("u3", 6, '"heat wave"')}
    saved = processing.article_rows(out, at()).first()
    assert (saved.url, saved.search_priority, str(saved.published_date)) == ("u1", 1, "2024-07-01")


def test_archive_runs(spark):
    captures = spark.createDataFrame(
        [("s1", f"202406{d:02d}0{h}0000", 200) for d in (1, 2) for h in (1, 2)] + [("s2", "20240601000000", 200)]
        + [("https://ivpressonline.com/article_1.html", "20240603000000", 200),
           ("https://ivpressonline.com/article_1.html", "20240605000000", 200)], "url string, ts string, statuscode int")
    link = '<a href="/web/1/https://ivpressonline.com/article_{}.html">'
    pages = spark.createDataFrame([
        ("s1", "20240601010000", link.format(1)), ("s1", "20240602010000", link.format(1) + link.format(2)),
        ("s1", "20240601020000", link.format(9)), ("s2", "20240601000000", ""),
        ("https://ivpressonline.com/article_1.html", "20240603000000", page("First", HEAT)),
        ("https://ivpressonline.com/article_1.html", "20240605000000", page("Second", "x"))],
        "url string, ts string, html string")
    sections = spark.createDataFrame([(0, "s1"), (1, "s2")], "section_ord int, url string")
    for sample in (50, None):
        counted, found = runs.capture_url_run(captures, sections, pages, sample=sample)
        assert [(r.capture_ord, r.new_urls, r.total_urls) for r in counted.orderBy("capture_ord").collect()] == [
            (0, 1, 1), (1, 1, 2), (2, 0, 2)]
    listed = found.withColumn("n", F.lit(0))
    out = runs.archive_run(listed, captures, pages, no_store(spark))
    assert {(r.url[-6:], r.outcome, r.title) for r in out.collect()} == {
        ("1.html", "saved", "First"), ("2.html", "no_archive", None)}


def test_stream_equals_batch(spark, tmp_path):
    rows = [(i, f"https://h{i % 3}.org/p{i % 25}", page(f"T{i % 25}", HEAT if i % 2 else "none")) for i in range(60)]
    folder = str(tmp_path / "in")
    for part in range(3):
        chunk = [r for r in rows if r[0] % 3 == part]
        spark.createDataFrame(chunk, "page_id bigint, url string, html string").coalesce(1).write.mode("append").parquet(folder)
    root, state = fresh_folder(spark, "store"), fresh_folder(spark, "state")

    def go():
        incremental.store_stream(
            incremental.page_stream(spark, folder, files_per_batch=1), root, state, at(),
            incremental.pages_as_candidates(urls.host_of)).awaitTermination()

    go()
    stored = writers.read_table(spark, root, "articles")
    expected = {u for _, u, h in rows if HEAT in h}
    assert sorted(r.url for r in stored.collect()) == sorted(expected)
    assert stored.select("batch_id").distinct().count() > 1
    go()  # nothing new
    assert writers.read_table(spark, root, "articles").count() == len(expected)


def test_nothing_to_do(spark):
    rows = spark.createDataFrame([], "url string, n int")
    out = runs.url_list_run(rows, page_table(spark, [("u", page("T", HEAT))]), hashes(spark, ["u"]))
    assert out.count() == 0
    row = counters.run_counters(out, "copies").first()
    assert row.total == 0 and row.hit_rate == 0.0


def test_runs_with_their_own_checkpoints_accumulate(spark, tmp_path):
    rows = [(i, f"{IV}/news/article_{i}.html", page(f"T{i}", HEAT)) for i in range(6)]
    folder = str(tmp_path / "pages")
    spark.createDataFrame(rows, "page_id bigint, url string, html string").write.parquet(folder)
    root = fresh_folder(spark, "store")
    for part in ("page_id < 4", "page_id > 2"):
        incremental.store_stream(
            incremental.page_stream(spark, folder).filter(part), root, fresh_folder(spark, "state"), at(),
            incremental.pages_as_candidates(urls.host_of)).awaitTermination()
    assert sorted(r.url for r in writers.read_table(spark, root, "articles").collect()) == sorted(u for _, u, _ in rows)


def test_short_bodies_count_except_in_archives(spark):
    short = page_table(spark, [("a/short", "<h1>Heat stroke</h1><article>heat death</article>")])
    listed = spark.createDataFrame([("a/short", 0)], "url string, n int")
    out = runs.url_list_run(listed, short, hashes(spark, [])).first()
    assert out.outcome != "errors" and out.heat_score > 0
    captured = short.withColumn("ts", F.lit("20240705120000"))
    index = captured.select("url", "ts", F.lit(200).alias("statuscode"))
    archived = runs.archive_run(listed, index, captured, hashes(spark, []), "20240701", "20240730")
    assert archived.first().outcome == "errors"


def test_catalog_shows_stored_batches(spark):
    root = fresh_folder(spark, "store")
    writers.create_store(spark, root)
    spark.sql("CREATE DATABASE IF NOT EXISTS batches")
    writers.create_catalog_tables(spark, root, "batches")
    processing.store_outcomes(list_run(spark), root, writers.batch_name("a"), at(), database="batches")
    assert spark.table("batches.articles").count() == 1


def test_lexicon_rows_keep_their_weights(spark):
    rows = [("en", "heat", 1, 10, 0, "heat death"), ("en", "heat", 1, 99, 1, "heat wave")]
    table = spark.createDataFrame(rows, "language string, category string, priority int, weight int, pattern_ord int, pattern string")
    from newsmill.functions.scoring import score_text
    from newsmill.sources.config import load_lexicons

    texts = spark.createDataFrame([("heat death and heat wave",)], "text string")
    assert score_text(texts, F.col("text"), otherwise=load_lexicons(table)["en"]).first().heat_score == 109
