"""Queries about captures and keyword search."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from newsmill.functions import scoring
from newsmill.functions.lexicon import SEARCH_TERMS, SearchTerm
from newsmill.operators import captures as cap
from newsmill.operators import search as find
from newsmill.operators.links import page_links
from newsmill.operators.ordering import with_global_index
from newsmill.session import fresh_folder
from newsmill.sources import phraseindex, readers
from newsmill.sources.config import term_table
from workload.inputs import (
    ARTICLES_SQL, CAPTURES_SQL, LINKS_SQL, PAGES_SQL, WORD_TERMS, articles, captures, pages, quoted, sql, table,
)

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(function):
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function
    return register


# --- captures ----------------------------------------------------------------------

_START, _END = "20240105", "20240125"
_DAILY = f"""daily AS (
  SELECT url, substr(ts, 1, 8) AS day, min(ts) AS ts FROM captures
  WHERE statuscode = 200 AND ts >= '{_START}000000' AND ts <= '{_END}235959' GROUP BY url, day),
sections AS (
  SELECT DISTINCT 'https://news.example.org/s/' || user_id AS url, CAST(user_id AS INTEGER) AS section_ord
  FROM events WHERE event_type = 'signup'),
listed AS (SELECT url, ts, section_ord FROM daily JOIN sections USING (url)),
numbered AS (SELECT *, row_number() OVER (ORDER BY section_ord, ts, url) - 1 AS i, count(*) OVER () AS n FROM listed),
sampled AS (
  SELECT url, ts, section_ord, CASE WHEN n > 50 THEN i // (n // 50) ELSE i END AS capture_ord FROM numbered
  WHERE n <= 50 OR (i % (n // 50) = 0 AND i // (n // 50) < 50))"""


def _listed(spark, folder):
    """Daily captures of the URLs of users that signed up, which act as sections."""
    users = table(spark, folder, "events").filter("event_type = 'signup'").select("user_id").distinct()
    sections = users.select(
        F.concat(F.lit("https://news.example.org/s/"), F.col("user_id")).alias("url"),
        F.col("user_id").cast("int").alias("section_ord"))
    return cap.of_sections(cap.daily(cap.in_range(captures(spark, folder), _START, _END)), sections)


@query("captures_in_range", sql(CAPTURES_SQL, select=f"""
SELECT url, ts, statuscode FROM captures WHERE statuscode = 200 AND ts BETWEEN '{_START}000000' AND '{_END}235959'"""))
def captures_in_range(spark, folder):
    return cap.in_range(captures(spark, folder), _START, _END)


@query("daily_captures", sql(CAPTURES_SQL, _DAILY, select="SELECT url, ts FROM daily"))
def daily_captures(spark, folder):
    return cap.daily(cap.in_range(captures(spark, folder), _START, _END))


@query("section_captures", sql(CAPTURES_SQL, _DAILY, select="SELECT url, ts, section_ord, i AS capture_ord FROM numbered"))
def section_captures(spark, folder):
    order = [F.col("section_ord"), F.col("ts"), F.col("url")]
    return with_global_index(_listed(spark, folder), order, "capture_ord")


@query("sampled_captures", sql(CAPTURES_SQL, _DAILY, select="SELECT url, ts, section_ord, capture_ord FROM sampled"))
def sampled_captures(spark, folder):
    return cap.even_sample(_listed(spark, folder))


@query("first_capture", sql(CAPTURES_SQL, select=f"""
SELECT order_id, url, min(ts) AS ts, 'https://web.archive.org/web/' || min(ts) || '/' || url AS archive_url
FROM (SELECT o_orderkey AS order_id, 'https://news.example.org/s/' || o_custkey AS url FROM orders)
LEFT JOIN (SELECT * FROM captures WHERE statuscode = 200 AND ts BETWEEN '{_START}000000' AND '{_END}235959') USING (url)
GROUP BY order_id, url"""))
def first_capture(spark, folder):
    """Orders name a URL by customer number: a list with repeats and URLs never captured."""
    listed = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.concat(F.lit("https://news.example.org/s/"), F.col("o_custkey")).alias("url"))
    return cap.first_capture(listed, captures(spark, folder), _START, _END)


@query("capture_index", """
SELECT 'https://news.example.org/s/' || user_id AS url, strftime(ts, '%Y%m%d%H%M%S') AS ts FROM events""")
def capture_index(spark, folder):
    """Every event as a JSON index answer of one header and one row."""
    ts = F.date_format("ts", "yyyyMMddHHmmss")
    answers = table(spark, folder, "events").select(
        F.concat(F.lit("https://news.example.org/s/"), F.col("user_id")).alias("url"),
        F.to_json(F.array(F.array(F.lit("timestamp")), F.array(ts))).alias("value"))
    return readers.parse_capture_index(answers)


@query("capture_index_rows", """
SELECT 'https://news.example.org/s/' || user_id AS url,
       unnest([strftime(ts, '%Y%m%d%H%M%S'), strftime(ts, '%Y%m%d') || '000000']) AS ts FROM events""")
def capture_index_rows(spark, folder):
    """Every event as an answer of a header, a row, an empty row and a longer row."""
    ts, day = F.date_format("ts", "yyyyMMddHHmmss"), F.date_format("ts", "yyyyMMdd'000000'")
    rows = F.array(F.array(F.lit("timestamp")), F.array(ts), F.array().cast("array<string>"), F.array(day, F.lit("200")))
    answers = table(spark, folder, "events").select(
        F.concat(F.lit("https://news.example.org/s/"), F.col("user_id")).alias("url"), F.to_json(rows).alias("value"))
    return readers.parse_capture_index(answers)


# Every page acts as a captured listing; its links get the marker of the site.
_FOUND = """marked AS (
  SELECT CAST(page_id AS BIGINT) AS capture_ord, '/web/20240701120000/https://ivpressonline.com/article_' || ltrim(href, '/') || '.html' AS href
  FROM links),
found AS (
  SELECT capture_ord, regexp_extract(href, '/web/[0-9]+/(https?://[^"'']+)', 1) AS url FROM marked),
fresh AS (SELECT capture_ord, count(*) AS new_urls FROM (
  SELECT url, min(capture_ord) AS capture_ord FROM found GROUP BY url) GROUP BY capture_ord)"""


def _found(spark, folder):
    marked = page_links(pages(spark, folder), ["page_id"]).select(
        F.col("page_id").cast("bigint").alias("capture_ord"),
        F.concat(F.lit("/web/20240701120000/https://ivpressonline.com/article_"),
                 F.regexp_replace("href", "^/+", ""), F.lit(".html")).alias("href"))
    found = marked.select("capture_ord", cap.article_url(F.col("href")).alias("url"))
    return found.filter("url IS NOT NULL")


@query("new_urls_per_capture", sql(PAGES_SQL, LINKS_SQL, _FOUND, select="""
SELECT page_id AS capture_ord, coalesce(new_urls, 0) AS new_urls,
       CAST(sum(coalesce(new_urls, 0)) OVER (ORDER BY page_id) AS BIGINT) AS total_urls
FROM pages LEFT JOIN fresh ON capture_ord = page_id"""))
def new_urls_per_capture(spark, folder):
    every = table(spark, folder, "pages").select(F.col("page_id").cast("bigint").alias("capture_ord"))
    return cap.new_urls_per_capture(every, _found(spark, folder))


@query("url_preview", sql(PAGES_SQL, LINKS_SQL, _FOUND, "d AS (SELECT DISTINCT url FROM found)", select="""
SELECT CAST(row_number() OVER (ORDER BY url) AS INTEGER) AS pos, url AS entry FROM (SELECT url FROM d ORDER BY url LIMIT 10)
UNION ALL SELECT 11, '... and ' || (n - 10) || ' more' FROM (SELECT count(*) AS n FROM d) WHERE n > 10"""))
def url_preview(spark, folder):
    return cap.preview(_found(spark, folder).select("url").distinct())


# --- search ------------------------------------------------------------------------

def _term_sql(phrases: tuple[str, ...], text: str) -> str:
    tests = []
    for phrase in phrases:
        pattern = r"\b" + r"\s+".join(phrase.split()) + r"\b"
        tests.append(f"regexp_matches({text}, {quoted(pattern)}, 'i')")
    return "(" + " AND ".join(tests) + ")"


def _budget_sql(terms: tuple[SearchTerm, ...], max_total: int, where: str) -> str:
    cases = " ".join(f"WHEN {_term_sql(t.phrases, 't')} THEN {i}" for i, t in enumerate(terms))
    rows = ", ".join(
        f"({i}, {t.priority}, {quoted(t.category)}, {quoted(t.term)})" for i, t in enumerate(terms))
    return f"""terms(term_ord, priority, category, term) AS (VALUES {rows}),
found AS (
  SELECT url, min(term_ord) AS term_ord FROM (
    SELECT url, CASE {cases} END AS term_ord
    FROM (SELECT url, lower(title || chr(10) || chr(10) || text) AS t FROM articles WHERE {where}))
  WHERE term_ord IS NOT NULL GROUP BY url),
counted AS (
  SELECT t.*, (SELECT count(*) FROM found f WHERE f.term_ord = t.term_ord) AS new_urls FROM terms t),
running AS (
  SELECT *, CAST(sum(new_urls) OVER (ORDER BY term_ord) AS BIGINT) AS total_urls FROM counted),
budget AS (SELECT * FROM running WHERE total_urls - new_urls < {max_total})"""


_DATES = (dt.date(2024, 6, 1), dt.date(2024, 8, 31))
_IN_DATES = "published_date BETWEEN DATE '2024-06-01' AND DATE '2024-08-31'"
_WORD_BUDGET = _budget_sql(WORD_TERMS, 60, _IN_DATES)


def _first_terms(spark, folder, terms):
    rows = find.published_between(articles(spark, folder), *_DATES)
    return find.first_terms(rows, scoring.full_text(F.col("title"), F.col("text")), terms)


@query("priority_search", sql(ARTICLES_SQL, _WORD_BUDGET, select="""
SELECT url, priority, category, term AS search_term, f.term_ord FROM found f JOIN budget b ON f.term_ord = b.term_ord"""))
def priority_search(spark, folder):
    found = _first_terms(spark, folder, WORD_TERMS)
    return find.priority_search(found, term_table(spark, WORD_TERMS), 60)


@query("term_budget", sql(ARTICLES_SQL, _WORD_BUDGET, select="""
SELECT term_ord, priority, category, term, new_urls, total_urls FROM budget"""))
def term_budget(spark, folder):
    found = _first_terms(spark, folder, WORD_TERMS)
    return find.term_budget(found, term_table(spark, WORD_TERMS), 60).drop("phrases")


@query("default_term_search", sql(ARTICLES_SQL, _budget_sql(SEARCH_TERMS, 50, _IN_DATES), select="""
SELECT url, priority, category, term AS search_term, f.term_ord FROM found f JOIN budget b ON f.term_ord = b.term_ord"""))
def default_term_search(spark, folder):
    found = _first_terms(spark, folder, SEARCH_TERMS)
    return find.priority_search(found, term_table(spark, SEARCH_TERMS))


def _indexed(spark, folder, terms):
    """The same from a phrase index that two batches of the articles left, one of them written twice."""
    root = fresh_folder(spark, "index")
    rows, text = articles(spark, folder), scoring.full_text(F.col("title"), F.col("text"))
    for number in (1, 0, 1):
        phraseindex.write_index(rows.filter(F.col("doc_id") % 2 == number), text, root, number)
    return phraseindex.first_terms(spark, root, terms, *_DATES)


@query("indexed_search", ORACLES["priority_search"])
def indexed_search(spark, folder):
    return find.priority_search(_indexed(spark, folder, WORD_TERMS), term_table(spark, WORD_TERMS), 60)


@query("indexed_default_search", ORACLES["default_term_search"])
def indexed_default_search(spark, folder):
    return find.priority_search(_indexed(spark, folder, SEARCH_TERMS), term_table(spark, SEARCH_TERMS))


# Every page acts as a result page; the paths of its links get the marker and the ending of articles.
_MARKED_HTML = """(href=")(https?://[^/"]+)?(/[^"]*)(")"""


@query("search_listing", sql(PAGES_SQL, LINKS_SQL, """marked AS (
  SELECT page_id, pos, CASE WHEN regexp_matches(href, '^(https?://[^/]+)?/') THEN regexp_replace(href, '^(https?://[^/]+)?(/.*)$', '\\1\\2/article_x.html', 's')
                            ELSE href END AS href FROM links),
absolute AS (
  SELECT page_id, pos, CASE WHEN starts_with(href, '/') THEN 'https://www.ivpressonline.com' || href
                            WHEN starts_with(href, 'http') THEN href END AS url
  FROM marked WHERE contains(href, 'article_') AND contains(href, '.html')),
listed AS (
  SELECT url, page_id, pos, row_number() OVER (PARTITION BY url ORDER BY page_id, pos) AS k FROM absolute WHERE url IS NOT NULL)""",
    select="""
SELECT url, page_id, CAST(pos AS INTEGER) AS pos FROM listed WHERE k = 1 ORDER BY page_id, pos LIMIT 50"""))
def search_listing(spark, folder):
    html = F.regexp_replace("html", _MARKED_HTML, "$1$2$3/article_x.html$4")
    results = pages(spark, folder).select("page_id", html.alias("html"))
    return find.search_listing(results, F.lit("https://www.ivpressonline.com"), page_ord="page_id")


_ANY = (("heat", "of"), ("from the",), ("worthless",))


@query("search_capped", sql(ARTICLES_SQL, select=f"""
SELECT url, CAST(published_date AS VARCHAR) AS published_date FROM articles
WHERE {_IN_DATES} AND ({' OR '.join(_term_sql(p, "lower(title || chr(10) || chr(10) || text)") for p in _ANY)})
ORDER BY published_date DESC, url LIMIT 50"""))
def search_capped(spark, folder):
    rows = find.published_between(articles(spark, folder), *_DATES)
    found = find.search(rows, scoring.full_text(F.col("title"), F.col("text")), _ANY)
    return found.select("url", F.col("published_date").cast("string"))
