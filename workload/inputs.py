"""How the given tables stand in for articles, pages, captures and stores.

Every mapping exists twice, as DataFrame code and as SQL, and covers its whole
table and whole texts.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmill.functions.columns import computed_once
from newsmill.functions.lexicon import ENGLISH, SPANISH, Category, Lexicon, SearchTerm
from newsmill.functions.urls import UrlRules, base_of, host_of
from newsmill.sources.readers import spread

# Sentences that real lexicon words occur in, by doc_id % 4 (English) or for any other language.
ENGLISH_SNIPPETS = (
    "Two people died from heat. The coroner said heat\nstroke death was the cause of death in the heat wave.",
    "A heated debate on the heat wave and heat death.",
    "Record breaking heat: farm worker suffered a heat stroke, then a heat death in deadly heat.",
    "Nothing here.",
)
OTHER_SNIPPET = "Murió por calor tras un golpe de calor durante la ola de calor; hipertermia."

# Lexicon and terms of words that the documents themselves contain.
WORD_LEXICON = Lexicon(
    categories=(
        Category("plain", 1, 10, (r"\bheat\b", r"worthless")),
        Category("pair", 2, 5, (r"heat\s+(?:the|and|of)\b", r"\bfrom\s+the\b")),
        Category("span", 3, 3, (r"that.*heat",)),
        Category("romance", 4, 2, (
            r"por\s+", r"por\s+(?:la|los|las|que)\s", r"que\s+(?:los|las|del)\s+")),
    ),
    exclusions=(r"\bweather\b",),
)
WORD_TERMS = (
    SearchTerm(1, "plain", '"from the"', ("from the",)),
    SearchTerm(1, "plain", "heat that", ("heat", "that")),
    SearchTerm(2, "pair", '"heat the" of', ("heat the", "of")),
    SearchTerm(3, "romance", "por", ("por",)),
    SearchTerm(3, "romance", '"que los"', ("que los",)),
    SearchTerm(4, "late", "worthless", ("worthless",)),
    SearchTerm(4, "late", "heat", ("heat",)),
)

# Rules under which links of the given pages can be articles.
PAGE_RULES = UrlRules(
    external=("cheap-pills", "adult-x", "spam-farm"),
    domains=("example.com", "example.net", "example.org"),
    nav_parts=("/the", "/and"),
    nav_endings=(".", ","),
    marker_site="www.", marker="/t", suffix="e", marker_decides=False,
    dated_names=("example",), dated_pattern=r"/[^/]*[aeiou][^/]*$", longer_than=28,
)


def quoted(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table with long texts, on all cores even if it is a single row group."""
    return spread(table(spark, folder, name))


# --- articles from documents -------------------------------------------------

def snippet() -> Column:
    slot = F.col("doc_id") % 4
    text = F.when(F.col("lang") != "en", OTHER_SNIPPET)
    for i, words in enumerate(ENGLISH_SNIPPETS):
        text = text.when(slot == i, words)
    return text


def articles(spark: SparkSession, folder: str) -> DataFrame:
    """documents as article records: first line as title, snippet appended to the text."""
    return texts(spark, folder, "documents").select(
        "doc_id", F.col("lang").alias("language"), "source",
        F.concat(F.lit("https://news.example.org/doc/"), F.col("doc_id")).alias("url"),
        F.md5(F.concat(F.lit("https://news.example.org/doc/"), F.col("doc_id")).cast("binary"))
        .alias("url_hash"),
        F.regexp_extract("text", r"^[^\n]*", 0).alias("title"),
        F.concat(F.col("text"), F.lit("\n\n"), snippet()).alias("text"),
        F.date_add(F.lit("2024-06-01").cast("date"), (F.col("doc_id") % 122).cast("int"))
        .alias("published_date"),
        F.timestamp_seconds(F.lit(1717200000) + F.col("doc_id")).alias("scraped_date"),
    )


_SNIPPET_SQL = "CASE WHEN lang <> 'en' THEN " + quoted(OTHER_SNIPPET) + "".join(
    f" WHEN doc_id % 4 = {i} THEN {quoted(s)}" for i, s in enumerate(ENGLISH_SNIPPETS)) + " END"

ARTICLES_SQL = f"""articles AS (
  SELECT doc_id, lang AS language, source,
         'https://news.example.org/doc/' || doc_id AS url,
         md5('https://news.example.org/doc/' || doc_id) AS url_hash,
         regexp_extract(text, '^[^\\n]*') AS title,
         text || chr(10) || chr(10) || {_SNIPPET_SQL} AS text,
         CAST(DATE '2024-06-01' + CAST(doc_id % 122 AS INTEGER) AS DATE) AS published_date,
         1717200000 + doc_id AS scraped_second
  FROM documents)"""


# --- scores in SQL -----------------------------------------------------------

def _pattern_rows(lexicon: Lexicon, language: str) -> list[str]:
    rows, order = [], 0
    for category in lexicon.categories:
        for pattern in category.patterns:
            rows.append(f"({quoted(language)}, {order}, {quoted(category.name)}, "
                        f"{category.weight}, {quoted(pattern)})")
            order += 1
    return rows


def lexicon_sql(lexicons: dict[str, Lexicon]) -> str:
    """CTEs `lexicon` and `exclusions`; the key '' stands for all other languages."""
    rows = [r for code, lex in lexicons.items() for r in _pattern_rows(lex, code)]
    out = [f"({quoted(c)}, {quoted(p)})" for c, lex in lexicons.items() for p in lex.exclusions]
    out = out or ["('-', '-')"]
    return (
        "lexicon(lex, pattern_ord, category, weight, pattern) AS (VALUES " + ", ".join(rows) + "),\n"
        "exclusions(lex, pattern) AS (VALUES " + ", ".join(out) + ")"
    )


TWO_LANGUAGES = {"en": ENGLISH, "": SPANISH}

# Expects `texts` (key columns, lex, t): t lower-cased.
HITS_SQL = """gated AS (
  SELECT * FROM texts x WHERE NOT EXISTS (
    SELECT 1 FROM exclusions e WHERE e.lex = x.lex AND regexp_matches(x.t, e.pattern, 'i'))),
hits AS (
  SELECT g.url_hash, l.pattern_ord, l.category, l.weight,
         unnest(regexp_extract_all(g.t, l.pattern, 0, 'i')) AS keyword
  FROM gated g JOIN lexicon l ON l.lex = g.lex),
scores AS (
  SELECT x.url_hash, CAST(coalesce(sum(h.weight), 0) AS DOUBLE) AS heat_score
  FROM texts x LEFT JOIN hits h USING (url_hash) GROUP BY x.url_hash)"""

RELEVANCE_SQL = """CASE WHEN heat_score >= 50 THEN 'EXTREMELY_RELEVANT' WHEN heat_score >= 20 THEN 'HIGHLY_RELEVANT'
       WHEN heat_score >= 10 THEN 'MODERATELY_RELEVANT' WHEN heat_score > 0 THEN 'MINIMALLY_RELEVANT'
       ELSE 'NOT_RELEVANT' END"""

TEXTS_SQL = """texts AS (
  SELECT url_hash, CASE WHEN language = 'en' THEN 'en' ELSE '' END AS lex,
         lower(title || chr(10) || chr(10) || text) AS t FROM articles)"""

SCORED_SQL = f"""{ARTICLES_SQL},
{lexicon_sql(TWO_LANGUAGES)},
{TEXTS_SQL},
{HITS_SQL},
scored AS (
  SELECT a.*, s.heat_score, {RELEVANCE_SQL} AS category
  FROM articles a JOIN scores s USING (url_hash))"""


# --- pages -------------------------------------------------------------------

def pages(spark: SparkSession, folder: str) -> DataFrame:
    """pages with host as source, site base and listing position."""
    return texts(spark, folder, "pages").withColumns({
        "source": host_of(F.col("url")), "base": base_of(F.col("url")),
        "section_ord": F.col("page_id").cast("int"),
    })


PAGES_SQL = """site_pages AS (
  SELECT page_id, url, html, regexp_extract(url, '^https?://([^/?#]+)', 1) AS source,
         regexp_extract(url, '^(https?://[^/?#]+)', 1) AS base, page_id AS section_ord FROM pages)"""

# All links in page order; comments and scripts are cut out first.
LINKS_SQL = """tags AS (
  SELECT *, regexp_extract_all(regexp_replace(html,
           '(?is)<!--.*?-->|<script\\b.*?</script\\s*>|<style\\b.*?</style\\s*>', '', 'g'),
           '(?i)<a\\s[^>]*?href\\s*=\\s*"([^"]*)"', 1) AS hrefs FROM site_pages),
links AS (
  SELECT page_id, source, base, section_ord, url AS page_url,
         unnest(hrefs) AS href, generate_subscripts(hrefs, 1) - 1 AS pos FROM tags)"""

# Article-shaped stand-ins for page URLs by page_id % 8, as (condition value, SQL text).
_SHAPES = (
    "'https://www.ivpressonline.com/news/local/x/article_' || md5(url) || '.html'",
    "'https://calexicochronicle.com/2024/07/' || dd || '/story-' || page_id || '/'",
    "'https://www.thedesertreview.com/2024/07/' || dd || '/story-' || page_id || '/'",
    "'https://www.facebook.com/sharer?u=ivpressonline.com/article_' || page_id || '.html'",
    "'https://www.ivpressonline.com/sports/article_' || page_id || '.html'",
    "url",
    "'https://holtvilletribune.com/2024/13/45/story-' || page_id || '/'",
    "'https://www.ivpressonline.com/tribune/2024/07/01/article_a/article_' || page_id || '.html'",
)
_SHAPE_SQL = "CASE " + " ".join(
    f"WHEN page_id % 8 = {i} THEN {shape}" for i, shape in enumerate(_SHAPES)) + " END"

SHAPED_SQL = f"""shaped AS (
  SELECT page_id, {_SHAPE_SQL} AS url
  FROM (SELECT page_id, url, lpad(CAST(1 + page_id % 28 AS VARCHAR), 2, '0') AS dd FROM pages))"""


def shaped_urls(spark: SparkSession, folder: str) -> DataFrame:
    """Page URLs rewritten to all the shapes the URL rules distinguish."""
    day = F.lpad((1 + F.col("page_id") % 28).cast("string"), 2, "0")
    listed = table(spark, folder, "pages").select("page_id", F.col("url").alias("page_url"), day.alias("dd"))
    shape = F.expr(re.sub(r"\burl\b", "page_url", _SHAPE_SQL))
    return computed_once(listed, shape, "url").select("page_id", "url")


# --- captures from events ----------------------------------------------------

def captures(spark: SparkSession, folder: str) -> DataFrame:
    """events as archive captures of one URL per user; error events are failed captures."""
    return table(spark, folder, "events").select(
        F.concat(F.lit("https://news.example.org/s/"), F.col("user_id")).alias("url"),
        F.date_format("ts", "yyyyMMddHHmmss").alias("ts"),
        F.when(F.col("event_type") == "error", 500).otherwise(200).alias("statuscode"),
    )


CAPTURES_SQL = """captures AS (
  SELECT 'https://news.example.org/s/' || user_id AS url, strftime(ts, '%Y%m%d%H%M%S') AS ts,
         CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS statuscode FROM events)"""


def sql(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select
