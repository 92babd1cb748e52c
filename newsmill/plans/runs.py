"""The runs a user starts: crawl, date range, search, priority search, URL list, archive.

Each takes tables of stored pages in place of the network and gives the
evaluated candidates; store them with
:func:`newsmill.plans.processing.store_outcomes`.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsmill.functions.lexicon import (
    DATE_RANGE_EXCLUSIONS, DEFAULT_QUERY, ENGLISH, SEARCH_TERMS, SearchTerm, by_priority,
)
from newsmill.functions.scoring import DEFAULT_THRESHOLD
from newsmill.functions.urls import DATED_RULES, STRICT_RULES, UrlRules
from newsmill.operators import captures as cap
from newsmill.operators import discovery as disc
from newsmill.operators import search as find
from newsmill.operators.articles import LEAST_BODY
from newsmill.operators.ordering import with_global_index
from newsmill.plans.processing import candidates_of_list, evaluate
from newsmill.sources.config import sections, term_table

# Fixed value: the source name of runs over a single site.
SINGLE_SOURCE = "Imperial Valley Press"
# End of fixed values.


def crawl_run(
    pages: DataFrame, sources: DataFrame, stored: DataFrame, rules: UrlRules = STRICT_RULES,
    max_articles: int = disc.ARTICLES_PER_SOURCE, threshold: float | None = None, **scoring,
) -> DataFrame:
    """Section crawl of all sources: score above zero is kept, language picks the lexicon."""
    listing = disc.section_pages(pages, sections(sources))
    found = disc.crawl(disc.section_links(listing, rules), max_articles)
    candidates = disc.with_attributes(found, sources).withColumnRenamed("source_ord", "seq")
    return evaluate(candidates, pages, stored, threshold=threshold, language="language", **scoring)


def date_range_run(
    archive_listing: DataFrame, pages: DataFrame, sources: DataFrame, stored: DataFrame,
    start: dt.date, end: dt.date, selection: int | str | None = None,
    rules: UrlRules = DATED_RULES, threshold: float | None = DEFAULT_THRESHOLD, **scoring,
) -> DataFrame:
    """Date-range run: archive listing first, sections as fallback, the user's cap last."""
    if end < start:
        raise ValueError("the end date is before the start date")
    archive_links = disc.section_links(archive_listing, rules)
    links = disc.section_links(disc.section_pages(pages, sections(sources)), rules)
    found = disc.discover_in_range(archive_links, links, start, end)
    named = disc.with_attributes(found, sources)
    chosen = disc.select_articles(named, selection, disc.newest_first())
    candidates = chosen.withColumnRenamed("source_ord", "seq")
    scoring.setdefault("otherwise", ENGLISH._replace(exclusions=DATE_RANGE_EXCLUSIONS))
    return evaluate(candidates, pages, stored, threshold=threshold, **scoring)


def search_run(
    articles: DataFrame, text: Column, stored: DataFrame, start: dt.date, end: dt.date,
    query: Sequence[Sequence[str]] = DEFAULT_QUERY, keywords: str | None = None,
    max_results: int = find.MAX_RESULTS, threshold: float | None = DEFAULT_THRESHOLD, **scoring,
) -> DataFrame:
    """Keyword search over an article table (url, title, text, published_date)."""
    found = find.search(find.published_between(articles, start, end), text, query, max_results)
    label = keywords or " OR ".join(" ".join(f'"{p}"' if " " in p else p for p in t) for t in query)
    candidates = found.select("url").withColumns({
        "source": F.lit(SINGLE_SOURCE), "search_keywords": F.lit(label)})
    return evaluate(candidates, articles, stored, extract=None, threshold=threshold, **scoring)


def priority_run(
    articles: DataFrame, text: Column, stored: DataFrame, start: dt.date, end: dt.date,
    terms: Sequence[SearchTerm] = SEARCH_TERMS, max_total: int = find.MAX_RESULTS,
    threshold: float | None = DEFAULT_THRESHOLD, **scoring,
) -> DataFrame:
    """Priority-ordered search under a global budget, with provenance columns."""
    found = find.first_terms(find.published_between(articles, start, end), text, terms)
    chosen = find.priority_search(found, term_table(articles.sparkSession, terms), max_total)
    candidates = chosen.select(
        "url", F.lit(SINGLE_SOURCE).alias("source"),
        F.col("priority").alias("search_priority"), F.col("search_term").alias("search_keywords"))
    scoring.setdefault("otherwise", by_priority(ENGLISH))
    return evaluate(candidates, articles, stored, extract=None, threshold=threshold, **scoring)


def url_list_run(
    urls: DataFrame, pages: DataFrame, stored: DataFrame,
    threshold: float | None = DEFAULT_THRESHOLD, **scoring,
) -> DataFrame:
    """Scoring of a URL list; count with `copies` in :func:`~newsmill.operators.counters.run_counters`."""
    candidates = candidates_of_list(urls).withColumn("source", F.lit(SINGLE_SOURCE))
    return evaluate(candidates, pages, stored, threshold=threshold, **scoring)


def capture_url_run(
    captures: DataFrame, section_list: DataFrame, captured_pages: DataFrame,
    start: str = cap.RANGE_START, end: str = cap.RANGE_END,
    domain: str = cap.ARCHIVE_DOMAIN, sample: int | None = cap.SAMPLE_SIZE,
) -> tuple[DataFrame, DataFrame]:
    """(captures with new-URL counts, distinct article URLs) of sampled daily captures."""
    days = cap.of_sections(cap.daily(cap.in_range(captures, start, end)), section_list)
    if sample is None:
        order = [F.col("section_ord"), F.col("ts"), F.col("url")]
        chosen = with_global_index(days, order, "capture_ord")
    else:
        chosen = cap.even_sample(days, sample)
    stored_pages = captured_pages.join(chosen.select("capture_ord", "url", "ts"), ["url", "ts"])
    found = cap.capture_article_urls(stored_pages, domain)
    return cap.new_urls_per_capture(chosen, found), found.select("url").distinct()


def archive_run(
    urls: DataFrame, captures: DataFrame, captured_pages: DataFrame,
    stored: DataFrame, start: str = cap.RANGE_START, end: str = cap.RANGE_END,
    threshold: float | None = DEFAULT_THRESHOLD, **scoring,
) -> DataFrame:
    """URL list against archived pages (url, ts, html): first capture in range, then scoring."""
    listed = candidates_of_list(urls).withColumn("source", F.lit(SINGLE_SOURCE))
    candidates = cap.first_capture(listed, captures, start, end).withColumn(
        "captured", F.col("ts").isNotNull())
    scoring.setdefault("least_body", LEAST_BODY)
    return evaluate(candidates, captured_pages, stored, page_keys=("ts",),
                    threshold=threshold, **scoring)
