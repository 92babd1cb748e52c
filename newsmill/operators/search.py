"""Keyword search over an article table, plain and priority-ordered.

A term is a set of phrases that must all occur; a query is a set of terms of
which one must match.  Terms are literals in the plan: the text is read once and
no article-by-term rows are made.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsmill.functions.columns import computed_once
from newsmill.functions.lexicon import SearchTerm
from newsmill.functions.patterns import folds_unusually, phrase_pattern, portable, sql_text
from newsmill.functions.urls import is_marked_article
from newsmill.operators.links import page_links
from newsmill.operators.ordering import first_n

# Fixed value: default cap of both searches.
MAX_RESULTS = 50
# End of fixed values.


def _has_term(phrases: Sequence[str]) -> str:
    """SQL test that all phrases occur; byte searches for their words run before the regexes."""
    words = sorted({w for p in phrases for w in p.lower().split()}, key=lambda w: (-len(w), w))
    nearby = " AND ".join(f"contains(_text, {sql_text(w)})" for w in words)
    found = " AND ".join(f"rlike(_text, {sql_text(portable(phrase_pattern(p)))})" for p in phrases)
    return f"((_unusual OR ({nearby})) AND {found})"


def _prepared(articles: DataFrame, text: Column) -> DataFrame:
    lowered = articles.withColumn("_text", F.lower(text))
    return lowered.withColumn("_unusual", folds_unusually(F.col("_text")))


def published_between(articles: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Articles published within [start, end]; reaches the scan when it is a stored column."""
    return articles.filter(F.col("published_date").between(F.lit(start), F.lit(end)))


def search(
    articles: DataFrame, text: Column, query: Sequence[Sequence[str]],
    max_results: int | None = MAX_RESULTS,
) -> DataFrame:
    """Distinct (url, published_date) of articles matching any term of `query`.

    Newest first, then by URL, cut after `max_results`; a URL that occurs
    several times counts once, with its latest date.
    """
    hit = F.expr(" OR ".join(_has_term(term) for term in query))
    found = (
        computed_once(_prepared(articles, text), hit, "_hit").filter("_hit")
        .groupBy("url").agg(F.max("published_date").alias("published_date"))
    )
    if max_results is None:
        return found
    newest = [F.col("published_date").desc_nulls_last(), F.col("url")]
    return first_n(found, newest, max(max_results, 1))


def search_listing(
    result_pages: DataFrame, base: Column, max_results: int | None = MAX_RESULTS, page_ord: str = "page_ord",
) -> DataFrame:
    """Article URLs of stored result pages (`page_ord`, html) in page order: (url, page_ord, pos).

    Links that look like articles become absolute under `base`; of repeated URLs
    the first one counts, and the list is cut after `max_results`.
    """
    links = page_links(result_pages, [page_ord], base=base)
    listed = links.filter(is_marked_article(F.col("href")) & F.col("full_url").isNotNull())
    found = (
        listed.groupBy(F.col("full_url").alias("url"))
        .agg(F.min(F.struct(F.col(page_ord), F.col("pos"))).alias("_first"))
        .select("url", f"_first.{page_ord}", "_first.pos")
    )
    if max_results is None:
        return found
    return first_n(found, [F.col(page_ord), F.col("pos")], max(max_results, 1))


def first_terms(articles: DataFrame, text: Column, terms: Sequence[SearchTerm]) -> DataFrame:
    """Every matching URL with the order number of the first term that finds it."""
    tests = ", ".join(f"CASE WHEN {_has_term(t.phrases)} THEN {i} END" for i, t in enumerate(terms))
    first = F.expr(f"try_element_at(filter(array({tests}), i -> i IS NOT NULL), 1)")
    found = computed_once(_prepared(articles, text), first, "term_ord")
    return (
        found.filter("term_ord IS NOT NULL")
        .groupBy("url").agg(F.min("term_ord").alias("term_ord"))
    )


def term_budget(found: DataFrame, terms: DataFrame, max_total: int = MAX_RESULTS) -> DataFrame:
    """The terms that still run, with their new URLs and the running total.

    A term runs while the earlier ones found fewer than `max_total` URLs; it is
    not cut itself.  All windows run over one row per term.
    """
    upto = Window.orderBy("term_ord").rowsBetween(Window.unboundedPreceding, 0)
    fresh = found.groupBy("term_ord").agg(F.count(F.lit(1)).alias("new_urls"))
    counted = terms.join(fresh, "term_ord", "left").na.fill(0, ["new_urls"])
    total = counted.withColumn("total_urls", F.sum("new_urls").over(upto))
    return total.filter(F.col("total_urls") - F.col("new_urls") < max_total)


def priority_search(found: DataFrame, terms: DataFrame, max_total: int = MAX_RESULTS) -> DataFrame:
    """URLs within the budget with the priority, category and term that found them."""
    running = term_budget(found, terms, max_total)
    kept = running.select("term_ord", "priority", "category", F.col("term").alias("search_term"))
    # One row per configured term.
    return found.join(F.broadcast(kept), "term_ord")
