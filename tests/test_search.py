import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from newsmill.functions.lexicon import SEARCH_TERMS, SearchTerm
from newsmill.operators import search as find
from newsmill.sources.config import term_table

WORDS = ("aa", "bb", "cc", "dd", "ee")
TERMS = tuple(SearchTerm(i // 2 + 1, f"g{i // 2}", w, (w,)) for i, w in enumerate(WORDS))


def budget_by_loop(articles, terms, most):
    found, runs = {}, []
    for i, term in enumerate(terms):
        if len(found) >= most:
            break
        new = 0
        for url, text in articles:
            if all(p in text.split() for p in term.phrases) and url not in found:
                found[url], new = i, new + 1
        runs.append((i, new, len(found)))
    return found, runs


@pytest.mark.parametrize("seed", range(4))
def test_priority_budget_like_a_loop(spark, seed):
    rng = random.Random(seed)
    articles = [(f"u{rng.randint(0, 60)}", " ".join(rng.sample(WORDS + ("zz",) * 3, rng.randint(1, 3)))) for _ in range(90)]
    most = rng.choice([1, 10, 25, 500])
    rows = spark.createDataFrame(articles, "url string, text string")
    terms = term_table(spark, TERMS)
    first = find.first_terms(rows, F.col("text"), TERMS)
    found, runs = budget_by_loop(articles, TERMS, most)
    got = {r.url: r.term_ord for r in find.priority_search(first, terms, most).collect()}
    assert got == found
    listed = find.term_budget(first, terms, most).orderBy("term_ord").collect()
    assert [(r.term_ord, r.new_urls, r.total_urls) for r in listed] == runs


def test_phrases(spark):
    texts = ["Farm  Worker dies: heat\ndeath", "farm workers heat death", "heat-related death", "preheat death",
             "heat ſtroke", "the body found in heat", "hyperthermıa"]
    rows = spark.createDataFrame([(t, t) for t in texts], "url string, text string")
    got = {r.url: SEARCH_TERMS[r.term_ord].term for r in find.first_terms(rows, F.col("text"), SEARCH_TERMS).collect()}
    assert got == {texts[0]: '"heat death"', texts[1]: '"heat death"', texts[2]: '"heat-related death"',
                   texts[4]: '"heat stroke"', texts[5]: '"body found" heat', texts[6]: "hyperthermia"}


def test_search_listing_in_page_order(spark):
    """Links in page order, the first of equal URLs, other links passed over, cut at the end."""
    rows = spark.createDataFrame([
        (2, '<a href="/n/article_3.html"><a href="/n/article_1.html">'),
        (1, '<a href="/n/article_2.html"><a href="about.html"><a href="https://x.org/article_1.html"><a href="/n/article_1.html">'
            '<a href="/n/article_2.html"><a href="ftp/article_9.html"><a href="/n/article_x">'),
        (3, None)], "page_ord int, html string")
    want = ["s/n/article_2.html", "https://x.org/article_1.html", "s/n/article_1.html", "s/n/article_3.html"]
    base = F.lit("s")
    assert [r.url for r in find.search_listing(rows, base).orderBy("page_ord", "pos").collect()] == want
    assert [r.url for r in find.search_listing(rows, base, 2).collect()] == want[:2]
    assert {r.url for r in find.search_listing(rows, base, None).collect()} == set(want)


def test_capped_search(spark):
    day = dt.date(2024, 7, 1)
    rows = spark.createDataFrame(
        [(f"u{i % 8}", "heat wave" if i % 2 else "Heat x death", day + dt.timedelta(days=i % 5)) for i in range(40)]
        + [("none", "cold", day), ("old", "heat wave", dt.date(2020, 1, 1)), ("undated", "heat wave", None)],
        "url string, text string, published_date date")
    inside = find.published_between(rows, day, dt.date(2024, 7, 31))
    got = find.search(inside, F.col("text"), (("heat", "death"), ("heat wave",)), 5)
    assert [r.url for r in got.collect()] == ["u0", "u1", "u2", "u3", "u4"]
    assert find.search(inside, F.col("text"), (("heat wave",),), None).count() == 4
    assert find.search(inside, F.col("text"), (("heat wave",),), 0).count() == 1
