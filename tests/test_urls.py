import datetime as dt
import hashlib
import re
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from newsmill.functions import urls
from newsmill.operators.links import page_links

STRICT = [
    ("https://www.ivpressonline.com/news/local/x/article_1a-2b.html", True, True),
    ("https://www.ivpressonline.com/article_a/article_b.html", False, False),
    ("https://www.ivpressonline.com/xarticle_b.html", False, False),
    ("https://calexicochronicle.com/2024/07/01/some-story/", True, True),
    ("https://calexicochronicle.com/2024/07/1/", False, False),
    ("https://x.calexicochronicle.com/2024/07/01/", True, True),
    ("https://calexicochronicle.com/2024/07/01", False, False),
    ("https://WWW.TheDesertReview.com/2024/07/01/some-story", True, False),
    ("https://www.ivpressonline.com/news/", False, False),
    ("https://www.ivpressonline.com/news/local", False, False),
    ("https://calexicochronicle.com/2024/07/01/story/news/", False, True),
    ("https://calexicochronicle.com/2024/07/01/story/local/$x", False, True),
    ("https://calexicochronicle.com/2024/07/01/about-town/", False, True),
    ("https://www.ivpressonline.com/sports/article_1.html", False, True),
    ("https://www.ivpressonline.com/tribune/2024/07/01/article_a/article_1.html", False, True),
    ("https://www.facebook.com/sharer?u=ivpressonline.com/article_1.html", False, False),
    ("https://www.ivpressonline.com/article_1.html?via=t.co", False, True),
    ("https://other.org/article_1.html", False, False),
    ("https://www.ivpressonline.com/search/?q=article_1.html", False, False),
]


def column(spark, values, expression):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.r for r in rows.select("i", expression(F.col("v")).alias("r")).orderBy("i").collect()]


def test_validators(spark):
    given = [u for u, _, _ in STRICT]
    assert column(spark, given, lambda c: urls.is_article(c, urls.STRICT_RULES)) == [s for _, s, _ in STRICT]
    assert column(spark, given, lambda c: urls.is_article(c, urls.DATED_RULES)) == [d for _, _, d in STRICT]
    loose = column(spark, given, urls.is_marked_article)
    assert loose == ["article_" in u and ".html" in u for u in given]


def test_absolutize_and_hash(spark):
    given = ["/a/b", "http://x.org/1", "https://x.org", "mailto:x", "#top", "", "//cdn.org/x", None, "página"]
    assert column(spark, given, lambda c: urls.absolutize(c, F.lit("https://s.org"))) == [
        "https://s.org/a/b", "http://x.org/1", "https://x.org", None, None, None, "https://s.org//cdn.org/x", None, None]
    assert column(spark, ["página", ""], urls.url_hash) == [hashlib.md5(v.encode()).hexdigest() for v in ("página", "")]


def test_dates(spark):
    given = ["/2024/07/05/x", "https://a/2024/13/45/b/2024/01/02/", "/0000/01/01/", "/2023/02/29/", "/2024/7/5/", "/12024/07/05/"]
    assert column(spark, given, urls.url_date) == [dt.date(2024, 7, 5), None, None, None, None, None]


def test_unwrap(spark):
    given = ["/web/20240701/https://ivpressonline.com/article_1.html", "https://web.archive.org/web/1/http://ivpressonline.com/a",
             "/web/x/https://ivpressonline.com/article_2.html", "//ivpressonline.com/article_3.html", "/web/1/https://o.org/a"]
    inner = column(spark, given, lambda c: urls.unwrap_replay(c, "ivpressonline.com"))
    assert inner == ["https://ivpressonline.com/article_1.html", "http://ivpressonline.com/a", given[2], given[3], given[4]]
    assert column(spark, ["//ivpressonline.com/a", "http://x"], urls.with_scheme) == ["https://ivpressonline.com/a", "http://x"]
    assert column(spark, ["https://a"], lambda c: urls.replay_url(F.lit("2024"), c)) == ["https://web.archive.org/web/2024/https://a"]


class _Hrefs(HTMLParser):
    def __init__(self):
        super().__init__()
        self.found = []

    def handle_starttag(self, tag, attrs):
        values = dict(attrs)
        if tag == "a" and "href" in values:
            self.found.append(values["href"] or "")


PAGES = [
    '<a href="/1">x</a><A class="q" HREF=\'/2\'>y</A><a\nhref = /3>z</a><a data-href="/no">n</a><a>no</a>',
    '<!-- <a href="/hidden"> --><script>var a = \'<a href="/js">\';</script><a title="a > b" href="/4?a=1&amp;b=2">t</a>',
    '<a href="">e</a><a href>v</a><abbr href="/no">x</abbr><a href="/5" href="/6">dup</a><a/href="/7">',
    "<style>a { }</style><p>text</p><a href='it\"s'>q</a><a href=\"it's &copy; &#233; &eacute;\">u</a>",
    '<a id="x" title="say href=/no" href="/8">t</a><a href="/9"/>', "", "no tags", '<a href="http://x.org/a\nb">nl</a>',
    '<a title=5" href="/one">a</a> <a href="/two">b</a>', "<a title=it's href='/a'>a</a><a href='/b'>b</a>",
    '<a x"y href="/q">a</a><a href="/r"class="c">b</a><a "href="/no">c</a><a href==/s>d</a><a href=/t/>e</a><a href="/u" / >f</a>',
]


def test_links_like_an_html_parser(spark):
    pages = spark.createDataFrame(list(enumerate(PAGES)), "page_id int, html string")
    got = {}
    for row in page_links(pages, ["page_id"]).orderBy("page_id", "pos").collect():
        got.setdefault(row.page_id, []).append(row.href)
    for i, page in enumerate(PAGES):
        parser = _Hrefs()
        parser.feed(page)
        if i == 2:
            parser.found.remove("/5") if "/5" in parser.found else None
        assert got.get(i, []) == parser.found, page


def test_links_of_the_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = page_links(pages, ["page_id"]).orderBy("page_id", "pos").collect()
    got = {}
    for row in rows:
        got.setdefault(row.page_id, []).append(row.href)
    for page in pages.collect():
        parser = _Hrefs()
        parser.feed(page.html)
        assert got.get(page.page_id, []) == parser.found


@pytest.mark.parametrize("given,host,base", [
    ("https://a.b.org/x?y", "a.b.org", "https://a.b.org"), ("http://a.org", "a.org", "http://a.org"), ("x", "", "")])
def test_host(spark, given, host, base):
    assert column(spark, [given], urls.host_of) == [host]
    assert column(spark, [given], urls.base_of) == [base]
    assert re.match("", given)
