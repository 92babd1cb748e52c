import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from newsmill.functions.htmltext import page_parts, title_and_body
from newsmill.operators import articles as art

LONG = "word " * 30


@pytest.mark.parametrize("html,title,body", [
    ("<title>T</title><h1> A <b>B</b></h1><article>x<p>y</p> z </article>", "AB", "x\ny\nz"),
    ("<title> T </title><main>m</main>", "T", "m"),
    ("<p>one</p><p>two <i>three</i></p>", "No title", "one\n\ntwothree"),
    ("<div class='content'>c</div><div class='x entry-content'>e</div>", "No title", "e"),
    ("<div class='article-body'>b<div>inner</div>tail</div>after", "No title", "b\ninner\ntail"),
    ("<article></article><p>p</p>", "No title", "p"),
    ("<article>a<script>no()</script><style>s</style><!-- c -->b</article>", "No title", "a\nb"),
    ("<p>a<p>b", "No title", "ab\n\nb"),
    ("<article>a<br>b<br/>c<img src=x>d</article>e", "No title", "a\nb\nc\nd"),
    ("<article>x &amp; y &lt;z&gt; &#233; &copy;</article>", "No title", "x & y <z> é ©"),
    ("<article>one</article><article>two</article>", "No title", "one"),
    ("<h1></h1><title>T</title><main>x</main>", "", "x"),
    ("<article>a < b</article>", "No title", "a < b"),
    ("<main>m<article>a</article></main>", "No title", "a"),
    ("<article>x</p></div>y</article>z", "No title", "x\ny"),
    ("<article>a<![CDATA[b]]>c</article>", "No title", "a\nb\nc"),
    ("", "No title", ""),
])
def test_title_and_body(html, title, body):
    assert title_and_body(html) == (title, body)


def test_all_parts_from_one_pass(spark):
    html = '<title>T</title><p>a<a title=5" href="/1?x=1&amp;y">l</a></p><!-- <a href="/no"> --><a href>e</a><p></p><p>b'
    assert page_parts(html) == ("T", "al\n\n\n\nb", ["al", "", "b"], ["/1?x=1&y", ""])
    pages = spark.createDataFrame([(1, html, "x"), (2, None, "y"), (3, "", "z")], "id int, html string, Links_of string")
    made = art.with_parts(pages)
    rows = {r.id: r for r in made.collect()}
    assert (rows[1].links, rows[1].paragraphs, rows[1].title) == (["/1?x=1&y", ""], ["al", "", "b"], "T")
    assert (rows[2].title, rows[2].links, rows[2].parse_error) == (None, None, None)
    assert (rows[3].title, rows[3].text, rows[3].links, rows[3].paragraphs) == ("No title", "", [], [])
    assert art.with_parts(pages.limit(0)).collect() == []
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython [") == 1


def test_a_rejected_page_names_its_exception(spark, monkeypatch):
    def failing(_html):
        raise AssertionError("markup")
    monkeypatch.setattr(art, "page_parts", failing)
    assert list(art._rows(["<p>", None], ("title", "parse_error"))) == [(None, "AssertionError"), (None, None)]
    failed = spark.createDataFrame([("s", "u", "AssertionError"), ("s", "v", None)], "source string, url string, parse_error string")
    got = {r.url: r.error_message for r in art.error_rows(failed, F.lit("t")).collect()}
    assert got == {"u": "Failed to extract article: AssertionError", "v": "Failed to extract article"}


def test_extraction_splits_good_and_bad(spark):
    pages = spark.createDataFrame(
        [("u1", f"<h1>T</h1><article>{LONG}</article>"), ("u2", "<article>short</article>"), ("u3", None)],
        "url string, html string")
    good, bad = art.extract_articles(pages, ["url"])
    row = good.first()
    assert good.count() == 1 and (row.url, row.title, row.text) == ("u1", "T", LONG.strip())
    errors = art.error_rows(bad.withColumn("source", F.lit("s")), F.lit("t")).orderBy("url").collect()
    assert [e.url for e in errors] == ["u2", "u3"] and errors[0].error_type == "SCRAPE_FAILED"


def test_pages_are_parsed_once(spark):
    pages = spark.createDataFrame([("u", "<p>x</p>")], "url string, html string")
    good, _ = art.extract_articles(pages, ["url"])
    plan = good._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython [") == 1


def test_records(spark):
    parsed = spark.createDataFrame(
        [("u", "t", "x", ["A", "B"], "2024-07-01 23:59:00"), ("v", "t", "x", [], None)],
        "url string, title string, text string, people array<string>, at string")
    rows = art.article_records(
        parsed, F.lit("en"), F.col("people"), F.col("at").cast("timestamp")).orderBy("url").collect()
    assert (rows[0].authors, rows[0].published_date, rows[0].language) == ("A, B", "2024-07-01", "en")
    assert rows[1].authors is None and rows[1].published_date is None


def test_a_large_batch_is_parsed_by_piece(monkeypatch):
    """What a worker holds as Python strings follows the length of the pages, not the rows of a batch."""
    monkeypatch.setattr(art, "PIECE_BYTES", 20)
    fields = [pa.field(part, art.PARTS[part]) for part in ("title", "text", "links")]
    pages = [f"<title>{i}</title><p>p{i}</p>" if i % 3 else None for i in range(10)]
    made = list(art._parsed(pa.array(pages), ("title", "text", "links"), fields))
    assert [len(piece) for piece in made] == [2, 1, 2, 1, 2, 1, 1]
    assert [row["text"] for piece in made for row in piece.to_pylist()] == [f"p{i}" if i % 3 else None for i in range(10)]
    assert [len(piece) for piece in art._parsed(pa.array([], pa.string()), ("title", "text", "links"), fields)] == [0]
    monkeypatch.setattr(art, "PIECE_BYTES", 10**6)
    assert len(list(art._parsed(pa.array(pages), ("title", "text", "links"), fields))) == 1
