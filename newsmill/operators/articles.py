"""From stored pages to article records."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from newsmill.functions.htmltext import page_parts
from newsmill.functions.urls import url_hash

# Least body length, error row texts.
LEAST_BODY = 100
ERROR_TYPE = "SCRAPE_FAILED"
ERROR_MESSAGE = "Failed to extract article"
# End of fixed values.

# What a page can be asked for; `parse_error` is the type of the exception that a page the parser rejects raised.
PARTS = {"title": pa.string(), "text": pa.string(), "paragraphs": pa.list_(pa.string()), "links": pa.list_(pa.string()), "parse_error": pa.string()}


# Pages of about so many bytes are parsed before their parts go back to Spark, however many rows a batch has.
PIECE_BYTES = 1_000_000


def _rows(html: Iterable[str | None], parts: Sequence[str]) -> Iterator[tuple]:
    """The parts of each page; NULLs for a page that is NULL or that the parser rejects, which must cost one page, not the job."""
    for page in html:
        found = {}
        if page is not None:
            try:
                found = page_parts(page)._asdict()
            except Exception as failure:  # noqa: BLE001
                found = {"parse_error": type(failure).__name__}
        yield tuple(found.get(part) for part in parts)


def _parsed(html: pa.Array, parts: Sequence[str], fields: Sequence[pa.Field]) -> Iterator[pa.StructArray]:
    """The parts of a batch of pages in its order, piece by piece: of the batch only one piece is held as Python strings."""
    for start, stop in _pieces(html):
        columns = list(zip(*_rows((page.as_py() for page in html[start:stop]), parts), strict=True)) or [()] * len(fields)
        yield pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, fields, strict=True)], fields=fields)


def _pieces(html: pa.Array) -> Iterator[tuple[int, int]]:
    """Runs of pages of at least PIECE_BYTES, the last one shorter; one empty run for no pages."""
    start = size = 0
    for at, length in enumerate(pc.binary_length(html).to_pylist(), 1):
        size += length or 0
        if size >= PIECE_BYTES:
            yield start, at
            start, size = at, 0
    if start < len(html) or not len(html):
        yield start, len(html)


def _parser(parts: Sequence[str]):
    """An Arrow function from HTML to a struct of `parts`; Spark neither pushes filters below it nor calls it twice."""
    fields = [pa.field(part, PARTS[part]) for part in parts]

    @F.arrow_udf(from_arrow_schema(pa.schema(fields)))
    def parsed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield from _parsed(batch, parts, fields)

    return parsed.asNondeterministic()


def with_parts(pages: DataFrame, parts: Sequence[str] = ("title", "text", "paragraphs", "links", "parse_error")) -> DataFrame:
    """`pages` with `html` replaced by the named parts, all from one pass over each page."""
    return (
        pages.withColumn("_parsed", _parser(parts)(F.col("html"))).drop("html")
        .withColumns({part: F.col(f"_parsed.{part}") for part in parts}).drop("_parsed")
    )


def parse_pages(pages: DataFrame) -> DataFrame:
    """Replace `html` by `title`, `text` and `parse_error`; title and text are NULL where parsing failed."""
    return with_parts(pages, ("title", "text", "parse_error"))


def is_extracted(title: Column, text: Column, least_body: int = LEAST_BODY) -> Column:
    """True for a usable article: parsed, and a body of the least length (0: of any length)."""
    return F.coalesce(title.isNotNull() & (F.length(text) >= least_body), F.lit(False))


def author_list(authors: Column) -> Column:
    """Names joined by a comma, NULL for none."""
    return F.when(F.size(authors) > 0, F.array_join(authors, ", "))


def publish_day(published: Column) -> Column:
    """Day of a publication time, or of a text that starts like one, as `yyyy-MM-dd`; NULL if unknown or unreadable."""
    return F.date_format(published.try_cast("timestamp_ntz"), "yyyy-MM-dd")


def article_records(
    parsed: DataFrame,
    language: Column | None = None,
    authors: Column | None = None,
    published: Column | None = None,
) -> DataFrame:
    """Article columns (url, url_hash, title, authors, text, published_date, language)."""
    missing = F.lit(None).cast("string")
    return parsed.select(
        "url", url_hash(F.col("url")).alias("url_hash"), "title",
        (missing if authors is None else author_list(authors)).alias("authors"),
        "text",
        (missing if published is None else publish_day(published)).alias("published_date"),
        (missing if language is None else language).alias("language"),
    )


def extract_articles(pages: DataFrame, carry: list[str]) -> tuple[DataFrame, DataFrame]:
    """(articles, rejected) of stored pages; `carry` names page columns to keep.

    Both sides come from one parsed frame; write them in one pass over a
    checkpoint if the two are needed.
    """
    parsed = parse_pages(pages.select(*carry, "html"))
    good = is_extracted(F.col("title"), F.col("text"))
    return parsed.filter(good).drop("parse_error"), parsed.filter(~good).select(*carry, "parse_error")


def error_rows(rejected: DataFrame, at: Column) -> DataFrame:
    """Error-log rows of pages without a usable article."""
    return rejected.select(at.alias("timestamp"), "source", "url", F.lit(ERROR_TYPE).alias("error_type"), error_message(rejected))


def error_message(failed: DataFrame) -> Column:
    """`error_message` of pages without an article; one that the parser rejected names its exception, if `parse_error` has it."""
    if "parse_error" not in failed.columns:
        return F.lit(ERROR_MESSAGE).alias("error_message")
    return F.concat(F.lit(ERROR_MESSAGE), F.coalesce(F.concat(F.lit(": "), F.col("parse_error")), F.lit(""))).alias("error_message")
