"""Archive captures: filtering, daily collapse, sampling and lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsmill.functions.urls import is_marked_article, replay_url, unwrap_replay, with_scheme
from newsmill.operators.links import page_links
from newsmill.operators.ordering import running_total, with_global_index

# Default range, sections and sample size of the archive run.
RANGE_START = "20240601"
RANGE_END = "20240930"
ARCHIVE_DOMAIN = "ivpressonline.com"
ARCHIVE_SECTIONS = (
    "https://ivpressonline.com/news/",
    "https://ivpressonline.com/news/local/",
    "https://ivpressonline.com/",
)
SAMPLE_SIZE = 50
# End of fixed values.


def _stamp(ts: Column) -> Column:
    """14-digit timestamp as a long: a fixed-width aggregation buffer; NULL for anything but digits."""
    return ts.try_cast("bigint")


def _text(stamp: Column) -> Column:
    return F.lpad(stamp.cast("string"), 14, "0")


def in_range(captures: DataFrame, start: str = RANGE_START, end: str = RANGE_END) -> DataFrame:
    """Successful captures from `start` to `end`, both inclusive (any prefix of a timestamp).

    Plain comparisons on stored columns, so they reach the scan.
    """
    return captures.filter(
        F.col("ts").between(start.ljust(14, "0"), end.ljust(14, "9")) & (F.col("statuscode") == 200)
    )


def daily(captures: DataFrame) -> DataFrame:
    """The first capture of each URL and day: (url, ts)."""
    return (
        captures.groupBy("url", F.substring("ts", 1, 8).alias("_day"))
        .agg(F.min(_stamp(F.col("ts"))).alias("_ts"))
        .select("url", _text(F.col("_ts")).alias("ts"))
    )


def of_sections(captures: DataFrame, sections: DataFrame) -> DataFrame:
    """Captures of the listed section URLs with their list position `section_ord`.

    `sections` (section_ord, url) is a configuration table; Spark broadcasts it
    when its size allows.
    """
    return captures.join(sections.select("section_ord", "url"), "url")


def even_sample(captures: DataFrame, size: int = SAMPLE_SIZE) -> DataFrame:
    """At most `size` captures, evenly spaced in (section_ord, ts) order, with `capture_ord`."""
    order = [F.col("section_ord"), F.col("ts"), F.col("url")]
    indexed = with_global_index(captures, order, "_index")
    total = indexed.count()
    step = total // size if total > size else 1
    limit = size if total > size else total
    return (
        indexed.filter((F.col("_index") % step == 0) & (F.col("_index") < step * limit))
        .withColumn("capture_ord", F.expr(f"_index div {step}")).drop("_index")
    )


def first_capture(
    urls: DataFrame, captures: DataFrame, start: str = RANGE_START, end: str = RANGE_END
) -> DataFrame:
    """Every URL with the time and replay address of its first capture in range, or NULLs.

    Captures shrink to one row per URL (merged before the shuffle) ahead of the
    join; a URL list row appears exactly once in the result.
    """
    earliest = (
        in_range(captures, start, end).groupBy("url")
        .agg(F.min(_stamp(F.col("ts"))).alias("_ts"))
    )
    ts = _text(F.col("_ts"))
    return (
        urls.join(earliest, "url", "left")
        .withColumns({"ts": ts, "archive_url": replay_url(ts, F.col("url"))}).drop("_ts")
    )


def capture_article_urls(
    captured_pages: DataFrame, domain: str = ARCHIVE_DOMAIN, key: str = "capture_ord"
) -> DataFrame:
    """Article URLs linked from captured pages: (capture key, url)."""
    links = page_links(captured_pages, [key])
    return links.select(key, article_url(F.col("href"), domain).alias("url")).filter("url IS NOT NULL")


def article_url(href: Column, domain: str = ARCHIVE_DOMAIN) -> Column:
    """Unwrapped absolute article URL of a link in a capture, NULL for other links."""
    inner = unwrap_replay(href, domain)
    return F.when(is_marked_article(inner, domain), with_scheme(inner))


def new_urls_per_capture(captures: DataFrame, found: DataFrame) -> DataFrame:
    """Per capture: URLs not seen in any earlier capture, and the running total.

    `captures` has the dense 0-based `capture_ord`; `found` is (capture_ord, url).
    """
    first = found.groupBy("url").agg(F.min("capture_ord").alias("capture_ord"))
    fresh = first.groupBy("capture_ord").agg(F.count(F.lit(1)).alias("new_urls"))
    counted = captures.join(fresh, "capture_ord", "left").na.fill(0, ["new_urls"])
    return running_total(counted, "capture_ord", "new_urls", "total_urls")


def preview(urls: DataFrame, shown: int = 10) -> DataFrame:
    """The first URLs in sorted order, then a line with the number of further ones: (pos, entry)."""
    first = urls.select("url").orderBy("url").limit(shown)
    numbered = first.select(
        F.row_number().over(Window.orderBy("url")).alias("pos"), F.col("url").alias("entry"))
    more = urls.agg((F.count(F.lit(1)) - shown).alias("_n")).filter("_n > 0").select(
        F.lit(shown + 1).alias("pos"), F.format_string("... and %d more", "_n").alias("entry"))
    return numbered.unionByName(more)
