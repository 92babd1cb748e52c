"""Article discovery from section and archive pages."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsmill.functions.urls import STRICT_RULES, UrlRules, is_article, url_date
from newsmill.operators.links import page_links
from newsmill.operators.keyfilter import key_filter, passing
from newsmill.operators.ordering import FILTER_VALUES, first_n, first_n_per_group, key_list_size
from newsmill.session import cut_lineage

# Default caps.
LINKS_PER_CRAWL = 50
ARTICLES_PER_SOURCE = 10
SELECTED_IF_TOO_SMALL = 20
SELECTED_IF_UNREADABLE = 50
# End of fixed values.

POSITION = ("section_ord", "pos")


def section_pages(pages: DataFrame, sources: DataFrame) -> DataFrame:
    """Pages of the sections of each source, with the base URL of the source.

    `sources` has one row per section (see :func:`newsmill.sources.config.sections`).
    """
    listed = sources.select("source", "base", "section_ord", F.col("section_url").alias("url"))
    few = [row.url for row in listed.select("url").distinct().limit(FILTER_VALUES + 1).collect()]
    if len(few) <= FILTER_VALUES:  # the filter reaches the scan and skips row groups
        return pages.filter(F.col("url").isin(few)).join(listed, "url")
    n, small = key_list_size(listed, ["source", "base", "url"])
    if small:
        return pages.join(F.broadcast(listed), "url")
    return passing(pages, key_filter(listed, ["url"], n)).join(listed, "url")


def section_links(listing: DataFrame, rules: UrlRules = STRICT_RULES) -> DataFrame:
    """All links of listing pages with `is_valid`: (source, section_ord, pos, url, is_valid)."""
    links = page_links(listing, ["source", "section_ord"], base=F.col("base"))
    return links.select(
        "source", "section_ord", "pos", F.col("full_url").alias("url"),
        F.coalesce(is_article(F.col("full_url"), rules), F.lit(False)).alias("is_valid"),
    )


def first_seen(links: DataFrame) -> DataFrame:
    """Distinct URLs per source at their first position.

    The position (two ints) travels as one long, so this is a hash aggregation:
    partial results are merged before the shuffle, and the key contains the URL,
    so no source is too large.
    """
    spot = F.shiftleft(F.col("section_ord").cast("bigint"), 32).bitwiseOR(F.col("pos").cast("bigint"))
    return links.groupBy("source", "url").agg(F.min(spot).alias("_spot")).select(
        "source", "url",
        F.shiftright("_spot", 32).cast("int").alias("section_ord"),
        F.col("_spot").bitwiseAND(F.lit((1 << 32) - 1)).cast("int").alias("pos"),
    )


def crawl(links: DataFrame, max_links: int = LINKS_PER_CRAWL) -> DataFrame:
    """Per source the first `max_links` distinct valid links in page order."""
    found = first_seen(links.filter("is_valid"))
    return first_n_per_group(found, ["source"], [F.col(c) for c in POSITION], max_links, "url")


def crawl_counters(links: DataFrame, sources: DataFrame) -> DataFrame:
    """Per source: links scanned and distinct valid articles; silent sources show 0."""
    counts = (
        links.groupBy("source", "url").agg(
            F.count(F.lit(1)).alias("n"), F.max(F.col("is_valid").cast("int")).alias("v"))
        .groupBy("source").agg(
            F.sum("n").alias("total_links"), F.sum("v").cast("bigint").alias("valid_links"))
    )
    return (
        sources.select("source").distinct().join(counts, "source", "left")
        .na.fill(0, ["total_links", "valid_links"])
    )


def with_attributes(found: DataFrame, sources: DataFrame) -> DataFrame:
    """Discovered URLs with list position, bias and language of their source.

    `sources` has one row per source; Spark broadcasts it if its size allows.
    """
    return found.join(sources.select("source", "source_ord", "source_bias", "language"), "source")


def in_date_range(found: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """URLs dated within [start, end], and those whose date is unknown."""
    day = F.col("estimated_date")
    return found.filter(day.isNull() | day.between(F.lit(start), F.lit(end)))


def archive_first(archive: DataFrame, sections: DataFrame) -> DataFrame:
    """Archive results; section results only for sources the archive knows nothing of.

    The archive rows are used twice and are fixed first, so their pages are read
    once; the source names are reduced to one row each before the anti-join.
    """
    archive = cut_lineage(archive)
    covered = archive.select("source").distinct()
    fallback = sections.join(covered, "source", "left_anti")
    return (
        archive.withColumn("via", F.lit("archive"))
        .unionByName(fallback.withColumn("via", F.lit("section")))
    )


def discover_in_range(
    archive_links: DataFrame, links: DataFrame, start: dt.date, end: dt.date
) -> DataFrame:
    """Date-range discovery: (source, url, section_ord, pos, estimated_date, via).

    The archive listing is trusted for its range; section links are filtered.
    """
    def dated(frame: DataFrame) -> DataFrame:
        found = first_seen(frame.filter("is_valid"))
        return found.withColumn("estimated_date", url_date(F.col("url")))

    return archive_first(dated(archive_links), in_date_range(dated(links), start, end))


def newest_first(source_ord: str = "source_ord") -> list[Column]:
    """Order of a date-range run: source list order, date descending, discovery order."""
    return [F.col(source_ord), F.col("estimated_date").desc_nulls_last(),
            F.col("section_ord"), F.col("pos"), F.col("url")]


def select_articles(found: DataFrame, selection: int | str | None, order: list[Column]) -> DataFrame:
    """The user's cap: nothing → all, a number below 1 → 20, unreadable → 50, else first n."""
    wanted = "" if selection is None else str(selection).strip()
    if wanted == "":
        return found
    try:
        n = int(wanted)
    except ValueError:
        n = SELECTED_IF_UNREADABLE
    return first_n(found, order, n if n >= 1 else SELECTED_IF_TOO_SMALL)


def found_per_source(found: DataFrame) -> DataFrame:
    """Discovered articles per source, most first."""
    return (
        found.groupBy("source").agg(F.count(F.lit(1)).alias("articles"))
        .orderBy(F.desc("articles"), "source")
    )

