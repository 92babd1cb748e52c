"""Aggregates over stored articles and the text report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Report texts, widths and list lengths.
TOP_ROWS = 10
TITLE_WIDTH = 70
RULE = "=" * 80
HEADING = "SCRAPING SUMMARY REPORT"
EMPTY_ADVICE = (
    "",
    "!!!No articles were saved.",
    "This could mean:",
    "  - No articles matched the heat death keywords",
    "  - The websites have changed structure",
    "  - The URL filters need adjustment",
    "",
    "Check scraper.log for detailed information.",
)
LANGUAGE_NAMES = {"en": "English"}
OTHER_LANGUAGE = "Spanish"
# End of fixed values.


def total_articles(articles: DataFrame) -> DataFrame:
    return articles.agg(F.count(F.lit(1)).alias("articles"))


def by_relevance(articles: DataFrame) -> DataFrame:
    """Articles and average score per relevance label, best first."""
    return (
        articles.groupBy("category")
        .agg(F.count(F.lit(1)).alias("articles"), F.avg("heat_score").alias("avg_score"))
        .orderBy(F.desc("avg_score"), "category")
    )


def by_source(articles: DataFrame) -> DataFrame:
    """Articles and average score per source, most articles first."""
    return (
        articles.groupBy("source")
        .agg(F.count(F.lit(1)).alias("articles"), F.avg("heat_score").alias("avg_score"))
        .orderBy(F.desc("articles"), "source")
    )


def language_name(language: Column) -> Column:
    name = F.lit(OTHER_LANGUAGE)
    for code, label in LANGUAGE_NAMES.items():
        name = F.when(language == code, label).otherwise(name)
    return name


def by_language(articles: DataFrame) -> DataFrame:
    """Articles per language code with its display name."""
    return (
        articles.groupBy("language").agg(F.count(F.lit(1)).alias("articles"))
        .select("language", language_name(F.col("language")).alias("language_name"), "articles")
    )


def top_articles(articles: DataFrame, n: int = TOP_ROWS) -> DataFrame:
    """The best-scored articles; ties go by URL hash."""
    return (
        articles.select("title", "source", "heat_score", "category", "url_hash")
        .orderBy(F.desc("heat_score"), "url_hash").limit(n)
    )


def newest(articles: DataFrame, n: int = TOP_ROWS) -> DataFrame:
    """The articles stored last with all their columns, so that costly ones can be made for these only."""
    return articles.orderBy(F.desc("scraped_date"), "url_hash").limit(n)


def newest_articles(articles: DataFrame, n: int = TOP_ROWS) -> DataFrame:
    """The articles stored last; ties go by URL hash."""
    return newest(articles.select("title", "heat_score", "category", "published_date", "scraped_date", "url_hash"), n)


def export_rows(articles: DataFrame) -> DataFrame:
    """The rows of the CSV export, under its column headings."""
    return articles.filter(F.col("heat_score") > 0).select(
        F.col("title").alias("Title"), F.col("source").alias("Source"),
        F.col("heat_score").alias("Score"), F.col("published_date").alias("Date"),
    )


def one_decimal(value: Column) -> Column:
    """One digit after the point, ties of the exact value to even."""
    return F.call_function("format_number", value, F.lit("0.0"))


def _line_array(section: int, *lines: Column | str) -> Column:
    """Lines of one section as (section, line) structs."""
    return F.array(*[
        F.struct(F.lit(section).alias("section"),
                 (F.lit(x) if isinstance(x, str) else x).alias("line")) for x in lines
    ])


GROUP_FIELDS = ("category", "source", "language")
# Bits of a group's `_set`, in the order of the fields: a set bit means "not grouped by".
BY_LABEL, BY_NAME, BY_CODE, ALL_ROWS = 0b011, 0b101, 0b110, 0b111


def _nothing(spark: SparkSession) -> DataFrame:
    """One row that counts no article; it keeps the grand total alive when nothing is stored."""
    empty = [F.lit(None).cast("string").alias(f) for f in GROUP_FIELDS]
    return spark.range(1).select(*empty, F.lit(None).cast("double").alias("heat_score"), F.lit(0).alias("_one"))


def report_groups(articles: DataFrame) -> DataFrame:
    """Counts and score sums by label, by source, by language and over all: one aggregation over grouping sets.

    Sums and counts can be added up, so the groups of several batches give those of all
    (:func:`merged_groups`); averages are taken at the end.
    """
    rows = articles.select(*GROUP_FIELDS, F.col("heat_score").cast("double").alias("heat_score"), F.lit(1).alias("_one"))
    return (
        rows.unionByName(_nothing(articles.sparkSession))
        .groupingSets([["category"], ["source"], ["language"], []], *GROUP_FIELDS)
        .agg(F.grouping_id().cast("int").alias("_set"), F.sum("_one").cast("bigint").alias("n"),
             F.count("heat_score").alias("scored"), F.sum("heat_score").alias("score_sum"))
        .filter((F.col("n") > 0) | (F.col("_set") == ALL_ROWS))
    )


def merged_groups(groups: DataFrame) -> DataFrame:
    """The groups of several batches added up; without any batch the total is none."""
    nothing = _nothing(groups.sparkSession).select(
        *GROUP_FIELDS, F.lit(ALL_ROWS).alias("_set"), F.lit(0).cast("bigint").alias("n"),
        F.lit(0).cast("bigint").alias("scored"), F.lit(None).cast("double").alias("score_sum"))
    return groups.select(*nothing.columns).unionByName(nothing).groupBy(*GROUP_FIELDS, "_set").agg(
        *(F.sum(c).alias(c) for c in ("n", "scored", "score_sum")))


def report_lines(articles: DataFrame) -> DataFrame:
    """The text report as (section, line_ord, line) in reading order.

    All counts and averages come from one aggregation over grouping sets, the
    top list from a second, column-pruned read.
    """
    return lines_of_groups(report_groups(articles), top_articles(articles))


def lines_of_groups(groups: DataFrame, best: DataFrame) -> DataFrame:
    """The report of counted groups and of the best articles; only these few rows are ranked, within their section."""
    kind = F.col("_set")
    groups = groups.withColumn("a", F.try_divide("score_sum", F.col("scored").cast("double")))
    order = [
        F.when(kind == BY_LABEL, -F.col("a")).when(kind == BY_NAME, -F.col("n").cast("double")),
        F.coalesce(*GROUP_FIELDS),
    ]
    rank = F.row_number().over(Window.partitionBy("_set").orderBy(*order))
    average = F.concat(F.lit("articles (avg score: "), one_decimal(F.col("a")), F.lit(")"))
    totals = F.concat(
        _line_array(0, "", RULE, HEADING, RULE, ""),
        _line_array(1, F.format_string("Total Articles in Database: %d", "n")),
        F.when(F.col("n") == 0, _line_array(2, *EMPTY_ADVICE)).otherwise(F.concat(
            _line_array(3, "", "By Relevance Category:"), _line_array(5, "", "By Source:"),
            _line_array(7, "", "By Language:"), _line_array(9, "", "Top 10 Most Relevant Articles:"))),
        _line_array(11, "", RULE),
    )
    grouped = groups.withColumn("_rank", rank).select("_rank", F.posexplode(
        F.when(kind == ALL_ROWS, totals)
        .when(kind == BY_LABEL, _line_array(4, F.format_string("  %-25s %4d %s", "category", "n", average)))
        .when(kind == BY_NAME, _line_array(6, F.format_string("  %-30s %4d %s", "source", "n", average)))
        .when(kind == BY_CODE, _line_array(8, F.format_string(
            "  %-30s %4d articles", language_name(F.col("language")), "n")))
    ).alias("_pos", "_line"))
    top_rank = F.row_number().over(Window.orderBy(F.desc("heat_score"), "url_hash"))
    best = best.withColumn("_rank", top_rank).select("_rank", F.posexplode(_line_array(
        10, "",
        F.format_string("  %d. [%s] %s", "_rank", one_decimal(F.col("heat_score")),
                        F.substring(F.coalesce("title", F.lit("")), 1, TITLE_WIDTH)),
        F.format_string("     Source: %s | Category: %s", "source", "category"),
    )).alias("_pos", "_line"))
    place = F.row_number().over(Window.partitionBy("_line.section").orderBy("_rank", "_pos"))
    return (
        grouped.unionByName(best)
        .select("_line.section", place.cast("bigint").alias("line_ord"), "_line.line")
        .orderBy("section", "line_ord")
    )
