"""Match rows and category breakdown of scored articles.

Each article row holds all its hits, so both are plain generators: no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def match_rows(scored: DataFrame, key: str = "url_hash") -> DataFrame:
    """One row per keyword occurrence (`match_count` is always 1)."""
    return (
        scored.select(key, F.explode("hits").alias("_hit"))
        .select(key, "_hit.category", "_hit.weight", "_hit.pattern_ord",
                F.posexplode("_hit.keywords").alias("occurrence", "keyword"))
        .select(key, "keyword", F.col("category").alias("keyword_type"),
                F.lit(1).alias("match_count"), "weight", "pattern_ord", "occurrence")
    )


def category_breakdown(scored: DataFrame, key: str = "url_hash") -> DataFrame:
    """Per article and category: matches, unique_matches, score and listing order."""
    category = F.explode(F.array_distinct(F.col("hits.category"))).alias("category")
    own = F.filter("hits", lambda h: h["category"] == F.col("category"))
    found = F.flatten(F.col("_own.keywords"))
    weight = F.col("_own")[0]["weight"].cast("bigint")
    return (
        scored.select(key, "hits", category)
        .select(key, "category", own.alias("_own"))
        .select(
            key, "category",
            F.size(found).cast("bigint").alias("matches"),
            F.size(F.array_distinct(found)).cast("bigint").alias("unique_matches"),
            (weight * F.size(found)).alias("score"),
            F.col("_own")[0]["pattern_ord"].alias("first_pattern_ord"),
        )
    )


def breakdown_listing(scored: DataFrame, key: str = "url_hash") -> DataFrame:
    """The breakdown in lexicon order, as printed per article."""
    rows = category_breakdown(scored, key)
    line = F.format_string("    - %s: %d matches (%d points)", "category", "matches", "score")
    return rows.select(key, "first_pattern_ord", "category", "matches", "score", line.alias("line"))


def stored_breakdown(matches: DataFrame, articles: DataFrame) -> DataFrame:
    """The breakdown again, from stored match rows joined to their articles.

    Counts are merged before the shuffle; the article title joins the totals,
    not the single match rows.
    """
    totals = matches.groupBy("url_hash", "keyword_type").agg(
        F.count(F.lit(1)).alias("matches"), F.sum(F.col("weight").cast("bigint")).alias("score"))
    return articles.select("url_hash", "title", "heat_score").join(totals, "url_hash")
