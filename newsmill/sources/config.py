"""Configuration as small tables: sources, lexicon, exclusions and search terms."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmill.functions.lexicon import Category, Lexicon, SearchTerm

# The configured news sources.
NEWS_SOURCES = (
    {"name": "Imperial Valley Press", "url": "https://www.ivpressonline.com",
     "sections": ["/news/local/", "/news/"], "language": "en", "bias": "LOCAL-UNRATED"},
    {"name": "Calexico Chronicle", "url": "https://calexicochronicle.com",
     "sections": ["/"], "language": "en", "bias": "LOCAL-UNRATED"},
    {"name": "Holtville Tribune", "url": "https://holtvilletribune.com",
     "sections": ["/category/regional-news/"], "language": "en", "bias": "LOCAL-UNRATED"},
    {"name": "The Desert Review", "url": "https://www.thedesertreview.com",
     "sections": ["/news/local/"], "language": "en", "bias": "LOCAL-UNRATED"},
    {"name": "Adelante Valle", "url": "https://www.ivpressonline.com",
     "sections": ["/adelante-valle/"], "language": "es", "bias": "LOCAL-UNRATED"},
)
DATE_RANGE_SOURCES = NEWS_SOURCES[:3]
# End of fixed values.

# A configuration is small by nature; a lexicon table with more patterns is refused.
MOST_PATTERNS = 100_000

_SOURCE_FIELDS = pa.schema([
    ("source_ord", pa.int32()), ("source", pa.string()), ("base", pa.string()),
    ("language", pa.string()), ("source_bias", pa.string()), ("sections", pa.list_(pa.string())),
])
_LEXICON_FIELDS = pa.schema([
    ("language", pa.string()), ("category", pa.string()), ("priority", pa.int32()),
    ("weight", pa.int32()), ("pattern_ord", pa.int32()), ("pattern", pa.string()),
])
_EXCLUSION_FIELDS = pa.schema([("language", pa.string()), ("pattern", pa.string())])
_TERM_FIELDS = pa.schema([
    ("term_ord", pa.int32()), ("priority", pa.int32()), ("category", pa.string()),
    ("term", pa.string()), ("phrases", pa.list_(pa.string())),
])


def _table(spark: SparkSession, rows: list[dict], fields: pa.Schema) -> DataFrame:
    """A local relation: Spark knows its size and decides on broadcasts by itself."""
    return spark.createDataFrame(pa.Table.from_pylist(rows, schema=fields))


def source_table(spark: SparkSession, sources: Sequence[dict] = NEWS_SOURCES) -> DataFrame:
    """One row per source with its list of sections."""
    return _table(spark, [
        {"source_ord": i, "source": s["name"], "base": s["url"], "language": s["language"],
         "source_bias": s["bias"], "sections": list(s["sections"])}
        for i, s in enumerate(sources)
    ], _SOURCE_FIELDS)


def sections(sources: DataFrame) -> DataFrame:
    """One row per section with its URL and list position."""
    return sources.select(
        "source_ord", "source", "base", "language", "source_bias",
        F.posexplode("sections").alias("section_ord", "section"),
    ).withColumn("section_url", F.concat("base", "section"))


def lexicon_table(spark: SparkSession, lexicons: dict[str, Lexicon]) -> DataFrame:
    """All patterns of the lexicons, one row each."""
    rows = []
    for language, lexicon in lexicons.items():
        order = 0
        for category in lexicon.categories:
            for pattern in category.patterns:
                rows.append({"language": language, "category": category.name,
                             "priority": category.priority, "weight": category.weight,
                             "pattern_ord": order, "pattern": pattern})
                order += 1
    return _table(spark, rows, _LEXICON_FIELDS)


def exclusion_table(spark: SparkSession, lexicons: dict[str, Lexicon]) -> DataFrame:
    return _table(spark, [
        {"language": language, "pattern": pattern}
        for language, lexicon in lexicons.items() for pattern in lexicon.exclusions
    ], _EXCLUSION_FIELDS)


def term_table(spark: SparkSession, terms: Sequence[SearchTerm]) -> DataFrame:
    return _table(spark, [
        {"term_ord": i, "priority": t.priority, "category": t.category, "term": t.term,
         "phrases": list(t.phrases)}
        for i, t in enumerate(terms)
    ], _TERM_FIELDS)


def load_lexicons(patterns: DataFrame, exclusions: DataFrame | None = None) -> dict[str, Lexicon]:
    """Lexicons from tables shaped like :func:`lexicon_table` and :func:`exclusion_table`.

    Patterns become part of the scoring plan, so this configuration is read
    when the plan is built; tables of more than `MOST_PATTERNS` rows raise a
    ValueError.  Each row keeps its weight and priority, and rows their order:
    neighbours that agree in both and in the category are one part of it.
    """
    grouped: dict[str, list[tuple[Category, list[str]]]] = {}
    for row in sorted(_collected(patterns), key=lambda r: (r.language, r.pattern_ord)):
        parts, head = grouped.setdefault(row.language, []), Category(row.category, row.priority, row.weight, ())
        if not parts or parts[-1][0] != head:
            parts.append((head, []))
        parts[-1][1].append(row.pattern)
    blocked: dict[str, list[str]] = {}
    for row in (_collected(exclusions) if exclusions is not None else []):
        blocked.setdefault(row.language, []).append(row.pattern)
    return {
        language: Lexicon(tuple(head._replace(patterns=tuple(own)) for head, own in parts), tuple(blocked.get(language, ())))
        for language, parts in grouped.items()
    }


def _collected(table: DataFrame) -> list:
    rows = table.limit(MOST_PATTERNS + 1).collect()
    if len(rows) > MOST_PATTERNS:
        raise ValueError(f"more than {MOST_PATTERNS} patterns")
    return rows
