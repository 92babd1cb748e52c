"""Schemas of the stored tables and of the inputs."""

from __future__ import annotations

from pyspark.sql import types as T

MATCH = T.StructType([
    T.StructField("keyword", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("weight", T.IntegerType()),
    T.StructField("points", T.IntegerType()),
])

ARTICLES = T.StructType([
    T.StructField("source", T.StringType(), False),
    T.StructField("source_bias", T.StringType()),
    T.StructField("language", T.StringType()),
    T.StructField("url", T.StringType(), False),
    T.StructField("url_hash", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("authors", T.StringType()),
    T.StructField("published_date", T.DateType()),
    T.StructField("scraped_date", T.TimestampType()),
    T.StructField("text_content", T.StringType()),
    T.StructField("keywords_matched", T.ArrayType(MATCH)),
    T.StructField("heat_score", T.DoubleType()),
    T.StructField("category", T.StringType()),
    T.StructField("search_priority", T.IntegerType()),
    T.StructField("search_keywords", T.StringType()),
])

KEYWORD_MATCHES = T.StructType([
    T.StructField("url_hash", T.StringType()),
    T.StructField("keyword", T.StringType()),
    T.StructField("keyword_type", T.StringType()),
    T.StructField("match_count", T.IntegerType()),
    T.StructField("weight", T.IntegerType()),
])

SCRAPE_SESSIONS = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("start_time", T.TimestampType()),
    T.StructField("end_time", T.TimestampType()),
    T.StructField("articles_found", T.LongType()),
    T.StructField("articles_new", T.LongType()),
    T.StructField("articles_scraped", T.LongType()),
    T.StructField("errors", T.LongType()),
    T.StructField("status", T.StringType()),
])

ERROR_LOG = T.StructType([
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("source", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("error_type", T.StringType()),
    T.StructField("error_message", T.StringType()),
])

STORE_TABLES = {
    "articles": ARTICLES,
    "keyword_matches": KEYWORD_MATCHES,
    "scrape_sessions": SCRAPE_SESSIONS,
    "error_log": ERROR_LOG,
}

PAGES = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()),
])

CAPTURES = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("ts", T.StringType()),
    T.StructField("statuscode", T.IntegerType()),
])
