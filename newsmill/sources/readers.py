"""Readers for URL lists, capture index answers and stored pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_EDGE_SPACE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def stripped(value: Column) -> Column:
    """Text without white space at either end."""
    return F.regexp_replace(value, _EDGE_SPACE, "")


def clean_url_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    """Stripped, non-empty lines as `url`; other columns stay and nothing is deduplicated."""
    return lines.withColumn("url", stripped(F.col(line))).drop(line).filter("url <> ''")


def read_url_list(spark: SparkSession, path: str) -> DataFrame:
    """URL list files, one URL per line: (url, file, block, row) where the last three give the order."""
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return clean_url_lines(lines)


def parse_capture_index(answers: DataFrame, body: str = "value", keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """Capture timestamps of JSON index answers (an array of rows, the first one the header)."""
    rows = F.from_json(F.col(body), "array<array<string>>")
    return (
        answers.select(*keep, F.posexplode(rows).alias("_pos", "_row"))
        .filter("_pos > 0").select(*keep, F.get("_row", F.lit(0)).alias("ts")).filter("ts IS NOT NULL")
    )


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt out to all cores if the input has fewer splits than the session has cores.

    A few large row groups would otherwise keep most cores idle during CPU-bound
    work.  Inputs with enough splits, as any large table has, are not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Stored pages (page_id, url, html)."""
    return spread(spark.read.parquet(path))
