"""The article store, and the file sinks for URL lists, exports and reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmill.operators.reports import export_rows
from newsmill.schemas import STORE_TABLES
from newsmill.sources.segments import BATCH, read_parts, settle, table_path

def create_store(spark: SparkSession, root: str) -> None:
    """Create the four tables below `root` unless they exist."""
    for name, schema in STORE_TABLES.items():
        spark.createDataFrame([], schema).write.mode("ignore").parquet(table_path(root, name))


def create_catalog_tables(spark: SparkSession, root: str, database: str = "default") -> None:
    """Register the store in the catalog, creating tables that are absent."""
    for name, schema in STORE_TABLES.items():
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS `{database}`.`{name}` ({columns}, `{BATCH}` STRING) "
            f"USING parquet PARTITIONED BY (`{BATCH}`) LOCATION '{table_path(root, name)}'"
        )
        spark.sql(f"ALTER TABLE `{database}`.`{name}` RECOVER PARTITIONS")  # of batches written before


def batch_name(run: str, number: int = 0) -> str:
    """The id of one batch of one run; two runs never share one, however they number their batches."""
    return f"{run}-{number:09d}"


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A stored table, recent batches and merged ones, with the batch id as a column."""
    return reduce(DataFrame.unionByName, read_parts(spark, root, table))


def write_batch(df: DataFrame, root: str, table: str, batch_id: int | str, database: str | None = None) -> None:
    """Add one batch to a table; writing the same batch again replaces it.

    So a batch that failed half-way, on any of the tables, is simply repeated.
    """
    settle(df.sparkSession, root)
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in STORE_TABLES[table]]
    path = f"{table_path(root, table)}/{BATCH}={batch_id}"
    df.select(*columns).write.mode("overwrite").parquet(path)
    if database is not None:
        df.sparkSession.sql(
            f"ALTER TABLE `{database}`.`{table}` ADD IF NOT EXISTS PARTITION (`{BATCH}` = '{batch_id}') LOCATION '{path}'")


def write_url_list(urls: DataFrame, path: str) -> None:
    """Distinct URLs as sorted text: a parallel range sort, part files in order."""
    urls.select("url").distinct().orderBy("url").write.mode("overwrite").text(path)


def write_report(lines: DataFrame, path: str) -> None:
    """The report as one text file (it has a few lines per source)."""
    lines.orderBy("section", "line_ord").select("line").coalesce(1).write.mode("overwrite").text(path)


def write_export(articles: DataFrame, path: str) -> None:
    """CSV of scored articles with the headings Title, Source, Score, Date."""
    export_rows(articles).write.mode("overwrite").option("header", True).option(
        "escape", '"').csv(path)
