"""The report's state: what each batch adds to it, so that a report reads no articles.

A batch leaves the counts and score sums of its labels, sources and languages, and its own ten best articles, in one folder
each below `_report` of the store.  Sums add up and the ten best of all are among the ten best of each batch, so the parts
of any number of batches give the report of the whole store.  Writing a batch again replaces its part.  The part is written
after the batch's articles: a batch that failed before has none until it is repeated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsmill.operators import reports
from newsmill.sources.segments import BATCH
from newsmill.session import file_system

_TEXT, _COUNT = T.StringType(), T.LongType()
PARTS = {
    "groups": T.StructType([
        *(T.StructField(f, _TEXT) for f in reports.GROUP_FIELDS), T.StructField("_set", T.IntegerType()),
        T.StructField("n", _COUNT), T.StructField("scored", _COUNT), T.StructField("score_sum", T.DoubleType())]),
    "best": T.StructType([
        T.StructField("title", _TEXT), T.StructField("source", _TEXT), T.StructField("heat_score", T.DoubleType()),
        T.StructField("category", _TEXT), T.StructField("url_hash", _TEXT)]),
}


def _path(root: str, part: str) -> str:
    return f"{root.rstrip('/')}/_report/{part}"


def write_state(articles: DataFrame, root: str, batch_id: int | str) -> None:
    """Stores what the articles of one batch add to the report."""
    for part, rows in (("groups", reports.report_groups(articles)), ("best", reports.top_articles(articles))):
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in PARTS[part]]
        rows.select(*columns).coalesce(1).write.mode("overwrite").parquet(f"{_path(root, part)}/{BATCH}={batch_id}")


def read_state(spark: SparkSession, root: str, part: str) -> DataFrame:
    """The stored rows of one part, with the batch id; none of a store that has no report state."""
    schema = T.StructType([*PARTS[part].fields, T.StructField(BATCH, _TEXT)])
    system, at = file_system(spark, _path(root, part))
    return spark.read.schema(schema).parquet(_path(root, part)) if system.exists(at) else spark.createDataFrame([], schema)


def groups(spark: SparkSession, root: str) -> DataFrame:
    """Counts and score sums of the whole store."""
    return reports.merged_groups(read_state(spark, root, "groups"))


def best(spark: SparkSession, root: str) -> DataFrame:
    """The ten best articles of the whole store."""
    return reports.top_articles(read_state(spark, root, "best"))


def _counted(spark: SparkSession, root: str, kind: int) -> DataFrame:
    average = F.try_divide("score_sum", F.col("scored").cast("double"))
    return groups(spark, root).filter(F.col("_set") == kind).withColumns({"articles": F.col("n"), "avg_score": average})


def total(spark: SparkSession, root: str) -> DataFrame:
    return _counted(spark, root, reports.ALL_ROWS).select("articles")


def by_relevance(spark: SparkSession, root: str) -> DataFrame:
    """Like :func:`newsmill.operators.reports.by_relevance`."""
    return _counted(spark, root, reports.BY_LABEL).select("category", "articles", "avg_score").orderBy(F.desc("avg_score"), "category")


def by_source(spark: SparkSession, root: str) -> DataFrame:
    """Like :func:`newsmill.operators.reports.by_source`."""
    return _counted(spark, root, reports.BY_NAME).select("source", "articles", "avg_score").orderBy(F.desc("articles"), "source")


def by_language(spark: SparkSession, root: str) -> DataFrame:
    """Like :func:`newsmill.operators.reports.by_language`."""
    return _counted(spark, root, reports.BY_CODE).select(
        "language", reports.language_name(F.col("language")).alias("language_name"), "articles")


def report(spark: SparkSession, root: str) -> DataFrame:
    """The text report of the whole store as :func:`newsmill.operators.reports.report_lines` gives it."""
    return reports.lines_of_groups(groups(spark, root), best(spark, root))
