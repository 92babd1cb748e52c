"""Outcome of every candidate and the counters built from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsmill.functions.scoring import DEFAULT_THRESHOLD, keep

# Outcome names, session status.
ALREADY = "already_scraped"
NO_ARCHIVE = "no_archive"
ERROR = "errors"
LOW = "score_too_low"
SAVED = "saved"
COMPLETED = "COMPLETED"
FAILED = "FAILED"
# End of fixed values.


def with_outcome(
    evaluated: DataFrame, threshold: float | None = DEFAULT_THRESHOLD, seq: str | None = None
) -> DataFrame:
    """Add `outcome` to evaluated candidates.

    Expects `already` (stored before the run), `extracted`, `heat_score`,
    `url_hash` and optionally `captured`.  If a URL can be a candidate more than
    once, `seq` names the run order: those after the first one that is kept are
    "already scraped" like in a sequential run.
    """
    kept = ~F.col("already") & F.col("extracted") & keep(F.col("heat_score"), threshold)
    no_capture = ~F.col("captured") if "captured" in evaluated.columns else F.lit(False)
    if seq is None:
        first, later = kept, F.lit(False)
    else:
        evaluated = evaluated.withColumn(
            "_first_kept", F.min(F.when(kept, F.col(seq))).over(Window.partitionBy("url_hash")))
        first, later = F.col(seq) == F.col("_first_kept"), F.col(seq) > F.col("_first_kept")
    outcome = (
        F.when(F.col("already") | later, ALREADY)
        .when(no_capture, NO_ARCHIVE)
        .when(~F.col("extracted"), ERROR)
        .when(first, SAVED)
        .otherwise(LOW)
    )
    return evaluated.withColumn("outcome", outcome).drop("_first_kept")


def _times(outcome: Column, copies: Column | None, *names: str) -> Column:
    weight = F.lit(1) if copies is None else copies
    return F.coalesce(F.sum(F.when(outcome.isin(*names), weight)), F.lit(0))


def counter_columns(copies: str | None = None) -> list[Column]:
    """The counters of a run as aggregates, to be collected or observed while the outcomes are written."""
    outcome = F.col("outcome")
    n = None if copies is None else F.col(copies)
    repeats = F.lit(0) if n is None else F.coalesce(F.sum(F.when(outcome == SAVED, n - 1)), F.lit(0))
    return [
        (F.count(F.lit(1)) if n is None else F.coalesce(F.sum(n), F.lit(0))).cast("bigint").alias("total"),
        (_times(outcome, n, LOW) + _times(outcome, None, SAVED)).cast("bigint").alias("processed"),
        (_times(outcome, n, ALREADY) + repeats).cast("bigint").alias(ALREADY),
        _times(outcome, None, SAVED).cast("bigint").alias(SAVED),
        _times(outcome, n, LOW).cast("bigint").alias(LOW),
        _times(outcome, n, ERROR).cast("bigint").alias(ERROR),
        _times(outcome, n, NO_ARCHIVE).cast("bigint").alias(NO_ARCHIVE),
    ]


def run_counters(outcomes: DataFrame, copies: str | None = None) -> DataFrame:
    """One row: total, processed and the number of each outcome, plus the hit rate.

    `copies` names a column telling how often a URL was listed: the first copy
    has the row's outcome, and the later copies of a saved one are already stored.
    """
    return outcomes.agg(*counter_columns(copies)).withColumn("hit_rate", hit_rate(F.col(SAVED), F.col("processed")))


COUNTERS = f"total long, processed long, {ALREADY} long, {SAVED} long, {LOW} long, {ERROR} long, {NO_ARCHIVE} long"


def counted(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    """Observed counters as the row that :func:`run_counters` gives."""
    row = spark.createDataFrame([tuple(counts[f.split()[0]] for f in COUNTERS.split(", "))], COUNTERS)
    return row.withColumn("hit_rate", hit_rate(F.col(SAVED), F.col("processed")))


def hit_rate(saved: Column, processed: Column) -> Column:
    """Saved articles per 100 processed ones, 0 when nothing was processed."""
    return F.coalesce(F.try_divide(saved.cast("double"), processed) * 100, F.lit(0.0))


def session_stats(
    outcomes: DataFrame, sources: DataFrame, start_time: Column, end_time: Column,
    failed: DataFrame | None = None,
) -> DataFrame:
    """One session row per source, sources without any link included.

    `failed` lists sources whose crawl broke: they count one more error, have no
    end time and are marked failed.
    """
    outcome = F.col("outcome")
    counts = outcomes.groupBy("source").agg(
        F.count(F.lit(1)).alias("articles_found"),
        F.count_if(outcome != ALREADY).alias("articles_new"),
        F.count_if(outcome == SAVED).alias("articles_scraped"),
        F.count_if(outcome == ERROR).alias("errors"),
    )
    rows = sources.select("source").distinct()
    if failed is None:
        rows = rows.withColumn("_failed", F.lit(False))
    else:
        broken = failed.select("source").distinct().withColumn("_failed", F.lit(True))
        rows = rows.join(broken, "source", "left").na.fill(False, ["_failed"])
    filled = rows.join(counts, "source", "left").na.fill(
        0, ["articles_found", "articles_new", "articles_scraped", "errors"])
    return filled.select(
        "source", start_time.alias("start_time"),
        F.when(~F.col("_failed"), end_time).alias("end_time"),
        "articles_found", "articles_new", "articles_scraped",
        (F.col("errors") + F.col("_failed").cast("bigint")).alias("errors"),
        F.when(F.col("_failed"), FAILED).otherwise(COMPLETED).alias("status"),
    )
