"""New pages as a stream: each micro-batch goes through the batch functions.

The store keeps one folder per micro-batch, named by the stream's own id, which Spark keeps with the checkpoint, and the
batch number; so streams with other checkpoints add to the same store.  A micro-batch repeated after a
failure replaces its own folder and ignores what it stored before, so the result
is the same as if it had run once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from newsmill.plans.processing import evaluate_pages, store_outcomes, stored_before
from newsmill.schemas import PAGES
from newsmill.sources.readers import spread
from newsmill.sources.writers import batch_name, create_store


def page_stream(
    spark: SparkSession, folder: str, glob: str = "*.parquet", files_per_batch: int | None = None,
) -> DataFrame:
    """Stored pages arriving as parquet files."""
    reader = spark.readStream.schema(PAGES).option("pathGlobFilter", glob)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def store_stream(
    pages: DataFrame, root: str, checkpoint: str, run_time: Column,
    candidates: Callable[[DataFrame], DataFrame], prepare: Callable[[DataFrame], DataFrame] | None = None,
    **options,
) -> StreamingQuery:
    """Score and store all pages available, then stop.

    `candidates` adds the candidate columns (source, …) to a batch of pages or
    leaves pages out, `prepare` may adapt the pages; `options` go to
    :func:`newsmill.plans.processing.evaluate_pages`.
    """
    create_store(pages.sparkSession, root)

    def one_batch(batch: DataFrame, number: int) -> None:
        stream = batch.sparkSession.read.text(f"{checkpoint.rstrip('/')}/metadata").select(F.get_json_object("value", "$.id")).first()[0]
        batch_id = batch_name(stream, number)
        ready = spread(batch if prepare is None else prepare(batch))
        stored = stored_before(batch.sparkSession, root, batch_id)
        outcomes = evaluate_pages(candidates(ready), stored, **options)
        store_outcomes(outcomes, root, batch_id, run_time)

    return (
        pages.writeStream.foreachBatch(one_batch)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def pages_as_candidates(source: Callable[[Column], Column]) -> Callable[[DataFrame], DataFrame]:
    """Every page of a batch is a candidate of the source its URL names."""
    def rows(batch: DataFrame) -> DataFrame:
        return batch.withColumn("source", source(F.col("url")))
    return rows
