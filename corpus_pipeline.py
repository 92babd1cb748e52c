"""From raw documents to token ids: toxic texts, near copies and benchmark passages go, personal data is masked, the rest encoded.

STAGES names the stages in order. A stage takes (spark, docs, sf_dir) and returns a DataFrame with the columns of
documents, the last one token ids; `run` writes each result below the shared folder and reads it again for the next.
As a stage's result is written before the next one starts, that removes what the stage before stored on its way.
Rows with NULL texts or ids, repeated rows and further columns pass as the operators' docstrings say.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmill.llm import byte_bpe, candidate_pii, chosen_path, positional_index, string_kernel
from newsmill.llm.tables import fold, forget, read, recorded, stored

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


_left: list[DataFrame] = []  # stored by the stage before


def stage(function: Callable) -> Callable:
    @wraps(function)
    def begun(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        while _left:
            forget(_left.pop())
        with recorded() as tables:
            result = function(spark, docs, sf_dir)
        _left.extend(tables)
        return result

    return begun


@stage
def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the string kernel calls toxic; it learns from the labelled documents among its input."""
    labelled = string_kernel.with_labels(docs.filter(fold(F.col("doc_id")) != 0), read(spark, sf_dir, "labels"))
    scored = string_kernel.score(docs.select(*docs.columns, F.struct(*docs.columns).alias("_row")), string_kernel.train(labelled))
    return scored.filter("predicted = 0").select(*(F.col(f"_row.`{c}`").alias(c) for c in docs.columns))


@stage
def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies."""
    return chosen_path.one_of_each(docs)


@stage
def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a window of a benchmark item."""
    found = positional_index.contaminated_texts(docs, read(spark, sf_dir, "benchmark")).withColumnRenamed("key", "_key")
    keyed = docs.withColumn("_key", positional_index.text_key(F.col("text")))
    found = stored(found, "contaminated-texts")
    return keyed.join(positional_index.bounded(found, "_key"), "_key", "left_anti").select(*docs.columns)


@stage
def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks personal data in the texts; n_chars follows the text."""
    masked = candidate_pii.redact(docs)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else masked


@stage
def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of the texts as little-endian unsigned 32-bit integers, their number and digest; `exact` says that they decode to the text."""
    coded = byte_bpe.round_trip(docs.select("doc_id", "text"), RANKS, public_tokenizers.PATTERN)
    return coded.select(
        "doc_id", "token_ids", F.expr("octet_length(token_ids) div 4").cast("long").alias("n_tokens"), F.sha2("token_ids", 256).alias("ids_sha256"),
        (F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")).alias("exact"))


STAGES = [
    ("toxicity", toxicity),
    ("near_copies", near_copies),
    ("benchmark_passages", benchmark_passages),
    ("personal_data", personal_data),
    ("token_ids", token_ids),
]
ORACLE_SQL = None  # the first stage fits a machine, which SQL can't express


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = read(spark, sf_dir, "documents"), []
    for name, function in STAGES:
        docs = stored(function(spark, docs, sf_dir), f"pipeline-{name}")
        forget(*before)
        before = [docs]
    return docs
