"""What the operators share: reading, stored copies, pieces of a batch, column names."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmill.session import fresh_folder, remove_folder

PIECE_BYTES = 3_000_000  # text that a task turns into words at a time; a longer text is a piece of its own


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written as Parquet below the shared folder and read again, so that lost executors cost no recomputation."""
    folder = fresh_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(folder)
    table = df.sparkSession.read.schema(df.schema).parquet(folder)
    table.stored_in = folder
    if _recorded is not None:
        _recorded.append(table)
    return table


_recorded: list[DataFrame] | None = None


@contextmanager
def recorded() -> Iterator[list[DataFrame]]:
    """The tables that `stored` writes meanwhile, for one who knows when nothing reads them any more."""
    global _recorded
    outer, _recorded = _recorded, []
    try:
        yield _recorded
    finally:
        _recorded = outer


def forget(*tables: DataFrame) -> None:
    """Deletes what `stored` wrote; nothing may read these tables any more."""
    for table in tables:
        remove_folder(table.sparkSession, table.stored_in)


def others(df: DataFrame, *outputs: str) -> list[Column]:
    """The columns of `df` without those that an operator is about to add; an operator's own columns win."""
    taken = {x.lower() for x in outputs}
    return [F.col(f"`{c}`") for c in df.columns if c.lower() not in taken]


def with_struct(df: DataFrame, made: Column, *fields: str) -> DataFrame:
    """`df` with the fields of one struct column as columns; the struct is evaluated once for each row."""
    return df.select(*others(df, *fields, "_made"), made.alias("_made")).select(
        *others(df, *fields, "_made"), *(F.col(f"_made.{x}").alias(x) for x in fields))


def pieces(texts: Iterable, most: int = PIECE_BYTES) -> Iterator[list]:
    """`texts` in runs of about `most` bytes."""
    run, size = [], 0
    for text in texts:
        if run and size + len(text) > most:
            yield run
            run, size = [], 0
        run.append(text)
        size += len(text)
    if run:
        yield run


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; NULL for a NULL id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def spans_of(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All positions of the ranges start, start + 1, ..., one range after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    begins = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts - begins, lengths)
