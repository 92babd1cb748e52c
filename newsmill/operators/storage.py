"""Insert-or-ignore semantics against a store of articles keyed by URL hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from newsmill.operators.ordering import first_per_key


def unseen(candidates: DataFrame, *stored: DataFrame) -> DataFrame:
    """Candidates whose URL is not stored; only the hash column of the store is read.

    A store in parts (:func:`newsmill.sources.segments.read_parts`) is met part by part, so that its bucketed
    segments are not shuffled.  No broadcast is forced: Spark picks one only if a part is small, and
    splits skewed hashes otherwise.
    """
    for part in reversed(stored):  # the bucketed part first: what it deals out serves the others
        candidates = candidates.join(part.select("url_hash"), "url_hash", "left_anti")
    return candidates


def insert_or_ignore(batch: DataFrame, *stored: DataFrame, order: list[Column]) -> DataFrame:
    """New rows of a batch: the first per URL, unless the URL is stored already."""
    return unseen(first_per_key(batch, ["url_hash"], order), *stored)
