"""Helper for expensive columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, value: Column, name: str) -> DataFrame:
    """Add an expensive column through a generator.

    Filters on the result stay above it; on a plain column Spark would push them
    down, copy the whole expression and evaluate it twice.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))
