"""Connected components by alternating large and small stars, as joins and minima over a stored edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsmill.llm.tables import stored


def components(edges: DataFrame, most_rounds: int = 100) -> DataFrame:
    """node and label (the least node of its component) for every node of an edge (a, b); fails rather than give unsettled labels.

    Each round lets a node point its neighbours to the least it knows; nodes with many neighbours are no group anywhere,
    only a key of a minimum that is partly taken before the shuffle and of joins that can be split.
    """
    now = stored(edges.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    state = None
    for _ in range(most_rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        now = stored(small.select("e.u", "e.v").filter("u != v").distinct(), "edges")
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == state:
            break
        state = seen
    else:
        raise RuntimeError(f"components are not settled after {most_rounds} rounds")
    roots = now.select(F.col("v").alias("node")).distinct().withColumn("label", F.col("node"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots)
