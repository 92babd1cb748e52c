"""First-seen, top-n, global index and running totals without one big task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsmill.operators.keyfilter import key_filter, passing
from newsmill.session import cut_lineage

# Above this many rows a limit would gather too much in one task.
SMALL_LIMIT = 10_000
# Spark trims `row_number() <= n` before the shuffle up to this n
# (spark.sql.optimizer.windowGroupLimitThreshold).
TRIMMED_BEFORE_SHUFFLE = 1_000
SALTS = 64
# Key lists up to this many bytes and rows are broadcast.
BROADCAST_BYTES = 32 << 20
BROADCAST_KEYS = 500_000
# Values up to this number are worth a filter that the scan can use to skip row groups.
FILTER_VALUES = 1_000
BLOCK_ROWS = 100_000


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first by `order`.

    Every map task keeps at most one row per key before the shuffle, so a key
    that holds a large part of the rows is no hot spot.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def first_n_per_group(
    df: DataFrame, groups: list[str], order: list[Column], n: int, salt_by: str
) -> DataFrame:
    """The first `n` rows of each group; `order` must be total within a group.

    A small `n` is trimmed map-side.  A large one is first cut within salted
    slices of the group, so no task ever sorts a whole hot group.
    """
    window = Window.partitionBy(*groups).orderBy(*order)
    if n > TRIMMED_BEFORE_SHUFFLE:
        sliced = Window.partitionBy(*groups, "_salt").orderBy(*order)
        df = (
            df.withColumn("_salt", F.pmod(F.xxhash64(salt_by), F.lit(SALTS)))
            .withColumn("_rank", F.row_number().over(sliced))
            .filter(F.col("_rank") <= n).drop("_rank", "_salt")
        )
    return (
        df.withColumn("_rank", F.row_number().over(window))
        .filter(F.col("_rank") <= n).drop("_rank")
    )


def key_list_size(keys: DataFrame, on: list[str]) -> tuple[int, bool]:
    """Rows of a fixed (written) list of text keys, and whether it may be broadcast."""
    size = F.coalesce(F.sum(sum(F.octet_length(F.col(c)) for c in on)), F.lit(0))
    n, in_bytes = keys.agg(F.count(F.lit(1)), size).first()
    return n, n <= BROADCAST_KEYS and in_bytes <= BROADCAST_BYTES


def narrowed_to(df: DataFrame, keys: DataFrame, on: list[str], wide: bool = False) -> DataFrame:
    """Semi-join of `df` with a fixed (written) list of text keys, by the size of the list.

    A few keys also become a filter on the first column, which reaches the scan
    and skips row groups; up to some more are broadcast, so `df` is not shuffled;
    a longer list joins like any table.  Rows that are too large to be shuffled
    are called `wide`: a longer list then becomes a Bloom filter in the scan, which
    lets a few other rows pass, so the caller has to join with the list later.
    """
    n, small = key_list_size(keys, on)
    if n <= FILTER_VALUES and small:
        df = df.filter(F.col(on[0]).isin([row[0] for row in keys.select(on[0]).collect()]))
    if wide and not small:
        return passing(df, key_filter(keys, on, n))
    return df.join(F.broadcast(keys) if small else keys, on, "left_semi")


def with_global_index(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Add the 0-based position of every row in the total order `order`.

    Range-sorted and written once, so the row ids are fixed; the position is the
    id within its sorted part plus the sizes of the parts before.  The offsets
    table has one row per part and is therefore safe to broadcast.
    """
    fixed = cut_lineage(df.orderBy(*order).withColumn("_row", F.monotonically_increasing_id()))
    part = F.shiftrightunsigned("_row", 33)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        fixed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        fixed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_row").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("_part", "_offset", "_row")
    )


def first_n(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """The first `n` rows of the total order `order`, for any `n`."""
    if n <= SMALL_LIMIT:
        return df.orderBy(*order).limit(n)
    return with_global_index(df, order, "_index").filter(F.col("_index") < n).drop("_index")


def running_total(df: DataFrame, index: str, value: str, name: str) -> DataFrame:
    """Add the running sum of `value` along a dense 0-based `index`.

    Blocks of equal size are summed in parallel; only one row per block goes
    through the ordered pass over block totals.
    """
    block = F.expr(f"{index} div {BLOCK_ROWS}")
    blocked = df.withColumn("_block", block)
    within = Window.partitionBy("_block").orderBy(index).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        blocked.groupBy("_block").agg(F.sum(value).alias("_sum"))
        .select("_block", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        blocked.withColumn("_within", F.sum(value).over(within)).join(offsets, "_block")
        .withColumn(name, F.col("_within") + F.col("_offset"))
        .drop("_block", "_within", "_offset")
    )
