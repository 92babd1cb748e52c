"""Long key lists as a blocked Bloom filter, which sorts out large rows in their scan, without shuffling them.

A key sets eight bits of one block of 256 bits, two in each of its four words. Tasks merge the bits of their own keys and
the shuffle carries at most one row for each block and task. The table of blocks has a fixed bound: a list too long for it
gets fewer bits for each key, so that more rows pass that are in no list, but none is ever lost and nothing else changes.
What passes must meet the list itself later, by a join of narrow rows.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_KEY = 12  # about one row in a hundred passes wrongly
BLOCK_BITS, WORDS = 256, ("w0", "w1", "w2", "w3")
MOST_BYTES = 64 << 20  # of all blocks, which are broadcast


class KeyFilter(NamedTuple):
    on: list[str]
    n_blocks: int
    blocks: DataFrame  # _block, w0 .. w3


def _block(on: list[str], n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(*on), F.lit(n_blocks))


def _words(on: list[str]) -> list[Column]:
    """The bits of a key in each word, from a hash of its own."""
    spread = F.xxhash64(F.lit(1), *on)

    def bit(i: int) -> Column:
        place = F.shiftrightunsigned(spread, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        return F.call_function("shiftleft", F.lit(1).cast("bigint"), place)

    return [bit(2 * i).bitwiseOR(bit(2 * i + 1)) for i in range(len(WORDS))]


def key_filter(keys: DataFrame, on: list[str], n: int) -> KeyFilter:
    """The filter of about `n` keys in the columns `on`."""
    n_blocks = max(1, -(-min(n * BITS_PER_KEY, MOST_BYTES * 8) // BLOCK_BITS))
    marked = keys.select(_block(on, n_blocks).alias("_block"), *(w.alias(x) for w, x in zip(_words(on), WORDS, strict=True)))
    return KeyFilter(on, n_blocks, marked.groupBy("_block").agg(*(F.bit_or(x).alias(x) for x in WORDS)))


def passing(rows: DataFrame, keys: KeyFilter) -> DataFrame:
    """The rows whose key may be in the list: all that are, and few others."""
    held = [F.col(x).bitwiseAND(w) == w for x, w in zip(WORDS, _words(keys.on), strict=True)]
    same = reduce(lambda a, b: a & b, held, F.col("_block") == _block(keys.on, keys.n_blocks))
    return rows.join(F.broadcast(keys.blocks), same, "left_semi")
