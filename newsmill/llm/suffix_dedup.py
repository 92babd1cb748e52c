"""Removal of byte strings that repeat across or within documents, by suffix arrays of shards.

Each string of LENGTH bytes holds an anchor: the position, among those in it, whose hash of the next ANCHOR bytes is least.
Equal strings have equal anchors at the same place, so repeated strings meet where anchors are grouped by hash, each with
its region: the bytes of all strings that have this anchor. Regions that are alike in full are repeats as they are and are
only counted. What is left of a group, its distinct regions, goes to a shard. There a suffix array is made by prefix
doubling with Larsson and Sadakane's refinement: only groups of suffixes that are still equal are sorted again. Common
prefixes of neighbours follow by Kasai's bound: a suffix shares with its neighbour all but one byte of what the suffix
before it shares. A group larger than a shard is cut into several; the suffixes of one are looked up in the array of each
other by binary search.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsmill.llm.chosen_path import groups_of, runs_of
from newsmill.llm.tables import others, pieces, spans_of, stored

LENGTH, ANCHOR = 400, 64
SHARD_REGIONS = 2_000  # distinct regions of one anchor in a shard
BROADCAST_BYTES = 64_000_000  # of regions or spans by row; more are joined by shuffle
STEP = 5  # symbols of nine bits in the first sort key, below the group
ANCHOR_PIECE = 1_000_000  # bytes of text whose anchors a task seeks at once


def anchors(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of texts that lie one after the other in `data`, and start and stop of their regions; each text has its own.

    The hash of ANCHOR bytes is a difference of prefix sums; a sliding minimum over the positions of a string names the
    anchor, the leftmost where hashes tie.
    """
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < LENGTH:
        return none, none, none
    powers, back = power_tables(n)
    sums = np.r_[np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[:n])]
    hashes = (sums[ANCHOR:] - sums[:-ANCHOR]) * back[:n - ANCHOR + 1]
    hashes = (hashes ^ (hashes >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    width = LENGTH - ANCHOR + 1  # positions of a string at which an anchor may start
    # The hash above the position: the least key is the least hash, and the leftmost where hashes tie.
    keys = (((hashes >> np.uint64(35)) << np.uint64(34)).view(np.int64)) | np.arange(len(hashes))
    blocks = -(-len(keys) // width)
    whole = np.full(blocks * width, np.iinfo(np.int64).max)
    whole[:len(keys)] = keys
    table = whole.reshape(blocks, width)
    ahead = np.minimum.accumulate(table, 1).ravel()
    behind = np.minimum.accumulate(table[:, ::-1], 1)[:, ::-1].ravel()
    many = len(keys) - width + 1
    least = np.minimum(behind[:many], ahead[width - 1:width - 1 + many]) & ((1 << 34) - 1)
    begins = np.r_[0, ends[:-1]]
    own = ends - begins >= LENGTH
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, begins[own], 1)
    np.add.at(edges, (ends - LENGTH + 1)[own], -1)
    starts = np.flatnonzero(np.cumsum(edges)[:many] > 0)  # of the strings within one text
    least = least[starts]
    if not len(least):
        return none, none, none
    # The anchor moves on with the strings, so those that have the same one follow each other.
    first = np.r_[True, least[1:] != least[:-1]]
    return least[first], starts[first], starts[np.r_[first[1:], True]] + LENGTH


@cache
def tables_of(size: int) -> tuple[np.ndarray, np.ndarray]:
    factor = 0x9E3779B97F4A7C15
    return tuple(np.cumprod(np.full(size, x, np.uint64)) for x in (factor, pow(factor, -1, 1 << 64)))


def power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a factor and of its inverse, at least n of each; the usual size is remembered."""
    return tables_of(2 * ANCHOR_PIECE) if n <= 2 * ANCHOR_PIECE else tables_of.__wrapped__(n)


ANCHOR_FIELDS = "anchor long, region long, row long, start int, stop int"


def find_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each anchor its hash, a hash of its region, and where the region lies. Input: row, text.

    Regions are compared below the same anchor only, so 64 bits of each make 128.
    """
    for batch in batches:
        ids, at = batch.column(0).to_pylist(), 0
        for run in pieces(batch.column(1).to_pylist(), ANCHOR_PIECE):
            rows = ids[at:at + len(run)]
            at += len(run)
            raw = [t.encode() for t in run]
            whole = b"".join(raw)
            ends = np.cumsum([len(x) for x in raw])
            found, start, stop = anchors(np.frombuffer(whole, np.uint8), ends)
            of = np.searchsorted(ends, found, "right")
            begins = np.r_[0, ends[:-1]]
            view = memoryview(whole)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.array([xxhash.xxh64_intdigest(view[a:a + ANCHOR]) for a in found.tolist()], np.uint64).view(np.int64)),
                pa.array(np.array([xxhash.xxh64_intdigest(view[a:b], seed=1) for a, b in zip(start.tolist(), stop.tolist(), strict=True)], np.uint64).view(np.int64)),
                pa.array(np.array(rows, np.int64)[of] if len(of) else np.zeros(0, np.int64)),
                pa.array((start - begins[of]).astype(np.int32)), pa.array((stop - begins[of]).astype(np.int32))],
                ["anchor", "region", "row", "start", "stop"])


def suffix_array(data: np.ndarray, group: np.ndarray, left: np.ndarray, reach: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes sorted by group, then by content up to the end of their region or `reach` bytes, their ranks, and the ranks before
    the last step.

    left: how many bytes each suffix has in its region. Equal ranks remain where suffixes agree that deep. No suffix is
    told apart beyond that.
    """
    n = len(data)
    symbols = np.zeros(n + STEP, np.int64)
    symbols[:n] = data.astype(np.int64) + 1
    key = group.astype(np.int64)
    for k in range(STEP):
        key = (key << 9) | np.where(k < left, symbols[k:k + n], 0)
    order = np.argsort(key)
    key = key[order]
    new = np.r_[True, key[1:] != key[:-1]]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    depth, earlier = STEP, rank
    while depth < reach:
        step = min(depth, reach - depth)
        edge = np.r_[np.flatnonzero(new), n]
        size = np.diff(edge)
        go_on = (size > 1) & (left[order[edge[:-1]]] >= depth)  # equal suffixes that have ended stay equal
        open_ = spans_of(edge[:-1][go_on], size[go_on])  # places in the array that are not settled
        if not len(open_):
            break
        if depth + step == reach:
            earlier = rank.copy()
        suffix = order[open_]
        beyond = np.where(left[suffix] > step, rank[np.minimum(suffix + step, n - 1)] + 1, 0)
        key = rank[suffix] * (n + 1) + beyond
        if n < 1 << 20:  # the place fits below the key: sorting values is faster than sorting places
            key = np.sort((key << 20) | np.arange(len(key)))
            sort, key = key & ((1 << 20) - 1), key >> 20
        else:
            sort = np.argsort(key)
            key = key[sort]
        suffix = suffix[sort]
        order[open_] = suffix
        split = np.r_[True, key[1:] != key[:-1]]
        new[open_] |= split
        rank[suffix] = np.maximum.accumulate(np.where(split, open_, 0))
        depth += step
    return order, rank, earlier


def words_at(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position as an integer; `data` ends in eight spare bytes."""
    return np.lib.stride_tricks.as_strided(data, (len(data) - 7, 8), (1, 1))


def extend(data: np.ndarray, a: np.ndarray, b: np.ndarray, most: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Common prefix of the suffixes a and b, of which `known` bytes agree, up to `most`."""
    length = np.minimum(known, most)
    view, live = words_at(data), np.flatnonzero(length < most)
    while len(live):
        x = np.ascontiguousarray(view[a[live] + length[live]]).view(np.uint64).ravel()
        y = np.ascontiguousarray(view[b[live] + length[live]]).view(np.uint64).ravel()
        differ = x ^ y
        low = differ & (~differ + np.uint64(1))
        same = np.where(differ == 0, 8, np.bitwise_count(low - np.uint64(1)).astype(np.int64) >> 3)
        length[live] = np.minimum(length[live] + same, most[live])
        live = live[(differ == 0) & (length[live] < most[live])]
    return length


def common_prefixes(data: np.ndarray, order: np.ndarray, rank: np.ndarray, earlier: np.ndarray, group: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Bytes that each suffix in the array shares with the one before it, at most LENGTH of them.

    Suffixes of equal rank share that much or their whole region; those whose ranks differed before the last step, and those
    with fewer bytes, share less, and count as 0. For the others, Kasai's bound in halving strides: the suffix s + k shares with its neighbour at least what s shares with its own, less
    k. Positions at the stride are done together, each from the bound of the position one stride before.
    """
    n = len(order)
    before = np.full(n, -1)
    before[order[1:]] = order[:-1]
    ok = before >= 0
    ok[ok] = (group[before[ok]] == group[ok]) & (left[ok] >= LENGTH) & (left[before[ok]] >= LENGTH)
    most = np.where(ok, np.minimum(left, left[np.maximum(before, 0)]), 0)
    most = np.minimum(most, LENGTH)
    shared, done = np.zeros(n, np.int64), ~ok
    alike = np.flatnonzero(ok)
    done[alike[earlier[alike] != earlier[before[alike]]]] = True
    tied = np.flatnonzero(ok)
    tied = tied[rank[tied] == rank[before[tied]]]
    shared[tied], done[tied] = most[tied], True
    stride = 64
    while stride:
        at = np.arange(0, n, stride)
        at = at[~done[at]]
        prior = at - stride
        bound = np.where(prior >= 0, np.maximum(shared[np.maximum(prior, 0)] - stride, 0), 0)
        bound = np.where(left[at] + stride == left[np.maximum(prior, 0)], bound, 0)  # of the same region
        shared[at] = extend(data, at, before[at], most[at], bound)
        done[at] = True
        stride //= 2
    # Suffixes alike beyond the depth of the array stand in any order, where the bound may promise too much.
    claimed = np.flatnonzero(shared >= LENGTH)
    claimed = claimed[rank[claimed] != rank[before[claimed]]]
    shared[claimed] = extend(data, claimed, before[claimed], most[claimed], np.zeros(len(claimed), np.int64))
    return shared[order]


def search(data: np.ndarray, order: np.ndarray, queries: np.ndarray, rank_group: np.ndarray, query_group: np.ndarray) -> np.ndarray:
    """For each query suffix a place in the array whose first LENGTH bytes are the same, or -1, by binary search.

    `order` holds suffixes with LENGTH bytes in their region only, sorted by group, then content.
    """
    view = words_at(data)
    lo = np.searchsorted(rank_group[order], query_group, "left")
    top = np.searchsorted(rank_group[order], query_group, "right")
    end, hi = top.copy(), top
    while True:
        open_ = np.flatnonzero(lo < hi)
        if not len(open_):
            break
        middle = (lo[open_] + hi[open_]) >> 1
        less = before(view, order[middle], queries[open_])
        lo[open_] = np.where(less, middle + 1, lo[open_])
        hi[open_] = np.where(less, hi[open_], middle)
    found = np.full(len(queries), -1)
    inside = np.flatnonzero(lo < end)
    same = extend(data, order[lo[inside]], queries[inside], np.full(len(inside), LENGTH), np.zeros(len(inside), np.int64)) == LENGTH
    found[inside[same]] = lo[inside[same]]
    return found


def before(view: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether LENGTH bytes from a sort before those from b."""
    less, live, at = np.zeros(len(a), bool), np.arange(len(a)), 0
    while len(live) and at < LENGTH:
        x = np.ascontiguousarray(view[a[live] + at]).view(">u8").ravel()
        y = np.ascontiguousarray(view[b[live] + at]).view(">u8").ravel()
        less[live] = x < y
        live = live[x == y]
        at += 8
    return less


def repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Strings of regions that occur elsewhere in their group, as row, start, stop of runs. Rows come in order of `shard`.

    Input: shard, group, part (0: the regions of the shard, 1: those of another shard that are compared with them, 2: both),
    many (whether the region occurs more than once), row, start, content.
    """
    for whole in groups_of(batches, "shard"):
        for begin, size in zip(*(x.tolist() for x in runs_of(whole, "shard")), strict=True):
            found = repeats_in(whole.slice(begin, size))
            if found is not None:
                yield found


def repeats_in(table: pa.Table) -> pa.RecordBatch | None:
    """The repeats in one shard."""
    content = table.column("content").combine_chunks()
    size = np.array([len(x) for x in content.to_pylist()], np.int64)
    data = np.frombuffer(b"".join(content.to_pylist()) + bytes(16), np.uint8)
    n = int(size.sum())
    region = np.repeat(np.arange(len(size)), size)
    ends = np.cumsum(size)
    left = ends[region] - np.arange(n)
    _, group_of = np.unique(table.column("group").to_numpy(), return_inverse=True)
    group = group_of[region]
    many, part = table.column("many").to_numpy(zero_copy_only=False)[region], table.column("part").to_numpy()[region]
    row, start = table.column("row").to_numpy(), table.column("start").to_numpy().astype(np.int64)
    text = np.unique(row, return_inverse=True)[1] << 34
    place = start[region] + np.arange(n) - (ends - size)[region]  # in the document
    base = np.flatnonzero(part != 1)
    # The shard's own array; positions keep their numbers.
    compact = np.full(n, -1)
    compact[base] = np.arange(len(base))
    own = np.r_[data[base], np.zeros(16, np.uint8)]
    order, rank, earlier = suffix_array(own[:-16], group[base], left[base])
    shared = common_prefixes(own, order, rank, earlier, group[base], left[base])
    order = base[order]
    del rank, earlier, own
    # A class: suffixes that share LENGTH bytes. It repeats if it holds two places, or a region that occurs twice.
    klass = np.cumsum(shared < LENGTH) - 1
    long_ = left[order] >= LENGTH
    order, klass = order[long_], klass[long_]
    spot = text[region[order]] + place[order]
    count = int(klass.max()) + 1 if len(klass) else 0
    low, high, copy = np.full(count, np.iinfo(np.int64).max), np.full(count, -1), np.zeros(count, bool)
    np.minimum.at(low, klass, spot)
    np.maximum.at(high, klass, spot)
    np.logical_or.at(copy, klass, many[order])
    hit = [order[((low != high) | copy)[klass] & (part[order] == 2)]]
    queries = np.flatnonzero((part == 1) & (left >= LENGTH))
    if len(queries) and len(order):
        at = search(data, order, queries, group, group[queries])
        met = at >= 0
        other = klass[at[met]]
        mine = text[region[queries[met]]] + place[queries[met]]
        elsewhere = copy[other] | many[queries[met]] | (low[other] != mine) | (high[other] != mine)
        hit.append(queries[met][elsewhere])
        back = np.zeros(count, bool)
        np.logical_or.at(back, other[elsewhere], True)
        hit.append(order[back[klass] & (part[order] == 0)])
    found = np.sort(np.concatenate(hit))
    found = found[np.r_[True, found[1:] != found[:-1]]] if len(found) else found
    if not len(found):
        return None
    edge = np.r_[True, (found[1:] != found[:-1] + 1) | (region[found[1:]] != region[found[:-1]])]
    first, last = found[edge], found[np.r_[edge[1:], True]]
    return pa.RecordBatch.from_arrays([
        pa.array(row[region[first]]), pa.array(place[first].astype(np.int32)), pa.array((place[last] + LENGTH).astype(np.int32))], ["row", "start", "stop"])


def cut_regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of regions. Input: row, text, regions (array of structs)."""
    for batch in batches:
        rows, texts, lists = (batch.column(i).to_pylist() for i in range(3))
        out = [(r["anchor"], r["region"], r["n_kinds"], r["many"], row, r["start"], raw[r["start"]:r["stop"]])
               for row, text, regions in zip(rows, texts, lists, strict=True) for raw in [text.encode()] for r in regions]
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int32(), pa.binary())
        for i in range(0, len(out), 5_000):
            columns = zip(*out[i:i + 5_000], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                             ["group", "region", "n_kinds", "many", "row", "start", "content"])


def small(by_row: DataFrame, column: str) -> DataFrame:
    """A join side with a broadcast hint if its counted rows and array entries allow that; else both sides are shuffled."""
    size = by_row.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size(column)).alias("e")).first()
    return F.broadcast(by_row) if 60 * size["n"] + 60 * (size["e"] or 0) <= BROADCAST_BYTES else by_row


def repeated_spans(texts: DataFrame) -> DataFrame:
    """row and spans (array of start, stop) of bytes in strings of LENGTH bytes that also start elsewhere.

    `texts`: row (unique), text (not NULL).
    """
    spark = texts.sparkSession
    found = stored(texts.filter(F.octet_length("text") >= LENGTH).mapInArrow(find_anchors, ANCHOR_FIELDS), "anchors")
    kinds = found.groupBy("anchor", "region").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("row", "start", "stop")).alias("one"))
    groups = kinds.groupBy("anchor").agg(F.sum("n").alias("n_all"), F.count(F.lit(1)).alias("n_kinds"), F.min("n").alias("least"))
    shared = groups.filter("n_all > 1").select("anchor", "n_kinds", "least")
    kinds = stored(kinds.join(shared, "anchor").select("anchor", "region", "n", "n_kinds", "least", "one.*"), "regions")
    twice = kinds.filter("n > 1").select("anchor", "region")
    alike = found.join(twice, ["anchor", "region"], "left_semi").select("row", "start", "stop")
    wanted = kinds.filter("n_kinds > 1 AND least = 1").withColumn("many", F.col("n") > 1)
    by_row = stored(wanted.groupBy("row").agg(F.collect_list(F.struct("anchor", "region", "n_kinds", "many", "start", "stop")).alias("regions")), "wanted")  # of one text
    regions = texts.join(small(by_row, "regions"), "row").select("row", "text", "regions").mapInArrow(
        cut_regions, "group long, region long, n_kinds long, many boolean, row long, start int, content binary")
    # Shards: small groups share one by hash; a large one is cut, and each two of its parts meet in a shard of their own.
    shards = F.lit(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1) * 8)
    alone = F.array(F.struct(F.concat(F.lit("s"), F.pmod(F.xxhash64("group"), shards)).alias("shard"), F.lit(2).alias("part")))
    met = F.transform(F.sequence(F.lit(0), F.col("_cuts") - 1), lambda other: F.struct(
        F.concat_ws("-", F.col("group").cast("string"), F.least("_own", other), F.greatest("_own", other)).alias("shard"),
        F.when(F.col("_own") == other, 2).when(F.col("_own") < other, 0).otherwise(1).alias("part")))
    cuts = F.ceil(F.col("n_kinds") / SHARD_REGIONS).cast("int")
    dealt = regions.withColumn("_cuts", cuts).withColumn("_own", F.pmod(F.xxhash64("region"), F.col("_cuts")).cast("int"))
    spread = dealt.withColumn("c", F.explode(F.when(F.col("_cuts") > 1, met).otherwise(alone))).select(
        "c.shard", "group", "c.part", "many", "row", "start", "content")
    unlike = spread.repartition("shard").sortWithinPartitions("shard").mapInArrow(repeats, "row long, start int, stop int")
    # Spans of a text that overlap or touch become one.
    order = Window.partitionBy("row").orderBy("start")
    behind = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    spans = alike.unionByName(unlike).groupBy("row", "start").agg(F.max("stop").alias("stop")).withColumn("_b", behind)
    island = F.sum(F.when(F.col("_b") >= F.col("start"), 0).otherwise(1)).over(order)
    merged = spans.withColumn("_i", island).groupBy("row", "_i").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    return stored(merged.groupBy("row").agg(F.collect_list(F.struct("start", "stop")).alias("spans")), "repeats")


def without_spans(raw: bytes, spans: list | None) -> tuple[bytes, int]:
    """What is left of a text, and the number of runs removed; spans may overlap or touch."""
    kept, at, runs, end = [], 0, 0, -1
    for start, stop in sorted((s["start"], s["stop"]) for s in spans or ()):
        if start > end:
            kept.append(raw[at:start])
            runs += 1
        end = max(end, stop)
        at = max(at, stop)
    kept.append(raw[at:])
    return b"".join(kept), runs


def dedup(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with kept (binary: the text as UTF-8 without repeated strings), n_bytes, n_removed, n_spans; such columns are replaced.

    A byte goes if any string of LENGTH bytes over it also starts at another place, in this document or another; strings
    are those of the input and may overlap. A NULL text is empty. Copies, repeated rows included, lose all such strings. What
    is kept may not be valid UTF-8, as strings are cut between bytes.
    """
    outputs = ("kept", "n_bytes", "n_removed", "n_spans")
    numbered = stored(docs.select(*others(docs, *outputs, "_row", "_text"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"),
                                  F.monotonically_increasing_id().alias("_row")), "texts")
    spans = repeated_spans(numbered.select(F.col("_row").alias("row"), F.col("_text").alias("text")))
    by_row = small(spans, "spans").withColumnsRenamed({"row": "_row", "spans": "_spans"})

    @F.arrow_udf("struct<kept: binary, n_spans: long>")
    def removed(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, lists in batches:
            kept, runs = zip(*(without_spans(t.encode(), s) for t, s in zip(texts.to_pylist(), lists.to_pylist(), strict=True)), strict=True) if len(texts) else ((), ())
            yield pa.StructArray.from_arrays([pa.array(kept, pa.binary()), pa.array(runs, pa.int64())], ["kept", "n_spans"])

    columns = [F.col(f"`{c}`") for c in numbered.columns if c not in ("_row", "_text")]
    whole = numbered.join(by_row, "_row", "left").select(*columns, "_text", removed.asNondeterministic()("_text", "_spans").alias("_m"))
    n = F.octet_length("_text").cast("long")
    return whole.select(*columns, F.col("_m.kept").alias("kept"), n.alias("n_bytes"), (n - F.octet_length("_m.kept")).alias("n_removed"), F.col("_m.n_spans").alias("n_spans"))
