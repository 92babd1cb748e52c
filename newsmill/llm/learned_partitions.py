"""Approximate nearest neighbours by largest inner product over learned partitions.

The index is fitted on a bounded sample: its neighbour graph is cut into balanced parts that keep neighbours together, and a
small network learns to name, for a vector, the parts in which its neighbours lie. Every vector is then filed under its most
probable part. A query visits its most probable parts until their probability reaches a share that, for vectors kept out of
the fit, found `recall` of their neighbours in the sample; it visits all parts if no smaller share does. Neighbours in the
whole table are closer than those in the sample, so the sample errs towards visiting more.

Equal vectors are one entry with its smallest ids, as no answer of n neighbours needs more of them: copies don't multiply work.
Parts are dealt out in blocks of candidates and blocks of queries, each pair of blocks being one group of bounded size. Scores
of a block are screened with a margin above rounding; what passes gets its sum in the order of components, so a score does
not depend on the block it was found in.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsmill.llm.tables import forget, spans_of, stored

SAMPLE = 8_192  # distinct vectors of the smallest hashes; graph, parts and network are fitted on these
KEPT_OUT = 768  # of the sample, at most an eighth: only for the share of probability to visit
PART_ROWS = 4_096
FEWEST_PARTS, MOST_PARTS = 8, 128
LEAST_FOR_A_PART = 64  # points; with fewer there is one part, which all queries visit
GRAPH_DEGREE = 12
HIDDEN = 96
STEPS = 1_200
SHARES = (0.5, 0.6, 0.7, 0.8, 0.85, 0.9, 0.93, 0.95, 0.97, 0.98, 0.99, 0.995, 0.999)
BLOCK_CANDIDATES, BLOCK_QUERIES, SCREENED_AT_ONCE = 16_384, 1_024, 128


class Router(NamedTuple):
    layers: tuple
    share: float
    parts: int


def top_neighbours(queries: np.ndarray, points: np.ndarray, n: int, own: np.ndarray | None = None) -> np.ndarray:
    """Rows of the `n` points of largest inner product for each query, but for its own row."""
    found = []
    for at in range(0, len(queries), 512):
        scores = queries[at:at + 512] @ points.T
        if own is not None:
            scores[np.arange(len(scores)), own[at:at + 512]] = -np.inf
        found.append(np.argpartition(-scores, min(n, scores.shape[1] - 1), axis=1)[:, :n])
    return np.concatenate(found)


def halves(points: np.ndarray, rows: np.ndarray, parts: int, label: np.ndarray, first: int = 0) -> None:
    """First parts: cuts across the direction of largest spread, sizes in proportion to the parts on each side."""
    if parts == 1:
        label[rows] = first
        return
    here = points[rows] - points[rows].mean(0)
    direction = np.linalg.eigh(here.T @ here)[1][:, -1]
    left = parts // 2
    order = rows[np.argsort(here @ direction, kind="stable")]
    cut = len(rows) * left // parts
    halves(points, order[:cut], left, label, first)
    halves(points, order[cut:], parts - left, label, first + left)


def balanced_parts(points: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 12, slack: float = 1.1) -> np.ndarray:
    """Part of each point: points move to the part of most neighbours while it has room, largest gain first."""
    n = len(points)
    label = np.zeros(n, np.int64)
    halves(points, np.arange(n), parts, label)
    room = int(np.ceil(n / parts * slack))
    ends = np.concatenate([np.repeat(np.arange(n), graph.shape[1]), graph.ravel()])
    others = np.concatenate([graph.ravel(), np.repeat(np.arange(n), graph.shape[1])])
    for _ in range(rounds):
        votes = np.bincount(ends * parts + label[others], minlength=n * parts).reshape(n, parts)
        target, own = votes.argmax(1), votes[np.arange(n), label]
        gain = votes[np.arange(n), target] - own
        sizes = np.bincount(label, minlength=parts)
        moves = 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            if sizes[target[i]] < room:
                sizes[label[i]] -= 1
                sizes[target[i]] += 1
                label[i] = target[i]
                moves += 1
        if not moves:
            break
    return label


def features(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors and the logarithm of their length, as large vectors are neighbours of more queries."""
    scale = np.abs(vectors).max(1, keepdims=True)
    unit = vectors / scale
    length = np.sqrt((unit * unit).sum(1, keepdims=True))
    return np.hstack([unit / length * np.sqrt(vectors.shape[1]), np.log(length * scale)])


def probabilities(layers: tuple, vectors: np.ndarray) -> np.ndarray:
    w1, b1, w2, b2 = layers
    out = np.maximum(features(vectors) @ w1 + b1, 0) @ w2 + b2
    out = np.exp(out - out.max(1, keepdims=True))
    return out / out.sum(1, keepdims=True)


def fitted_network(vectors: np.ndarray, wanted: np.ndarray) -> tuple:
    """One hidden layer, cross entropy against the share of neighbours in each part, Adam over small batches."""
    rng = np.random.default_rng(7)
    x, parts = features(vectors), wanted.shape[1]
    layers = [rng.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, np.sqrt(1 / HIDDEN), (HIDDEN, parts)), np.zeros(parts)]
    mean, square = [np.zeros_like(p) for p in layers], [np.zeros_like(p) for p in layers]
    for step in range(1, STEPS + 1):
        rows = rng.integers(0, len(x), 256)
        hidden = np.maximum(x[rows] @ layers[0] + layers[1], 0)
        out = hidden @ layers[2] + layers[3]
        out = np.exp(out - out.max(1, keepdims=True))
        back = (out / out.sum(1, keepdims=True) - wanted[rows]) / len(rows)
        below = (back @ layers[2].T) * (hidden > 0)
        slopes = [x[rows].T @ below + 1e-4 * layers[0], below.sum(0), hidden.T @ back + 1e-4 * layers[2], back.sum(0)]
        rate = 5e-3 * (1 - step / (STEPS + 1))
        for i, slope in enumerate(slopes):
            mean[i] = 0.9 * mean[i] + 0.1 * slope
            square[i] = 0.999 * square[i] + 0.001 * slope * slope
            layers[i] = layers[i] - rate * (mean[i] / (1 - 0.9**step)) / (np.sqrt(square[i] / (1 - 0.999**step)) + 1e-9)
    return tuple(layers)


def visited(chances: np.ndarray, share: float) -> np.ndarray:
    """Which parts each row visits: the most probable ones until their sum reaches `share`, all parts for a share of 1."""
    if share >= 1:
        return np.ones(chances.shape, bool)
    order = np.argsort(-chances, axis=1, kind="stable")
    ordered = np.take_along_axis(chances, order, 1)
    before = np.cumsum(ordered, 1) - ordered
    chosen = np.zeros(chances.shape, bool)
    np.put_along_axis(chosen, order, before < share, 1)
    return chosen


def fit(sample: np.ndarray, rows: int, n: int, recall: float) -> Router:
    """Parts, network and share for a table of `rows` distinct vectors, from a sample of them."""
    parts = int(np.clip(rows // PART_ROWS, FEWEST_PARTS, MOST_PARTS))
    out = min(KEPT_OUT, len(sample) // 8)
    held, points = sample[:out], sample[out:]
    if len(points) < LEAST_FOR_A_PART * parts:
        return Router((), 1.0, 1)
    graph = top_neighbours(points, points, min(GRAPH_DEGREE, len(points) - 1), np.arange(len(points)))
    label = balanced_parts(points, graph, parts)
    near = np.hstack([graph, np.arange(len(points))[:, None]])
    wanted = np.bincount((np.arange(len(points))[:, None] * parts + label[near]).ravel(), minlength=len(points) * parts).reshape(-1, parts) / near.shape[1]
    layers = fitted_network(points, wanted)
    filed = probabilities(layers, points).argmax(1)[top_neighbours(held, points, n)]
    chances = probabilities(layers, held)
    for share in SHARES:
        if np.take_along_axis(visited(chances, share), filed, 1).mean() >= recall:
            return Router(layers, share, parts)
    return Router(layers, 1.0, parts)


def usable(vectors: DataFrame, id_: str, vector: str, query: Column) -> DataFrame:
    """(id, vec, query, k1, k2) of the rows that take part; k1, k2 are 128 bits of the vector's hash."""
    v = F.col(f"`{vector}`").cast("array<float>" if vectors.schema[vector].dataType.simpleString() == "array<float>" else "array<double>")
    fine = F.forall("vec", lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf")))) & F.exists("vec", lambda x: x != 0.0)
    rows = vectors.select(F.col(f"`{id_}`").alias("id"), v.alias("vec"), F.coalesce(query, F.lit(False)).alias("query")).filter(F.col("id").isNotNull() & fine)
    size = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size("vec") == (size.n if size else 0)).select("*", F.xxhash64("vec").alias("k1"), F.xxhash64(F.lit("second"), "vec").alias("k2"))


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    return np.asarray(flat.flatten(), np.float64).reshape(len(column), -1)


def filed_under(table: DataFrame, router: Router) -> DataFrame:
    """Rows with `part`, the most probable one of each vector, and `visits`, all that it visits as a query."""
    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            if router.layers:
                vec = batch.column("vec")
                chances = probabilities(router.layers, np.asarray(vec.flatten(), np.float64).reshape(len(vec), -1))
                part, chosen = chances.argmax(1).astype(np.int32), visited(chances, router.share)
            else:
                part, chosen = np.zeros(batch.num_rows, np.int32), np.ones((batch.num_rows, 1), bool)
            ends = np.concatenate([[0], np.cumsum(chosen.sum(1))]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.nonzero(chosen)[1].astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part), lists], [*batch.schema.names, "part", "visits"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in table.schema)
    return table.mapInArrow(file, f"{kinds}, part int, visits array<int>")


def best_of_block(n: int):
    """The `n` nearest rows of a block of candidates for each query of a block, ties to the smaller id."""
    names = ["k1", "k2", "score", "id", "same"]

    def search(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        kinds = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("score", pa.float64()), ("id", candidates.schema.field("ids").type.value_type), ("same", pa.bool_())])
        if not candidates.num_rows or not queries.num_rows:
            return kinds.empty_table()
        c, q = matrix(candidates["vec"]), matrix(queries["vec"])
        ids = candidates["ids"].combine_chunks()
        every_id, counts = np.asarray(ids.flatten()), np.asarray(pa.compute.list_value_length(ids)).astype(np.int64)
        begins = np.cumsum(counts) - counts
        ck1, ck2 = np.asarray(candidates["k1"]), np.asarray(candidates["k2"])
        qk1, qk2 = np.asarray(queries["k1"]), np.asarray(queries["k2"])
        sized = np.sqrt((c * c).sum(1)).max()
        parts = []
        for at in range(0, len(q), SCREENED_AT_ONCE):
            here = q[at:at + SCREENED_AT_ONCE]
            coarse = here @ c.T
            if len(c) > n:
                margin = 1e-12 * np.sqrt((here * here).sum(1)) * sized
                enough = -np.partition(-coarse, n - 1, axis=1)[:, n - 1] - margin
                row, col = np.nonzero(coarse >= enough[:, None])
            else:
                row, col = (x.ravel() for x in np.indices(coarse.shape))
            score = np.zeros(len(row))
            for d in range(c.shape[1]):
                score += here[row, d] * c[col, d]
            many = counts[col]
            row, col, score, found = np.repeat(row, many), np.repeat(col, many), np.repeat(score, many), every_id[spans_of(begins[col], many)]
            order = np.lexsort([found, -score, row])
            row, col, score, found = row[order], col[order], score[order], found[order]
            start = np.concatenate([[True], row[1:] != row[:-1]])
            rank = np.arange(len(row)) - np.maximum.accumulate(np.where(start, np.arange(len(row)), 0))
            keep = rank < n
            row, col = row[keep] + at, col[keep]
            parts.append(pa.Table.from_arrays(
                [pa.array(qk1[row]), pa.array(qk2[row]), pa.array(score[keep]), pa.array(found[keep], kinds.field("id").type), pa.array((qk1[row] == ck1[col]) & (qk2[row] == ck2[col]))], names))
        return pa.concat_tables(parts)

    return search


def search(vectors: DataFrame, query: Column, id_: str = "vec_id", vector: str = "embedding", n: int = 20, recall: float = 0.97) -> DataFrame:
    """The `n` nearest found of every row that `query` marks, among all rows but itself: (query_id, rank, id, score).

    Nearness is the inner product in double precision, the largest first; ties go to the smaller id. With `n` or fewer other
    rows all are returned. Rows take no part if the id or the vector is NULL, or if the vector is zero, holds a NULL or
    non-finite component, or is not of the commonest length. A repeated row is a neighbour of its copies, and each copy is a
    query of its own with its own rows in the result. Ids are integers. An empty table gives no rows; other columns are not read.
    """
    rows = stored(usable(vectors, id_, vector, query), "vectors")
    kind = rows.schema["id"].dataType.simpleString()
    most = n + 1  # one more, as a query may find itself
    first = Window.partitionBy("k1", "k2").orderBy("id")
    distinct = stored(
        rows.withColumn("_rank", F.row_number().over(first)).filter(F.col("_rank") <= most)
        .groupBy("k1", "k2").agg(F.min_by("vec", "_rank").alias("vec"), F.sort_array(F.collect_list("id")).alias("ids"), F.max("query").alias("query")),
        "distinct-vectors")
    # A marked row may lie beyond the smallest ids, so the marks come from the rows.
    asked = rows.filter("query").groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("askers"))
    total = distinct.count()
    sample = distinct.orderBy("k1", "k2").limit(SAMPLE).select("vec").toArrow()["vec"]
    router = fit(matrix(sample), total, n, recall) if total else Router((), 1.0, 1)
    filed = stored(filed_under(distinct.drop("query"), router), "filed-vectors")
    forget(distinct)
    visits = stored(filed.join(asked, ["k1", "k2"], "left_semi").select("k1", "k2", "vec", F.explode("visits").alias("part")), "visits")

    # One row for each part: how many blocks of candidates and of queries it has.
    held = dict(filed.groupBy("part").count().collect())
    come = dict(visits.groupBy("part").count().collect())
    blocks = [(p, -(-held.get(p, 0) // BLOCK_CANDIDATES), -(-come.get(p, 0) // BLOCK_QUERIES)) for p in held if p in come]
    sizes = F.broadcast(rows.sparkSession.createDataFrame(blocks, "part int, c_blocks int, q_blocks int"))

    def dealt(block: Column, of: str, other: str, blocks_of_other: str, table: DataFrame, *keep: str) -> DataFrame:
        own = F.pmod(block, F.col(of)).cast("int").alias("own")
        return table.join(sizes, "part").select(*keep, "part", own, F.explode(F.sequence(F.lit(0), F.col(blocks_of_other) - 1)).alias(other))

    left = dealt(F.xxhash64("k1", F.lit(1)), "c_blocks", "q_block", "q_blocks", filed, "k1", "k2", "vec", "ids").withColumnRenamed("own", "c_block")
    right = dealt(F.xxhash64("k2", F.lit(2)), "q_blocks", "c_block", "c_blocks", visits, "k1", "k2", "vec").withColumnRenamed("own", "q_block")
    pair = ["part", "c_block", "q_block"]
    found = left.groupBy(*pair).cogroup(right.groupBy(*pair)).applyInArrow(best_of_block(most), f"k1 long, k2 long, score double, id {kind}, same boolean")
    best = Window.partitionBy("k1", "k2").orderBy(F.desc("score"), "id", "same")
    lists = stored(
        found.withColumn("_rank", F.row_number().over(best)).filter(F.col("_rank") <= most)
        .groupBy("k1", "k2").agg(F.sort_array(F.collect_list(F.struct("_rank", "score", "id", "same"))).alias("near")), "neighbours")
    forget(visits, filed)
    own = F.array_position(F.transform("near", lambda x: x["same"] & (x["id"] == F.col("query_id"))), True).cast("int")
    answered = rows.filter("query").select(F.col("id").alias("query_id"), "k1", "k2").join(lists, ["k1", "k2"])
    cut = answered.withColumn("_own", own).select(
        "query_id", F.filter("near", lambda x, i: (F.col("_own") == 0) | (i != F.col("_own") - 1)).alias("near"))
    return (cut.select("query_id", F.posexplode(F.slice("near", 1, n)))
            .select("query_id", (F.col("pos") + 1).alias("rank"), F.col("col.id").alias(id_), F.col("col.score").alias("score")))
