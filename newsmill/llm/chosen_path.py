"""Join of near copies by Jaccard similarity of word n-grams, by chosen paths.

Texts with the same set of n-grams are one set. A set is embedded into minhash positions; a run chooses, at each node of a
tree, the positions by which it splits the sets there: a path is followed by all sets with the same values at its
positions. 1 / similarity positions are chosen on average, so two similar sets stay together on some path. Small buckets
are compared by brute force, large ones are split again; what doesn't split (a large group of near copies) is compared with
one of its sets first, and only the rest with everybody, in blocks. Runs are repeated until the wanted recall.

What this finds are candidates by a lenient estimate; their components are compared exactly, on whole sets, in blocks. The
links found there are counted, and their components are the classes. No step makes rows for all pairs of a group.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsmill.llm.components import components
from newsmill.llm.positional_index import bounded, text_key
from newsmill.llm.tables import pieces, spans_of, stored

SHINGLE, SIMILARITY = 5, 0.8
POSITIONS = 64  # minhash values of a set
LENIENT = 0.62  # of the estimate; three standard errors below the similarity and more
RECALL = 0.9999  # of pairs at the similarity itself, by the runs' paths
SMALL, DEPTH = 128, 3  # largest bucket compared by brute force, most splits of a larger one
BLOCK = 1024  # sets that a task compares with as many others
CHANCE = 1 << 20
RUN_BYTES = 1_000_000  # of text split into words at a time
RUN_PAIRS, RUN_LINES = 20_000, 256  # pairs of sketches, and lines of a block of sets, that are compared at a time

SETS = "struct<set_key: binary, n_grams: int, signature: array<int>>"


def runs_needed(recall: float = RECALL, similarity: float = SIMILARITY, depth: int = DEPTH) -> int:
    """A path lives on with the chance that one of Poisson(1 / similarity) chosen positions agrees, at each of `depth` splits."""
    alive = 1.0
    for _ in range(depth):
        alive = 1 - math.exp(-alive)
    return math.ceil(math.log(1 - recall) / math.log(1 - alive))


def grams(texts: list[str], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct word n-grams of each text, sorted, one text after the other, and how many each has.

    Words are cut at ASCII blanks and compared without regard to the case of A-Z. A text of fewer words has one gram of all.
    """
    flat, sizes = [], []
    for text in texts:
        own = text.encode().lower().split()
        flat += own
        sizes.append(len(own))
    coded = pa.array(flat, pa.binary()).dictionary_encode()
    hashed = np.fromiter(map(xxhash.xxh64_intdigest, coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    words = hashed[coded.indices.to_numpy(zero_copy_only=False)]
    power, made, counts, at = np.uint64(0x9E3779B97F4A7C15), [], [], 0
    whole = np.zeros(max(0, len(words) - size + 1), np.uint64)
    for k in range(size):
        whole = (whole + words[k:k + len(whole)]) * power
    whole ^= whole >> np.uint64(29)
    for n in sizes:
        if n >= size:
            own = np.unique(whole[at:at + n - size + 1])
        elif n:
            own = np.array([xxhash.xxh64_intdigest(words[at:at + n].tobytes(), seed=n)], np.uint64)
        else:
            own = np.zeros(0, np.uint64)
        made.append(own)
        counts.append(len(own))
        at += n
    return (np.concatenate(made) if made else np.zeros(0, np.uint64)), np.array(counts, np.int64)


def signatures(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Minhash values of each set that isn't empty, as 32-bit integers."""
    odd = np.random.default_rng(11).integers(1, 1 << 62, (POSITIONS, 2), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    begin = (np.cumsum(counts) - counts)[counts > 0]
    out = np.zeros((len(begin), POSITIONS), np.uint32)
    if len(begin):
        for k, (a, b) in enumerate(odd):
            mixed = (hashes ^ (hashes >> np.uint64(31))) * a + b
            out[:, k] = np.minimum.reduceat((mixed >> np.uint64(32)).astype(np.uint32), begin)
    return out.view(np.int32)


def embed(texts: list[str], size: int) -> list[dict | None]:
    hashes, counts = grams(texts, size)
    rows, ends = iter(signatures(hashes, counts)), np.cumsum(counts)
    return [{"set_key": hashlib.blake2b(hashes[e - n:e].tobytes(), digest_size=16).digest(), "n_grams": int(n), "signature": next(rows)} if n else None
            for n, e in zip(counts.tolist(), ends.tolist(), strict=True)]


def sets_of(docs: DataFrame, id_column: str, text: str, size: int) -> DataFrame:
    """id, key (of the text), set_key, n_grams, signature of each document, stored; no set where a text has no words."""

    @F.arrow_udf(SETS)
    def embedded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.struct([("set_key", pa.binary()), ("n_grams", pa.int32()), ("signature", pa.list_(pa.int32()))])
        for batch in batches:
            yield pa.array([row for run in pieces((t.as_py() or "" for t in batch), RUN_BYTES) for row in embed(run, size)], kind)

    whole = F.col(f"`{text}`")
    made = docs.select(F.col(f"`{id_column}`").cast("long").alias("id"), text_key(whole).alias("key"), embedded.asNondeterministic()(whole).alias("s"))
    return stored(made.select("id", "key", "s.set_key", "s.n_grams", "s.signature"), "sets")


def paths(sets: DataFrame, runs: int) -> DataFrame:
    """set_key and path below the roots of all runs; which positions split a root is the same for all sets."""
    rng = np.random.default_rng(5)
    chosen = [(r, int(i)) for r in range(runs) for i in np.flatnonzero(rng.random(POSITIONS) < 1 / (SIMILARITY * POSITIONS))]
    return sets.select("set_key", F.explode(F.array(*(F.xxhash64(F.lit(r), F.lit(i), F.col("signature")[i]) for r, i in chosen))).alias("path"))


def deeper(sets: DataFrame, level: DataFrame) -> DataFrame:
    """The same one split further: a hash of the path chooses the positions."""
    chosen = F.filter(F.sequence(F.lit(0), F.lit(POSITIONS - 1)), lambda i: F.pmod(F.xxhash64("path", i), F.lit(CHANCE)) < CHANCE / (SIMILARITY * POSITIONS))
    return level.join(sets.select("set_key", "signature"), "set_key").select(
        "set_key", F.explode(F.transform(chosen, lambda i: F.xxhash64("path", i, F.get("signature", i)))).alias("path"))


def cells(rows: DataFrame, group: str, count: str) -> DataFrame:
    """Rows dealt to the cells of a square of blocks over each group: a row stands in one line and one column of blocks.

    Adds cell, and side: 0 for a row of the block that is compared, 1 for one of the other block, 2 where both are the same.
    """
    blocks = F.ceil(F.col(count) / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("set_key"), blocks).cast("int")
    all_cells = F.transform(F.sequence(F.lit(0), F.col("_blocks") - 1), lambda other: F.struct(
        F.concat_ws("-", F.least(F.col("_own"), other), F.greatest(F.col("_own"), other)).alias("cell"),
        F.when(F.col("_own") == other, 2).when(F.col("_own") < other, 0).otherwise(1).alias("side")))
    return rows.withColumns({"_blocks": blocks, "_own": own}).select(
        *(c for c in rows.columns), F.explode(all_cells).alias("_c")).select(*rows.columns, "_c.cell", "_c.side").withColumn(
        "cell", F.concat_ws("/", F.col(group).cast("string"), "cell"))


def labelled(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least index in the component of each of n nodes."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def groups_of(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.Table]:
    """Tables of whole groups out of batches in which a group's rows follow each other; small groups come together."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        rest = table if rest is None else pa.concat_tables([rest, table])
        names = rest.column(column).combine_chunks()
        if names[0] == names[-1]:
            continue
        values = names.to_pylist()
        last = len(values) - 1
        while values[last - 1] == values[-1]:
            last -= 1
        yield rest.slice(0, last)
        rest = rest.slice(last)
    if rest is not None and rest.num_rows:
        yield rest


def runs_of(table: pa.Table, column: str) -> tuple[np.ndarray, np.ndarray]:
    codes = table.column(column).combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
    begin = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
    return begin, np.diff(np.r_[begin, len(codes)])


def compare_sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of a spanning forest of the estimated links in each cell; rows in order of their cell."""
    for table in groups_of(batches, "cell"):
        keys = table.column("set_key").to_pylist()
        sketch = table.column("signature").combine_chunks().flatten().to_numpy().reshape(-1, POSITIONS)
        side = table.column("side").to_numpy()
        out_a, out_b = [], []
        begin, size = runs_of(table, "cell")
        small = size <= 64
        # All pairs of all small cells at once, in slices; then large cells one by one.
        rows = spans_of(begin[small], size[small])
        end = np.repeat((begin + size)[small], size[small])
        for i in range(0, len(rows), 20_000):
            some, many = rows[i:i + 20_000], (end - rows - 1)[i:i + 20_000]
            a = np.repeat(some, many)
            b = spans_of(some + 1, many)
            ok = (side[a] == 2) | (side[b] == 2) | (side[a] != side[b])
            a, b = a[ok], b[ok]
            for j in range(0, len(a), RUN_PAIRS):
                near = (sketch[a[j:j + RUN_PAIRS]] == sketch[b[j:j + RUN_PAIRS]]).mean(1) >= LENIENT
                out_a.append(a[j:j + RUN_PAIRS][near])
                out_b.append(b[j:j + RUN_PAIRS][near])
        for s, n in zip(begin[~small].tolist(), size[~small].tolist(), strict=True):
            own, sides = sketch[s:s + n], side[s:s + n]
            for i in range(n):
                near = i + 1 + np.flatnonzero((own[i + 1:] == own[i]).mean(1) >= LENIENT)
                near = near[(sides[near] == 2) | (sides[i] == 2) | (sides[near] != sides[i])]
                out_a.append(np.full(len(near), s + i))
                out_b.append(s + near)
        a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (out_a, out_b))
        label = labelled(len(keys), a, b)
        moved = np.flatnonzero(label != np.arange(len(keys)))
        yield pa.RecordBatch.from_pydict({
            "a": pa.array([keys[i] for i in moved.tolist()], pa.binary()), "b": pa.array([keys[i] for i in label[moved].tolist()], pa.binary())})


def candidate_edges(sets: DataFrame, runs: int) -> DataFrame:
    """Edges between sets that an estimate calls similar, enough to connect all of them."""
    level, parts, pivots = stored(paths(sets, runs), "paths"), [], []
    for depth in range(1, DEPTH + 1):
        counts = level.groupBy("path").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        met = stored(level.join(counts, "path"), "buckets")
        parts.append(met.filter(F.col("n") <= SMALL).withColumns({"cell": F.col("path").cast("string"), "side": F.lit(2)}).select("set_key", "cell", "side"))
        large = met.filter(F.col("n") > SMALL).select("set_key", "path", "n")
        if large.isEmpty():
            break
        level = stored(deeper(sets, large), "paths") if depth < DEPTH else large
    else:
        first = level.groupBy("path").agg(F.min("set_key").alias("pivot"))
        mine = level.join(sets.select("set_key", "signature"), "set_key")
        theirs = first.join(sets.select(F.col("set_key").alias("pivot"), F.col("signature").alias("_s")), "pivot")
        agree = F.aggregate(F.zip_with("signature", "_s", lambda x, y: (x == y).cast("int")), F.lit(0), lambda acc, x: acc + x)
        judged = stored(mine.join(theirs, "path").select("set_key", "path", "pivot", (agree >= LENIENT * POSITIONS).alias("near")), "pivots")
        pivots.append(judged.filter("near AND set_key != pivot").select(F.col("set_key").alias("a"), F.col("pivot").alias("b")))
        # The rest is compared with everybody: the rest in blocks of lines, all others in blocks of columns.
        far = judged.filter("NOT near").groupBy("path").agg(F.count(F.lit(1)).alias("n_far"))
        whole = judged.join(far, "path").join(judged.groupBy("path").agg(F.count(F.lit(1)).alias("n")), "path")
        lines, columns = (F.ceil(F.col(c) / BLOCK).cast("int") for c in ("n_far", "n"))
        place = F.xxhash64("set_key")
        rest = whole.filter("NOT near").select("set_key", "path", F.pmod(place, lines).alias("line"), F.explode(F.sequence(F.lit(0), columns - 1)).alias("column"), F.lit(0).alias("side"))
        everybody = whole.select("set_key", "path", F.explode(F.sequence(F.lit(0), lines - 1)).alias("line"), F.pmod(place, columns).cast("int").alias("column"), F.lit(1).alias("side"))
        parts.append(rest.unionByName(everybody).select("set_key", F.concat_ws("/", "path", "line", "column").alias("cell"), "side"))
    dealt = parts[0]
    for part in parts[1:]:
        dealt = dealt.unionByName(part)
    dealt = dealt.join(sets.select("set_key", "signature"), "set_key")
    edges = dealt.repartition("cell").sortWithinPartitions("cell").mapInArrow(compare_sketches, "a binary, b binary")
    for part in pivots:
        edges = edges.unionByName(part)
    return stored(edges.distinct(), "candidates")


def compare_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each row of a cell the copies of the sets linked to it there, and an edge to the least of its component there."""
    for table in groups_of(batches, "cell"):
        begin, size = runs_of(table, "cell")
        hashes = table.column("hashes").combine_chunks()
        flat, length = hashes.flatten().to_numpy(), hashes.value_lengths().to_numpy().astype(np.int64)
        offset = np.cumsum(length) - length
        copies, side = table.column("copies").to_numpy(), table.column("side").to_numpy()
        links, label = np.zeros(len(length), np.int64), np.arange(len(length))
        for s, n in zip(begin.tolist(), size.tolist(), strict=True):
            if n < 2:
                continue
            own = flat[offset[s]:offset[s + n - 1] + length[s + n - 1]]
            _, column, times = np.unique(own, return_inverse=True, return_counts=True)
            row = np.repeat(np.arange(n), length[s:s + n])
            shared = times[column] > 1  # a hash that one set has adds to no intersection
            names, column = np.unique(column[shared], return_inverse=True)
            row, common = row[shared], np.zeros((n, n), np.float32)
            order = np.argsort(column, kind="stable")
            row, column = row[order], column[order]
            for c in range(0, len(names), 2048):
                part = slice(*np.searchsorted(column, [c, c + 2048]))
                present = np.zeros((n, 2048), np.float32)
                present[row[part], column[part] - c] = 1
                common += present @ present.T
            sizes, sides, many = length[s:s + n], side[s:s + n], copies[s:s + n]
            out_a, out_b = [], []
            for i in range(0, n, RUN_LINES):
                some = slice(i, i + RUN_LINES)
                near = common[some] >= SIMILARITY * (sizes[some, None] + sizes - common[some]) - 1e-9
                near &= (sides[some, None] == 2) | (sides == 2) | (sides[some, None] != sides)
                np.fill_diagonal(near[:, i:], False)
                links[s + i:s + i + len(near)] = near @ many
                a, b = np.nonzero(near)
                out_a.append((a + i).astype(np.int32))
                out_b.append(b.astype(np.int32))
            label[s:s + n] = s + labelled(n, np.concatenate(out_a), np.concatenate(out_b))
        keys = table.column("set_key").combine_chunks()
        yield pa.RecordBatch.from_pydict({"a": keys, "b": keys.take(pa.array(label)), "links": pa.array(links)})


def link_sets(docs: DataFrame, sets: DataFrame, text: str, size: int) -> DataFrame:
    """set_key, label and linked (documents with other, similar sets) of the sets that are similar to another."""
    whole = stored(sets.filter("set_key IS NOT NULL").groupBy("set_key").agg(
        F.count(F.lit(1)).alias("copies"), F.any_value("signature").alias("signature"), F.min("key").alias("key")), "distinct-sets")
    found = stored(components(candidate_edges(whole, runs_needed())), "candidate-groups")
    groups = found.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    members = stored(found.join(groups, "label").select(F.col("node").alias("set_key"), "label", "n").join(
        whole.select("set_key", "copies", "key"), "set_key"), "members")

    @F.arrow_udf("array<long>")
    def hashed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            lists = []
            for run in pieces((t.as_py() for t in batch), RUN_BYTES):
                hashes, counts = grams(run, size)
                lists += np.split(hashes.view(np.int64), np.cumsum(counts)[:-1]) if run else []
            yield pa.array(lists, pa.list_(pa.int64()))

    texts = docs.select(text_key(F.col(f"`{text}`")).alias("key"), F.col(f"`{text}`").alias("text")).join(bounded(members.select("key"), "key"), "key")
    one = texts.groupBy("key").agg(F.any_value("text").alias("text"))  # copies go before the shuffle, task by task
    exact = stored(members.join(one.select("key", hashed.asNondeterministic()("text").alias("hashes")), "key").select(
        "set_key", "label", "n", "copies", "hashes"), "member-sets")
    dealt = cells(exact.withColumn("label", F.hex("label")), "label", "n").select("set_key", "cell", "side", "copies", "hashes")
    linked = stored(dealt.repartition("cell").sortWithinPartitions("cell").mapInArrow(compare_sets, "a binary, b binary, links long"), "links")
    labels = components(linked.select("a", "b"))
    counts = linked.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("linked"))
    return stored(labels.join(counts, "node").select(F.col("node").alias("set_key"), "label", "linked"), "linked-sets").join(
        whole.select("set_key", "copies"), "set_key")


def classes(docs: DataFrame, id_column: str = "doc_id", text: str = "text", size: int = SHINGLE) -> DataFrame:
    """One row for each document: id, key, class_key, class_id, class_size, n_links.

    Two documents are linked if the Jaccard similarity of their sets of `size`-word n-grams is SIMILARITY or more; classes are
    the connected components of the links. class_id is the least id in the class, n_links the number of other rows linked to
    this one, copies included. A text without words (NULL, empty, blank) has no set: its class is itself, it has no link and
    class_key is NULL. Repeated rows are copies. NULL ids are allowed; a class of such rows has a NULL id.
    """
    sets = sets_of(docs, id_column, text, size)
    linked = link_sets(docs, sets, text, size)
    by_set = sets.filter("set_key IS NOT NULL").groupBy("set_key").agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("least"))
    known = by_set.join(linked.select("set_key", "label", "linked"), "set_key", "left").withColumn("label", F.coalesce("label", "set_key"))
    total = known.groupBy("label").agg(F.min("least").alias("class_id"), F.sum("copies").alias("class_size"))
    table = stored(known.join(total, "label").select(
        "set_key", F.col("label").alias("class_key"), "class_id", "class_size", (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "classes")
    out = sets.select("id", "key", "set_key").join(table, "set_key", "left")
    alone = F.col("set_key").isNull()
    return out.select("id", "key", "class_key", F.when(alone, F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
                      F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with one row of each class: the one with the least id (NULL last), then the least key; of equal rows any one.

    Texts without words stay, each by itself.
    """
    found = stored(classes(docs, id_column, text), "document-classes")
    large = found.filter("class_size > 1")
    best = large.groupBy("class_key").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key")).alias("best"))
    keys = stored(large.select("key", "class_key").distinct().join(best, "class_key").select(F.col("key").alias("_key"), "class_key", "best"), "class-winners")
    # Texts stay where they are while the narrow verdicts fit a broadcast.
    keyed = docs.withColumn("_key", text_key(F.col(f"`{text}`"))).join(bounded(keys, F.lit(120)), "_key", "left")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    alone = keyed.filter(F.col("class_key").isNull()).select(*columns)
    winner = (F.col("_key") == F.col("best.key")) & F.col(f"`{id_column}`").cast("long").eqNullSafe(F.col("best.id"))
    return alone.unionByName(keyed.filter(F.col("class_key").isNotNull() & winner).dropDuplicates(["class_key"]).select(*columns))
