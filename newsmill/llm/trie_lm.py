"""Language-model scores from an Elias-Fano n-gram trie of word pairs.

The model is a bigram with Dirichlet smoothing, P(v | u) = (c(u v) + K * P(v)) / (c(u) + K), so the logarithm of a text is
a sum of what depends on v and its predecessors and of what depends on u alone. Pairs are dealt out by their last word v,
which puts all counts a bucket needs into it, and both the counting and the scoring of a pair into one shuffle. Very
frequent words are dealt out further by their predecessor; their counts, at most two words a bucket, are sent along.

Each bucket builds a trie. Its first level holds the words v, its second, for each v, the words u before it. Pointers and
children are monotone sequences in Elias-Fano code, the children of v shifted by v's place; smoothed values are quantised
into bins. The levels lie in files that are mapped into memory; a pair is looked up by successor search among the
children of v. Pairs without a child take the smoothed value of v.
"""

from __future__ import annotations

import math
import tempfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsmill.llm.tables import pieces, spans_of, stored

START, END = b"\t", b"\n"  # no word holds a blank
SUMS = ("row", "id", "held", "n_tokens", "n_known", "base", "score")
STRENGTH = 20.0  # K: how many observations of a context the unigram is worth
BINS = 4096
BUCKET_BYTES = 12_000_000  # of text for each bucket of pairs


class EliasFano:
    """A non-decreasing sequence below `universe`: low bits packed, high bits in unary with a directory of counts."""

    def __init__(self, folder: Path, name: str):
        self.n, self.width, self.universe = map(int, np.load(folder / f"{name}-shape.npy"))
        for part in ("low", "high", "ones"):
            setattr(self, part, np.load(folder / f"{name}-{part}.npy", mmap_mode="r"))

    @staticmethod
    def write(folder: Path, name: str, values: np.ndarray, universe: int) -> None:
        n = len(values)
        width = max(0, (universe // max(1, n)).bit_length() - 1)
        bits = np.empty((n, width), np.uint8)
        for k in range(width):
            bits[:, k] = (values >> k) & 1
        low = np.r_[np.packbits(bits.ravel(), bitorder="little"), np.zeros(8, np.uint8)]
        del bits
        unary = np.zeros(-(-(n + (universe >> width) + 2) // 64) * 64, np.uint8)
        unary[(values >> width) + np.arange(n)] = 1
        high = np.packbits(unary, bitorder="little").view(np.uint64)
        ones = np.r_[0, np.cumsum(np.bitwise_count(high).astype(np.int64))]
        for part, made in (("shape", np.array([n, width, universe])), ("low", low), ("high", high), ("ones", ones)):
            np.save(folder / f"{name}-{part}.npy", made)

    def low_bits(self, i: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(i), np.int64)
        bit = i * self.width
        rows = np.lib.stride_tricks.as_strided(self.low, (len(self.low) - 7, 8), (1, 1))[bit >> 3]
        word = np.ascontiguousarray(rows).view(np.uint64).ravel() >> (bit & 7).astype(np.uint64)
        return (word & np.uint64((1 << self.width) - 1)).astype(np.int64)

    def place(self, i: np.ndarray, bit: int) -> np.ndarray:
        """Where the i-th (from 0) one or zero of the unary part stands."""
        words = np.arange(len(self.ones), dtype=np.int64) * 64
        before = np.asarray(self.ones) if bit else words - self.ones
        at = np.searchsorted(before, i, "right") - 1
        rest = i - before[at]
        word = np.asarray(self.high[at]) if bit else ~np.asarray(self.high[at])
        found = at * 64
        for half in (32, 16, 8, 4, 2, 1):
            count = np.bitwise_count(word & np.uint64((1 << half) - 1)).astype(np.int64)
            beyond = rest >= count
            rest = rest - np.where(beyond, count, 0)
            word = np.where(beyond, word >> np.uint64(half), word)
            found = found + np.where(beyond, half, 0)
        return found

    def access(self, i: np.ndarray) -> np.ndarray:
        return ((self.place(i, 1) - i) << self.width) | self.low_bits(i)

    def successor(self, x: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
        """The first index in [least, most) whose value is x or more, by binary search among equal high bits."""
        high, low = x >> self.width, x & ((1 << self.width) - 1)
        begin = np.where(high > 0, self.place(np.maximum(high - 1, 0), 0) - (high - 1), 0)
        a, b = np.clip(begin, least, most), np.clip(self.place(high, 0) - high, least, most)
        while True:
            open_ = a < b
            if not open_.any():
                return a
            middle = (a + b) >> 1
            less = np.zeros(len(x), bool)
            less[open_] = self.low_bits(middle[open_]) < low[open_]
            a, b = np.where(open_ & less, middle + 1, a), np.where(open_ & ~less, middle, b)


def quantise(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bins of equal width and the values that they stand for."""
    low, high = (float(values.min()), float(values.max())) if len(values) else (0.0, 0.0)
    step = (high - low) / (BINS - 1) or 1.0
    return np.rint((values - low) / step).astype(np.uint16), low + step * np.arange(BINS)


class Trie:
    """Words v, and for each the words before it with log10(c(u v) + K * P(v)), quantised."""

    def __init__(self, folder: Path):
        self.pointers, self.children = EliasFano(folder, "pointers"), EliasFano(folder, "children")
        for name in ("pair-bins", "pair-values", "word-bins", "word-values"):
            setattr(self, name.replace("-", "_"), np.load(folder / f"{name}.npy", mmap_mode="r"))

    @staticmethod
    def write(folder: Path, first: np.ndarray, last: np.ndarray, counts: np.ndarray, share: np.ndarray) -> None:
        """first (u) and last (v) of pairs in order of v, then u; share: K * P of every word."""
        n = len(share)
        EliasFano.write(folder, "pointers", np.searchsorted(last, np.arange(n + 1)), len(last) + 1)
        EliasFano.write(folder, "children", last * n + first, max(1, n * n))
        for name, values in (("pair", np.log10(counts + share[last])), ("word", np.log10(share))):
            bins, stands = quantise(values)
            np.save(folder / f"{name}-bins.npy", bins)
            np.save(folder / f"{name}-values.npy", stands)

    def look_up(self, first: np.ndarray, last: np.ndarray, some: int = 1 << 17) -> np.ndarray:
        """The smoothed value of each pair, `some` pairs at a time."""
        parts = [self.values(first[i:i + some], last[i:i + some]) for i in range(0, len(last), some)]
        return np.concatenate(parts) if parts else np.zeros(0)

    def values(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        n = len(self.word_bins)
        value = self.word_values[self.word_bins[last]]
        if not self.children.n or not len(last):
            return value
        words, which = np.unique(last, return_inverse=True)
        least, most = self.pointers.access(words)[which], self.pointers.access(words + 1)[which]
        x = last * n + first
        at = self.children.successor(x, least, most)
        inside = np.flatnonzero(at < most)
        seen = inside[self.children.access(at[inside]) == x[inside]]
        value[seen] = self.pair_values[self.pair_bins[at[seen]]]
        return value


@dataclass(frozen=True)
class Corpus:
    """Training tokens, distinct training tokens, the number of buckets, and the counts of the words that are split."""

    tokens: int
    distinct: int
    buckets: int
    frequent: dict[bytes, int]

    @property
    def constant(self) -> float:
        return math.log10(self.tokens + 0.5 * (self.distinct + 1))

    def parts(self, word: bytes) -> int:
        """Among how many buckets the pairs of a word are split."""
        return min(self.buckets, -(-2 * self.buckets * self.frequent[word] // max(1, self.tokens)))


def sequences(texts: list[str]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words, the codes of start, words and end of each text in turn, and the text of each."""
    flat, sizes = [], []
    for text in texts:
        own = text.encode().lower().split()  # bytes.lower changes A-Z only, bytes.split cuts at ASCII blanks only
        flat.append(START)
        flat += own
        flat.append(END)
        sizes.append(len(own) + 2)
    coded = pa.array(flat, pa.binary()).dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), np.repeat(np.arange(len(texts)), sizes)


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for run in pieces([t or "" for t in batch.column(0).to_pylist()]):
            words, codes, _ = sequences(run)
            counts = np.bincount(codes, minlength=len(words))
            kept = pa.array(np.array([w != START for w in words.to_pylist()], bool))
            yield pa.RecordBatch.from_arrays([words.filter(kept), pa.array(counts).filter(kept)], ["word", "n"])


def packed(arrays: dict[str, pa.Array]) -> bytes:
    batch = pa.RecordBatch.from_pydict(arrays)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpacked(data: list[bytes]) -> pa.Table:
    return pa.concat_tables([pa.ipc.open_stream(x).read_all() for x in data]).combine_chunks()


def deal(texts: list[str], rows: np.ndarray, ids: pa.Array, held: np.ndarray, corpus: Corpus) -> Iterator[tuple[int, bytes, bytes, bytes, bytes]]:
    """For each bucket the pairs of some texts (all words v, then all words u), their training counts, and which text has each
    how often."""
    words, codes, doc = sequences(texts)
    n, many = len(texts), len(words)
    last = np.flatnonzero(np.r_[False, doc[1:] == doc[:-1]])
    pair_doc, times = np.unique((codes[last] * many + codes[last - 1]) * n + doc[last], return_counts=True)
    pair, of = np.divmod(pair_doc, n)
    new = np.r_[True, pair[1:] != pair[:-1]]
    pairs, which = pair[new], np.cumsum(new) - 1
    training = np.bincount(which, np.where(held[of], 0, times), len(pairs)).astype(np.int64)
    v, u = np.divmod(pairs, many)
    names = words.to_pylist()
    hashed = np.fromiter(map(zlib.crc32, names), np.int64, many)
    parts = np.fromiter((corpus.parts(w) if w in corpus.frequent else 1 for w in names), np.int64, many)
    bucket = (hashed[v] + hashed[u] // 7 % parts[v]) % corpus.buckets
    order = np.argsort(bucket, kind="stable")
    begin, size = np.flatnonzero(new), np.diff(np.r_[np.flatnonzero(new), len(pair)])
    edges = np.searchsorted(bucket[order], np.arange(corpus.buckets + 1))
    for b in np.flatnonzero(np.diff(edges)):
        own = order[edges[b]:edges[b + 1]]
        at = spans_of(begin[own], size[own])
        docs, local = np.unique(of[at], return_inverse=True)
        named, codes_ = np.unique(np.r_[v[own], u[own]], return_inverse=True)
        yield int(b), packed({"word": pa.DictionaryArray.from_arrays(pa.array(codes_.astype(np.int32)), words.take(pa.array(named)))}), packed({
            "training": pa.array(training[own].astype(np.int32)), "size": pa.array(size[own].astype(np.int32))}), packed({"doc": pa.array(local.astype(np.int32)), "times": pa.array(times[at].astype(np.int32))}), packed({
                "row": pa.array(rows[docs]), "id": ids.take(pa.array(docs)), "held": pa.array(held[docs])})


def score_bucket(table: pa.Table, corpus: Corpus) -> pa.Table:
    """Sums over the pairs of a bucket for each text, in one packet for each run of texts."""
    data = {name: table.column(name).to_pylist() for name in ("pairs", "numbers", "uses", "docs")}
    column = lambda t, name: t.column(name).to_numpy()
    names = pa.concat_tables([pa.ipc.open_stream(x).read_all() for x in data.pop("pairs")]).unify_dictionaries().column("word")
    words = names.chunk(0).dictionary.to_pylist()
    codes = [c.indices.to_numpy() for c in names.chunks]
    many, numbers = len(words), unpacked(data.pop("numbers"))
    v, u = (np.concatenate([c[part * len(c) // 2:(part + 1) * len(c) // 2] for c in codes]).astype(np.int64) for part in (0, 1))
    training, size = column(numbers, "training"), column(numbers, "size")
    del names, codes, numbers
    counts = np.bincount(v, training, many)
    for code, word in enumerate(words):
        if word in corpus.frequent:
            counts[code] = corpus.frequent[word]
    share = STRENGTH * (counts + 0.5) / (corpus.tokens + 0.5 * (corpus.distinct + 1))
    keys, which = np.unique(v * many + u, return_inverse=True)
    seen = np.bincount(which, training, len(keys))
    last, first = np.divmod(keys, many)
    kept = seen > 0
    with tempfile.TemporaryDirectory() as folder:
        Trie.write(Path(folder), first[kept], last[kept], seen[kept], share)
        trie = Trie(Path(folder))
        value = trie.look_up(first, last) - np.log10(counts[last] + STRENGTH)
        del trie
    value, base, known = value[which], np.log10(counts[v] + 0.5), counts[v] > 0
    at, gone, out = 0, 0, []
    until = np.cumsum(size)
    del u, which, keys, last, first, seen, kept
    for piece, uses, docs in zip(table.column("piece").to_pylist(), data["uses"], data["docs"], strict=True):  # a text's pairs are all in one packet
        used, own = unpacked([uses]), unpacked([docs])
        doc, times = column(used, "doc"), column(used, "times")
        gone += len(doc)
        end = int(np.searchsorted(until, gone)) + 1
        pair, n = np.repeat(np.arange(at, end), size[at:end]), own.num_rows
        total = lambda x: np.bincount(doc, x * times, n)  # noqa: B023, E731
        out.append((piece, packed(dict(zip(SUMS, [
            *(own.column(c).combine_chunks() for c in ("row", "id", "held")), pa.array(total(1).astype(np.int64)), pa.array(total(known[pair]).astype(np.int64)),
            pa.array(total(base[pair])), pa.array(total(value[pair]))], strict=True)))))
        at = end
    pa.default_memory_pool().release_unused()
    return pa.table({"piece": pa.array([p for p, _ in out], pa.int64()), "sums": pa.array([s for _, s in out], pa.binary())})


def sum_piece(table: pa.Table) -> pa.Table:
    """Adds up what the buckets say about the texts of one run, which is about PIECE_BYTES long."""
    found = unpacked(table.column("sums").to_pylist())
    _, first, which = np.unique(found.column("row").to_numpy(), return_index=True, return_inverse=True)
    own = found.select(["id", "held"]).take(pa.array(first))
    sums = {c: np.bincount(which, found.column(c).to_numpy(), len(first)) for c in SUMS[3:]}
    return pa.table({"id": own.column("id"), "held": own.column("held"), **{
        c: pa.array(x.astype(np.int64) if c.startswith("n_") else x) for c, x in sums.items()}})


def corpus_of(texts: DataFrame, text_bytes: int) -> Corpus:
    """Counts over all training texts; words are merged by Spark and stay distributed."""
    words = stored(texts.mapInArrow(count_words, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")
    buckets = max(4, -(-text_bytes // BUCKET_BYTES))
    total = words.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    tokens = total["n"] or 0
    frequent = words.filter(F.col("n") * (2 * buckets) > tokens).collect()  # fewer than 2 words a bucket
    return Corpus(tokens, total["v"] or 0, buckets, {bytes(r["word"]): r["n"] for r in frequent})


def score(docs: DataFrame, held_out: Column, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document: id, held, n_tokens, n_known, train_tokens, base_score, score (both log10).

    Learns from the rows where `held_out` isn't true (NULL counts as not held out) and scores all rows. A NULL text is an
    empty one; an empty text is its end alone. Repeated rows get a row each; ids may be NULL. Without training rows every
    token is unknown. An empty table gives no rows.
    """
    rows = docs.select(F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"), F.col(f"`{id_column}`").cast("long").alias("id"),
                       F.coalesce(held_out, F.lit(False)).alias("held"))
    size = rows.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    corpus = corpus_of(rows.filter("NOT held").select("text"), size)
    shared = docs.sparkSession.sparkContext.broadcast(corpus)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            at, texts = 0, [t or "" for t in batch.column(0).to_pylist()]
            held = batch.column(2).to_numpy(zero_copy_only=False)
            for run in pieces(texts):
                n = len(run)
                for b, pairs, numbers, uses, own in deal(run, np.arange(row, row + n), batch.column(1)[at:at + n], held[at:at + n], shared.value):
                    yield pa.RecordBatch.from_pydict({"bucket": pa.array([b], pa.int32()), "piece": pa.array([row], pa.int64()), "pairs": [pairs], "numbers": [numbers], "uses": [uses], "docs": [own]})
                at, row = at + n, row + n

    sums = rows.mapInArrow(dealt, "bucket int, piece long, pairs binary, numbers binary, uses binary, docs binary").groupBy("bucket").applyInArrow(
        lambda table: score_bucket(table, shared.value), "piece long, sums binary")
    merged = sums.groupBy("piece").applyInArrow(sum_piece, "id long, held boolean, n_tokens long, n_known long, base double, score double")
    return merged.select("id", "held", "n_tokens", "n_known", F.lit(corpus.tokens).cast("long").alias("train_tokens"),
                         (F.col("base") - F.col("n_tokens") * corpus.constant).alias("base_score"), "score")
