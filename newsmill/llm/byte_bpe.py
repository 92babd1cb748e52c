"""Byte-level BPE encoding and decoding by a segment tree of pair ranks.

A piece of text is a row of live byte positions. The leaf of a position holds the rank of the pair that starts there,
inner nodes hold the minimum of their children, so the root names the leftmost pair of least rank. A merge changes three
leaves: the merged pair, the pair before it and the pair that vanishes; each is carried to the root in logarithmic time.
Short pieces of equal tree size are merged side by side in numpy, long ones alone.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsmill.llm.tables import pieces, with_struct

NEVER = np.int64(1) << 60
SIDE_BY_SIDE = 64  # bytes; longer pieces have a tree of their own
KNOWN_PIECES = 200_000  # pieces whose ids a worker remembers; beyond, it starts anew
RUN_BYTES = 1_000_000  # text that is cut into pieces at a time; a longer text is a run of its own
AT_ONCE = 4096  # pieces merged side by side


class Merges:
    """The ranks of a vocabulary file and what a pair of ids merges into."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.bytes_of = {rank: token for token, rank in self.ranks.items()}
        self.width = max(self.bytes_of) + 1
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        self.pairs = {
            (self.ranks[token[:k]], self.ranks[token[k:]]): rank
            for token, rank in self.ranks.items() for k in range(1, len(token))
            if token[:k] in self.ranks and token[k:] in self.ranks}
        keys = np.array([a * self.width + b for a, b in self.pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.merged = keys[order], np.array(list(self.pairs.values()), np.int64)[order]

    def lookup(self, left: np.ndarray, right: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
        """rank * size + position of each pair, NEVER where the vocabulary has no such pair or there is no right token."""
        key = left * self.width + right
        k = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((right >= 0) & (self.keys[k] == key), self.merged[k] * size + at, NEVER)

    def encode(self, words: list[bytes]) -> list[bytes]:
        """The ids of each piece as little-endian unsigned 32-bit integers."""
        out: list = [None] * len(words)
        sizes: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            rank = self.ranks.get(word)
            if rank is not None:
                out[i] = rank.to_bytes(4, "little")
            elif len(word) > SIDE_BY_SIDE:
                out[i] = np.array(self.encode_long(word), "<u4").tobytes()
            else:
                sizes.setdefault(1 << (len(word) - 1).bit_length(), []).append(i)
        for size, all_ in sizes.items():
            for start in range(0, len(all_), AT_ONCE):
                own = all_[start:start + AT_ONCE]
                for i, ids in zip(own, self.encode_short([words[i] for i in own], size), strict=True):
                    out[i] = ids
        return out

    def encode_short(self, words: list[bytes], size: int) -> list[bytes]:
        n = len(words)
        lengths = np.fromiter(map(len, words), np.int64, n)
        raw = np.frombuffer(b"".join(w.ljust(size, b"\0") for w in words), np.uint8).reshape(n, size)
        place = np.arange(size)
        ids = np.where(place < lengths[:, None], self.single[raw], -1)
        after = np.where(place + 1 < lengths[:, None], place + 1, size)  # the next live position; size: none
        before = np.tile(place - 1, (n, 1))
        tree = np.full((n, 2 * size), NEVER)
        right = np.full((n, size), -1)
        right[:, :-1] = ids[:, 1:]
        tree[:, size:] = self.lookup(np.maximum(ids, 0), right, place, size)
        level = size
        while level > 1:
            tree[:, level // 2:level] = np.minimum(tree[:, level:2 * level:2], tree[:, level + 1:2 * level:2])
            level //= 2

        flat_tree, flat_ids, flat_after, flat_before = tree.ravel(), ids.ravel(), after.ravel(), before.ravel()

        def put(rows: np.ndarray, at: np.ndarray, value: np.ndarray) -> None:
            """Sets a leaf of each of `rows` and carries it to the root."""
            first = rows * (2 * size)
            node = at + size
            place = first + node
            flat_tree[place] = value
            for _ in range(size.bit_length() - 1):
                least = np.minimum(flat_tree[place], flat_tree[place ^ 1])
                node = node >> 1
                place = first + node
                flat_tree[place] = least

        live = np.flatnonzero(tree[:, 1] < NEVER)
        while len(live):
            first = live * size
            best = tree[live, 1]
            at, rank = best & (size - 1), best // size
            here = first + at
            gone = flat_after[here]
            flat_ids[here] = rank
            flat_ids[first + gone] = -1
            put(live, gone, NEVER)
            beyond = flat_after[first + gone]
            flat_after[here] = beyond
            has = beyond < size
            flat_before[(first + beyond)[has]] = at[has]
            put(live, at, self.lookup(rank, np.where(has, flat_ids[first + np.minimum(beyond, size - 1)], -1), at, size))
            prior = flat_before[here]
            has = np.flatnonzero(prior >= 0)
            if len(has):
                rows, prior = live[has], prior[has]
                put(rows, prior, self.lookup(flat_ids[first[has] + prior], rank[has], prior, size))
            live = live[tree[live, 1] < NEVER]
        kept = ids >= 0
        flat, ends = ids[kept].astype("<u4").tobytes(), np.cumsum(kept.sum(1)) * 4
        return [flat[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]

    def encode_long(self, word: bytes) -> list[int]:
        n = len(word)
        size = 1 << (n - 1).bit_length()
        ids = self.single[np.frombuffer(word, np.uint8)].tolist()
        after, before, never, pairs = [*range(1, n), -1], [*range(-1, n - 1)], int(NEVER), self.pairs
        tree = [never] * (2 * size)
        for i in range(n - 1):
            rank = pairs.get((ids[i], ids[i + 1]))
            if rank is not None:
                tree[size + i] = rank * size + i
        for k in range(size - 1, 0, -1):
            tree[k] = min(tree[2 * k], tree[2 * k + 1])

        def put(at: int, rank: int | None) -> None:
            node = at + size
            tree[node] = never if rank is None else rank * size + at
            while node > 1:
                least = min(tree[node], tree[node ^ 1])
                node >>= 1
                if tree[node] == least:
                    return
                tree[node] = least

        while tree[1] < never:
            rank, at = divmod(tree[1], size)
            gone = after[at]
            beyond, prior = after[gone], before[at]
            ids[at], ids[gone], after[at] = rank, -1, beyond
            put(gone, None)
            if beyond >= 0:
                before[beyond] = at
            put(at, pairs.get((rank, ids[beyond])) if beyond >= 0 else None)
            if prior >= 0:
                put(prior, pairs.get((ids[prior], rank)))
        return [i for i in ids if i >= 0]


@cache
def merges(path: str) -> Merges:
    return Merges(path)


def encode_texts(texts: list[str], table: Merges, find, known: dict[str, bytes]) -> list[bytes]:
    split = [find(text) for text in texts]
    new = [*set().union(*map(set, split)).difference(known)] if split else []
    if len(known) + len(new) > KNOWN_PIECES:
        known.clear()
        new = [*set().union(*map(set, split))]
    known.update(zip(new, table.encode([w.encode() for w in new]), strict=True))
    return [b"".join(map(known.__getitem__, words)) for words in split]


def encoded_batch(batch: pa.Array, table: Merges, find, known: dict[str, bytes]) -> list[bytes]:
    """The ids of each text of a batch; the texts become Python strings run by run."""
    return [x for run in pieces((t.as_py() or "" for t in batch), RUN_BYTES) for x in encode_texts(run, table, find, known)]


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """`docs` with `token_ids`, binary: the ids as little-endian unsigned 32-bit integers.

    Each match of `pattern` is encoded by itself, as ranks in the file at `path` say; bytes between matches are left out.
    A NULL or empty text has no ids. Texts are taken whole, however long; a column named `token_ids` is replaced.
    """

    @F.arrow_udf("struct<token_ids: binary>")
    def encoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table, find, known = merges(path), regex.compile(pattern).findall, {}
        for batch in batches:
            yield pa.StructArray.from_arrays([pa.array(encoded_batch(batch, table, find, known), pa.binary())], ["token_ids"])

    return with_struct(docs, encoded.asNondeterministic()(F.col(f"`{text}`")), "token_ids")


def decoded_batch(ids: Iterable[bytes], of) -> list[bytes]:
    return [b"".join(map(of, np.frombuffer(x, "<u4").tolist())) for x in ids]


def decode(encoded: DataFrame, path: str, ids: str = "token_ids") -> DataFrame:
    """`encoded` with `decoded`, binary: the bytes that the ids stand for; NULL ids decode to no bytes."""

    @F.arrow_udf("struct<decoded: binary>")
    def decoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        of = merges(path).bytes_of.__getitem__
        for batch in batches:
            made = decoded_batch((x.as_py() or b"" for x in batch), of)
            yield pa.StructArray.from_arrays([pa.array(made, pa.binary())], ["decoded"])

    return with_struct(encoded, decoded.asNondeterministic()(F.col(f"`{ids}`")), "decoded")


def round_trip(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """`docs` with `token_ids` as of `encode` and `decoded` as of `decode`, by one worker for each task instead of two."""

    @F.arrow_udf("struct<token_ids: binary, decoded: binary>")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table, find, known = merges(path), regex.compile(pattern).findall, {}
        for batch in batches:
            ids = encoded_batch(batch, table, find, known)
            back = decoded_batch(ids, table.bytes_of.__getitem__)
            yield pa.StructArray.from_arrays([pa.array(ids, pa.binary()), pa.array(back, pa.binary())], ["token_ids", "decoded"])

    return with_struct(docs, both.asNondeterministic()(F.col(f"`{text}`")), "token_ids", "decoded")
