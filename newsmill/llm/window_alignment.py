"""Alignment of two tokenisers' ids over the same texts, and what each id of the one mostly stands beside in the other.

Both tokenisers run over the whole text. Where both have a token that starts with a blank at the same byte, the tokens before
end together; these anchors cut a text into windows, mostly words. A window is a tuple of ids of each side, and its
alignment depends on nothing else, so the equal windows of a task's packet of texts are found by their tuples and aligned
once. Inside a window the shared ends cut the tokens into groups, and all pairs of a group are linked.

Counts of pairs go through packets: a task handles a few megabytes of text at a time and writes the packet's distinct pairs
once, with the documents pointing into them. Pair counts are summed over packets, and each packet gets the counts of its own
pairs back, so no table of pairs is held in a task, and a pair that all texts share has one row for each packet.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from newsmill.llm.tables import pieces, spans_of, stored

PACKET_BYTES = 4_000_000  # text of a packet; a longer text is a packet of its own
LONG_GROUP = 4_096  # links of a group whose ids are counted first
LONG_WINDOW = 64  # ids of a window; longer ones are few
MEASURES = ("n_a", "n_b", "n_groups", "n_links")
BLANK = "▁"


class Side(NamedTuple):
    encode: object  # texts to lists of ids
    entries: list[bytes]
    sizes: np.ndarray
    marked: np.ndarray  # whether the entry starts with a blank


def side(encode, entries: list[bytes]) -> Side:
    return Side(encode, entries, np.array([len(e) for e in entries], np.int64), np.array([e[:1] == b" " for e in entries]))


def byte_letters() -> dict[str, int]:
    """The printable letter of each byte in byte-level vocabularies, inverted: printable bytes are themselves, the others follow 255."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@cache
def byte_level(path: str, pattern: str) -> Side:
    """The byte-level BPE model of a tokenizer file; each text gets a blank in front, special tokens are plain text.

    If the file says no more than a split by `pattern` and merges in the order of their ids, the faster library runs them;
    otherwise the one that the file is made for.
    """
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    letters = byte_letters()
    special = {t["id"] for t in spec["added_tokens"]}
    vocab = {i: w for w, i in spec["model"]["vocab"].items()}
    entries = [bytes(letters[c] for c in vocab[i]) if i in vocab and i not in special else b"" for i in range(max([*vocab, *special]) + 1)]
    splitter = spec["pre_tokenizer"]
    merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in spec["model"]["merges"]]
    if (spec["normalizer"] is None and splitter["type"] == "ByteLevel" and splitter["use_regex"] and not splitter["add_prefix_space"]
            and [spec["model"]["vocab"][m] for m in merged] == list(range(256, 256 + len(merged)))):
        ranks = {e: i for i, e in enumerate(entries) if i not in special}
        model = tiktoken.Encoding("byte-level", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        return side(lambda texts: [model.encode_ordinary(" " + t) for t in texts], entries)
    own = Tokenizer.from_file(path)
    own.encode_special_tokens = True
    return side(lambda texts: [e.ids for e in own.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)], entries)


@cache
def piece_level(path: str) -> Side:
    """The pieces of a model file, which puts the blank in front itself."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)

    def entry(i: int) -> bytes:
        piece = model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace(BLANK, " ").encode()

    return side(lambda texts: model.encode(texts, num_threads=1), [entry(i) for i in range(model.get_piece_size())])


class Windows(NamedTuple):
    """Alignments of distinct windows, the pairs of one after those of the other."""
    texts: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    pairs: np.ndarray  # distinct pairs of all windows, sorted
    n_pairs: np.ndarray
    places: np.ndarray  # of a window's pairs among `pairs`
    times: np.ndarray


class Aligner:
    def __init__(self, a: Side, b: Side):
        self.a, self.b, self.width = a, b, len(b.entries)
        self.names = np.array([str(i) for i in range(max(len(a.entries), len(b.entries)))], object)

    def __call__(self, ids_a: np.ndarray, n_a: np.ndarray, ids_b: np.ndarray, n_b: np.ndarray) -> Windows:
        """All windows at once: both sides of a window have equally many bytes, so ends of different windows never meet."""
        windows = len(n_a)
        ends_a, ends_b = np.cumsum(self.a.sizes[ids_a]), np.cumsum(self.b.sizes[ids_b])
        shared = np.intersect1d(ends_a, ends_b, assume_unique=True)
        to_a, to_b = np.searchsorted(ends_a, shared, "right"), np.searchsorted(ends_b, shared, "right")
        size_a, size_b = np.diff(to_a, prepend=0), np.diff(to_b, prepend=0)
        of = np.searchsorted(ends_a[np.cumsum(n_a) - 1], shared) if windows else np.zeros(0, np.int64)
        at_window, pair, times = self.linked(ids_a, ids_b, to_a - size_a, to_b - size_b, size_a, size_b, of)
        pairs, place = np.unique(pair, return_inverse=True)
        code, inverse = np.unique(at_window * max(len(pairs), 1) + place.ravel(), return_inverse=True)
        at_window, places = np.divmod(code, max(len(pairs), 1))
        return Windows(self.written(ids_a, ids_b, to_a, to_b, size_a, size_b, of), np.bincount(of, minlength=windows), totals(size_a * size_b, of, windows),
                       pairs, np.bincount(at_window, minlength=windows), places, totals(times, inverse.ravel(), len(code)))

    def linked(self, ids_a, ids_b, from_a, from_b, size_a, size_b, of) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, pair, times) of all groups; a long group's ids are counted before they are paired."""
        links = size_a * size_b
        short = np.flatnonzero(links <= LONG_GROUP)
        each = np.repeat(short, links[short])
        step = spans_of(np.zeros(len(short), np.int64), links[short])
        found = [(of[each], ids_a[from_a[each] + step // size_b[each]] * self.width + ids_b[from_b[each] + step % size_b[each]], np.ones(len(each), np.int64))]
        for g in np.flatnonzero(links > LONG_GROUP):
            x, n_x = np.unique(ids_a[from_a[g]:from_a[g] + size_a[g]], return_counts=True)
            y, n_y = np.unique(ids_b[from_b[g]:from_b[g] + size_b[g]], return_counts=True)
            found.append((np.full(len(x) * len(y), of[g]), (x[:, None] * self.width + y).ravel(), (n_x[:, None] * n_y).ravel()))
        return tuple(map(np.concatenate, zip(*found, strict=True)))

    def written(self, ids_a, ids_b, to_a, to_b, size_a, size_b, of) -> np.ndarray:
        """Each window as `a1,a2|b1;a3|b2,b3`."""
        ids, after = np.zeros(len(ids_a) + len(ids_b), np.int64), np.zeros(len(ids_a) + len(ids_b), np.int8)
        ids[np.arange(len(ids_a)) + np.repeat(to_b - size_b, size_a)] = ids_a  # a group's first side follows the groups before
        ids[np.arange(len(ids_b)) + np.repeat(to_a, size_b)] = ids_b
        after[to_a + to_b - size_b - 1] = 1
        after[to_a + to_b - 1] = np.where(np.diff(of, append=-1) != 0, 3, 2)
        marks = np.array([",", "|", ";", "\n"], object)[after]
        return np.array("".join(chain.from_iterable(zip(self.names[ids], marks, strict=True))).split("\n")[:-1], object)


@cache
def aligner(path_a: str, pattern: str, path_b: str) -> Aligner:
    return Aligner(byte_level(path_a, pattern), piece_level(path_b))


def encoded(texts: list[str], a: Side, b: Side) -> tuple[list, list]:
    """Ids of both sides; none for a text that is empty or that one side does not give back byte by byte."""
    none = np.zeros(0, np.int64)
    found_a, found_b = [none] * len(texts), [none] * len(texts)
    some = [i for i, t in enumerate(texts) if t]
    asked = [texts[i] for i in some]
    for i, text, x, y in zip(some, asked, a.encode(asked), b.encode(asked), strict=True):
        whole = b" " + text.encode()
        if b"".join(map(a.entries.__getitem__, x)) == whole and b"".join(map(b.entries.__getitem__, y)) == whole:
            found_a[i], found_b[i] = np.array(x, np.int64), np.array(y, np.int64)
    return found_a, found_b


def totals(values: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n, np.int64)
    np.add.at(out, of, values)
    return out


def distinct_windows(ids_a, ids_b, n_a, n_b) -> tuple[tuple, np.ndarray]:
    """Ids and sizes of both sides of the distinct windows, and which of these each window is."""
    first_a, first_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
    which, found, number = np.zeros(len(n_a), np.int64), [], 0
    order = np.lexsort([n_b, n_a])
    edges = np.flatnonzero((np.diff(n_a[order]) != 0) | (np.diff(n_b[order]) != 0)) + 1
    for rows in np.split(order, edges) if len(order) else []:  # windows of equal sizes
        x, y = int(n_a[rows[0]]), int(n_b[rows[0]])
        table = np.hstack([ids_a[first_a[rows][:, None] + np.arange(x)], ids_b[first_b[rows][:, None] + np.arange(y)]])
        if x + y <= LONG_WINDOW:
            code, reach = table[:, 0], int(table[:, 0].max()) + 1
            for column in table.T[1:]:
                top = int(column.max()) + 1
                if reach * top >= 1 << 62:  # ranks of the codes so far are smaller than the rows
                    code, reach = np.unique(code, return_inverse=True)[1].ravel(), len(rows)
                code, reach = code * top + column, reach * top
        else:
            seen: dict[bytes, int] = {}
            code = np.array([seen.setdefault(row.tobytes(), len(seen)) for row in table])
        _, at, inverse = np.unique(code, return_index=True, return_inverse=True)
        which[rows] = inverse.ravel() + number
        number += len(at)
        found.append((table[at, :x].ravel(), np.full(len(at), x), table[at, x:].ravel(), np.full(len(at), y)))
    none = (np.zeros(0, np.int64),) * 4
    return tuple(map(np.concatenate, zip(none, *found, strict=True))), which


def packed(numbers: np.ndarray) -> bytes:
    """Small numbers as bytes of equal weight side by side, which compress well."""
    return np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


class Packet(NamedTuple):
    measures: list[np.ndarray]
    digests: list[str]
    pairs: np.ndarray
    holds: np.ndarray  # documents of the packet that hold the pair
    counts: np.ndarray  # distinct pairs of each document
    at: np.ndarray  # their places among the packet's pairs, one document after the other
    times: np.ndarray


def packet(texts: list[str], align: Aligner) -> Packet:
    docs = len(texts)
    found_a, found_b = encoded(texts, align.a, align.b)
    size_a, size_b = np.array([len(x) for x in found_a]), np.array([len(x) for x in found_b])
    ids_a, ids_b = np.concatenate([*found_a, np.zeros(0, np.int64)]), np.concatenate([*found_b, np.zeros(0, np.int64)])
    # Positions of all texts in one line of bytes: equal ends of different texts never meet.
    starts_a, starts_b = (np.cumsum(s) - s for s in (align.a.sizes[ids_a], align.b.sizes[ids_b]))
    anchors = np.intersect1d(starts_a[align.a.marked[ids_a]], starts_b[align.b.marked[ids_b]], assume_unique=True)
    some = size_a > 0
    heads = starts_a[(np.cumsum(size_a) - size_a)[some]]
    cuts = np.union1d(anchors, heads)
    of_a, of_b = np.searchsorted(cuts, starts_a, "right") - 1, np.searchsorted(cuts, starts_b, "right") - 1
    doc_of = np.flatnonzero(some)[np.searchsorted(heads, cuts, "right") - 1] if len(cuts) else np.zeros(0, np.int64)
    distinct, which = distinct_windows(ids_a, ids_b, np.bincount(of_a, minlength=len(cuts)), np.bincount(of_b, minlength=len(cuts)))
    windows = align(*distinct)
    n = max(len(windows.n_pairs), 1)
    ends = np.cumsum(np.bincount(doc_of, minlength=docs))
    digests = [hashlib.sha256(";".join(windows.texts[which[e - k:e]]).encode()).hexdigest() if k else "" for k, e in zip(np.diff(ends, prepend=0), ends, strict=True)]

    # Distinct windows of each document with their copies, then distinct pairs of each document.
    code, copies = np.unique(doc_of * n + which, return_counts=True)
    doc, window = np.divmod(code, n)
    degree, n = windows.n_pairs[window], max(len(windows.pairs), 1)
    flat = spans_of((np.cumsum(windows.n_pairs) - windows.n_pairs)[window], degree)
    both, inverse = np.unique(np.repeat(doc, degree) * n + windows.places[flat], return_inverse=True)
    summed = totals(windows.times[flat] * np.repeat(copies, degree), inverse.ravel(), len(both))
    doc, at = np.divmod(both, n)
    return Packet([size_a, size_b, totals(windows.n_groups[which], doc_of, docs), totals(windows.n_links[which], doc_of, docs)], digests, windows.pairs,
                  np.bincount(at, minlength=len(windows.pairs)), np.bincount(doc, minlength=docs), at, summed)


def encode_packets(docs: DataFrame, path_a: str, pattern: str, path_b: str, text: str, keep: list[Column]) -> DataFrame:
    """One row for each document; the first row of each packet carries the packet's pairs and where its documents hold them."""
    rows = docs.select(F.col(f"`{text}`").cast("string").alias("_text"), F.struct(F.lit(0).alias("_"), *keep).alias("_row"))
    fields = {f"_{m}": pa.int64() for m in MEASURES} | {
        "_digest": pa.string(), "_packet": pa.int64(), "_at": pa.int32(), "_pairs": pa.list_(pa.int64()), "_holds": pa.list_(pa.int32()),
        "_counts": pa.list_(pa.int32()), "_places": pa.binary(), "_times": pa.binary()}

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align, number = aligner(path_a, pattern, path_b), TaskContext.get().partitionId() << 33
        for batch in batches:
            begin = 0
            for run in pieces([t or "" for t in batch.column(0).to_pylist()], PACKET_BYTES):
                made, n = packet(run, align), len(run)
                steps = np.diff(made.at, prepend=0)
                first = np.cumsum(made.counts) - made.counts
                heads = first[made.counts > 0]
                steps[heads] = made.at[heads]  # places start anew with each document
                only = lambda x: [x] + [None] * (n - 1)
                columns = [*made.measures, made.digests, np.full(n, number), np.arange(n), only(made.pairs), only(made.holds), only(made.counts),
                           only(packed(steps)), only(packed(made.times))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1).slice(begin, n), *(pa.array(c, k) for c, k in zip(columns, fields.values(), strict=True))], ["_row", *fields])
                begin, number = begin + n, number + 1

    kinds = {pa.int64(): "long", pa.int32(): "int", pa.string(): "string", pa.binary(): "binary", pa.list_(pa.int64()): "array<long>", pa.list_(pa.int32()): "array<int>"}
    return rows.mapInArrow(encode, f"_row {rows.schema['_row'].dataType.simpleString()}, " + ", ".join(f"{n} {kinds[k]}" for n, k in fields.items()))


def pair_counts(packets: DataFrame, width: int) -> DataFrame:
    """(pair, docs, best): documents that hold the pair linked, and whether no other pair of its first id has more."""
    each = packets.select(F.explode(F.arrays_zip(F.col("_pairs").alias("pair"), F.col("_holds").alias("docs"))).alias("p"))
    counts = each.groupBy("p.pair").agg(F.sum("p.docs").alias("docs")).withColumn("a", F.expr(f"pair div {width}"))
    most = counts.groupBy("a").agg(F.max("docs").alias("most"))
    return counts.join(most, "a").select("pair", "docs", (F.col("docs") == F.col("most")).alias("best"))


def with_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums over the links of each document, from the counts of the packet's pairs."""
    for batch in batches:
        for row in range(batch.num_rows):
            number, counts, places, times, known = (batch.column(i)[row] for i in range(5))
            counts, places, times = np.asarray(counts.values, np.int64), unpacked(places.as_py()), unpacked(times.as_py())
            known = known.values.flatten() if len(known) else [pa.array([], pa.int32()), pa.array([], pa.int64()), pa.array([], pa.bool_())]
            docs, best = np.zeros(len(known[0]), np.int64), np.zeros(len(known[0]), np.int64)
            docs[np.asarray(known[0])], best[np.asarray(known[0])] = np.asarray(known[1]), np.asarray(known[2].cast(pa.int64()))
            of = np.repeat(np.arange(len(counts)), counts)
            first = np.cumsum(counts) - counts
            # places are steps within a document: sum them up and take off what came before the document
            run = np.cumsum(places)
            at = run - np.repeat(np.concatenate([[0], run])[first], counts) if len(run) else run
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(counts), number.as_py())), pa.array(np.arange(len(counts)), pa.int32()),
                 pa.array(totals(times * best[at], of, len(counts))), pa.array(totals(times * docs[at], of, len(counts)))],
                ["_packet", "_at", "n_best", "count_sum"])


def align(docs: DataFrame, path_a: str, pattern: str, path_b: str, text: str = "text", keep: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """The documents with their measures, and the table of linked pairs (a, b, docs, best).

    Of `docs` the columns `keep` stay (all but the text unless given); a column with the name of a measure is replaced.
    Measures: n_a, n_b (tokens), n_groups, n_links, n_best (links whose pair no other pair of its first id outnumbers),
    count_sum (documents of each link's pair, summed) and groups_sha256. A text that is NULL, empty, or not given back byte
    by byte by both tokenisers has zeros and an empty digest. Repeated rows are documents of their own; an empty table gives
    empty tables. A group of tokens is aligned whole, and all its pairs count, however long it is.
    """
    outputs = {*MEASURES, "n_best", "count_sum", "groups_sha256"}
    names = [c for c in (docs.columns if keep is None else keep) if c != text and c.lower() not in outputs]
    width = piece_level(path_b).sizes.size
    whole = stored(encode_packets(docs, path_a, pattern, path_b, text, [F.col(f"`{c}`") for c in names]), "aligned-packets")
    packets = whole.filter("_at = 0").select("_packet", "_pairs", "_holds", "_counts", "_places", "_times")
    pairs = stored(pair_counts(packets, width), "pair-counts")
    asked = packets.select("_packet", F.posexplode("_pairs").alias("_i", "pair")).join(pairs, "pair")
    known = asked.groupBy("_packet").agg(F.collect_list(F.struct(F.col("_i").cast("int"), "docs", "best")).alias("known"))
    empty = F.array().cast(known.schema["known"].dataType)
    sums = packets.join(known, "_packet", "left").select("_packet", "_counts", "_places", "_times", F.coalesce("known", empty)).mapInArrow(
        with_counts, "_packet long, _at int, n_best long, count_sum long")
    joined = whole.join(sums, ["_packet", "_at"])
    measured = joined.select(*(F.col(f"_row.`{c}`").alias(c) for c in names), *(F.col(f"_{m}").alias(m) for m in MEASURES), "n_best", "count_sum", F.col("_digest").alias("groups_sha256"))
    linked = pairs.select(F.expr(f"cast(pair div {width} as int)").alias("a"), F.expr(f"cast(pair % {width} as int)").alias("b"), "docs", "best")
    return measured, linked
