"""Quality rules by tokeniser fertility.

Two public vocabularies look at every word of a text: a piece vocabulary with byte fallback and a byte-level one. Text in a
language that the vocabularies know needs few pieces for many characters, few fallback bytes and a varied set of pieces;
symbol junk, broken encodings and endless repetition don't. Bands for these measures, by script, reject what lies outside.
The measures: characters per piece and per byte-level token, the share of pieces that are fallback bytes, and the entropy of
the pieces of a text in bits, as a share of the most that so many pieces, or 2,048 of them, can have.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsmill.llm.tables import pieces, spans_of, with_struct

LEAST_WORDS, WINDOW, MOST_REPEATED = 20, 8, 30  # words; words; percent of the words
SYMBOLS = "#*$%&|<>"
MOST_VARIED = 2048  # pieces from which the greatest entropy grows no more: a long text uses its words again
KNOWN_WORDS = 500_000

# Least and most characters per piece, least and most characters per byte-level token, most fallback share, least entropy.
# Fixed by script: alphabets share pieces over several characters, other scripts come in single characters or bytes.
BANDS = {
    "latin": (1.4, 8.0, 1.2, 8.0, 0.10, 0.35),
    "cyrillic": (1.2, 8.0, 0.4, 6.0, 0.15, 0.35),
    "greek": (0.6, 4.0, 0.3, 3.0, 0.30, 0.35),
    "han": (0.4, 3.0, 0.25, 2.5, 0.60, 0.35),
    "other": (0.2, 6.0, 0.15, 6.0, 0.95, 0.30),
    "none": (1.4, 8.0, 1.2, 8.0, 0.10, 0.35),
}
SCRIPTS = {
    "latin": r"\p{Latin}", "cyrillic": r"\p{Cyrillic}", "greek": r"\p{Greek}",
    "han": r"[\p{Han}\p{Hiragana}\p{Katakana}]",
}
FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_pieces", "n_fallback", "n_byte_tokens",
          "piece_entropy", "script")
BLANKS = " \t\n\x0b\x0c\r"
NOT_ASCII_LETTER = re.compile(r"[\x00-\x40\x5b-\x60\x7b-\x7f]+")


class Vocabularies:
    """A piece model with byte fallback and a byte-level rank file; each word is encoded once while it is remembered."""

    def __init__(self, piece_path: str, rank_path: str, pattern: str):
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        with open(rank_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.levels = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.size = self.pieces.get_piece_size()
        self.is_byte = np.array([self.pieces.is_byte(i) for i in range(self.size)])
        self.known: dict[bytes, bytes] = {}

    def look_up(self, words: list[bytes]) -> list[bytes]:
        """For each word 32-bit numbers: how many byte-level tokens it has, then its pieces."""
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > KNOWN_WORDS:
            self.known.clear()
            new = words
        texts = [w.decode() for w in new]
        for word, text, ids in zip(new, texts, self.pieces.encode(texts, num_threads=1) if texts else [], strict=True):
            count = len(self.levels.encode_ordinary(" " + text))
            self.known[word] = np.array([count, *ids], np.uint32).tobytes()
        return [self.known[w] for w in words]


@cache
def vocabularies(piece_path: str, rank_path: str, pattern: str) -> Vocabularies:
    return Vocabularies(piece_path, rank_path, pattern)


def repeated_words(codes: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
    """Words of each document that lie in a window found twice or more in it.

    A hash of the windows names those that may be repeated; only these are compared word by word.
    """
    n = len(codes) - WINDOW + 1
    if n < 2:
        return np.zeros(n_docs, np.int64)
    power = np.uint64(0x9E3779B97F4A7C15)
    hashes = np.zeros(n, np.uint64)
    for k in range(WINDOW):
        hashes = hashes * power + codes[k:k + n].astype(np.uint64) + np.uint64(1)
    hashes ^= doc[:n].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    starts = np.flatnonzero(doc[:n] == doc[WINDOW - 1:])
    own = hashes[starts]
    order = np.sort(own)
    twice = np.unique(order[1:][order[1:] == order[:-1]])
    if not len(twice):
        return np.zeros(n_docs, np.int64)
    starts = starts[np.isin(own, twice)]
    rows = np.stack([doc[starts], *(codes[starts + k] for k in range(WINDOW))], 1)
    _, which, counts = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
    starts = starts[counts[which.ravel()] > 1]
    edge = np.zeros(len(codes) + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + WINDOW, -1)
    return np.bincount(doc, np.cumsum(edge[:-1]) > 0, n_docs).astype(np.int64)


def entropies(tokens: np.ndarray, doc: np.ndarray, n_docs: int, size: int) -> np.ndarray:
    """Entropy of the tokens of each document in bits."""
    key = np.sort(doc * size + tokens)
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    counts = np.diff(np.r_[first, len(key)])
    of = key[first] // size
    total = np.bincount(of, counts, n_docs)
    logs = np.bincount(of, counts * np.log2(np.maximum(counts, 1)), n_docs)
    return np.where(total > 0, np.log2(np.maximum(total, 1)) - logs / np.maximum(total, 1), 0.0)


def script_of(text: str, patterns: dict) -> str:
    """The script with most letters; ASCII letters count as Latin, and a text without letters has none."""
    counts = dict.fromkeys(patterns, 0)
    rest = text if not text.isascii() else ""
    if not rest:
        counts["latin"] = len(NOT_ASCII_LETTER.sub("", text))
    else:
        rest = re.sub(r"[\x00-\x40\x5b-\x60\x7b-\x7f]+", "", text)
        ascii_letters = len(re.sub(r"[^\x00-\x7f]+", "", rest))
        beyond = re.sub(r"[\x00-\x7f]+", "", rest)
        counts = {name: len(found.findall(beyond)) for name, found in patterns.items()}
        counts["latin"] += ascii_letters
        counts["other"] = max(0, sum(c.isalpha() for c in beyond) - sum(counts.values()) + ascii_letters)
    most = max(counts, key=counts.get)
    return most if counts[most] else "none"


def measure(texts: list[str], vocabulary: Vocabularies, patterns: dict) -> list[list]:
    """The fields of FIELDS for each text."""
    words, lengths = [], []
    for text in texts:
        own = text.encode().split()
        words += own
        lengths.append(len(own))
    n, sizes = len(texts), np.array(lengths, np.int64)
    doc = np.repeat(np.arange(n), sizes)
    coded = pa.array(words, pa.binary()).dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    ids = vocabulary.look_up(coded.dictionary.to_pylist())
    flat = np.frombuffer(b"".join(ids), np.uint32).astype(np.int64)
    length = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
    begin = np.cumsum(length) - length
    many = length[codes] - 1
    tokens = flat[spans_of(begin[codes] + 1, many)]
    token_doc = np.repeat(doc, many)
    n_pieces = np.bincount(token_doc, minlength=n)
    fallback = np.bincount(token_doc, vocabulary.is_byte[tokens] if len(tokens) else None, n).astype(np.int64)
    levels = np.bincount(doc, flat[begin[codes]] if len(codes) else None, n).astype(np.int64)
    repeated, bits = repeated_words(codes, doc, n), entropies(tokens, token_doc, n, vocabulary.size)
    rows = []
    for i, text in enumerate(texts):
        lines = [x for x in text.split("\n") if x.strip(BLANKS)]
        rows.append([
            lengths[i], len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)),
            int(repeated[i]), int(n_pieces[i]), int(fallback[i]), int(levels[i]), float(bits[i]), script_of(text, patterns)])
    return rows


SCHEMA = pa.schema([*((name, pa.int64()) for name in FIELDS[:8]), ("piece_entropy", pa.float64()), ("script", pa.string())])


def measures(docs: DataFrame, piece_path: str, rank_path: str, pattern: str, text: str = "text") -> DataFrame:
    """`docs` with the measures named in FIELDS, over whole texts; columns of these names are replaced.

    A NULL text counts as an empty one: all counts 0, entropy 0, script `none`.
    """

    @F.arrow_udf("struct<" + ", ".join(f"{x.name}: {'string' if x.name == 'script' else 'double' if x.type == pa.float64() else 'long'}" for x in SCHEMA) + ">")
    def measured(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        vocabulary = vocabularies(piece_path, rank_path, pattern)
        patterns = {name: regex.compile(x) for name, x in SCRIPTS.items()}
        for batch in batches:
            rows = [row for run in pieces([t or "" for t in batch.to_pylist()]) for row in measure(run, vocabulary, patterns)]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * len(SCHEMA)
            yield pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, SCHEMA, strict=True)], fields=list(SCHEMA))

    return with_struct(docs, measured.asNondeterministic()(F.col(f"`{text}`")), *FIELDS)


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def fertile(bands: dict | None = None) -> Column:
    """True where the measures lie within the bands of the script; edges belong to the band."""
    pieces_ = F.greatest(F.col("n_pieces"), F.lit(1))
    per_piece = F.col("word_chars") / pieces_
    per_token = F.col("word_chars") / F.greatest(F.col("n_byte_tokens"), F.lit(1))
    share = F.col("n_fallback") / pieces_
    spread = F.when(pieces_ > 1, F.col("piece_entropy") / F.log2(F.least(pieces_, F.lit(MOST_VARIED)))).otherwise(1.0)
    verdict = F.lit(False)
    for name, (low, high, low_token, high_token, most, least) in (bands or BANDS).items():
        verdict = F.when(F.col("script") == name, per_piece.between(low, high) & per_token.between(low_token, high_token) & (share <= most) & (spread >= least)).otherwise(verdict)
    return verdict


def rate(docs: DataFrame, piece_path: str, rank_path: str, pattern: str, text: str = "text", bands: dict | None = None) -> DataFrame:
    """`docs` with the measures, `base_failed` and `kept`."""
    measured = measures(docs, piece_path, rank_path, pattern, text)
    return measured.withColumns({"base_failed": base_failed(), "kept": ~base_failed() & fertile(bands)})
