"""Token counts by a unigram vocabulary without making the tokens.

An Aho-Corasick automaton over the vocabulary names every match in a word. Going through the match ends from left to
right, each position carries the best score that reaches it and the number of pieces on that path. Rules, as the public
`tokenizers` library has them for a unigram model behind its Metaspace splitter: words start at blanks, which become the
word mark; at equal score the path found first, with the longest last piece, stays; where no piece of one character
starts, an unknown character costs the least score less 10; an unknown character counts one token for each UTF-8 byte.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import cache

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsmill.llm.tables import pieces, with_struct

MARK = "▁"
UNKNOWN_PENALTY = 10.0
KNOWN_WORDS = 800_000


def vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a model file, in the order of their ids."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class Counts:
    def __init__(self, pieces: list[tuple[str, float]]):
        self.trie = ahocorasick.Automaton()
        for piece, score in dict(pieces).items():
            self.trie.add_word(piece, (len(piece), score))
        self.trie.make_automaton()
        self.unknown = min(score for _, score in pieces) - UNKNOWN_PENALTY
        self.single = {piece for piece, _ in pieces if len(piece) == 1}

    def __call__(self, word: str) -> tuple[int, int]:
        """Tokens of a word, and how many of them are bytes of unknown characters.

        The matches that end at a position come with the longest, hence the leftmost start, first.
        """
        n = len(word)
        score, count = [0.0] + [-math.inf] * n, [0] * (n + 1)
        unknown = [] if self.single.issuperset(word) else [i for i, c in enumerate(word) if c not in self.single]
        if unknown:
            return self.with_unknown(word, unknown)
        for last, (length, worth) in self.trie.iter(word):
            start = last + 1 - length
            whole = score[start] + worth
            if whole > score[last + 1]:
                score[last + 1], count[last + 1] = whole, count[start] + 1
        return count[n], 0

    def with_unknown(self, word: str, unknown: list[int]) -> tuple[int, int]:
        n = len(word)
        score, count, strange = [0.0] + [-math.inf] * n, [0] * (n + 1), [0] * (n + 1)
        ends: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
        for last, found in self.trie.iter(word):
            ends[last + 1].append(found)
        odd = set(unknown)
        for end in range(1, n + 1):
            steps = [(length, worth, 1, 0) for length, worth in ends[end]]
            if end - 1 in odd:
                cost = len(word[end - 1].encode())
                steps.append((1, self.unknown, cost, cost))
            for length, worth, cost, bytes_ in steps:
                start = end - length
                if score[start] + worth > score[end]:
                    score[end] = score[start] + worth
                    count[end], strange[end] = count[start] + cost, strange[start] + bytes_
        return count[n], strange[n]


@cache
def counter(path: str) -> Counts:
    return Counts(vocabulary(path))


def words_of(text: str) -> Counter:
    """Words with their mark; a text that does not start with a blank gets a mark, as the splitter has it."""
    if not text:
        return Counter()
    marked = text.replace(" ", MARK)
    head, *rest = marked.split(MARK)
    found = Counter(rest)
    if head:
        found[head] += 1
    return found


def token_counts(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """`docs` with `n_tokens` and `n_byte_tokens`, long.

    A NULL or empty text has no tokens. Equal words of a text are counted once and multiplied; a worker remembers words.
    Columns of these names are replaced.
    """

    @F.arrow_udf("struct<n_tokens: long, n_byte_tokens: long>")
    def counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        count, known = counter(path), {}
        for batch in batches:
            totals, bytes_ = [], []
            for run in pieces([t or "" for t in batch.to_pylist()]):
                if len(known) > KNOWN_WORDS:
                    known.clear()
                for one in map(words_of, run):
                    total = odd = 0
                    for word, times in one.items():
                        found = known.get(word)
                        if found is None:
                            found = known[word] = count(MARK + word)
                        total += times * found[0]
                        odd += times * found[1]
                    totals.append(total)
                    bytes_.append(odd)
            yield pa.StructArray.from_arrays([pa.array(totals, pa.int64()), pa.array(bytes_, pa.int64())], ["n_tokens", "n_byte_tokens"])

    return with_struct(docs, counted.asNondeterministic()(F.col(f"`{text}`")), "n_tokens", "n_byte_tokens")
