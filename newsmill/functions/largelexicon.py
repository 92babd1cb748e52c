"""Scoring against lexicons of thousands of patterns.

With :func:`newsmill.functions.scoring.score_text` each pattern is an expression of the plan, which is right for dozens and too
large for thousands.  Here the plan holds one Arrow function, whatever the lexicon.  Patterns that are words joined by `\\s+`,
with or without `\\b` at their ends, are the keys of one automaton: it runs over a text once and names every place of each of
them, so that the cost of a text grows with its length and its hits and not with the lexicon.  For the other patterns a second
automaton over one word that each must contain names the few whose regex is then tried; those without such a word are tried on
every text.  Hits, scores and labels are those of `score_text`.
"""

from __future__ import annotations

import functools
import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsmill.functions.lexicon import Lexicon
from newsmill.functions.patterns import FOLDED_TWINS, required_words
from newsmill.functions.scoring import HITS_TYPE, relevance, score_of

_TWINS = str.maketrans({twin: letter for letter, twin in FOLDED_TWINS.items()})

# A word boundary in marked texts. Where a text has the sign itself, another sign of no word stands for it.
_MARK = "\0"
_FOLDED = [(twin, letter) for letter, twin in FOLDED_TWINS.items()] + [(_MARK, "\1")]
_RUN = re.compile(r"(\\b)?([A-Za-z0-9áéíóúüñ'/-]+(?:\\s\+[A-Za-z0-9áéíóúüñ'/-]+)*)(\\b)?")
_SPACES, _BOUNDARY = re.compile(r"\s+"), re.compile(r"\b")

PIECE_CHARS = 1_000_000  # text whose hits are held at a time


class Chooser:
    """Patterns that a lower-cased text may match, in their order."""

    def __init__(self, patterns: tuple[str, ...]) -> None:
        self.always: list[int] = []
        self.automaton, by_word = ahocorasick.Automaton(), {}
        for i, pattern in enumerate(patterns):
            words = required_words(pattern)
            if words:
                by_word.setdefault(words[0].translate(_TWINS), []).append(i)
            else:
                self.always.append(i)
        for word, which in by_word.items():
            self.automaton.add_word(word, (word, which))
        if by_word:
            self.automaton.make_automaton()
        self.empty = not by_word

    def __call__(self, text: str) -> list[int]:
        if self.empty:
            return self.always
        words = dict(found for _, found in self.automaton.iter(text.translate(_TWINS)))
        return sorted([*self.always, *(i for which in words.values() for i in which)])


class Runs:
    """Places of the patterns that are words joined by `\\s+`, from one walk over a lower-cased text.

    The text is walked with white space as single blanks and a mark at each word boundary, so that `\\b` is a sign of the key.
    """

    def __init__(self, patterns: list[tuple[int, str]]) -> None:
        self.automaton, by_key = ahocorasick.Automaton(), {}
        self.others: list[tuple[int, str]] = []
        for i, pattern in patterns:
            run = _RUN.fullmatch(pattern)
            if run is None:
                self.others.append((i, pattern))
                continue
            words = run[2].replace(r"\s+", " ").lower()
            key = _BOUNDARY.sub(_MARK, words).strip(_MARK)
            left, right = bool(run[1]), bool(run[3])
            by_key.setdefault((_MARK * left + key + _MARK * right, left, right), (words, []))[1].append(i)
        # One entry for each key: a pattern and its neighbours of the same words and boundaries match alike.
        for (key, left, right), (words, which) in by_key.items():
            self.automaton.add_word(key, (len(key) - 1 - left, 1 - right, words, which))
        self.empty = not by_key
        if by_key:
            self.automaton.make_automaton()

    def __call__(self, text: str) -> dict[int, list[str]]:
        """What each pattern matches, from left to right without overlaps; a pattern that matches nothing is left out."""
        if self.empty:
            return {}
        folded = text
        for sign, plain in _FOLDED:  # far faster than one translation, as most texts have none
            folded = folded.replace(sign, plain)
        blank = _SPACES.sub(" ", folded)
        parts = _BOUNDARY.split(blank)
        # What a key matched is the key itself, but for folded signs and for white space other than a blank.
        place, as_written = None if blank == text else _places(text, blank, parts), folded == text
        found: dict[int, list[str]] = {}
        ends: dict[int, int] = {}
        for last, (back, after, words, which) in self.automaton.iter(_MARK.join(parts)):
            first, end = last - back, last + after
            if first < ends.get(which[0], 0):
                continue
            ends[which[0]] = end
            keyword = words if place is None or (as_written and " " not in words) else text[place(first):place(end - 1) + 1]
            for i in which:
                found.setdefault(i, []).append(keyword)
        return found


def _places(text: str, blank: str, parts: list[str]) -> Callable[[int], int]:
    """From a place in the marked text that holds no mark to its place in the text."""
    marks = [end + n for n, end in enumerate(accumulate(map(len, parts[:-1])))]
    runs, dropped, total = [], [0], 0
    if len(blank) < len(text):
        for run in re.finditer(r"\s\s+", text):
            runs.append(run.start() - total)  # where its blank stands
            total += len(run.group()) - 1
            dropped.append(total)

    def place(marked: int) -> int:
        plain = marked - bisect_right(marks, marked)
        return plain + dropped[bisect_left(runs, plain)]

    return place


class Matcher:
    """The hits of a text; regexes are compiled when a text first asks for them."""

    def __init__(self, lexicon: Lexicon) -> None:
        self.rows = [(c.name, c.weight, p) for c in lexicon.categories for p in c.patterns]
        self.exclusions = lexicon.exclusions
        self.runs = Runs([(i, p) for i, (_, _, p) in enumerate(self.rows)])
        self.numbers = [i for i, _ in self.runs.others]
        self.chosen = Chooser(tuple(p for _, p in self.runs.others))
        self.excluding = Runs(list(enumerate(lexicon.exclusions)))
        self.excluded = Chooser(tuple(p for _, p in self.excluding.others))
        self.regex: Callable = functools.cache(lambda pattern: re.compile(pattern, re.IGNORECASE))
        self.names = pa.array([name for name, _, _ in self.rows], pa.string())
        self.weights = np.array([weight for _, weight, _ in self.rows], np.int32)

    def __call__(self, text: str) -> list[tuple[int, list[str]]]:
        """(number of the pattern, keywords) of each pattern that matches."""
        if any(self.regex(self.excluding.others[i][1]).search(text) for i in self.excluded(text)) or self.excluding(text):
            return []
        found = self.runs(text)
        for i in self.chosen(text):
            keywords = [m.group() for m in self.regex(self.runs.others[i][1]).finditer(text)]
            if keywords:
                found[self.numbers[i]] = keywords
        return sorted(found.items())

    def hits(self, texts: list[str | None]) -> pa.ListArray:
        """The hits of several texts as one array; none for NULL."""
        lists, orders, counts, keywords = [0], [], [], []
        for text in texts:
            for order, own in [] if text is None else self(text):
                orders.append(order)
                counts.append(len(own))
                keywords += own
            lists.append(len(orders))
        of = np.array(orders, np.int32)
        starts = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)]).astype(np.int32)
        words = pa.ListArray.from_arrays(pa.array(starts), pa.array(keywords, pa.string()))
        rows = pa.StructArray.from_arrays(
            [pa.array(of), self.names.take(pa.array(of)), pa.array(self.weights[of]), words], ["pattern_ord", "category", "weight", "keywords"])
        return pa.ListArray.from_arrays(pa.array(lists, pa.int32()), rows)


@functools.lru_cache(maxsize=4)
def _matcher(lexicon: Lexicon) -> Matcher:
    return Matcher(lexicon)


def _hits_by_piece(matcher: Matcher, texts: pa.Array) -> Iterator[pa.Array]:
    """The hits of a batch in its order, of about PIECE_CHARS of text at a time."""
    run, size = [], 0
    for text in texts:
        run.append(text.as_py())
        size += len(run[-1] or "")
        if size >= PIECE_CHARS:
            yield matcher.hits(run)
            run, size = [], 0
    if run or not len(texts):
        yield matcher.hits(run)


def score_large(df: DataFrame, text: Column, lexicon: Lexicon) -> DataFrame:
    """Add `hits`, `heat_score` and `relevance` to every row, as `score_text` does with `otherwise=lexicon`.

    The lexicon, whose size its loader checks, goes to the executors once; a worker builds its automaton at its first batch.
    NULL texts have no hits.
    """
    shared = df.sparkSession.sparkContext.broadcast(lexicon)

    @F.arrow_udf(HITS_TYPE)
    def hits_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield from _hits_by_piece(_matcher(shared.value), batch)

    hits = df.withColumn("hits", hits_of(F.lower(text)))
    return hits.withColumn("heat_score", score_of(F.col("hits"))).withColumn("relevance", relevance(F.col("heat_score")))
