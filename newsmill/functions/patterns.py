"""Regular-expression helpers shared by scoring and search.

Patterns run on lower-cased text and ignore case.  Most of them are plain words
with gaps; for those a case-sensitive regex means the same on lower-cased text
and is several times faster, and the words themselves can be looked for with a
byte search before any regex runs.
"""

from __future__ import annotations

import functools
import operator
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# `.` stops at \n only, Unicode character classes; case folding where needed.
_FLAGS = "(?dU)"
_FOLDING_FLAGS = "(?iduU)"

# The white space classes of Java leave out the four separators 0x1C-0x1F.
_SPACE = re.compile(r"(?<!\\)((?:\\\\)*)\\s")
_SPACE_CLASS = r"\1[\\s\\x1c-\\x1f]"

_GAP = re.compile(r"\\s\+|\\b|\.\*|\(\?:(?:[A-Za-z0-9áéíóúüñ'/| -]|\\s\+)*\)(?![?*+{])")
_WORDS = re.compile(r"[A-Za-z0-9áéíóúüñ'/ -]*")
_LETTER = re.compile(r"\\.|[A-Za-záéíóúüñ]")

# Lower-case letters that case folding equates with an ASCII letter.
FOLDED_TWINS = {"s": "ſ", "i": "ı"}


def is_plain(pattern: str) -> bool:
    """True for words joined by `\\s+`, `\\b`, `.*` or a plain group, and nothing else."""
    return all(_WORDS.fullmatch(piece) for piece in _GAP.split(pattern))


def portable(pattern: str) -> str:
    """`pattern` as a Spark regex that ignores case on lower-cased Unicode text."""
    if not is_plain(pattern):
        return _FOLDING_FLAGS + _SPACE.sub(_SPACE_CLASS, pattern)

    def fold(token: re.Match) -> str:
        letter = token.group().lower()
        if letter in FOLDED_TWINS:
            return f"[{letter}{FOLDED_TWINS[letter]}]"
        return letter

    return _FLAGS + _SPACE.sub(_SPACE_CLASS, _LETTER.sub(fold, pattern))


def required_words(pattern: str) -> list[str]:
    """Literal pieces every match of `pattern` must contain, longest first.

    Empty for patterns that are not plain, which means "cannot be ruled out".
    """
    if not is_plain(pattern):
        return []
    pieces = {piece.lower() for piece in _GAP.split(pattern) if piece}
    return sorted(pieces, key=lambda p: (-len(p), p))


def any_of(conditions: list[Column]) -> Column:
    return functools.reduce(operator.or_, conditions) if conditions else F.lit(False)


def contains_any(text: Column, words: tuple[str, ...] | list[str]) -> Column:
    return any_of([text.contains(w) for w in words])


def folds_unusually(text: Column) -> Column:
    """True where a byte search could miss a word because of a folded twin letter."""
    return contains_any(text, list(FOLDED_TWINS.values()))


def phrase_pattern(phrase: str) -> str:
    """Whole-word, white-space-flexible pattern of a search phrase."""
    words = phrase.split()
    if all(re.fullmatch(r"\w+([-'/]\w+)*", w) for w in words):
        return r"\b" + r"\s+".join(words) + r"\b"
    return r"(?<!\w)" + r"\s+".join(re.escape(w) for w in words) + r"(?!\w)"


def sql_text(value: str) -> str:
    """A string literal of Spark SQL."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
