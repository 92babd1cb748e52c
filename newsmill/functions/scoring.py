"""Scoring of text against weighted lexicons.

Every pattern is a literal in the plan, so its regex is compiled once per task
and an article is scored inside one map-side projection: no join with the
lexicon, no row blow-up and no shuffle.  A byte search for the words a pattern
requires runs first, so most patterns never reach the regex engine.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsmill.functions.columns import computed_once
from newsmill.functions.lexicon import ENGLISH, SPANISH, Lexicon
from newsmill.functions.patterns import folds_unusually, portable, required_words, sql_text

# Relevance labels by least score, and the usual keep thresholds.
RELEVANCE_STEPS = (
    (50, "EXTREMELY_RELEVANT"),
    (20, "HIGHLY_RELEVANT"),
    (10, "MODERATELY_RELEVANT"),
)
MINIMAL_LABEL = "MINIMALLY_RELEVANT"
NO_LABEL = "NOT_RELEVANT"
DEFAULT_THRESHOLD = 10
# End of fixed values.

# A word this many patterns need is searched once for all of them.
SHARED_BY = 3

HITS_TYPE = "array<struct<pattern_ord:int,category:string,weight:int,keywords:array<string>>>"


def full_text(title: Column, body: Column) -> Column:
    """Title and body with an empty line between, so `.` never spans both."""
    return F.concat(F.coalesce(title, F.lit("")), F.lit("\n\n"), F.coalesce(body, F.lit("")))


class _Gates:
    """Cheap tests that rule patterns out before the regex engine sees the text.

    First a few byte searches decide whether a text can match anything at all;
    most texts of a large corpus end here.  For the others, words that several
    patterns need are searched once, and a pattern's own longest word only if
    those are present.  Texts with folded twin letters pass every gate.
    """

    def __init__(self, lexicons: list[Lexicon]) -> None:
        counts = Counter(
            word for lexicon in lexicons for pattern in _all_patterns(lexicon)
            for word in _long_words(pattern)
        )
        shared = sorted(word for word, n in counts.items() if n >= SHARED_BY)
        self.columns = {word: f"_has{i}" for i, word in enumerate(shared)}

    def flags(self) -> dict[str, Column]:
        return {
            name: F.expr(f"CASE WHEN _maybe THEN contains(_text, {sql_text(word)}) END")
            for word, name in self.columns.items()
        }

    def sql(self, pattern: str) -> str:
        words = _long_words(pattern)
        if not words:
            return "true"
        tests = [self.columns[w] for w in words if w in self.columns]
        own = [w for w in words if w not in self.columns]
        if own:
            tests.append(f"contains(_text, {sql_text(own[0])})")
        return f"(_unusual OR ({' AND '.join(tests)}))"


def _long_words(pattern: str) -> list[str]:
    return [word for word in required_words(pattern) if len(word) > 2]


def _maybe_sql(patterns: list[str]) -> str:
    """False where none of the patterns can match: no word of a covering set occurs."""
    open_sets = [set(_long_words(p)) for p in patterns]
    if not all(open_sets):
        return "true"
    cover = []
    while open_sets:
        counts = Counter(word for words in open_sets for word in sorted(words))
        best = min(counts, key=lambda w: (-counts[w], -len(w), w))
        cover.append(best)
        open_sets = [words for words in open_sets if best not in words]
    tests = [f"contains(_text, {sql_text(word)})" for word in cover]
    return " OR ".join(["_unusual", *tests])


def _all_patterns(lexicon: Lexicon) -> list[str]:
    return [*lexicon.exclusions, *(p for c in lexicon.categories for p in c.patterns)]


def _excluded_sql(lexicon: Lexicon, gates: _Gates) -> str:
    """True where any exclusion pattern of the lexicon occurs."""
    tests = [f"({gates.sql(p)} AND rlike(_text, {sql_text(portable(p))}))" for p in lexicon.exclusions]
    return " OR ".join(tests) or "false"


def _hits_sql(lexicon: Lexicon, gates: _Gates) -> str:
    """Per matching pattern: order, category, weight and all matched keywords.

    Matches of one pattern do not overlap each other; matches of different
    patterns may.  The exclusion gate comes first and leaves no hits.
    """
    rows = []
    for category in lexicon.categories:
        for pattern in category.patterns:
            rows.append(
                f"named_struct('pattern_ord', {len(rows)}, 'category', {sql_text(category.name)}, "
                f"'weight', {category.weight}, 'keywords', CASE WHEN {gates.sql(pattern)} "
                f"THEN regexp_extract_all(_text, {sql_text(portable(pattern))}, 0) END)"
            )
    found = f"filter(array({', '.join(rows)}), h -> size(h.keywords) > 0)" if rows else "array()"
    if lexicon.exclusions:
        found = f"CASE WHEN {_excluded_sql(lexicon, gates)} THEN array() ELSE {found} END"
    return f"CAST({found} AS {HITS_TYPE})"


def _with_text(df: DataFrame, text: Column, maybe: Column, gates: _Gates) -> DataFrame:
    """Add the lower-cased text and the gate columns.

    Spark keeps these projections apart from the scoring one, because their
    columns are used by many patterns: each is computed once per row.
    """
    return (
        df.withColumn("_text", F.lower(text))
        .withColumn("_unusual", folds_unusually(F.col("_text")))
        .withColumn("_maybe", maybe)
        .withColumns(gates.flags())
    )


def _without_text(df: DataFrame, gates: _Gates) -> DataFrame:
    return df.drop("_text", "_unusual", "_maybe", *gates.columns.values())


def mark_excluded(df: DataFrame, text: Column, lexicon: Lexicon, name: str = "excluded") -> DataFrame:
    """Add a column telling whether the exclusion gate fires."""
    gates = _Gates([lexicon._replace(categories=())])
    maybe = F.expr(_maybe_sql(list(lexicon.exclusions)))
    excluded = F.expr(f"_maybe AND ({_excluded_sql(lexicon, gates)})")
    return _without_text(computed_once(_with_text(df, text, maybe, gates), excluded, name), gates)


def score_of(hits: Column) -> Column:
    """Sum over all matches of the weight of their pattern."""
    return F.aggregate(
        hits, F.lit(0).cast("bigint"),
        lambda total, h: total + h["weight"].cast("bigint") * F.size(h["keywords"]),
    ).cast("double")


def relevance(score: Column) -> Column:
    """Relevance label of a score."""
    label = None
    for least, name in RELEVANCE_STEPS:
        label = F.when(score >= least, name) if label is None else label.when(score >= least, name)
    return label.when(score > 0, MINIMAL_LABEL).otherwise(NO_LABEL)


def keep(score: Column, threshold: float | None = DEFAULT_THRESHOLD) -> Column:
    """Keep rule: at least `threshold`, or any score above zero for `None`."""
    return score > 0 if threshold is None else score >= threshold


def match_list(hits: Column) -> Column:
    """All matches in lexicon order as (keyword, category, weight, points)."""
    return F.flatten(F.transform(hits, lambda h: F.transform(h["keywords"], lambda k: F.struct(
        k.alias("keyword"), h["category"].alias("category"),
        h["weight"].alias("weight"), h["weight"].alias("points"),
    ))))


def score_text(
    df: DataFrame,
    text: Column,
    language: Column | None = None,
    by_language: dict[str, Lexicon] | None = None,
    otherwise: Lexicon | None = None,
) -> DataFrame:
    """Add `hits`, `heat_score` and `relevance` to every row.

    With a `language` column each language of `by_language` uses its lexicon and
    everything else, NULL included, the `otherwise` one (default: English with
    exclusions, and Spanish for the rest).  Without one, `otherwise` (default
    English) scores all rows.
    """
    if language is None:
        choices, rest = {}, otherwise or ENGLISH
    else:
        choices = {"en": ENGLISH} if by_language is None else by_language
        rest = otherwise or SPANISH
    gates = _Gates([*choices.values(), rest])

    def by_choice(make) -> Column:
        chosen = F.expr(make(rest))
        for code, lexicon in choices.items():
            chosen = F.when(language == code, F.expr(make(lexicon))).otherwise(chosen)
        return chosen

    maybe = by_choice(lambda lexicon: _maybe_sql([p for c in lexicon.categories for p in c.patterns]))
    hits = F.when(F.col("_maybe"), by_choice(lambda lexicon: _hits_sql(lexicon, gates)))
    hits = hits.otherwise(F.expr(f"CAST(array() AS {HITS_TYPE})"))
    return (
        _without_text(computed_once(_with_text(df, text, maybe, gates), hits, "hits"), gates)
        .withColumn("heat_score", score_of(F.col("hits")))
        .withColumn("relevance", relevance(F.col("heat_score")))
    )
