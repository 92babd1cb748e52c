"""The weighted lexicon, its exclusions and the search terms, as data.

A lexicon is a list of :class:`Category` rows plus exclusion patterns.  Nothing
in the library depends on the default words: pass other lists, read them from a
table (:mod:`newsmill.sources.config`) or derive one with :func:`reweighted` and
:func:`extended`.
"""

from __future__ import annotations

from typing import NamedTuple


class Category(NamedTuple):
    name: str
    priority: int
    weight: int
    patterns: tuple[str, ...]


class Lexicon(NamedTuple):
    categories: tuple[Category, ...]
    exclusions: tuple[str, ...] = ()


class SearchTerm(NamedTuple):
    """All phrases of a term must occur; `term` is the label kept as provenance."""

    priority: int
    category: str
    term: str
    phrases: tuple[str, ...]


# Categories, weights, priorities, patterns, exclusions and search terms.
ENGLISH = Lexicon(
    categories=(
        Category("primary_death", 1, 10, (
            r"heat\s+death", r"heat-related\s+death", r"heat-caused\s+death",
            r"heat\s+fatality", r"died\s+from\s+heat", r"died\s+of\s+heat",
            r"heat\s+exposure\s+death", r"hyperthermia\s+death",
            r"heat\s+stroke\s+death", r"died\s+from\s+hyperthermia",
            r"succumbed\s+to\s+heat", r"heat\s+related\s+fatality",
            r"heat\s+victim", r"heat\s+casualty",
        )),
        Category("heat_illness", 4, 5, (
            r"heat\s+stroke", r"heat\s+exhaustion", r"hyperthermia",
            r"heat\s+illness", r"heat\s+related\s+illness", r"heat\s+emergency",
            r"heat-associated", r"severe\s+dehydration",
        )),
        Category("contextual_death", 3, 7, (
            r"found\s+dead.*heat", r"body\s+found.*heat", r"unresponsive.*heat",
            r"pronounced\s+dead.*heat", r"died\s+after.*heat\s+wave",
            r"succumbed.*heat", r"extreme\s+heat.*died",
        )),
        Category("environmental", 6, 2, (
            r"excessive\s+heat\s+warning", r"heat\s+wave", r"extreme\s+heat",
            r"triple-digit\s+temperature", r"record\s+heat", r"blistering\s+heat",
            r"record\s+breaking\s+heat", r"dangerous\s+heat", r"heat\s+advisory",
            r"scorching\s+(?:heat|temperature)", r"heat\s+claims\s+lives",
            r"deadly\s+heat", r"heat\s+turns\s+deadly",
        )),
        Category("location_specific", 2, 8, (
            r"died\s+in\s+vehicle.*heat", r"found\s+in\s+car.*heat",
            r"outdoor\s+death.*heat", r"homeless.*heat\s+death",
            r"farm\s+worker.*heat\s+death", r"agricultural\s+worker.*heat",
            r"(?:air\s+conditioning|A/C)\s+failure.*death",
            r"no\s+(?:A/C|air\s+conditioning).*death",
            r"mobile\s+home.*heat\s+death",
        )),
        Category("medical_coroner", 5, 3, (
            r"coroner.*heat", r"medical\s+examiner.*heat", r"autopsy.*heat",
            r"cause\s+of\s+death.*heat", r"heat\s+related\s+cause",
            r"environmental\s+heat.*death", r"heat\s+as\s+contributing\s+factor",
        )),
    ),
    exclusions=(
        r"heated\s+argument", r"heated\s+debate", r"heat\s+of\s+the\s+moment",
        r"preheat", r"heat\s+pump", r"heating\s+system", r"heated\s+game",
        r"heated\s+competition",
    ),
)

SPANISH = Lexicon(
    categories=(
        Category("primary_death", 1, 10, (
            r"muerte\s+por\s+calor", r"falleció\s+por\s+calor",
            r"murió\s+por\s+calor", r"sucumbió\s+por\s+calor",
            r"falleció\s+por\s+el\s+calor", r"hipertermia\s+fatal",
        )),
        Category("heat_illness", 4, 5, (
            r"golpe\s+de\s+calor", r"insolación", r"hipertermia",
            r"deshidratación\s+severa", r"enfermedad\s+por\s+calor",
        )),
        Category("environmental", 6, 2, (
            r"ola\s+de\s+calor", r"calor\s+extremo", r"temperatura\s+récord",
            r"aviso\s+de\s+calor", r"calor\s+peligroso", r"calor\s+mortal",
        )),
    ),
)

SEARCH_TERMS = (
    SearchTerm(1, "primary_death", '"heat death"', ("heat death",)),
    SearchTerm(1, "primary_death", '"heat-related death"', ("heat-related death",)),
    SearchTerm(1, "primary_death", '"heat fatality"', ("heat fatality",)),
    SearchTerm(1, "primary_death", '"died from heat"', ("died from heat",)),
    SearchTerm(1, "primary_death", '"heat stroke death"', ("heat stroke death",)),
    SearchTerm(2, "location_specific", '"farm worker" heat death', ("farm worker", "heat", "death")),
    SearchTerm(2, "location_specific", '"agricultural worker" heat', ("agricultural worker", "heat")),
    SearchTerm(2, "location_specific", 'homeless "heat death"', ("homeless", "heat death")),
    SearchTerm(3, "contextual_death", '"found dead" heat', ("found dead", "heat")),
    SearchTerm(3, "contextual_death", '"body found" heat', ("body found", "heat")),
    SearchTerm(4, "heat_illness", '"heat stroke"', ("heat stroke",)),
    SearchTerm(4, "heat_illness", '"heat exhaustion"', ("heat exhaustion",)),
    SearchTerm(4, "heat_illness", "hyperthermia", ("hyperthermia",)),
    SearchTerm(4, "heat_illness", '"heat illness"', ("heat illness",)),
    SearchTerm(5, "medical_coroner", "coroner heat", ("coroner", "heat")),
    SearchTerm(5, "medical_coroner", '"medical examiner" heat', ("medical examiner", "heat")),
    SearchTerm(5, "medical_coroner", "autopsy heat", ("autopsy", "heat")),
    SearchTerm(6, "environmental", '"heat wave"', ("heat wave",)),
    SearchTerm(6, "environmental", '"extreme heat"', ("extreme heat",)),
    SearchTerm(6, "environmental", '"heat advisory"', ("heat advisory",)),
    SearchTerm(6, "environmental", '"excessive heat warning"', ("excessive heat warning",)),
)

# The default query of the plain keyword search: any of these terms.
DEFAULT_QUERY = (("heat", "death"), ("heat stroke",), ("heat wave",))

# The date-range run knows one exclusion fewer.
DATE_RANGE_EXCLUSIONS = ENGLISH.exclusions[:7]
# End of fixed values.


def reweighted(lexicon: Lexicon, weights: dict[str, int]) -> Lexicon:
    """The same lexicon with other weights for the named categories."""
    return lexicon._replace(categories=tuple(
        c._replace(weight=weights.get(c.name, c.weight)) for c in lexicon.categories
    ))


def extended(lexicon: Lexicon, category: Category) -> Lexicon:
    """The lexicon with one more category, or more patterns for one of the same name, weight and priority.

    Patterns of a known name with another weight or priority keep their own: they follow as a part of that category.
    """
    def same(c: Category) -> bool:
        return c._replace(patterns=()) == category._replace(patterns=())

    if not any(map(same, lexicon.categories)):
        return lexicon._replace(categories=lexicon.categories + (category,))
    return lexicon._replace(categories=tuple(
        c._replace(patterns=c.patterns + category.patterns) if same(c) else c for c in lexicon.categories
    ))


def by_priority(lexicon: Lexicon) -> Lexicon:
    """Categories from the highest priority (1) down; scores do not depend on it."""
    return lexicon._replace(categories=tuple(sorted(lexicon.categories, key=lambda c: c.priority)))
