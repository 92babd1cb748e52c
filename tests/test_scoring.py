import random
import re

import pytest
from pyspark.sql import functions as F

from newsmill.functions import scoring
from newsmill.functions.lexicon import (
    DATE_RANGE_EXCLUSIONS, ENGLISH, SPANISH, Category, Lexicon, by_priority, extended, reweighted,
)
from newsmill.functions.patterns import portable, required_words
from newsmill.operators import matching
from newsmill.sources.config import exclusion_table, lexicon_table, load_lexicons


def expected(text, lexicon):
    """(score, [(category, weight, keyword)]) with the standard regex module."""
    low = text.lower()
    if any(re.search(p, low, re.IGNORECASE) for p in lexicon.exclusions):
        return 0.0, []
    found = [(c.name, c.weight, m.group(0)) for c in lexicon.categories for p in c.patterns
             for m in re.finditer(p, low, re.IGNORECASE)]
    return float(sum(w for _, w, _ in found)), found


def scored(spark, texts, **options):
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    return scoring.score_text(rows, F.col("text"), **options)


def collected(spark, texts, **options):
    rows = scored(spark, texts, **options).orderBy("id").collect()
    return [(r.heat_score, [(h.category, h.weight, k) for h in r.hits for k in h.keywords]) for r in rows]


def test_worked_example(spark):
    text = ("heat-related death heat-related deaths heat stroke heat exhaustion heat exhaustion "
            "excessive heat warning excessive heat warning")
    row = scored(spark, [text]).first()
    assert row.heat_score == 39.0 and row.relevance == "HIGHLY_RELEVANT"


def test_lexicon_integrity(spark):
    assert {c.name: c.weight for c in ENGLISH.categories} == {
        "primary_death": 10, "location_specific": 8, "contextual_death": 7,
        "heat_illness": 5, "medical_coroner": 3, "environmental": 2}
    assert sum(len(c.patterns) for c in ENGLISH.categories) == 58
    assert sum(len(c.patterns) for c in SPANISH.categories) == 17
    assert [c.priority for c in by_priority(ENGLISH).categories] == [1, 2, 3, 4, 5, 6]
    assert r"heated\s+competition" not in DATE_RANGE_EXCLUSIONS and len(DATE_RANGE_EXCLUSIONS) == 7


@pytest.mark.parametrize("score,label", [
    (0, "NOT_RELEVANT"), (1, "MINIMALLY_RELEVANT"), (9, "MINIMALLY_RELEVANT"), (10, "MODERATELY_RELEVANT"),
    (19, "MODERATELY_RELEVANT"), (20, "HIGHLY_RELEVANT"), (49, "HIGHLY_RELEVANT"), (50, "EXTREMELY_RELEVANT")])
def test_relevance_steps(spark, score, label):
    assert spark.range(1).select(scoring.relevance(F.lit(float(score))).alias("r")).first().r == label


def test_keep_rules(spark):
    rows = spark.createDataFrame([(0.0,), (1.0,), (10.0,), (20.0,)], "s double")
    counts = [rows.filter(scoring.keep(F.col("s"), t)).count() for t in (None, 10, 20)]
    assert counts == [3, 2, 1]


def test_gate_overlap_and_language(spark):
    assert collected(spark, ["heat stroke death"], otherwise=ENGLISH) == [
        (15.0, [("primary_death", 10, "heat stroke death"), ("heat_illness", 5, "heat stroke")])]
    assert collected(spark, ["a heated debate about heat death"], otherwise=ENGLISH) == [(0.0, [])]
    rows = spark.createDataFrame(
        [(1, "en", "ola de calor"), (2, "es", "Ola de calor"), (3, None, "OLA DE CALOR heat death"),
         (4, "en", "heat death")], "id int, lang string, text string")
    got = scoring.score_text(rows, F.col("text"), F.col("lang")).orderBy("id").collect()
    assert [r.heat_score for r in got] == [0.0, 2.0, 2.0, 10.0]


def test_unicode_cases(spark):
    texts = ["heat death", "heat\x1cdeath", "heat\x0bdeath", "heat ſtroke", "ınsolación", "coroner   heat",
             "coroner \r heat", "coroner\nheat", "HEAT\tDEATH", "hyperthermıa", "İNSOLACIÓN", "preheat", "\u212a heat wave", "coroner \u2028 \x85 heat"]
    for lexicon in (ENGLISH, SPANISH):
        assert collected(spark, texts, otherwise=lexicon) == [expected(t, lexicon) for t in texts]


def test_random_texts_match_the_standard_regex_module(spark):
    rng = random.Random(7)
    words = sorted({w for lex in (ENGLISH, SPANISH) for c in lex.categories for p in c.patterns
                    for w in required_words(p)}) + ["A/C", "air conditioning", "no", "heated", "debate", "xyz", "Heat"]
    gaps = [" ", " ", "\u00a0", "\n", "  ", "\t", " ", "-", "\x1d", ". "]
    texts = ["".join(w + rng.choice(gaps) for w in rng.choices(words, k=rng.randint(1, 40))) for _ in range(600)]
    for lexicon in (ENGLISH, SPANISH, ENGLISH._replace(exclusions=())):
        assert collected(spark, texts, otherwise=lexicon) == [expected(t, lexicon) for t in texts]


def test_user_patterns_beyond_plain_words(spark):
    lexicon = Lexicon((Category("a", 1, 4, (r"deaths?", r"\d{3}\s*f\b", r"(?:hot|warm)\s+day", r"[xy]+z", r"Straße")),))
    texts = ["death deaths", "110 F 99 F ١١٠ f", "HOT day warm\nday", "xyxz XYZ", "STRASSE straße Straße", "it's hot"]
    assert collected(spark, texts, otherwise=lexicon) == [expected(t, lexicon) for t in texts]
    assert required_words(r"deaths?") == [] and required_words(r"a\s+(?:b|c)") == ["a"]
    assert portable(r"x\\s").endswith(r"x\\s")


def test_lexicon_changes_and_tables(spark):
    heavier = reweighted(ENGLISH, {"primary_death": 15})
    assert collected(spark, ["heat death"], otherwise=heavier)[0][0] == 15.0
    more = extended(extended(ENGLISH, Category("primary_death", 1, 10, (r"sun\s+death",))), Category("new", 7, 1, ("zzz",)))
    assert collected(spark, ["sun death zzz"], otherwise=more)[0][0] == 11.0
    both = {"en": ENGLISH, "es": SPANISH}
    again = load_lexicons(lexicon_table(spark, both), exclusion_table(spark, both))
    assert again == both
    assert lexicon_table(spark, both).count() == 75 and exclusion_table(spark, both).count() == 8


def test_match_rows_and_breakdown(spark):
    rows = scored(spark, ["heat wave, heat  wave and heat wave; coroner: heat death", "", None]).withColumn(
        "url_hash", F.col("id").cast("string"))
    matches = matching.match_rows(rows).collect()
    assert len(matches) == 5 and all(m.match_count == 1 for m in matches)
    got = {r.category: (r.matches, r.unique_matches, r.score)
           for r in matching.category_breakdown(rows).collect()}
    assert got == {"environmental": (3, 2, 6), "primary_death": (1, 1, 10), "medical_coroner": (1, 1, 3)}
    lines = [r.line for r in matching.breakdown_listing(rows).orderBy("first_pattern_ord").collect()]
    assert lines == ["    - primary_death: 1 matches (10 points)", "    - environmental: 3 matches (6 points)",
                     "    - medical_coroner: 1 matches (3 points)"]
    listed = rows.select(scoring.match_list(F.col("hits")).alias("m")).first().m
    assert [(m.keyword, m.points) for m in listed][:2] == [("heat death", 10), ("heat wave", 2)]
