import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from newsmill.functions.lexicon import SEARCH_TERMS, SearchTerm
from newsmill.operators import search as find
from newsmill.sources import phraseindex

WORDS = ("heat", "Heat", "wave", "of", "the", "heat-related", "don't", "A/C", "ſtroke", "ola", "récord", "preheat", "_x", "9")
GAPS = (" ", " ", " ", "  ", "\n", "\t\x1c", "-", "/", "'", ", ", " - ", "", " ", "́ ")
PHRASES = ("heat", "heat wave", "wave of the", "heat of the heat", "heat-related", "heat-related wave", "don't", "a/c heat", "STROKE", "récord",
           "the the the the the", "of of")


def made(spark, n, seed):
    rng = random.Random(seed)
    day = dt.date(2024, 5, 20)
    rows = []
    for i in range(n):
        text = "".join(rng.choice(WORDS) + rng.choice(GAPS) for _ in range(rng.randint(0, 30)))
        rows.append((f"u{rng.randint(0, n)}", rng.choice([text, text, None, ""]) if i % 9 == 0 else text,
                     rng.choice([None, day, day + dt.timedelta(days=rng.randint(0, 60))]), i))
    rows += rng.sample(rows, n // 5)  # repeated rows
    return spark.createDataFrame(rows, "url string, text string, published_date date, place int")


def listed(df):
    return sorted((r.url, r.term_ord) for r in df.collect())


@pytest.mark.parametrize("seed", range(3))
def test_like_the_search_over_texts(spark, tmp_path, seed):
    rng = random.Random(seed)
    terms = tuple(SearchTerm(1, "c", str(i), tuple(rng.sample(PHRASES, rng.randint(1, 2)))) for i in range(6))
    rows = made(spark, 250, seed)
    for batch in range(2):
        phraseindex.write_index(rows.filter(F.col("place") % 2 == batch), F.col("text"), str(tmp_path), batch)
    got = listed(phraseindex.first_terms(spark, str(tmp_path), terms))
    assert got == listed(find.first_terms(rows, F.col("text"), terms)) and got
    start, end = dt.date(2024, 5, 25), dt.date(2024, 6, 20)
    inside = find.published_between(rows, start, end)
    got = listed(phraseindex.first_terms(spark, str(tmp_path), terms, start, end))
    assert got == listed(find.first_terms(inside, F.col("text"), terms)) and got


def test_each_phrase(spark, tmp_path):
    """Every phrase by itself, so that an earlier term hides none."""
    rows = made(spark, 300, 9)
    phraseindex.write_index(rows, F.col("text"), str(tmp_path), 0)
    for phrase in PHRASES:
        term = (SearchTerm(1, "c", phrase, (phrase,)),)
        assert listed(phraseindex.first_terms(spark, str(tmp_path), term)) == listed(find.first_terms(rows, F.col("text"), term)), phrase


def test_a_repeated_batch_and_an_empty_index(spark, tmp_path):
    term = (SearchTerm(1, "c", "heat", ("heat",)),)
    assert listed(phraseindex.first_terms(spark, str(tmp_path), term)) == []
    assert listed(phraseindex.first_terms(spark, str(tmp_path), ())) == []
    day = dt.date(2024, 6, 1)
    for text in ("heat", "cold"):
        rows = spark.createDataFrame([("u", text, day)], "url string, text string, published_date date")
        phraseindex.write_index(rows, F.col("text"), str(tmp_path), 0)
    assert listed(phraseindex.first_terms(spark, str(tmp_path), term)) == []
    phraseindex.write_index(rows.limit(0), F.col("text"), str(tmp_path), 1)
    assert listed(phraseindex.first_terms(spark, str(tmp_path), (SearchTerm(1, "c", "cold", ("cold",)),))) == [("u", 0)]


def test_long_texts(spark, tmp_path):
    """Long runs of signs and words cost time in proportion."""
    text = "-!" * 200_000 + "heat " * 50_000 + "wave" + "!?" * 200_000
    rows = spark.createDataFrame([("u", text, None)], "url string, text string, published_date date")
    phraseindex.write_index(rows, F.col("text"), str(tmp_path), 0)
    term = (SearchTerm(1, "c", "x", ("heat heat heat wave",)),)
    assert listed(phraseindex.first_terms(spark, str(tmp_path), term)) == [("u", 0)]


def test_what_is_no_phrase(spark):
    for phrase in ("", "c++", "(heat)", "naïve", "heat ."):
        with pytest.raises(ValueError):
            phraseindex.pieces(phrase)
    assert [tuple(p) for p in phraseindex.pieces("A b c-d e")] == [(0, "a", " b"), (2, "c", "-d"), (3, "d", " e")]
    assert all(phraseindex.pieces(p) for t in SEARCH_TERMS for p in t.phrases)


def test_search_reads_its_words_and_no_text(spark, tmp_path):
    rows = made(spark, 60, 4).withColumnRenamed("text", "body_text")
    phraseindex.write_index(rows, F.col("body_text"), str(tmp_path), 0)
    found = phraseindex.first_terms(spark, str(tmp_path), SEARCH_TERMS, dt.date(2024, 6, 1), dt.date(2024, 6, 30))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "body_text" not in plan and "month" in plan[plan.index("PartitionFilters"):]
    assert "In(word" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_texts_are_dealt_and_postings_stay_in_their_task(spark, tmp_path, monkeypatch):
    """Text decides the number of tasks; files hold whole articles, sorted by word, and more phrases than one number has bits are told apart."""
    monkeypatch.setattr(phraseindex, "PART_CHARS", 2_000)
    rows = made(spark, 300, 2)
    dealt = phraseindex._bodies(rows, F.col("text"))
    tasks = phraseindex._parts(dealt)
    assert tasks == -(-dealt.agg(F.sum(F.length("_body"))).first()[0] // 2_000) > 4
    phraseindex.write_index(rows, F.col("text"), str(tmp_path), 0)
    stored = phraseindex.read_index(spark, str(tmp_path), "postings").select("article", "word", F.input_file_name().alias("file"), F.col("_metadata.row_index").alias("at"))
    held = stored.collect()
    files = {}
    for r in held:
        files.setdefault(r.file, []).append((r.at, r.word))
    assert len(files) > 4 and all([w for _, w in sorted(own)] == sorted(w for _, w in own) for own in files.values())
    assert len({(bytes(r.article), r.file) for r in held}) <= len({bytes(r.article) for r in held}) * 3  # a URL and text may recur in up to three months
    expected = phraseindex.postings(rows, F.col("text"))
    assert sorted(map(str, phraseindex.read_index(spark, str(tmp_path), "postings").select(*expected.columns).collect())) == sorted(map(str, expected.collect()))
    many = tuple(SearchTerm(1, "c", str(i), ("heat", f"none{i}") if i < 70 else ("heat wave", "of")) for i in range(72))
    got = listed(phraseindex.first_terms(spark, str(tmp_path), many))
    assert got == listed(find.first_terms(rows, F.col("text"), many)) and got
