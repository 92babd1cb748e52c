import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from newsmill.functions import largelexicon, scoring
from newsmill.functions.lexicon import ENGLISH, SPANISH, Category, Lexicon
from newsmill.sources import config

WORDS = ("heat", "death", "Heat\nstroke", "golpe de calor", "ſtroke", "hyperthermıa", "heated debate", "farm worker", "OLA DE CALOR", "x", "coroner")


def made(spark, n, seed=0):
    rng = random.Random(seed)
    rows = [(i, " ".join(rng.choice(WORDS) for _ in range(rng.randint(0, 25)))) for i in range(n)]
    return spark.createDataFrame([*rows, (n, None), (n + 1, "")], "id int, text string")


def listed(df):
    return [tuple(r) for r in df.select("id", "hits", "heat_score", "relevance").orderBy("id").collect()]


ODD = Lexicon((Category("odd", 1, 2, (r"[hx]eat", r"\bx\b", r"(a|o)la\s+de", r"stroke", "")), Category("none", 1, 1, ())), (r"farm\s+worker x",))


@pytest.mark.parametrize("lexicon", [ENGLISH, SPANISH, ODD, Lexicon((), ())], ids=["en", "es", "odd", "none"])
def test_like_literal_patterns(spark, lexicon):
    """Required words, patterns without any, folded letters, exclusions, empty and missing texts."""
    rows = made(spark, 300)
    assert listed(largelexicon.score_large(rows, F.col("text"), lexicon)) == listed(scoring.score_text(rows, F.col("text"), otherwise=lexicon))


def test_thousands_of_patterns_leave_the_plan_small(spark):
    lexicon = Lexicon(tuple(Category(f"c{k}", 1, k + 1, tuple(rf"\bw{i}\s+w{i + k}\b" for i in range(1000))) for k in range(6)), ())
    rows = spark.range(2000).select(F.col("id").cast("int").alias("id"), F.concat_ws(" ", *[F.concat(F.lit("w"), F.col("id") + d) for d in (0, 1, 3, 3)]).alias("text"))
    out = largelexicon.score_large(rows, F.col("text"), lexicon)
    assert len(out._jdf.queryExecution().executedPlan().toString()) < 20_000
    got = dict(out.select("id", "heat_score").collect())
    # w(i) w(i+1): weight 2, w(i+1) w(i+3): weight 3, w(i+3) w(i+3): weight 1.
    assert got == {i: 2.0 * (i < 1000) + 3.0 * (i + 1 < 1000) + 1.0 * (i + 3 < 1000) for i in range(2000)}


def test_too_large_a_table_is_refused(spark, monkeypatch):
    monkeypatch.setattr(config, "MOST_PATTERNS", 3)
    rows = config.lexicon_table(spark, {"": Lexicon((Category("a", 1, 1, ("a", "b", "c", "d")),), ())})
    with pytest.raises(ValueError):
        config.load_lexicons(rows)
    assert config.load_lexicons(rows.filter("pattern < 'd'"))[""].categories[0].patterns == ("a", "b", "c")


def test_runs_match_as_their_regexes_do():
    """Boundaries, shared ends, overlaps, odd white space, folded letters and the mark itself, against `finditer`."""
    rng = random.Random(5)
    words = ("heat", "a", "-a", "a-", "x/y", "it's", "s", "stroke", "ñu", "-", "a-a")
    between = (" ", "  ", "\t \n", "-", " - ", "", "\0", "\x1c", "\xa0")
    for _ in range(1500):
        patterns = tuple(
            rng.choice(("", r"\b")) + r"\s+".join(rng.choice(words) for _ in range(rng.randint(1, 3))) + rng.choice(("", r"\b")) for _ in range(4))
        text = "".join(rng.choice((*words, "heats", "ſtroke", "é")) + rng.choice(between) for _ in range(rng.randint(0, 14)))
        wanted = [(i, found) for i, p in enumerate(patterns) if (found := [m.group() for m in re.finditer(p, text, re.IGNORECASE)])]
        assert largelexicon.Matcher(Lexicon((Category("c", 1, 1, patterns),), ()))(text) == wanted


def test_no_regex_is_tried_for_words_that_stand_apart():
    """A text with every word of a thousand runs, none of them next to each other, costs one walk."""
    words = [f"word{i}" for i in range(40)]
    lexicon = Lexicon((Category("c", 1, 1, tuple(rf"\b{a}\s+{b}\b" for a in words for b in words if a != b)),), (r"word1\s+word0",))
    matcher = largelexicon.Matcher(lexicon)
    assert not matcher(" - ".join(words)) and matcher.regex.cache_info().currsize == 0
    assert matcher("word3  word2") == [(3 * 39 + 2, ["word3  word2"])]


def test_a_batch_gives_its_hits_by_piece(monkeypatch):
    monkeypatch.setattr(largelexicon, "PIECE_CHARS", 10)
    matcher = largelexicon.Matcher(Lexicon((Category("c", 1, 2, (r"\bheat\b",)),), ()))
    made = list(largelexicon._hits_by_piece(matcher, pa.array(["heat", None, "cold heat heat", "", "x"])))
    assert [len(piece) for piece in made] == [3, 2]
    assert [[len(h["keywords"]) for h in row] for piece in made for row in piece.to_pylist()] == [[1], [], [2], [], []]
    assert [len(piece) for piece in largelexicon._hits_by_piece(matcher, pa.array([], pa.string()))] == [0]
