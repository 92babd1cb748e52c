"""A stored index of words for phrase search, so that new search terms don't read the texts again.

One posting for each word of each text: the word, its place, and the following word with what joins the two.  Postings lie in
one folder for each batch and publication month.  Each file holds all words of some texts, sorted by word, so a search reads the
months it asks for and, by the statistics of the pages of a file, little beyond the words it asks for.  The texts are what is
dealt to tasks, a few million words to each: postings, which are many times larger, are made, sorted and written in one task,
and a frequent word is spread over all files.  A phrase of two words is one filter of the scan; a longer one is covered by pairs, whose places are then intersected.

Words are runs of word characters of the lower-cased text, the folded twins of s and i taken as these letters; words of a
phrase are joined by white space, or by one of - ' / where the phrase has it.  So the index finds what
:func:`newsmill.operators.search.first_terms` finds.  Phrases with other signs or letters are no phrases of the index:
they raise a ValueError and remain with the search over texts.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsmill.functions.lexicon import SearchTerm
from newsmill.functions.patterns import FOLDED_TWINS, is_plain, phrase_pattern
from newsmill.session import file_system
from newsmill.sources.segments import BATCH

MONTH = "month"
SPACE, JOINTS = " ", "-'/"
_BITS = 62  # phrases to a column of bits
POSTINGS = T.StructType([
    T.StructField("word", T.StringType()), T.StructField("next", T.StringType()), T.StructField("article", T.BinaryType()),
    T.StructField("place", T.IntegerType()), T.StructField("published_date", T.DateType())])
ARTICLES = T.StructType([
    T.StructField("article", T.BinaryType()), T.StructField("url", T.StringType()), T.StructField("published_date", T.DateType())])
TABLES = {"postings": POSTINGS, "articles": ARTICLES}
PART_CHARS, LEAST_CHARS = 16_000_000, 1_000_000  # text whose postings one task sorts, some 400 MB; text worth a task of its own
_PARTITIONS = [T.StructField(BATCH, T.StringType()), T.StructField(MONTH, T.StringType())]


class Piece(NamedTuple):
    """A word at its offset in a phrase, with the following word if that is looked up with it."""
    offset: int
    word: str
    next: str | None


def _path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/_phrases/{name}"


def _folded(text: str) -> str:
    return text.lower().translate({ord(twin): letter for letter, twin in FOLDED_TWINS.items()})


def pieces(phrase: str) -> list[Piece]:
    """What a phrase asks of the index: its word, or pairs of neighbours that cover it."""
    words = phrase.split()
    if not words or not is_plain(phrase_pattern(phrase)) or not all(re.fullmatch(r"\w+([-'/]\w+)*", w) for w in words):
        raise ValueError(f"no phrase for the index: {phrase!r}")
    parts = re.findall(r"(^|[-'/ ])(\w+)", _folded(SPACE.join(words)))
    if len(parts) == 1:
        return [Piece(0, parts[0][1], None)]
    last = len(parts) - 2
    return [Piece(i, parts[i][1], "".join(parts[i + 1])) for i in sorted({*range(0, last + 1, 2), last})]


def _article() -> Column:
    return F.unhex(F.md5(F.concat_ws("\0", "url", "_body").cast("binary")))


# A word with the signs after it; the group is what ties it to the next word, empty for other signs.
_WORD = r"(?U)\w+"
_TIED = r"(?U)\w++(?:([\s\x1c-\x1f]++|[-'/])(?=\w)|\W*+)"


def _bodies(articles: DataFrame, text: Column) -> DataFrame:
    bodies = articles.select("url", "published_date", text.alias("_body"))
    return bodies.select(_article().alias("article"), "url", "published_date", _month().alias(MONTH), "_body")


def postings(articles: DataFrame, text: Column) -> DataFrame:
    """Postings of articles (url, published_date); `article` tells texts and URLs apart by 128 bits.

    Two regex passes over a text, none over its words.  Articles without text or words have none; equal rows give equal postings.
    """
    return _postings(_bodies(articles, text)).drop(MONTH)


def _postings(bodies: DataFrame) -> DataFrame:
    folded = F.translate(F.lower("_body"), "".join(FOLDED_TWINS.values()), "".join(FOLDED_TWINS))
    carried = "article", "published_date", MONTH
    texts = bodies.select(*carried, F.explode(F.array(folded)).alias("_text"))
    words = texts.select(*carried, F.explode(F.array(F.struct(
        F.regexp_extract_all("_text", F.lit(_WORD), F.lit(0)).alias("words"),
        F.regexp_extract_all("_text", F.lit(_TIED), F.lit(1)).alias("ties")))).alias("_in"))
    placed = words.select(*carried, F.posexplode(F.arrays_zip(
        F.col("_in.words").alias("word"), F.slice("_in.words", 2, F.greatest(F.size("_in.words"), F.lit(0))).alias("after"),
        F.col("_in.ties").alias("tie"))).alias("place", "_at"))
    tie = F.col("_at.tie")
    following = F.when(tie != "", F.concat(F.when(tie.isin(list(JOINTS)), tie).otherwise(SPACE), F.col("_at.after")))
    return placed.select("_at.word", following.alias("next"), "article", "place", "published_date", MONTH)


def _month() -> Column:
    return F.date_format("published_date", "yyyy-MM")


def _parts(bodies: DataFrame) -> int:
    """Tasks for texts: so many that the postings of one fit its memory, and for short work no more than there are cores."""
    size = bodies.agg(F.sum(F.length("_body"))).first()[0] or 0
    return max(1, -(-size // PART_CHARS), min(bodies.sparkSession.sparkContext.defaultParallelism, size // LEAST_CHARS))


def write_index(articles: DataFrame, text: Column, root: str, batch_id: int | str) -> None:
    """Indexes one batch of articles (url, published_date); writing it again replaces it."""
    bodies = _bodies(articles, text)
    dealt = bodies.drop("url").repartitionByRange(_parts(bodies), MONTH, "article")
    rows = {
        "postings": _postings(dealt).sortWithinPartitions(MONTH, "word"),
        "articles": bodies.drop("_body").repartitionByRange(MONTH, "article").sortWithinPartitions(MONTH, "article"),
    }
    for name, table in rows.items():
        table.write.mode("overwrite").partitionBy(MONTH).parquet(f"{_path(root, name)}/{BATCH}={batch_id}")


def read_index(spark: SparkSession, root: str, name: str, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """Postings or articles, of a time of publication (both days included) if one is given."""
    schema = T.StructType([*TABLES[name].fields, *_PARTITIONS])
    system, at = file_system(spark, _path(root, name))
    rows = spark.read.schema(schema).parquet(_path(root, name)) if system.exists(at) else spark.createDataFrame([], schema)
    if start is not None:
        rows = rows.filter((F.col(MONTH) >= f"{start.year:04d}-{start.month:02d}") & (F.col("published_date") >= F.lit(start)))
    if end is not None:
        rows = rows.filter((F.col(MONTH) <= f"{end.year:04d}-{end.month:02d}") & (F.col("published_date") <= F.lit(end)))
    return rows


def phrase_hits(found: DataFrame, phrases: Sequence[str]) -> DataFrame:
    """(article, phrase) for every article with a phrase, numbered as in `phrases`, from postings.

    The scan keeps the words and pairs of the phrases; only phrases of three words and more shuffle places.
    """
    asked = [(n, p.word, p.next, p.offset, len(cover)) for n, cover in enumerate(map(pieces, phrases)) for p in cover]
    uses = found.sparkSession.createDataFrame(asked, "phrase int, word string, then string, offset int, of int")
    alone = sorted({word for _, word, then, *_ in asked if then is None})
    pairs = sorted({then for _, _, then, *_ in asked if then is not None})
    read = found.filter(F.col("word").isin(sorted({word for _, word, *_ in asked})) & (F.col("word").isin(alone) | F.col("next").isin(pairs)))
    # One row for each configured word or pair.
    rows = read.join(F.broadcast(uses), "word").filter("then IS NULL OR next = then").select(
        "article", "phrase", "of", "offset", (F.col("place") - F.col("offset")).alias("start"))
    covered = (
        rows.filter("of > 1").groupBy("article", "phrase", "of", "start").agg(F.collect_set("offset").alias("_offsets"))
        .filter("size(_offsets) = of").select("article", "phrase")
    )
    return rows.filter("of = 1").select("article", "phrase").unionByName(covered)


def first_terms(
    spark: SparkSession, root: str, terms: Sequence[SearchTerm], start: dt.date | None = None, end: dt.date | None = None,
) -> DataFrame:
    """Every matching URL with the order number of the first term that finds it, as the search over texts gives it.

    `start` and `end` are days of publication; articles without one are found only if neither is given.  No text is read.
    """
    phrases = sorted({p for t in terms for p in t.phrases})
    number = {p: i for i, p in enumerate(phrases)}
    held = phrase_hits(read_index(spark, root, "postings", start, end), phrases)
    # The phrases of an article as bits, so that they are merged before they are shuffled.
    chunks = range(0, max(1, len(phrases)), _BITS)
    bits = [F.expr(f"bit_or(CASE WHEN phrase BETWEEN {c} AND {c + _BITS - 1} THEN shiftleft(1L, phrase - {c}) ELSE 0L END)").alias(f"_held{c}") for c in chunks]
    by_article = held.groupBy("article").agg(*bits)

    def holds(asked: set[int]) -> Column:
        test = F.lit(True)
        for c in chunks:
            mask = sum(1 << (n - c) for n in asked if c <= n < c + _BITS)
            test = test & (F.col(f"_held{c}").bitwiseAND(F.lit(mask).cast("long")) == mask)
        return test

    tests = [F.when(holds({number[p] for p in t.phrases}), F.lit(i)) for i, t in enumerate(terms)]
    first = by_article.select("article", F.coalesce(*tests, F.lit(None).cast("int")).alias("term_ord")).filter("term_ord IS NOT NULL")
    named = read_index(spark, root, "articles", start, end).select("article", "url")
    return named.join(first, "article").groupBy("url").agg(F.min("term_ord").alias("term_ord"))
