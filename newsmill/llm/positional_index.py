"""Benchmark decontamination over a positional inverted index of the training texts.

The index has a posting for each occurrence of a test term: the term, the text and the position. A window's rarest term gives
its candidates: the positions of its list, moved back by the term's place in the window. The list of the next rarest term is
intersected with them at its own offset, and what is left with the lists of all further terms, each at its own; a candidate
that every list confirms is an exact phrase match. Proximity matches count the lists that have a position near the rarest term's.

Everything is DataFrame functions. Words are taken from all texts once, and postings are written in the same pass, without a shuffle. What is
asked of the lists is narrow: a Bloom filter of it is applied in the scan of the postings, and only what passes is shuffled, by
text, term and position, so that no term is a hot key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsmill.llm.tables import stored
from newsmill.operators.keyfilter import key_filter, passing

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
NO_TERM = ""  # no word is empty
MOST_WORDS = 1 << 20  # no window is longer
SALTS = 16
BROADCAST_ROWS, BROADCAST_BYTES = 2_000_000, 64_000_000  # of test windows or terms; larger sets are shuffled


def words(text: Column) -> Column:
    """Lower-case words of a text; NULL has none."""
    return F.coalesce(F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def text_key(text: Column) -> Column:
    """128 bits of a hash of the text; equal texts share postings and verdict."""
    return F.substring(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256), 1, 32)


def bounded(small: DataFrame, column: str | Column) -> DataFrame:
    """A join side with a broadcast hint if its counted size allows that: the length of a column, or bytes of a row, and 40 for each row."""
    each = F.length(F.col(column).cast("string")) if isinstance(column, str) else column
    size = small.agg(F.count(F.lit(1)).alias("n"), F.sum(each).alias("b")).first()
    return F.broadcast(small) if size["n"] <= BROADCAST_ROWS and (size["b"] or 0) + 40 * size["n"] <= BROADCAST_BYTES else small


@dataclass
class Index:
    tokens: DataFrame  # id, key, n_words
    postings: DataFrame  # term, key, at (0-based): every occurrence of a test term; copies of a text repeat them
    windows: DataFrame  # window, size, ranked: (n, offset, term) of each of its words, rarest first; only windows whose terms all occur
    items: DataFrame  # window, item


def test_windows(benchmark: DataFrame, item: str, text: str, size: int) -> DataFrame:
    """Each window of each item, without repetition; an item of fewer words than a window is one window."""
    own = benchmark.select(F.col(f"`{item}`").cast("string").alias("item"), words(F.col(f"`{text}`")).alias("w")).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1)))
    return own.select("item", F.explode(F.transform(starts, lambda s: F.slice(F.col("w"), s, F.lit(size)))).alias("words")).distinct().withColumn(
        "window", F.substring(F.sha2(F.array_join("words", " "), 256), 1, 32))


def build(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text: str = "text", item: str = "item_id",
          item_text: str = "text", size: int = WINDOW) -> Index:
    of_items = stored(test_windows(benchmark, item, item_text, size), "test-windows")
    windows = of_items.select("window", "words").distinct()
    terms = stored(windows.select(F.explode("words").alias("term")).distinct(), "test-terms")
    # Texts are read once: each gives a row for itself, as its occurrence of no term at all, and one for each of its words.
    split = docs.select(F.col(f"`{id_column}`").alias("id"), text_key(F.col(f"`{text}`")).alias("key"), words(F.col(f"`{text}`")).alias("words"))
    listed = split.select("id", "key", F.size("words").cast("long").alias("n_words"), F.posexplode(F.concat(F.array(F.lit(NO_TERM)), "words")).alias("at", "term"))
    own = F.col("term") == NO_TERM
    marked = terms.unionByName(docs.sparkSession.range(1).select(F.lit(NO_TERM).alias("term")))
    index = stored(by_term(listed, marked).select(
        "term", "key", (F.col("at") - 1).alias("at"), F.when(own, F.col("id")).alias("id"), F.when(own, F.col("n_words")).alias("n_words")), "postings")
    tokens, postings = index.filter(own).select("id", "key", "n_words"), index.filter(~own).select("term", "key", "at")
    counts = postings.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    placed = windows.select("window", F.size("words").alias("size"), F.posexplode("words").alias("offset", "term")).join(counts, "term")
    ranked = placed.groupBy("window", "size").agg(F.array_sort(F.collect_list(F.struct("n", "offset", "term"))).alias("ranked"))  # at most `size`
    return Index(tokens, postings, stored(ranked.filter(F.size("ranked") == F.col("size")), "ranked-windows"),
                 of_items.select("window", "item"))


def by_term(postings: DataFrame, asked: DataFrame) -> DataFrame:
    """`postings` with what is asked of their terms; where that is too large for a broadcast, a term's postings are dealt to SALTS keys."""
    side = bounded(asked, F.lit(80))
    if side is not asked:
        return postings.join(side, "term")
    salted = asked.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return postings.withColumn("_salt", F.pmod(F.xxhash64("key", "at"), F.lit(SALTS)).cast("int")).join(salted, ["term", "_salt"]).drop("_salt")


def met(postings: DataFrame, asked: DataFrame, on: list[str]) -> DataFrame:
    """Rows of `asked` (stored) that postings confirm, repeated for each of them; `on` names key, term and place."""
    return passing(postings, key_filter(asked, on, asked.count())).distinct().join(asked, on)


def candidates(index: Index) -> DataFrame:
    """Windows at the places where their rarest term puts them: key, window, size, start (from 0), at (of the rarest term); each once."""
    rarest = index.windows.select("window", "size", F.col("ranked")[0]["term"].alias("term"), F.col("ranked")[0]["offset"].alias("_offset"))
    return by_term(index.postings, rarest).select("key", "window", "size", (F.col("at") - F.col("_offset")).alias("start"), "at").distinct()


def phrases(index: Index) -> DataFrame:
    """Exact matches: key, window, start, size; each once."""
    columns = ["key", "window", "start", "size"]
    place = ["key", "term", "at"]
    one = stored(candidates(index).filter("start >= 0").select(*columns), "candidates")

    def asked(of: DataFrame, first: int, last: int, name: str) -> DataFrame:
        """Where the terms of the ranks first .. last would stand."""
        terms = index.windows.select("window", F.explode(F.slice("ranked", first, last - first + 1)).alias("r")).select("window", "r.term", "r.offset")
        return stored(of.join(bounded(terms, F.lit(80)), "window").select(*columns, "term", (F.col("start") + F.col("offset")).alias("at")), name)

    two = stored(met(index.postings, asked(one.filter("size > 1"), 2, 2, "asked-second"), place).select(*columns).distinct(), "candidates-two")
    rest = met(index.postings, asked(two.filter("size > 2"), 3, MOST_WORDS, "asked-rest"), place)
    whole = rest.groupBy(*columns).agg(F.size(F.collect_set("at")).alias("n")).filter("n = size - 2")  # at most `size` places
    return one.filter("size = 1").unionByName(two.filter("size = 2")).unionByName(whole.select(*columns))


def near(index: Index, share: float = 0.8) -> DataFrame:
    """Proximity matches: key and window where at least `share` of the window's distinct terms stand near its rarest one, in
    any order, less than a window's length before or after it.

    Positions are put in bins of a window's length, and a candidate asks the lists for the bin of its rarest term and its neighbours.
    """
    size = index.windows.agg(F.max("size")).first()[0] or 1
    places = stored(candidates(index).select("key", "window", "at").distinct(), "places")
    terms = index.windows.select("window", F.explode(F.array_distinct(F.transform("ranked", lambda r: r["term"]))).alias("term"))
    wide = index.windows.select("window", F.col("size").alias("_reach"), F.size(F.array_distinct(F.transform("ranked", lambda r: r["term"]))).alias("_terms"))
    here = F.col("at").cast("long") / size
    bins = F.explode(F.array(*(F.floor(here) + d for d in (-1, 0, 1)))).alias("bin")
    asked = stored(places.join(bounded(wide, F.lit(80)), "window").join(bounded(terms, F.lit(80)), "window").select(
        "key", "window", F.col("at").alias("_from"), "_reach", "_terms", "term", bins), "asked-near")
    found = met(index.postings.withColumn("bin", F.floor(here)), asked, ["key", "term", "bin"]).filter(F.abs(F.col("at") - F.col("_from")) < F.col("_reach"))
    return found.groupBy("key", "window", "_from", "_terms").agg(F.size(F.collect_set("term")).alias("n")).filter(
        F.col("n") >= share * F.col("_terms")).select("key", "window").distinct()


def hits(index: Index) -> DataFrame:
    """By key: words within any match, and the items that match, in order as strings.

    The ranges of a text are walked in order of their start; each adds what lies beyond the furthest end so far.
    """
    found = stored(phrases(index), "phrases")
    ranges = found.groupBy("key", "start").agg(F.max(F.col("start") + F.col("size")).alias("stop"))
    before = Window.partitionBy("key").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.greatest(F.col("stop") - F.greatest(F.col("start"), F.coalesce(F.max("stop").over(before), F.lit(0))), F.lit(0))
    n_hit = ranges.withColumn("fresh", fresh).groupBy("key").agg(F.sum("fresh").alias("n_hit"))
    of_items = found.select("key", "window").distinct().join(index.items, "window").select("key", "item").distinct()
    return n_hit.join(of_items.groupBy("key").agg(F.array_sort(F.collect_list("item")).alias("item_ids")), "key")


def contamination(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text: str = "text", item: str = "item_id",
                  item_text: str = "text", size: int = WINDOW) -> DataFrame:
    """One row for each document: id, key, n_words, n_hit, item_ids (array of strings), contaminated.

    Documents and items without words hit nothing. Repeated rows get a row each. NULL ids stay NULL; a benchmark item with a
    NULL id hits words but isn't listed. An empty benchmark or an empty table gives no hits or no rows.
    """
    index = build(docs, benchmark, id_column, text, item, item_text, size)
    found = stored(hits(index), "hits")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return index.tokens.select("id", "key", "n_words").join(found, "key", "left").select(
        "id", "key", "n_words", n_hit.alias("n_hit"), F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        (n_hit > 0).alias("contaminated"))


def contaminated_texts(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """The keys of texts that hold a test window."""
    index = build(docs.select(F.lit(None).cast("long").alias("id"), F.col(f"`{text}`").alias("text")), benchmark, "id", "text", item, item_text)
    return phrases(index).select("key").distinct()
