"""Queries about scoring, matches, reports and storage, over `documents`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmill.functions import largelexicon, scoring
from newsmill.functions.lexicon import ENGLISH, SPANISH, by_priority, reweighted
from newsmill.operators import counters, matching, reports, storage
from newsmill.plans import processing
from newsmill.schemas import ARTICLES, STORE_TABLES
from newsmill.session import cut_lineage, fresh_folder
from newsmill.sources import config, readers, reportstate, segments, writers
from workload.inputs import (
    ARTICLES_SQL, HITS_SQL, RELEVANCE_SQL, SCORED_SQL, TEXTS_SQL, TWO_LANGUAGES, WORD_LEXICON,
    articles, lexicon_sql, sql, table, texts,
)

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(function):
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function
    return register


def scored(spark: SparkSession, folder: str) -> DataFrame:
    """All articles with hits, score and relevance, the language choosing the lexicon."""
    rows = articles(spark, folder)
    text = scoring.full_text(F.col("title"), F.col("text"))
    return scoring.score_text(rows, text, F.col("language"))


def stored(spark: SparkSession, folder: str) -> DataFrame:
    """Scored articles under the column names of the store."""
    return scored(spark, folder).withColumnRenamed("relevance", "category")


@query("score_articles", sql(SCORED_SQL, select="SELECT url_hash, heat_score, category AS relevance FROM scored"))
def score_articles(spark, folder):
    return scored(spark, folder).select("url_hash", "heat_score", "relevance")


@query("keyword_matches", sql(SCORED_SQL, select="""
SELECT url_hash, keyword, category AS keyword_type, CAST(1 AS INTEGER) AS match_count, weight FROM hits"""))
def keyword_matches(spark, folder):
    return matching.match_rows(scored(spark, folder)).drop("pattern_ord", "occurrence")


_BREAKDOWN = """
SELECT url_hash, category, count(*) AS matches, count(DISTINCT keyword) AS unique_matches,
       CAST(sum(weight) AS BIGINT) AS score, min(pattern_ord) AS first_pattern_ord
FROM hits GROUP BY url_hash, category"""


@query("category_breakdown", sql(SCORED_SQL, select=_BREAKDOWN))
def category_breakdown(spark, folder):
    return matching.category_breakdown(scored(spark, folder))


@query("breakdown_listing", sql(SCORED_SQL, f"b AS ({_BREAKDOWN})", select="""
SELECT url_hash, first_pattern_ord, category, matches, score,
       '    - ' || category || ': ' || matches || ' matches (' || score || ' points)' AS line FROM b"""))
def breakdown_listing(spark, folder):
    return matching.breakdown_listing(scored(spark, folder))


@query("stored_breakdown", sql(SCORED_SQL, f"b AS ({_BREAKDOWN})", select="""
SELECT url_hash, title, heat_score, b.category AS keyword_type, matches, score
FROM b JOIN scored USING (url_hash)"""))
def stored_breakdown(spark, folder):
    rows = scored(spark, folder)
    return matching.stored_breakdown(
        matching.match_rows(rows).withColumnRenamed("category", "keyword_type"), rows)


_SERIAL_HITS = """
numbered AS (
  SELECT g.url_hash, l.pattern_ord, l.category, l.weight, regexp_extract_all(g.t, l.pattern, 0, 'i') AS ks
  FROM gated g JOIN lexicon l ON l.lex = g.lex),
occurrences AS (
  SELECT url_hash, pattern_ord, category, weight, unnest(ks) AS keyword, generate_subscripts(ks, 1) AS i FROM numbered)"""
_SERIAL = """
SELECT url_hash, CAST(to_json(list({'keyword': keyword, 'category': category, 'weight': weight, 'points': weight}
                      ORDER BY pattern_ord, i)) AS VARCHAR) AS keywords_matched
FROM occurrences GROUP BY url_hash"""


def _serialised(rows: DataFrame) -> DataFrame:
    found = rows.filter(F.size("hits") > 0)
    return found.select("url_hash", F.to_json(scoring.match_list(F.col("hits"))).alias("keywords_matched"))


@query("serialised_matches", sql(SCORED_SQL, _SERIAL_HITS, select=_SERIAL))
def serialised_matches(spark, folder):
    return _serialised(scored(spark, folder))


@query("priority_order_matches", sql(
    ARTICLES_SQL, lexicon_sql({"en": by_priority(ENGLISH)}),
    "texts AS (SELECT url_hash, 'en' AS lex, lower(title || chr(10) || chr(10) || text) AS t FROM articles)",
    HITS_SQL, _SERIAL_HITS, select=_SERIAL))
def priority_order_matches(spark, folder):
    rows = articles(spark, folder)
    text = scoring.full_text(F.col("title"), F.col("text"))
    return _serialised(scoring.score_text(rows, text, otherwise=by_priority(ENGLISH)))


_HEAVY = {"primary_death": 15, "environmental": 1}


@query("reweighted_scores", sql(
    ARTICLES_SQL, lexicon_sql({"en": reweighted(ENGLISH, _HEAVY), "": SPANISH}), TEXTS_SQL, HITS_SQL,
    select=f"SELECT url_hash, heat_score, {RELEVANCE_SQL} AS relevance FROM scores"))
def reweighted_scores(spark, folder):
    rows = articles(spark, folder)
    text = scoring.full_text(F.col("title"), F.col("text"))
    out = scoring.score_text(
        rows, text, F.col("language"), {"en": reweighted(ENGLISH, _HEAVY)}, SPANISH)
    return out.select("url_hash", "heat_score", "relevance")


_RAW_TEXTS = """texts AS (SELECT CAST(doc_id AS VARCHAR) AS url_hash, '' AS lex, lower(text) AS t FROM documents)"""


@query("word_lexicon_scores", sql(
    lexicon_sql({"": WORD_LEXICON}), _RAW_TEXTS, HITS_SQL,
    select=f"SELECT url_hash AS doc, heat_score, {RELEVANCE_SQL} AS relevance FROM scores"))
def word_lexicon_scores(spark, folder):
    docs = texts(spark, folder, "documents")
    out = scoring.score_text(docs, F.col("text"), otherwise=WORD_LEXICON)
    return out.select(F.col("doc_id").cast("string").alias("doc"), "heat_score", "relevance")


@query("table_lexicon_scores", ORACLES["word_lexicon_scores"])
def table_lexicon_scores(spark, folder):
    """The same with patterns and exclusions written as tables and loaded from there."""
    root = fresh_folder(spark, "lexicon")
    config.lexicon_table(spark, {"": WORD_LEXICON}).write.parquet(f"{root}/patterns")
    config.exclusion_table(spark, {"": WORD_LEXICON}).write.parquet(f"{root}/exclusions")
    loaded = config.load_lexicons(spark.read.parquet(f"{root}/patterns"), spark.read.parquet(f"{root}/exclusions"))
    docs = texts(spark, folder, "documents")
    out = scoring.score_text(docs, F.col("text"), otherwise=loaded[""])
    return out.select(F.col("doc_id").cast("string").alias("doc"), "heat_score", "relevance")


# Every run of one to four words of the benchmark texts is a pattern, weighted by its words.  In SQL \b knows ASCII
# only, so other letters, digits and marks become a digit there, which is a word character of no pattern.
_RUN_WORDS = 4
_RUNS_SQL = """worded AS (
  SELECT regexp_extract_all(lower(text), '[a-z]+') AS w FROM benchmark),
runs AS (
  SELECT DISTINCT array_to_string(list_slice(w, i, i + n - 1), ' ') AS run, n
  FROM (SELECT w, n, unnest(range(1, len(w) - n + 2)) AS i FROM worded, (SELECT unnest(range(1, 5)) AS n))),
patterns AS (
  SELECT '\\b' || replace(run, ' ', '\\s+') || '\\b' AS pattern, string_split(run, ' ') AS w, n FROM runs)"""


@query("large_lexicon_scores", sql(_RUNS_SQL, """low AS (
  SELECT doc_id, regexp_replace(lower(text), '[^\\P{L}a-z]|[^\\P{N}0-9]|\\p{M}', '0', 'g') AS t FROM documents),
found AS (
  SELECT doc_id, sum(n * len(regexp_extract_all(t, pattern, 0, 'i'))) AS score
  FROM low JOIN patterns ON contains(t, w[1]) AND contains(t, w[-1]) AND contains(t, w[greatest(len(w) - 1, 1)]) GROUP BY doc_id)""", select=f"""
SELECT doc_id, heat_score, {RELEVANCE_SQL} AS relevance FROM (
  SELECT doc_id, CAST(coalesce(score, 0) AS DOUBLE) AS heat_score FROM low LEFT JOIN found USING (doc_id))"""))
def large_lexicon_scores(spark, folder):
    """Documents against thousands of patterns, which are written as a table and loaded from there."""
    words = table(spark, folder, "benchmark").select(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0)).alias("w"))
    runs = words.select("w", F.explode(F.sequence(F.lit(1), F.lit(_RUN_WORDS))).alias("n")).filter("size(w) >= n").select(
        "n", F.explode(F.expr("transform(sequence(1, size(w) - n + 1), i -> array_join(slice(w, i, n), ' '))")).alias("run"))
    patterns = runs.distinct().select(
        F.lit("").alias("language"), F.format_string("words_%d", "n").alias("category"), F.lit(1).alias("priority"),
        F.col("n").cast("int").alias("weight"), F.col("n").cast("int").alias("pattern_ord"),
        F.concat(F.lit("\\b"), F.replace("run", F.lit(" "), F.lit("\\s+")), F.lit("\\b")).alias("pattern"))
    path = fresh_folder(spark, "lexicon")
    patterns.write.parquet(path)
    loaded = config.load_lexicons(spark.read.parquet(path))
    docs = texts(spark, folder, "documents")
    return largelexicon.score_large(docs, F.col("text"), loaded[""]).select("doc_id", "heat_score", "relevance")


@query("word_lexicon_matches", sql(
    lexicon_sql({"": WORD_LEXICON}), _RAW_TEXTS, HITS_SQL,
    select="SELECT url_hash AS doc, keyword, category AS keyword_type, CAST(1 AS INTEGER) AS match_count, weight FROM hits"))
def word_lexicon_matches(spark, folder):
    docs = texts(spark, folder, "documents").withColumn("doc", F.col("doc_id").cast("string"))
    out = scoring.score_text(docs, F.col("text"), otherwise=WORD_LEXICON)
    return matching.match_rows(out, "doc").drop("pattern_ord", "occurrence")


@query("exclusion_gate", sql(
    ARTICLES_SQL, lexicon_sql({"en": ENGLISH}),
    "texts AS (SELECT url_hash, 'en' AS lex, lower(title || chr(10) || chr(10) || text) AS t FROM articles)",
    """raw AS (
  SELECT x.url_hash, CAST(sum(l.weight * len(regexp_extract_all(x.t, l.pattern, 0, 'i'))) AS DOUBLE) AS raw_score
  FROM texts x CROSS JOIN lexicon l GROUP BY x.url_hash)""",
    select="""
SELECT url_hash, raw_score,
       CAST(EXISTS (SELECT 1 FROM exclusions e WHERE regexp_matches(t, e.pattern, 'i')) AS INTEGER) AS excluded
FROM texts JOIN raw USING (url_hash)"""))
def exclusion_gate(spark, folder):
    text = scoring.full_text(F.col("title"), F.col("text"))
    rows = scoring.mark_excluded(articles(spark, folder), text, ENGLISH)
    out = scoring.score_text(rows, text, otherwise=ENGLISH._replace(exclusions=()))
    return out.select(
        "url_hash", F.col("heat_score").alias("raw_score"), F.col("excluded").cast("int"))


@query("threshold_variants", sql(SCORED_SQL, select="""
SELECT language, count(*) AS articles, count(*) FILTER (heat_score > 0) AS above_zero,
       count(*) FILTER (heat_score >= 10) AS at_least_10, count(*) FILTER (heat_score >= 20) AS at_least_20
FROM scored GROUP BY language"""))
def threshold_variants(spark, folder):
    score = F.col("heat_score")
    return scored(spark, folder).groupBy("language").agg(
        F.count(F.lit(1)).alias("articles"),
        F.count_if(scoring.keep(score, None)).alias("above_zero"),
        F.count_if(scoring.keep(score)).alias("at_least_10"),
        F.count_if(scoring.keep(score, 20)).alias("at_least_20"))


# --- reports -----------------------------------------------------------------

@query("total_articles", sql(SCORED_SQL, select="SELECT count(*) AS articles FROM scored WHERE heat_score > 0"))
def total_articles(spark, folder):
    return reports.total_articles(stored(spark, folder).filter("heat_score > 0"))


@query("relevance_report", sql(SCORED_SQL, select="""
SELECT category, count(*) AS articles, avg(heat_score) AS avg_score FROM scored GROUP BY category"""))
def relevance_report(spark, folder):
    return reports.by_relevance(stored(spark, folder))


@query("source_report", sql(SCORED_SQL, select="""
SELECT source, count(*) AS articles, avg(heat_score) AS avg_score FROM scored GROUP BY source"""))
def source_report(spark, folder):
    return reports.by_source(stored(spark, folder))


@query("language_report", sql(SCORED_SQL, select="""
SELECT language, CASE WHEN language = 'en' THEN 'English' ELSE 'Spanish' END AS language_name,
       count(*) AS articles FROM scored GROUP BY language"""))
def language_report(spark, folder):
    """A count needs no scores: no text is read."""
    return reports.by_language(articles(spark, folder))


@query("top_articles", sql(SCORED_SQL, select="""
SELECT title, source, heat_score, category, url_hash FROM scored ORDER BY heat_score DESC, url_hash LIMIT 10"""))
def top_articles(spark, folder):
    return reports.top_articles(stored(spark, folder))


@query("newest_articles", sql(SCORED_SQL, select="""
SELECT title, heat_score, category, CAST(published_date AS VARCHAR) AS published_date, scraped_second, url_hash
FROM scored ORDER BY scraped_second DESC, url_hash LIMIT 10"""))
def newest_articles(spark, folder):
    """The ten newest of all articles are found first, and only they are scored."""
    newest = reports.newest(articles(spark, folder))
    done = scoring.score_text(newest, scoring.full_text(F.col("title"), F.col("text")), F.col("language"))
    rows = reports.newest_articles(done.withColumnRenamed("relevance", "category"))
    return rows.select("title", "heat_score", "category", F.col("published_date").cast("string"),
                       F.unix_seconds("scraped_date").alias("scraped_second"), "url_hash")


@query("export_rows", sql(SCORED_SQL, select="""
SELECT title AS "Title", source AS "Source", heat_score AS "Score", CAST(published_date AS VARCHAR) AS "Date"
FROM scored WHERE heat_score > 0"""))
def export_rows(spark, folder):
    return reports.export_rows(stored(spark, folder)).withColumn("Date", F.col("Date").cast("string"))


_RULE = "=" * 80


@query("report_text", sql(
    SCORED_SQL, "kept AS (SELECT * FROM scored WHERE heat_score > 0)",
    """r AS (SELECT category, count(*) AS n, avg(heat_score) AS a FROM kept GROUP BY category),
s AS (SELECT source, count(*) AS n, avg(heat_score) AS a FROM kept GROUP BY source),
l AS (SELECT language, count(*) AS n FROM kept GROUP BY language),
best AS (SELECT *, row_number() OVER (ORDER BY heat_score DESC, url_hash) AS k FROM kept
         ORDER BY heat_score DESC, url_hash LIMIT 10),
fixed(section, line_ord, line) AS (VALUES
  (0, 1, ''), (0, 2, '""" + _RULE + """'), (0, 3, 'SCRAPING SUMMARY REPORT'), (0, 4, '""" + _RULE + """'), (0, 5, ''),
  (3, 1, ''), (3, 2, 'By Relevance Category:'), (5, 1, ''), (5, 2, 'By Source:'), (7, 1, ''), (7, 2, 'By Language:'),
  (9, 1, ''), (9, 2, 'Top 10 Most Relevant Articles:'), (11, 1, ''), (11, 2, '""" + _RULE + """'))""",
    select="""
SELECT section, CAST(line_ord AS BIGINT) AS line_ord, line FROM fixed
UNION ALL SELECT 1, 1, 'Total Articles in Database: ' || count(*) FROM kept
UNION ALL SELECT 4, row_number() OVER (ORDER BY a DESC, category),
  format('  {:<25} {:>4} articles (avg score: {:.1f})', category, n, a) FROM r
UNION ALL SELECT 6, row_number() OVER (ORDER BY n DESC, source),
  format('  {:<30} {:>4} articles (avg score: {:.1f})', source, n, a) FROM s
UNION ALL SELECT 8, row_number() OVER (ORDER BY language), format('  {:<30} {:>4} articles',
  CASE WHEN language = 'en' THEN 'English' ELSE 'Spanish' END, n) FROM l
UNION ALL SELECT 10, k * 3 - 2, '' FROM best
UNION ALL SELECT 10, k * 3 - 1, format('  {}. [{:.1f}] ', k, heat_score) || substr(title, 1, 70) FROM best
UNION ALL SELECT 10, k * 3, '     Source: ' || source || ' | Category: ' || category FROM best"""))
def report_text(spark, folder):
    """The report reads its articles twice, so the scored ones are written once first."""
    columns = ["category", "source", "language", "heat_score", "title", "url_hash"]
    kept = cut_lineage(stored(spark, folder).filter("heat_score > 0").select(*columns))
    return reports.report_lines(kept)


@query("report_from_batches", ORACLES["report_text"])
def report_from_batches(spark, folder):
    """The same report from the stored parts of three batches, one of them written twice: no article is read again."""
    root = fresh_folder(spark, "store")
    columns = ["doc_id", "category", "source", "language", "heat_score", "title", "url_hash"]
    kept = cut_lineage(stored(spark, folder).filter("heat_score > 0").select(*columns))
    reportstate.write_state(kept, root, 2)
    for number in range(3):
        reportstate.write_state(kept.filter(F.col("doc_id") % 3 == number), root, number)
    return reportstate.report(spark, root)


@query("source_report_from_batches", ORACLES["source_report"])
def source_report_from_batches(spark, folder):
    """Articles and average score by source out of the stored parts of a run's two batches."""
    root = fresh_folder(spark, "store")
    columns = ["doc_id", "category", "source", "language", "heat_score", "title", "url_hash"]
    rows = cut_lineage(stored(spark, folder).select(*columns))
    for number in range(2):
        reportstate.write_state(rows.filter(F.col("doc_id") % 2 == number), root, number)
    return reportstate.by_source(spark, root)


@query("report_file", f"""
WITH lines AS (SELECT section, line_ord, string_split(line, chr(10)) AS parts FROM ({ORACLES["report_text"]})),
each AS (SELECT section, line_ord, unnest(parts) AS line, generate_subscripts(parts, 1) AS part FROM lines)
SELECT row_number() OVER (ORDER BY section, line_ord, part) - 1 AS line_no, line FROM each""")
def report_file(spark, folder):
    """The report written to its file and read back line by line; titles may hold line ends."""
    path = fresh_folder(spark, "report")
    writers.write_report(report_text(spark, folder), path)
    return spark.read.text(path).select(F.monotonically_increasing_id().alias("line_no"), F.col("value").alias("line"))


# --- storage -----------------------------------------------------------------

_BATCH_SQL = """batch AS (
  SELECT doc_id, source, 'https://news.example.org/text/' || md5(text) AS url,
         md5('https://news.example.org/text/' || md5(text)) AS url_hash FROM documents),
known AS (
  SELECT DISTINCT url_hash FROM batch JOIN labels USING (doc_id))"""


def _batch(spark, folder):
    """documents addressed by content, so exact copies share a URL; labelled ones are stored."""
    url = F.concat(F.lit("https://news.example.org/text/"), F.md5(F.col("text").cast("binary")))
    rows = table(spark, folder, "documents").select(
        "doc_id", "source", url.alias("url")).withColumn("url_hash", F.md5(F.col("url").cast("binary")))
    known = rows.join(table(spark, folder, "labels").select("doc_id"), "doc_id", "left_semi")
    return rows, known.select("url_hash").distinct()


@query("new_articles", sql(_BATCH_SQL, select="""
SELECT url_hash, url, source, doc_id FROM (
  SELECT *, row_number() OVER (PARTITION BY url_hash ORDER BY doc_id) AS k FROM batch)
WHERE k = 1 AND url_hash NOT IN (SELECT url_hash FROM known)"""))
def new_articles(spark, folder):
    rows, known = _batch(spark, folder)
    return storage.insert_or_ignore(rows, known, order=[F.col("doc_id")]).select(
        "url_hash", "url", "source", "doc_id")


@query("unseen_urls", sql(_BATCH_SQL, select="""
SELECT doc_id, url_hash FROM batch WHERE url_hash NOT IN (SELECT url_hash FROM known)"""))
def unseen_urls(spark, folder):
    rows, known = _batch(spark, folder)
    return storage.unseen(rows, known).select("doc_id", "url_hash")


@query("unseen_in_segments", ORACLES["unseen_urls"])
def unseen_in_segments(spark, folder):
    """The same over a store whose batches were merged into bucketed segments."""
    rows, known = _batch(spark, folder)
    root = fresh_folder(spark, "store")
    writers.create_store(spark, root)
    have = {f.name: f.dataType for f in ARTICLES}
    articles = cut_lineage(known.select(*(F.col(c) if c == "url_hash" else F.lit("").alias(c) if c in ("url", "source") else F.lit(None).cast(t).alias(c)
                                          for c, t in have.items())))
    for number in range(5):
        part = articles.filter(F.pmod(F.xxhash64("url_hash"), F.lit(5)) == number)
        for name in STORE_TABLES:
            writers.write_batch(part if name == "articles" else spark.createDataFrame([], STORE_TABLES[name]), root, name, number)
        segments.compact(spark, root, fanout=2, buckets=8)
    return storage.unseen(rows, *segments.read_parts(spark, root, "articles")).select("doc_id", "url_hash")


# --- outcomes of a run over the documents --------------------------------------

_OUTCOME_SQL = """evaluated AS (
  SELECT a.*, a.doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AS already,
         a.doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1) AS extracted FROM scored a),
outcomes AS (
  SELECT *, CASE WHEN already THEN 'already_scraped' WHEN NOT extracted THEN 'errors'
                 WHEN heat_score >= 10 THEN 'saved' ELSE 'score_too_low' END AS outcome FROM evaluated)"""


def outcomes(spark, folder):
    """Scored documents as a run: good labels are stored already, toxic ones fail to extract."""
    labels = table(spark, folder, "labels").select(
        "doc_id", (F.col("quality") == 1).alias("already"), (F.col("toxic") == 0).alias("extracted"))
    rows = scored(spark, folder).join(labels, "doc_id", "left").na.fill(False, ["already"])
    rows = rows.na.fill(True, ["extracted"]).withColumn("seq", F.col("doc_id"))
    return counters.with_outcome(rows)


@query("run_outcomes", sql(SCORED_SQL, _OUTCOME_SQL, select="SELECT url_hash, outcome FROM outcomes"))
def run_outcomes(spark, folder):
    return outcomes(spark, folder).select("url_hash", "outcome")


_COUNTERS = """
SELECT count(*) AS total, count(*) FILTER (outcome IN ('saved', 'score_too_low')) AS processed,
       count(*) FILTER (outcome = 'already_scraped') AS already_scraped, count(*) FILTER (outcome = 'saved') AS saved,
       count(*) FILTER (outcome = 'score_too_low') AS score_too_low, count(*) FILTER (outcome = 'errors') AS errors,
       CAST(0 AS BIGINT) AS no_archive,
       CASE WHEN count(*) FILTER (outcome IN ('saved', 'score_too_low')) = 0 THEN 0.0
            ELSE CAST(count(*) FILTER (outcome = 'saved') AS DOUBLE)
                 / count(*) FILTER (outcome IN ('saved', 'score_too_low')) * 100 END AS hit_rate
FROM outcomes"""


@query("run_counters", sql(SCORED_SQL, _OUTCOME_SQL, select=_COUNTERS))
def run_counters(spark, folder):
    return counters.run_counters(outcomes(spark, folder))


@query("hit_rate", sql(SCORED_SQL, _OUTCOME_SQL, select="""
SELECT source, coalesce(CAST(count(*) FILTER (outcome = 'saved') AS DOUBLE)
       / nullif(count(*) FILTER (outcome IN ('saved', 'score_too_low')), 0) * 100, 0.0) AS hit_rate
FROM outcomes GROUP BY source"""))
def hit_rate(spark, folder):
    done = F.count_if(F.col("outcome").isin(counters.SAVED, counters.LOW))
    return outcomes(spark, folder).groupBy("source").agg(
        counters.hit_rate(F.count_if(F.col("outcome") == counters.SAVED), done).alias("hit_rate"))


@query("session_stats", sql(
    SCORED_SQL, _OUTCOME_SQL,
    """sources AS (SELECT DISTINCT source FROM documents UNION SELECT DISTINCT event_type FROM events),
failed AS (SELECT DISTINCT source FROM documents WHERE lang = 'es' AND n_chars < 300)""",
    select="""
SELECT source, '2024-10-01 00:00:00' AS start_time,
       CASE WHEN source IN (SELECT source FROM failed) THEN NULL ELSE '2024-10-01 01:00:00' END AS end_time,
       count(url_hash) AS articles_found,
       count(*) FILTER (outcome <> 'already_scraped') AS articles_new,
       count(*) FILTER (outcome = 'saved') AS articles_scraped,
       count(*) FILTER (outcome = 'errors') + CAST(source IN (SELECT source FROM failed) AS BIGINT) AS errors,
       CASE WHEN source IN (SELECT source FROM failed) THEN 'FAILED' ELSE 'COMPLETED' END AS status
FROM sources LEFT JOIN outcomes USING (source) GROUP BY source"""))
def session_stats(spark, folder):
    docs = table(spark, folder, "documents")
    events = table(spark, folder, "events")
    sources = docs.select("source").union(events.select("event_type")).distinct()
    failed = docs.filter("lang = 'es' AND n_chars < 300").select("source")
    return counters.session_stats(
        outcomes(spark, folder), sources, F.lit("2024-10-01 00:00:00"),
        F.lit("2024-10-01 01:00:00"), failed)


# --- sinks, read back -------------------------------------------------------------

@query("stored_tables", sql(SCORED_SQL, _OUTCOME_SQL, select="""
SELECT 'articles' AS table_name, source, count(*) AS n, CAST(sum(heat_score) AS BIGINT) AS total
FROM outcomes WHERE outcome = 'saved' GROUP BY source
UNION ALL SELECT 'keyword_matches', h.category, count(*), CAST(sum(h.weight) AS BIGINT)
FROM hits h JOIN outcomes o ON o.url_hash = h.url_hash WHERE o.outcome = 'saved' GROUP BY h.category
UNION ALL SELECT 'error_log', source, count(*), CAST(0 AS BIGINT) FROM outcomes WHERE outcome = 'errors' GROUP BY source
UNION ALL SELECT 'scrape_sessions', source, count(*),
  CAST(count(*) FILTER (outcome = 'saved') AS BIGINT) FROM outcomes GROUP BY source"""))
def stored_tables(spark, folder):
    """One batch written to all four tables of a new store and summed up from there."""
    root = fresh_folder(spark, "store")
    writers.create_store(spark, root)
    at = F.lit("2024-10-01 00:00:00").cast("timestamp")
    sources = table(spark, folder, "documents").select("source")
    processing.store_outcomes(outcomes(spark, folder), root, 0, at, sources)

    def summed(name, key, n, total):
        return writers.read_table(spark, root, name).groupBy(F.col(key).alias("source")).agg(
            n.cast("bigint").alias("n"), F.coalesce(total, F.lit(0)).cast("bigint").alias("total"),
        ).withColumn("table_name", F.lit(name))

    count = F.count(F.lit(1))
    return (
        summed("articles", "source", count, F.sum("heat_score"))
        .unionByName(summed("keyword_matches", "keyword_type", count, F.sum("weight")))
        .unionByName(summed("error_log", "source", count, F.lit(0)))
        .unionByName(summed("scrape_sessions", "source", F.sum("articles_found"), F.sum("articles_scraped")))
    )


@query("catalog_read", sql(SCORED_SQL, _OUTCOME_SQL, select="""
SELECT source, count(*) AS n, sum(heat_score) AS total FROM outcomes WHERE outcome = 'saved' GROUP BY source"""))
def catalog_read(spark, folder):
    """Two batches of one store, seen through the catalog: one written before its tables were registered, one after."""
    root = fresh_folder(spark, "store")
    database = "news_" + root.rsplit("-", 1)[1]
    writers.create_store(spark, root)
    at = F.lit("2024-10-01 00:00:00").cast("timestamp")
    done = outcomes(spark, folder)
    processing.store_outcomes(done.filter("doc_id % 2 = 0"), root, 0, at)
    spark.sql(f"CREATE DATABASE {database} LOCATION '{root}/_database'")
    writers.create_catalog_tables(spark, root, database)
    processing.store_outcomes(done.filter("doc_id % 2 = 1"), root, 1, at, database=database)
    return spark.sql(f"SELECT source, count(*) AS n, sum(heat_score) AS total FROM {database}.articles GROUP BY source")


@query("url_list_file", sql(ARTICLES_SQL, select="SELECT DISTINCT url FROM articles"))
def url_list_file(spark, folder):
    """Distinct sorted URLs written as text and read as a URL list."""
    path = fresh_folder(spark, "urls")
    writers.write_url_list(articles(spark, folder), path)
    return readers.read_url_list(spark, path).select("url")


@query("export_file", sql(SCORED_SQL, select="""
SELECT title AS "Title", source AS "Source", heat_score AS "Score", CAST(published_date AS VARCHAR) AS "Date"
FROM scored WHERE heat_score > 0"""))
def export_file(spark, folder):
    """The CSV export, read back under its header."""
    path = fresh_folder(spark, "export")
    writers.write_export(stored(spark, folder), path)
    columns = "Title string, Source string, Score double, Date string"
    return spark.read.schema(columns).option("header", True).option("escape", '"').csv(path)
