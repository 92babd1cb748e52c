"""Page look-up, staging, merged batches: results, plans and failures on the way."""

import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F

from newsmill.functions import urls
from newsmill.operators import counters, discovery, keyfilter, ordering, storage
from newsmill.operators.matching import match_rows
from newsmill.plans import processing, runs
from newsmill.schemas import STORE_TABLES
from newsmill.session import cut_lineage, fresh_folder, shared_folder
from newsmill.sources import segments, writers

FILL = " filler" * 20


def at():
    return F.lit("2024-10-01 00:00:00").cast("timestamp")


def page(title, body):
    return f"<html><h1>{title}</h1><article>{body}{FILL}</article></html>"


def formatted(df):
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def exchanges(df):
    """Input columns of the exchanges of a plan, broadcasts aside."""
    return re.findall(r"\(\d+\) Exchange\s*\nInput \[\d+\]: \[(.*?)\]", formatted(df))


@pytest.fixture
def long_lists(spark, monkeypatch):
    """Every list of keys counts as too long for a broadcast, by this library and by Spark."""
    monkeypatch.setattr(ordering, "FILTER_VALUES", 0)
    monkeypatch.setattr(discovery, "FILTER_VALUES", 0)
    monkeypatch.setattr(ordering, "BROADCAST_KEYS", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def page_rows(spark, tmp_path, n=3000):
    rows = spark.range(n).select(
        F.concat(F.lit("https://h.org/"), "id").alias("url"), F.lit(page("T", "heat death and heat wave")).alias("html"), F.col("id").alias("page_id"))
    rows.write.parquet(str(tmp_path / "pages"))
    return spark.read.parquet(str(tmp_path / "pages"))


def test_key_filter_loses_nothing_and_passes_little(spark, tmp_path):
    rows = page_rows(spark, tmp_path, 40_000)
    keys = rows.filter("page_id % 10 = 0").select("url")
    passed = keyfilter.passing(rows, keyfilter.key_filter(keys, ["url"], 4000))
    assert passed.filter("page_id % 10 = 0").count() == 4000
    assert passed.filter("page_id % 10 <> 0").count() < 0.02 * 36_000


def test_key_filter_stays_below_its_bound(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keyfilter, "MOST_BYTES", 1024)
    rows = page_rows(spark, tmp_path)
    keys = rows.filter("page_id < 2000").select("url")
    made = keyfilter.key_filter(keys, ["url"], 2000)
    assert made.blocks.count() <= 32
    assert keyfilter.passing(rows, made).filter("page_id < 2000").count() == 2000
    assert keyfilter.passing(rows, keyfilter.key_filter(keys.limit(0), ["url"], 0)).isEmpty()


def test_long_lists_do_not_shuffle_html(spark, tmp_path, long_lists):
    rows = page_rows(spark, tmp_path)
    listed = rows.filter("page_id % 7 = 0").select("url").union(spark.createDataFrame([("gone",)], "url string"))
    known = rows.filter("page_id % 14 = 0").select(urls.url_hash(F.col("url")).alias("url_hash"))
    out = runs.url_list_run(listed, rows.select("url", "html"), known)
    given = exchanges(out)
    assert given and not any("html#" in columns for columns in given)
    assert "Scan parquet" in formatted(out) and "LeftSemi" in formatted(out)
    assert {r.outcome: r["count"] for r in out.groupBy("outcome").count().collect()} == {"already_scraped": 215, "saved": 214, "errors": 1}


def test_long_lists_agree_in_the_capture_time(spark, tmp_path, long_lists):
    """With a filter that lets everything pass, pages of other times and of stored candidates stay out."""
    pages = spark.createDataFrame(
        [("a", "1", page("old", "heat death and heat wave")), ("a", "2", page("new", "nothing")), ("b", "1", page("b", "heat death and heat wave"))],
        "url string, ts string, html string")
    listed = spark.createDataFrame([("a", "2", "s"), ("b", "1", "s")], "url string, ts string, source string")
    known = spark.createDataFrame([("b",)], "url string").select(urls.url_hash(F.col("url")).alias("url_hash"))
    out = processing.evaluate(listed, pages, known, page_keys=("ts",))
    assert {(r.url, r.title, r.outcome) for r in out.collect()} == {("a", "new", "score_too_low"), ("b", None, "already_scraped")}


def test_the_largest_version_of_a_page_counts(spark):
    pages = spark.createDataFrame(
        [("a", 1, page("one", "x")), ("a", 3, page("three", "x")), ("a", 2, page("two", "x"))], "url string, page_id long, html string")
    listed = pages.select("url").distinct().withColumn("source", F.lit("s"))
    none = spark.createDataFrame([], "url_hash string")
    assert processing.evaluate(listed, pages, none, version="page_id").first().title == "three"
    assert processing.evaluate_pages(pages.withColumn("source", F.lit("s")), none, version="page_id").first().title == "three"


def test_unreadable_days_cost_their_day_only(spark):
    root = fresh_folder(spark, "store")
    writers.create_store(spark, root)
    pages = spark.createDataFrame(
        [(u, page("T", "heat death and heat wave"), d) for u, d in (("a", "June 2024"), ("b", "2024-07-01T10:00:00"), ("c", "2024-07-02"), ("d", None))],
        "url string, html string, published_date string")
    out = runs.url_list_run(pages.select("url"), pages, spark.createDataFrame([], "url_hash string"))
    processing.store_outcomes(out, root, 0, at())
    assert {r.url: r.published_date for r in writers.read_table(spark, root, "articles").collect()} == {
        "a": None, "b": dt.date(2024, 7, 1), "c": dt.date(2024, 7, 2), "d": None}


def run_of(spark, rows):
    pages = spark.createDataFrame(rows, "url string, html string")
    return runs.url_list_run(pages.select("url"), pages, spark.createDataFrame([], "url_hash string"))


def test_outcomes_are_staged_and_removed(spark, monkeypatch):
    root = fresh_folder(spark, "store")
    writers.create_store(spark, root)
    sources = spark.createDataFrame([(runs.SINGLE_SOURCE,)], "source string")
    plans = {}

    def noted(df, root, table, *rest):
        plans[table] = formatted(df)
        return writers.write_batch(df, root, table, *rest)

    monkeypatch.setattr(processing, "write_batch", noted)
    out = run_of(spark, [("a", page("T", "heat death and heat wave")), ("b", page("T", "none")), ("c", None)])
    counts = processing.store_outcomes(out, root, 0, at(), sources)
    assert (counts["total"], counts["saved"], counts["score_too_low"], counts["errors"]) == (3, 1, 1, 1)
    assert counters.counted(spark, counts).first() == counters.run_counters(out, "copies").first()
    for table in ("scrape_sessions", "error_log"):
        read = re.findall(r"ReadSchema: (.*)", plans[table])
        assert read and not any("text" in r or "title" in r for r in read if "outcome" in r)
    folder = shared_folder(spark).removeprefix("file:")
    assert not [f for f in os.listdir(folder) if f.startswith("outcomes-")]


def test_no_folder_stays_after_a_failure(spark, monkeypatch):
    root = fresh_folder(spark, "store")
    writers.create_store(spark, root)
    monkeypatch.setattr(processing, "article_rows", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        processing.store_outcomes(run_of(spark, [("a", page("T", "x"))]), root, 0, at())
    assert not [f for f in os.listdir(shared_folder(spark).removeprefix("file:")) if f.startswith("outcomes-")]


def test_an_empty_run_counts_nothing(spark):
    root = fresh_folder(spark, "store")
    writers.create_store(spark, root)
    counts = processing.store_outcomes(run_of(spark, []), root, 0, at())
    assert counters.counted(spark, counts).first().total == 0


# --- merged batches -----------------------------------------------------------------


def put(spark, root, batch, rows, errors=()):
    """A batch of articles (url, title) with one match each."""
    given = spark.createDataFrame([(u, t) for u, t in rows], "url string, title string")
    full = given.select(*(
        F.col(f.name) if f.name in given.columns else urls.url_hash(F.col("url")).alias(f.name) if f.name == "url_hash"
        else F.lit("s").alias(f.name) if f.name == "source" else F.lit(None).cast(f.dataType).alias(f.name) for f in STORE_TABLES["articles"]))
    match = full.select(*(F.col("url_hash") if f.name == "url_hash" else F.lit(None).cast(f.dataType).alias(f.name) for f in STORE_TABLES["keyword_matches"]))
    log = spark.createDataFrame([(u,) for u in errors], "url string").select(
        *(F.col("url") if f.name == "url" else F.lit(None).cast(f.dataType).alias(f.name) for f in STORE_TABLES["error_log"]))
    writers.write_batch(match, root, "keyword_matches", batch)
    writers.write_batch(log, root, "error_log", batch)
    writers.write_batch(full, root, "articles", batch)


def titles(spark, root):
    return sorted((r.batch_id, r.url, r.title) for r in writers.read_table(spark, root, "articles").select("batch_id", "url", "title").collect())


def all_rows(spark, root):
    return {t: sorted(map(repr, writers.read_table(spark, root, t).collect())) for t in STORE_TABLES}


def batch_folders(root, table="articles"):
    folder = f"{root}/{table}".removeprefix("file:")
    return sorted(f for f in os.listdir(folder) if f.startswith("batch_id="))


@pytest.fixture
def store(spark):
    root = fresh_folder(spark, "store")
    writers.create_store(spark, root)
    return root


def test_merging_keeps_all_rows_and_leaves_fewer_files(spark, store):
    for b in range(9):
        put(spark, store, f"b{b}", [(f"u{b}-{i}", "t") for i in range(3)], [f"e{b}"])
        if b == 4:
            assert segments.compact(spark, store, fanout=2, buckets=3) == 1  # five batches at once
    before = all_rows(spark, store)
    assert segments.compact(spark, store, fanout=2) == 2  # four batches, then two segments
    assert all_rows(spark, store) == before
    manifest = segments.manifest_of(spark, store)
    assert [s["level"] for s in manifest.segments] == [2] and manifest.buckets == 3
    assert batch_folders(store) == [] and segments.compact(spark, store, fanout=2) == 0
    files = [f for d, _, names in os.walk(f"{store}/_segments/articles".removeprefix("file:")) for f in names if f.endswith(".parquet")]
    assert 0 < len(files) <= 3
    with pytest.raises(ValueError):
        segments.compact(spark, store, fanout=1)


def test_a_batch_can_come_again_after_it_was_merged(spark, store):
    for b in range(4):
        put(spark, store, f"b{b}", [(f"u{b}", "first"), (f"v{b}", "first")], [f"e{b}"])
    segments.compact(spark, store, fanout=2, buckets=2)
    own = processing.stored_before(spark, store, "b1")
    assert own.count() == 6 and own.filter(F.col("url_hash") == urls.url_hash(F.lit("u1"))).isEmpty()
    put(spark, store, "b1", [("u1", "second")])
    want = sorted([(f"b{b}", f"{c}{b}", "first") for b in (0, 2, 3) for c in "uv"] + [("b1", "u1", "second")])
    assert titles(spark, store) == want
    assert writers.read_table(spark, store, "error_log").count() == 3
    put(spark, store, "b4", [("u4", "first")])
    segments.compact(spark, store, fanout=2)
    assert titles(spark, store) == sorted([*want, ("b4", "u4", "first")])
    assert batch_folders(store) == [] and writers.read_table(spark, store, "error_log").count() == 3


def test_a_superseded_batch_stays_away_when_its_old_segment_is_not_merged_yet(spark, store):
    for b in range(3):
        put(spark, store, f"b{b}", [(f"u{b}", "first")])
    segments.compact(spark, store, fanout=3, buckets=2)
    for b in (1, 3, 4):
        put(spark, store, f"b{b}", [(f"u{b}", "second")])
    segments.compact(spark, store, fanout=3)
    assert [s["without"] for s in segments.manifest_of(spark, store).segments] == [["b1"], []]
    assert titles(spark, store) == [("b0", "u0", "first"), ("b1", "u1", "second"), ("b2", "u2", "first"), ("b3", "u3", "second"), ("b4", "u4", "second")]
    for b in range(5, 8):
        put(spark, store, f"b{b}", [(f"u{b}", "third")])
    segments.compact(spark, store, fanout=3)
    assert [s["level"] for s in segments.manifest_of(spark, store).segments] == [2]
    assert len(titles(spark, store)) == 8 and ("b1", "u1", "second") in titles(spark, store)


def test_a_merge_may_fail_at_any_point(spark, store, monkeypatch):
    for b in range(4):
        put(spark, store, f"b{b}", [(f"u{b}", "first")])
    before = all_rows(spark, store)
    lost = lambda *_: (_ for _ in ()).throw(RuntimeError("lost"))
    with monkeypatch.context() as m:
        m.setattr(segments, "_commit", lost)  # before the manifest
        with pytest.raises(RuntimeError):
            segments.compact(spark, store, fanout=2, buckets=2)
    assert all_rows(spark, store) == before and segments.manifest_of(spark, store) is None
    removed = []
    with monkeypatch.context() as m:  # after the manifest, with some of the folders gone
        m.setattr(segments, "remove_folder", lambda s, p: lost() if len(removed) > 2 else removed.append(p))
        with pytest.raises(RuntimeError):
            segments.compact(spark, store, fanout=2, buckets=2)
    assert len(batch_folders(store)) == 4 and all_rows(spark, store) == before
    put(spark, store, "b2", [("u2", "again")])  # the next writer removes them, then a batch comes again
    assert batch_folders(store) == ["batch_id=b2"]
    assert titles(spark, store) == [("b0", "u0", "first"), ("b1", "u1", "first"), ("b2", "u2", "again"), ("b3", "u3", "first")]


def test_segments_are_not_shuffled(spark, store):
    for b in range(2):
        put(spark, store, f"b{b}", [(f"u{b}-{i}", "t") for i in range(50)])
    segments.compact(spark, store, fanout=2, buckets=6)
    put(spark, store, "b9", [("w", "t")])
    parts = segments.read_parts(spark, store, "articles")
    asked = cut_lineage(spark.createDataFrame([(f"u{b}-{i}", i) for b in range(3) for i in range(40)], "url string, n int").withColumn("url_hash", urls.url_hash(F.col("url"))))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        new = storage.unseen(asked, *parts)
        plan = formatted(new)
        stored_scan = re.search(r"Location: .*_segments/articles", plan)
        assert stored_scan and "SelectedBucketsCount: 6 out of 6" in plan
        # The candidates are dealt out once, the recent batches too; the segments are not.
        assert len(exchanges(new)) == 2
        assert sum("n#" in columns for columns in exchanges(new)) == 1
        assert sorted(r.url for r in new.collect()) == sorted(f"u2-{i}" for i in range(40))
        first = storage.insert_or_ignore(asked.union(asked), *parts, order=[F.col("n")])
        assert first.count() == 40
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_matches_meet_their_articles_in_place(spark, store):
    for b in range(2):
        put(spark, store, f"b{b}", [(f"u{b}-{i}", "t") for i in range(20)])
    segments.compact(spark, store, fanout=2, buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        matches, articles = (segments.read_parts(spark, store, t)[1] for t in ("keyword_matches", "articles"))
        joined = matches.join(articles.select("url_hash", "title"), "url_hash")
        assert exchanges(joined) == [] and joined.count() == 40
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_match_rows_read_no_text(spark, tmp_path):
    out = run_of(spark, [("a", page("T", "heat death and heat wave"))])
    out.write.parquet(str(tmp_path / "outcomes"))
    plan = formatted(match_rows(spark.read.parquet(str(tmp_path / "outcomes"))))
    assert "text:string" not in re.search(r"ReadSchema: (.*)", plan)[1]
