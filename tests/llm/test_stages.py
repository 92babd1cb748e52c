"""Token counts against the public library, links between quotations, and the stages of the pipeline against plain versions."""

from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
import tokenizers
from brute import op5, op9
from pyspark.sql import functions as F
from test_contracts import EDGES, SMALL, docs_of, edge_dir, ordered  # noqa: F401 - edge_dir is a fixture

from newsmill.llm import candidate_pii, queries, quotation_links, string_kernel, viterbi_counts


def unigram():
    """The library's unigram model over the same pieces and scores."""
    model = tokenizers.models.Unigram(viterbi_counts.vocabulary(queries.PIECES), unk_id=0, byte_fallback=True)
    made = tokenizers.Tokenizer(model)
    made.pre_tokenizer = tokenizers.pre_tokenizers.Metaspace(replacement=viterbi_counts.MARK, prepend_scheme="always", split=True)
    return made


@pytest.mark.parametrize("which", ["small", "edges"])
def test_op6(spark, edge_dir, which):  # noqa: F811
    folder = SMALL if which == "small" else edge_dir
    plain = unigram()
    want = [(d, len(plain.encode(t or "", add_special_tokens=False).ids)) for d, t in docs_of(spark, folder)]
    got = queries.QUERIES["op6_viterbi_counts"](spark, folder).select("doc_id", "n_tokens").collect()
    assert ordered(map(tuple, got)) == ordered(want)


TALK = [
    ("a", 1, "user", "Hello there. How are you today? I went to the market."),
    ("a", 2, "guest", "> How  are you\n> TODAY?\nFine, thanks. And you?"),
    ("a", 3, "user", "> > How are you today?\n> Fine, thanks. And you?\nGood too."),
    ("a", 4, "guest", "> I went to the market.\nWhich one?"),
    ("a", 5, "user", "> Never said this.\nHm."),
    ("a", None, "user", "> Hello there."),
    ("b", 1, None, None),
    ("b", 2, "user", "> How are you today?\nQuoted from elsewhere."),
]
LINKS = {  # n_quoted, n_linked, reply_to, root, depth, path, clean_text
    ("a", 1): (0, 0, None, 1, 0, [1], TALK[0][3]), ("a", 2): (1, 1, 1, 1, 1, [1, 2], "Fine, thanks. And you?"),
    ("a", 3): (3, 3, 2, 1, 2, [1, 2, 3], "Good too."), ("a", 4): (1, 1, 1, 1, 1, [1, 4], "Which one?"),
    ("a", 5): (1, 0, None, 5, 0, [5], "Hm."), ("a", None): (0, 0, None, None, 0, [None], ""),
    ("b", 1): (0, 0, None, 1, 0, [1], ""), ("b", 2): (1, 0, None, 2, 0, [2], "Quoted from elsewhere."),
}


def test_op10_links(spark):
    schema = "conv_id string, turn long, role string, text string, path string, _conv string"
    talk = spark.createDataFrame([(*r, "old", "old") for r in [*TALK, TALK[1]]], schema)
    got = quotation_links.link(talk).collect()
    assert Counter((r.conv_id, r.turn) for r in got) == Counter((c, t) for c, t, *_ in [*TALK, TALK[1]])
    for r in got:
        have = (r.n_quoted, r.n_linked, r.reply_to, r.root, r.depth, list(r.path), r.clean_text)
        if (r.conv_id, r.turn) == ("a", 2):  # the row stands twice, its quotation counts once
            assert have == LINKS["a", 2]
        else:
            assert have == LINKS[r.conv_id, r.turn]
        assert r.formatted == f"{r.role or 'unknown'}: {r.clean_text}"


def test_op10_long_chain(spark):
    """A chain of replies, each to the one before, is followed to its start."""
    talk = [("c", 1, "user", "Sentence number 1.")] + [("c", i, "user", f"> Sentence number {i - 1}.\nSentence number {i}.") for i in range(2, 40)]
    got = quotation_links.link(spark.createDataFrame(talk, "conv_id string, turn long, role string, text string")).collect()
    assert {r.turn: list(r.path) for r in got} == {i: list(range(1, i + 1)) for i in range(1, 40)}


def without_copies(rows):
    """The ids that stay of (id, text) rows: one for each class, the least id."""
    root, _ = op9([t for _, t in rows])
    best = {}
    for r, (d, _) in zip(root, rows, strict=True):
        best[r] = min(best.get(r, (True, 0)), (d is None, d or 0))
    return Counter(None if none else d for none, d in best.values())


def test_near_copies_stage(spark, edge_dir):  # noqa: F811
    docs = spark.read.parquet(f"{edge_dir}/documents.parquet")
    kept = corpus_pipeline.near_copies(spark, docs, edge_dir)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == without_copies(docs_of(spark, edge_dir))


def test_benchmark_stage(spark, edge_dir):  # noqa: F811
    docs = spark.read.parquet(f"{edge_dir}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{edge_dir}/benchmark.parquet").select("item_id", "text").collect()]
    rows = docs_of(spark, edge_dir)
    want = Counter(d for (d, _), x in zip(rows, op5([t for _, t in rows], items), strict=True) if not x[4])
    kept = corpus_pipeline.benchmark_passages(spark, docs, edge_dir)
    assert kept.columns == docs.columns and Counter(r.doc_id for r in kept.collect()) == want


def masked(text, spans):
    """`text` with each island of overlapping spans replaced by the kind of its first, longest span."""
    islands = []
    for start, stop, kind in sorted(spans, key=lambda s: (s[0], -s[1], s[2])):
        if islands and start < islands[-1][1]:
            islands[-1][1] = max(islands[-1][1], stop)
        else:
            islands.append([start, stop, kind])
    for start, stop, kind in reversed(islands):
        text = f"{text[:start]}[{kind.upper()}]{text[stop:]}"
    return text


def test_personal_data_stage(spark):
    texts = {
        1: None, 2: "", 3: "nothing in here", 4: "4111111111111111@example.org and 4111 1111 1111 1111.",
        5: "🙂 call +1 275 555 5927 or write to a.b@c.de, c.d@e.fg", 6: "10.0.0.25", 7: "café 192.168.1.1🙂+44 20 7946 0958",
    }
    docs = spark.createDataFrame([(d, t, 0, "kept") for d, t in texts.items()], "doc_id long, text string, n_chars int, key string")
    spans = {d: [] for d in texts}
    keys = {r.key: r.doc_id for r in docs.select("doc_id", candidate_pii.text_key(docs.text).alias("key")).collect() if texts[r.doc_id]}
    for r in candidate_pii.find(docs).collect():
        spans[keys[r.key]].append((r.start, r.stop, r.kind))
    got = corpus_pipeline.personal_data(spark, docs, SMALL)
    assert got.columns == docs.columns
    for r in got.collect():
        want = None if texts[r.doc_id] is None else masked(texts[r.doc_id], spans[r.doc_id])
        assert (r.text, r.n_chars, r.key) == (want, None if want is None else len(want), "kept")
    assert spans[4] and masked(texts[4], spans[4]) == "[EMAIL] and [CARD]."


def test_pipeline(spark):
    """The whole run against the plain versions, one stage after the other."""
    toxic = {r.doc_id for r in queries.QUERIES["op3_subsequence_kernel"](spark, SMALL).filter("predicted = 1").collect()}
    rows = [(d, t) for d, t in docs_of(spark, SMALL) if d not in toxic]
    kept = without_copies(rows)
    rows = [(d, t) for d, t in rows if d in kept]
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    want = Counter(d for (d, _), x in zip(rows, op5([t for _, t in rows], items), strict=True) if not x[4])
    got = corpus_pipeline.run(spark, SMALL).collect()
    assert Counter(r.doc_id for r in got) == want
    assert all(r.exact and len(r.token_ids) == 4 * r.n_tokens for r in got)


def test_edges_are_what_the_tests_assume():
    assert len(EDGES) > 15


def test_personal_data_learns_from_every_proposal(spark):
    """More base matches than any bound: each teaches or is held out, twice with its disguise; equal ones weigh their number."""
    texts = spark.range(12_000).select(F.format_string("write to m%d@site.org or m@x%d.net, not to m%d [at] odd [dot] com today", "id", "id", "id").alias("text"))
    rows = candidate_pii.proposals(texts, "text")
    rows = rows.withColumn("held", F.col("base") & candidate_pii.holds(F.col("kind"), F.col("match")))
    examples = candidate_pii.grouped(candidate_pii.examples_of(rows, candidate_pii.mark_overlaps(rows)))
    found = {r["label"]: (r["n"], r["rows"]) for r in examples.groupBy("label").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("rows")).collect()}
    assert found[1.0][0] == 48_000 and found[0.0][0] == 12_000 + 11_990  # the disguised ones, and digits that make no card
    assert found[1.0][1] < 1_000 and found[0.0][1] < 1_000
    assert [candidate_pii.bins(n) for n in (5, 10_000, 10_001, 90_000)] == [32, 32, 101, 300]
    assert all(candidate_pii.bins(n) ** 2 >= n for n in (10_001, 65_537, 10**7 + 1))


def test_toxicity_curve_is_fitted_on_every_labelled_text(spark):
    ids = spark.range(24_000)
    word = F.element_at(F.array(*map(F.lit, ("garden", "window", "market", "letter", "idiot"))), (F.pmod(F.xxhash64("id"), F.lit(5)) + 1).cast("int"))
    texts = ids.select(F.format_string("%s number %d here", word, F.col("id")).alias("text"), ((word == "idiot") != (F.col("id") % 50 == 0)).cast("int").alias("toxic"))
    model = string_kernel.train(texts)
    rows = string_kernel.with_features(texts, model).select("toxic", "_f").collect()
    x, y = np.array([[1.0, *r["_f"]] for r in rows]), np.array([r["toxic"] for r in rows], float)
    p = 1 / (1 + np.exp(-np.clip(x @ model.curve, -30, 30)))
    assert len(rows) == 24_000 and np.abs(x.T @ (y - p) - 0.1 * model.curve).max() < 1e-4  # the optimum over all of them
