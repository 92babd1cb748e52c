"""The queries of the operators against plain versions, on the smallest tables and on edge cases."""

import random
import struct
from collections import Counter

import pytest
from brute import BASE8, encoding, fold, lower, luhn, op1, op2, op4, op5, op8, op9, sha

from newsmill.llm import byte_bpe, components, fertility, queries

SMALL = "/root/testdata/sf0.001"
EDGES = [
    (1, None), (2, ""), (3, " \n\t "), (None, "no id here at all"), (5, "one"), (5, "one"),
    (6, "ab" * 900), (7, "x" * 1500), (8, "naïve café 日本語 🙂 end. " * 40), (9, "x" * 399), (10, "\x1f\x85 odd\xa0blanks here"),
    (11, "mail a.b@c.de_x@y.z or +1 (275) 555-5927, 4111 1111 1111 1111; 10.0.0.256 and 10.0.0.25 1.2.3.4.5"),
    (12, "The Quick brown fox jumps over the lazy dog and runs far away"), (13, "the quick brown fox jumps over the lazy dog and runs far away"),
    (14, "w " * 3000), (15, "line one\nline one\n\nline one\n" * 5), (16, "0" * 30 + ".1.2.3 " + "9" * 5000 + " @ " + "a." * 4000),
]


@pytest.fixture(scope="session")
def edge_dir(spark, tmp_path_factory):
    """Tables of edge cases, with NULLs, repeated rows, and columns whose names the operators use for their own results."""
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 6))) for _ in range(400)]
    base = [" ".join(rng.choices(words, k=rng.randint(60, 160))) for _ in range(12)]
    rows = list(EDGES)
    for i in range(70):
        w = rng.choice(base).split()
        for _ in range(rng.choice([0, 1, 1, 2, 6])):
            w[rng.randrange(len(w))] = rng.choice(words)
        rows.append((100 + i, " ".join(w)))
    folder = str(tmp_path_factory.mktemp("edges"))
    schema = "doc_id long, text string, score double, kept boolean, key string, n_words long, spans string, lang string, source string, n_chars long"
    spark.createDataFrame([(d, t, 1.5, None, "k", 7, None, None, "s", None) for d, t in rows], schema).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(d, 1, int(i % 7 == 0)) for i, (d, _) in enumerate(rows)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    items = [(1, base[0][:300]), (2, None), (3, ""), (4, "brown fox"), (4, "brown fox"), (None, "lazy dog and"), (10, base[0][:300].upper())]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


@pytest.fixture(scope="session")
def empty_dir(spark, edge_dir, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("empty"))
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{edge_dir}/{name}.parquet").limit(0).write.parquet(f"{folder}/{name}.parquet")
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(f"{folder}/conversations.parquet")
    return folder


@pytest.fixture(params=["small", "edges"])
def folder(request, edge_dir):
    return SMALL if request.param == "small" else edge_dir


def rows_of(spark, folder, name, columns):
    got = queries.QUERIES[name](spark, folder).select(*columns).collect()
    return sorted((tuple(r) for r in got), key=repr)


def docs_of(spark, folder):
    return [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]


def ordered(rows):
    return sorted(rows, key=repr)


def test_op1(spark, folder):
    docs = docs_of(spark, folder)
    want = [(d, *x) for (d, _), x in zip(docs, op1([t for _, t in docs]), strict=True)]
    assert rows_of(spark, folder, "op1_suffix_array", ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]) == ordered(want)


def test_op2(spark, folder):
    docs = docs_of(spark, folder)
    want = []
    for d, t in docs:
        n, *rest, repeated = op2(t)
        want.append((d, n, *rest, repeated, n < 20 or 100 * repeated > 30 * n))
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert rows_of(spark, folder, "op2_tokeniser_fertility", names) == ordered(want)
    assert queries.QUERIES["op2_tokeniser_fertility"](spark, folder).filter("kept AND base_failed OR kept IS NULL").isEmpty()


def test_op2_counts_of_long_words(spark):
    """A word of more tokens than 16 bits can count, in letters and in a script of single characters."""
    texts = ["x1" * 60_000, "\u8a9e\u6f22" * 45_000, "short words only"]
    found = fertility.rate(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"), queries.PIECES, queries.RANKS, queries.public_tokenizers.PATTERN)
    levels, own = encoding(), fertility.vocabularies(queries.PIECES, queries.RANKS, queries.public_tokenizers.PATTERN).pieces
    for r in found.collect():
        words = texts[r.doc_id].split()
        assert r.n_byte_tokens == sum(len(levels.encode_ordinary(" " + w)) for w in words)
        assert r.n_pieces == sum(len(own.encode(w)) for w in words)


def test_op3_rows(spark, folder):
    got = queries.QUERIES["op3_subsequence_kernel"](spark, folder).collect()
    assert Counter((r.doc_id, r.held_out) for r in got) == Counter((d, fold(d) == 0) for d, _ in docs_of(spark, folder))
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)


def test_op4(spark, folder):
    want = ordered(op4(docs_of(spark, folder)))
    got = rows_of(spark, folder, "op4_elias_fano_trie", ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(ordered(x[:5] + (round(x[5], 6),) for x in got), ordered(x[:5] + (round(x[5], 6),) for x in want), strict=True):
        assert g == pytest.approx(w) if g[0] is not None else True
    assert sorted(g[6] for g in got) == pytest.approx(sorted(w[6] for w in want), rel=2e-3, abs=0.01)


def test_op5(spark, folder):
    docs = docs_of(spark, folder)
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    want = [(d, *x) for (d, _), x in zip(docs, op5([t for _, t in docs], [i for i in items if i[0] is not None]), strict=True)]
    names = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    got = rows_of(spark, folder, "op5_positional_index", names)
    if folder == SMALL:
        assert got == ordered(want)
    else:  # an item without an id hits words and isn't listed
        hits = op5([t for _, t in docs], items)
        assert got == ordered((d, h[0], h[1], w[3], w[4], h[4]) for (d, _), h, w in zip(docs, hits, want, strict=True))


def test_op7(spark, folder):
    encode, want = encoding(), []
    for d, t in docs_of(spark, folder):
        ids = encode.encode_ordinary(t or "")
        want.append((d, len(ids), sha(struct.pack(f"<{len(ids)}I", *ids)), sha(encode.decode_bytes(ids))))
    assert rows_of(spark, folder, "op7_segment_tree_bpe", ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]) == ordered(want)


def test_op7_apart_and_together(spark, edge_dir):
    docs = spark.read.parquet(f"{edge_dir}/documents.parquet").select("doc_id", "text")
    pattern = queries.public_tokenizers.PATTERN
    apart = byte_bpe.decode(byte_bpe.encode(docs, queries.RANKS, pattern), queries.RANKS)
    together = byte_bpe.round_trip(docs, queries.RANKS, pattern)
    assert apart.columns == together.columns
    assert ordered(map(tuple, apart.collect())) == ordered(map(tuple, together.collect()))


def test_op8(spark, folder):
    want = {}
    for d, t in docs_of(spark, folder):
        spans = op8(t)
        want.setdefault(d, []).append((*(sum(s.startswith(k) for s in spans) for k in BASE8), sha(",".join(spans).encode()), spans))
    seen = 0
    for r in queries.QUERIES["op8_boosted_pii"](spark, folder).collect():
        all_ = r.spans.split(",") if r.spans else []
        assert any(tuple(r)[1:6] == w[:5] and set(w[5]) <= set(all_) for w in want[r.doc_id])
        assert all_ == sorted(all_, key=lambda s: (int(s.split(":")[1]), list(BASE8).index(s.split(":")[0])))
        seen += 1
    assert seen == sum(map(len, want.values()))


def test_op9(spark, folder):
    docs = docs_of(spark, folder)
    root, links = op9([t for _, t in docs])
    least = {}
    for r, (d, _) in zip(root, docs, strict=True):
        least[r] = min((x for x in (least.get(r), d) if x is not None), default=None)
    sizes = Counter(root)
    want = [(d, least[r], sizes[r], n) for (d, _), r, n in zip(docs, root, links, strict=True)]
    assert rows_of(spark, folder, "op9_chosen_path", ["doc_id", "class_id", "class_size", "n_links"]) == ordered(want)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_empty_tables(spark, empty_dir, name):
    assert queries.QUERIES[name](spark, empty_dir).count() == 0


def test_unsettled_components_fail(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long")
    assert {r.label for r in components.components(chain).collect()} == {0}
    with pytest.raises(RuntimeError, match="not settled"):
        components.components(chain, most_rounds=1)


def test_helpers_of_the_plain_versions():
    assert lower("ÀBC") == "Àbc" and luhn("4111111111111111")
