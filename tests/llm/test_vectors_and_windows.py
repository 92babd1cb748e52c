"""Clustering, neighbours and cross-tokeniser alignment against plain versions."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from test_contracts import EDGES, SMALL
from tokenizers import Tokenizer

from newsmill.llm import learned_partitions, pivot_clusters, queries, window_alignment

TENTH = "/root/testdata/sf0.1"


def vectors(spark, folder, rows, kind="float"):
    spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, cluster int, id string, k1 long").write.parquet(f"{folder}/embeddings.parquet")
    return str(folder)


def rows_of_edges(seed=5):
    """Groups of copies, ties, ids given twice, and vectors that take no part."""
    rng = np.random.default_rng(seed)
    far = lambda: rng.normal(0, 1, 64).astype(np.float32).tolist()
    hot, rows = far(), []
    for i in range(120):
        v = hot if i % 3 == 0 else far() if i % 5 else [float(int(x)) for x in rng.integers(-2, 3, 64)]
        rows.append((i, v, 1, "x", 2))
    rows += [rows[20], rows[40], (7, far(), 1, "x", 2)]
    broken = far()
    rows += [(500, None, 1, "x", 2), (501, [], 1, "x", 2), (502, far()[:63], 1, "x", 2), (503, [*broken[:63], None], 1, "x", 2),
             (504, [*broken[:63], float("nan")], 1, "x", 2), (505, [*broken[:63], float("-inf")], 1, "x", 2), (520, [0.0] * 64, 1, "x", 2)]
    return rows


@pytest.fixture(scope="module")
def edge_vectors(spark, tmp_path_factory):
    return vectors(spark, tmp_path_factory.mktemp("vectors"), rows_of_edges())


def clusters(rows, k=8, rounds=10):
    kept = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)]
    centres = [v for _, v in sorted(kept, key=lambda r: (hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))[:k]]

    def assigned():
        found = []
        for _, v in kept:
            d = [sum((x - y) ** 2 for x, y in zip(v, c, strict=True)) for c in centres]
            found.append((d.index(min(d)), min(d)))
        return found

    for _ in range(rounds):
        own = assigned()
        for c in range(len(centres)):
            members = [v for (_, v), (a, _) in zip(kept, own, strict=True) if a == c]
            if members:
                centres[c] = [sum(x) // len(members) for x in zip(*members, strict=True)]
    own = assigned()
    inertia = Counter()
    for c, d in own:
        inertia[c] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted((i, c, d, inertia[c], sum(inertia.values()), digest[c]) for (i, _), (c, d) in zip(kept, own, strict=True))


def plain_vectors(spark, folder):
    return [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]


def test_op11(spark, edge_vectors):
    got = queries.QUERIES["op11_pivot_table"](spark, edge_vectors).collect()
    assert sorted(map(tuple, got)) == clusters(plain_vectors(spark, edge_vectors))
    assert len(got) == 124  # all that have 64 finite components, the zero vector among them


def test_bounds_save_distances(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 1, (6, 64))
    rows = [(i, (centres[i % 6] + rng.normal(0, 0.01, 64)).tolist()) for i in range(300)]
    found = pivot_clusters.cluster(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=6)
    assert found.assigned.agg(F.avg("n_exact")).first()[0] < 3
    assert sum(found.sizes) == 300


def test_large_components(spark):
    big = float(2**17)  # 2^27 once scaled: squares of differences just fit a long
    rows = [(1, [big] * 64), (2, [-big] * 64), (3, [big * 2] * 64)]
    found = pivot_clusters.cluster(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=1, rounds=0)
    assert sorted(r.distance for r in found.assigned.collect()) == [0, 64 * 2**56]


def nearest(rows, n=20):
    """Per query row: ids and scores of its neighbours, sums in the order of components."""
    kept = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    every, ids = np.array([v for _, v in kept]), np.array([i for i, _ in kept])
    out = []
    for at, (i, v) in enumerate(kept):
        if i % 20 == 0:
            score = np.zeros(len(kept))
            for d in range(64):
                score += v[d] * every[:, d]
            order = [j for j in np.lexsort([ids, -score]) if j != at][:n]
            out.append((i, [(int(ids[j]), float(score[j])) for j in order]))
    return out


def test_op13_small_tables_are_exact(spark, edge_vectors):
    got = defaultdict(list)
    for r in queries.QUERIES["op13_learned_partitions"](spark, edge_vectors).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    want = defaultdict(list)
    for i, near in nearest(plain_vectors(spark, edge_vectors)):
        want[i] += [(rank, *pair) for rank, pair in enumerate(near, 1)]
    assert {i: sorted(x) for i, x in got.items()} == {i: sorted(x) for i, x in want.items()}


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01", TENTH])
def test_op13_recall(spark, folder):
    got = defaultdict(dict)
    for r in queries.QUERIES["op13_learned_partitions"](spark, folder).collect():
        got[r.query_id][r.vec_id] = r.score
    found = total = 0
    for i, near in nearest(plain_vectors(spark, folder)):
        assert len(got[i]) == 20 and i not in got[i]
        found += sum(got[i].get(j) == score for j, score in near)
        total += len(near)
    assert found >= 0.95 * total


def test_parts_are_visited_sparingly_where_neighbours_gather():
    rng = np.random.default_rng(2)
    centres = rng.normal(0, 1, (64, 64))
    sample = centres[rng.integers(0, 64, 8192)] + rng.normal(0, 0.05, (8192, 64))
    router = learned_partitions.fit(sample, 16 * learned_partitions.PART_ROWS, 20, 0.97)
    chances = learned_partitions.probabilities(router.layers, sample)
    assert router.parts == 16 and learned_partitions.visited(chances, router.share).sum(1).mean() < 6
    sizes = np.bincount(chances.argmax(1), minlength=16)
    assert sizes.max() < 2 * sizes.mean()


def test_search_of_few_rows(spark):
    rows = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [0.5, 0.5]), (0, [1.0, 2.0])], "vec_id long, embedding array<double>")
    got = learned_partitions.search(rows, F.col("vec_id") == 0).collect()
    assert sorted(map(tuple, got)) == sorted([(0, 1, 0, 5.0), (0, 2, 1, 5.0), (0, 3, 2, 1.5)] * 2)


def test_empty_vectors(spark, tmp_path):
    folder = vectors(spark, tmp_path, [])
    for name in ("op11_pivot_table", "op13_learned_partitions"):
        assert queries.QUERIES[name](spark, folder).isEmpty()


def alignments(docs):
    """Rows of the contract, from the public libraries one text at a time."""
    ours = Tokenizer.from_file(queries.MERGES)
    ours.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=queries.PIECES)
    letters = window_alignment.byte_letters()
    held, every, out = Counter(), [], []
    for d, text in docs:
        a, b, groups, links, ends = [], [], [], [], []
        if text:
            a, b = ours.encode(" " + text, add_special_tokens=False).ids, pieces.encode(text)
            of_a = [bytes(letters[c] for c in ours.id_to_token(i)) for i in a]
            of_b = [bytes([int(pieces.id_to_piece(i)[3:5], 16)]) if pieces.is_byte(i) else pieces.id_to_piece(i).replace("▁", " ").encode() for i in b]
            whole = (" " + text).encode()
            if b"".join(of_a) != whole or b"".join(of_b) != whole:
                a, b = [], []
            else:
                ends_a, ends_b = (list(np.cumsum([len(x) for x in of])) for of in (of_a, of_b))
                ends = sorted(set(ends_a) & set(ends_b))
                x = y = 0
                for end in ends:
                    x_to, y_to = ends_a.index(end, x) + 1, ends_b.index(end, y) + 1
                    groups.append(",".join(map(str, a[x:x_to])) + "|" + ",".join(map(str, b[y:y_to])))
                    links += [(i, j) for i in a[x:x_to] for j in b[y:y_to]]
                    x, y = x_to, y_to
        held.update(set(links))
        every.append(links)
        out.append((d, len(a), len(b), len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
    most = defaultdict(int)
    for (i, _), n in held.items():
        most[i] = max(most[i], n)
    rows = [(d, a, b, g, len(links), sum(held[p] == most[p[0]] for p in links), sum(held[p] for p in links), digest)
            for (d, a, b, g, digest), links in zip(out, every, strict=True)]
    return sorted(rows, key=repr), {(*p, n, n == most[p[0]]) for p, n in held.items()}


NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = [(50, "▁ marks of its own"), (51, "<|endoftext|> and </s><unk> <0x41>"), (52, "a\x00b\x01"), (53, "  two   blanks \t\n\n x　y "), (54, "日本語のテキスト" * 40),
       (55, "ｆｕｌｌ ﬁne é é ½ 🏳️‍🌈"), (56, "0123456789" * 200), (57, "'s 't're"), (58, "loooooooong" + "o" * 9000), (59, "\U0010ffff� ")]


@pytest.mark.parametrize("source", ["small", "edges"])
def test_op12(spark, source, tmp_path):
    if source == "small":
        folder = SMALL
    else:
        folder = str(tmp_path)
        schema = "doc_id long, text string, n_a string, _row string, n_best int"
        spark.createDataFrame([(d, t, "x", "y", 3) for d, t in EDGES + ODD], schema).write.parquet(f"{folder}/documents.parquet")
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.QUERIES["op12_anchor_windows"](spark, folder)
    assert sorted(map(tuple, got.select(NAMES).collect()), key=repr) == alignments(docs)[0]


def test_alignment_keeps_columns_and_counts_pairs(spark):
    docs = [("a", "one two two"), ("b", "two words"), ("b", "two words"), ("c", None)]
    frame = spark.createDataFrame([(d, t, "kept", 9) for d, t in docs], "name string, text string, _packet string, n_links int")
    measured, pairs = window_alignment.align(frame, queries.MERGES, public_tokenizers.PATTERN, queries.PIECES)
    assert measured.columns == ["name", "_packet", *NAMES[1:]]
    rows, linked = alignments(docs)
    assert sorted((r.name, *r[2:]) for r in measured.collect()) == rows
    assert {tuple(r) for r in pairs.collect()} == linked


def test_long_groups_are_counted_alike(monkeypatch):
    align = window_alignment.aligner(queries.MERGES, public_tokenizers.PATTERN, queries.PIECES)
    texts = ["日本語 and ½½½ words", "é́́ ﬁ" * 9]
    whole = window_alignment.packet(texts, align)
    monkeypatch.setattr(window_alignment, "LONG_GROUP", 1)
    monkeypatch.setattr(window_alignment, "LONG_WINDOW", 2)
    again = window_alignment.packet(texts, align)
    assert whole.digests == again.digests and (whole.pairs == again.pairs).all() and (whole.at == again.at).all() and (whole.times == again.times).all()


def test_packets_do_not_change_counts(spark, monkeypatch):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    one = window_alignment.align(docs, queries.MERGES, public_tokenizers.PATTERN, queries.PIECES)[0]
    monkeypatch.setattr(window_alignment, "PACKET_BYTES", 20_000)
    other = window_alignment.align(docs.repartition(3), queries.MERGES, public_tokenizers.PATTERN, queries.PIECES)[0]
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, other.collect()))


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert queries.QUERIES["op12_anchor_windows"](spark, str(tmp_path)).isEmpty()


def test_both_byte_level_libraries_agree(tmp_path):
    import json

    spec = json.load(open(queries.MERGES))
    spec["pre_tokenizer"]["use_regex"] = True
    spec["normalizer"] = {"type": "NFC"}  # more than the faster library does
    (tmp_path / "t.json").write_text(json.dumps(spec))
    fast, slow = (window_alignment.byte_level(p, public_tokenizers.PATTERN) for p in (queries.MERGES, str(tmp_path / "t.json")))
    texts = [t for _, t in EDGES + ODD if t and "́" not in t]
    assert fast.encode(texts) == slow.encode(texts) and fast.entries == slow.entries
