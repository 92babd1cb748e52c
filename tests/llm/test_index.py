"""The positional index against plain searches: phrases by document and place, and terms close by."""

import random
import re

import pytest
from brute import WORD5, lower

from newsmill.llm import positional_index as pi


def split(text):
    return re.findall(WORD5, lower(text))


def windows_of(items, size):
    found = set()
    for _, text in items:
        w = split(text)
        found |= {tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()
    return found


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(11)
    words = ["the", "of", "a"] * 6 + [f"w{i}" for i in range(30)]
    items = [(i, " ".join(rng.choices(words, k=rng.choice([1, 2, 3, 9, 10, 14])))) for i in range(25)]
    items += [(90, "the the the the"), (91, "of of"), (92, "nowhere"), (93, None), (94, "the zzz of")]
    docs = []
    for i in range(120):
        w = rng.choices(words, k=rng.randint(0, 80))
        for _, text in rng.sample(items, 2):
            part = split(text)
            if rng.random() < 0.3:
                rng.shuffle(part)
            w[rng.randint(0, len(w)):0] = part
        docs.append((i, " ".join(w)))
    docs += [(200, None), (201, ""), *[(300 + i, docs[0][1]) for i in range(40)]]
    return docs, items


def index_of(spark, tables, size):
    docs, items = tables
    return pi.build(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), size=size)


@pytest.mark.parametrize("small", [True, False])
@pytest.mark.parametrize("size", [1, 2, 10])
def test_phrases_and_neighbours(spark, tables, monkeypatch, size, small):
    if not small:  # the way of larger inputs: salted terms, filtered and shuffled lists
        monkeypatch.setattr(pi, "BROADCAST_ROWS", 0)
    docs, items = tables
    index = index_of(spark, tables, size)
    names = {r.window: tuple(x.term for x in sorted(r.ranked, key=lambda x: x.offset)) for r in index.windows.collect()}
    ids = {r.id: r.key for r in index.tokens.collect()}
    got = sorted((r.key, names[r.window], r.start) for r in pi.phrases(index).collect())
    want, close = set(), set()
    counts = {}
    for _, text in docs:
        for w in split(text):
            counts[w] = counts.get(w, 0) + 1
    for d, text in docs:
        w = split(text)
        for window in windows_of(items, size):
            want |= {(ids[d], window, i) for i in range(len(w) - len(window) + 1) if tuple(w[i:i + len(window)]) == window}
            if all(t in counts for t in window):
                rarest = min(range(len(window)), key=lambda i: (counts[window[i]], i))
                n = len(window)
                for at in (i for i, x in enumerate(w) if x == window[rarest]):
                    if len(set(w[max(0, at - n + 1):at + n]) & set(window)) >= 0.8 * len(set(window)):
                        close.add((ids[d], window))
    assert got == sorted(want) and want
    assert {(r.key, names[r.window]) for r in pi.near(index).collect()} == close


def test_lists_hold_every_occurrence_of_test_terms(spark, tables):
    docs, items = tables
    index = index_of(spark, tables, 10)
    terms = {x for _, t in items for x in split(t)}
    assert index.postings.count() == sum(x in terms for _, t in docs for x in split(t))
    assert "words" not in index.tokens.columns
