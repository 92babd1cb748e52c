"""What a Python worker holds at once beyond its input: bounded pieces, and the same results as in one piece."""

import tracemalloc

import numpy as np
import pyarrow as pa

from newsmill.llm import chosen_path, string_kernel


def peak_of(work) -> tuple[object, float]:
    """What `work` returns, and the most MB it held beyond what was there."""
    tracemalloc.start()
    try:
        made = work()
        return made, tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def kernel_model() -> string_kernel.Model:
    weights = np.random.default_rng(1).normal(size=string_kernel.SYMBOLS ** 3)
    return string_kernel.Model(weights, -0.1, np.array([0.1, 0.5, 0.2, 0.1]))


def words(n: int) -> list[str]:
    rng = np.random.default_rng(2)
    return ["".join(map(chr, row)) for row in rng.integers(97, 123, (n, 8))]


def test_decisions_on_many_words():
    model, some = kernel_model(), [*words(50_000), "x" * 60_000, "", "é1-字"]
    found, mb = peak_of(lambda: model.decisions(some))
    assert mb < 100  # 237 MB when all words were split into triples at once
    which, triple, weight = string_kernel.triples(some)
    assert (found == np.bincount(which, weight * model.weights[triple], len(some)) + model.offset).all()
    assert len(model.decisions([])) == 0


def test_remembered_decisions_are_bounded():
    model, known = kernel_model(), {}
    some = words(300_000)
    for i in range(0, len(some), 20_000):
        string_kernel.features_of([" ".join(some[i:i + 20_000])], model, known)
    assert len(known) <= 200_000
    again = string_kernel.features_of([" ".join(some[:50])], model, known)
    assert (again == string_kernel.features_of([" ".join(some[:50])], model, {})).all()


def test_large_cell_of_sets():
    """Two thousand sets in one cell, in 50 groups of near copies; sides keep pairs of one block apart."""
    n, rng = 2_000, np.random.default_rng(3)
    base = [rng.integers(0, 1 << 62, 40, dtype=np.int64) for _ in range(50)]
    sets = [np.r_[base[i % 50][:40 - i % 4], rng.integers(0, 1 << 62, i % 4, dtype=np.int64)] for i in range(n)]
    side, copies = rng.integers(0, 3, n), rng.integers(1, 5, n)
    keys = [b"%06d" % i for i in range(n)]
    batch = pa.RecordBatch.from_pydict({
        "set_key": pa.array(keys, pa.binary()), "cell": pa.array(["c"] * n), "side": pa.array(side, pa.int32()),
        "copies": pa.array(copies), "hashes": pa.array(sets, pa.list_(pa.int64()))})
    found, mb = peak_of(lambda: pa.Table.from_batches(list(chosen_path.compare_sets(iter([batch])))).to_pydict())
    assert mb < 75  # 102 MB when all pairs of a cell were judged at once
    linked, label = np.zeros(n, int), list(range(n))
    near = []
    for i in range(n):
        for j in range(i % 50, n, 50):
            common = len(np.intersect1d(sets[i], sets[j]))
            if i != j and (side[i] == 2 or side[j] == 2 or side[i] != side[j]) and common >= 0.8 * (80 - common):
                linked[i] += copies[j]
                near.append((i, j))
    moved = True
    while moved:
        moved = False
        for i, j in near:
            if label[j] < label[i]:
                label[i], moved = label[j], True
    assert found["links"] == linked.tolist()
    assert found["b"] == [keys[x] for x in label]
