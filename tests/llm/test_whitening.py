import math
import random

import numpy as np
import pytest

from postroom.llm import whitening as W


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, n int, x string, size int")


def rows_of(rng, n, d=5):
    base = [[rng.gauss(0, 3) for _ in range(d)] for _ in range(d)]
    return [[sum(rng.gauss(0, 1) * b[j] for b in base) for j in range(d)] for _ in range(n)]


def test_scatter_is_exact():
    rng = np.random.default_rng(0)
    for high, rows in ((2, 1), (2, 64), (1000, 200), (2**40, 65)):
        x = rng.integers(0, high, (rows, 7))
        i, j = np.triu_indices(7)
        assert W.scatter(x) == [sum(int(a) * int(b) for a, b in zip(x[:, p], x[:, q])) for p, q in zip(i, j)]


@pytest.mark.parametrize("shift", [0.0, 1e4])
def test_whitened_against_numpy(spark, shift):
    rng = random.Random(2)
    vectors = [[float(np.float32(v + shift)) for v in r] for r in rows_of(rng, 300)]
    odd = [(900, None), (901, [1.0, None, 2.0, 3.0, 4.0]), (902, [1.0, float("nan"), 0.0, 0.0, 0.0]), (903, [float("inf")] * 5), (904, [])]
    rows = [(i, v, 1, "x", 2) for i, v in enumerate(vectors)] + [(None, vectors[0], 1, "x", 2), (0, vectors[0], 1, "x", 2)] + [(i, v, 1, "x", 2) for i, v in odd]
    got = W.whiten(table(spark, rows)).collect()
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for v in [*vectors, vectors[0], vectors[0]]]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    assert len(got) == n * 5 and {r["n"] for r in got} == {n} and None in {r["vec_id"] for r in got}
    cov = np.array([[(n * sum(a[i] * a[j] for a in x) - sums[i] * sums[j]) / n**2 for j in range(5)] for i in range(5)])
    value = np.linalg.eigvalsh(cov)[::-1]
    z = {(r["vec_id"], r["component"]): r["whitened"] for r in got}
    for k in range(5):
        assert abs([r["explained"] for r in got if r["component"] == k + 1][0] - value[k] / value.sum()) < 1e-9
    whole = np.array([[z[i, k + 1] for k in range(5)] for i in range(300)])
    # distances of whitened rows don't depend on the signs of axes
    far = np.array(x[:300], float) - np.array([s / n for s in sums])
    want = np.einsum("ij,jk,ik->i", far, np.linalg.inv(cov), far)
    assert np.allclose((whole**2).sum(1), want, rtol=1e-6)
    dev = {r["vec_id"]: r["deviation"] for r in got}
    assert all(dev[i] == sum((n * a - s) ** 2 for a, s in zip(x[i], sums)) for i in range(300))
    assert {r["identity_error"] for r in got}.pop() < 1e-6


def test_flat_dimensions_lengths_and_no_rows(spark):
    rows = [(i, [float(i), 2.0], 1, "x", 2) for i in range(20)] + [(100 + i, [float(i % 3)], 1, "x", 2) for i in range(9)]
    got = W.whiten(table(spark, rows)).collect()
    two = [r for r in got if r["n"] == 20]
    assert len(two) == 40 and all((r["whitened"] is None) == (r["component"] == 2) for r in two)
    assert len([r for r in got if r["n"] == 9]) == 9 and all(r["identity_error"] < 1e-9 for r in got)
    assert W.whiten(table(spark, [])).count() == 0
    one = W.whiten(table(spark, [(1, [3.0, 4.0], 1, "x", 2)])).collect()
    assert [(r["whitened"], r["deviation"], r["explained"], r["identity_error"]) for r in one] == [(None, 0, None, None)] * 2


def test_deviation_beyond_a_long_is_null(spark):
    got = W.whiten(table(spark, [(i, [1e15 * i], 1, "x", 2) for i in range(3)])).collect()
    assert {r["vec_id"]: r["deviation"] for r in got} == {0: None, 1: 0, 2: None}
