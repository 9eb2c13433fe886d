import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from postroom.llm import periodic_runs as P


def brute(w):
    """All runs of one document, lag by lag."""
    n, out = len(w), []
    for q in range(1, n // 3 + 1):
        x = 0
        while x < n - q:
            if w[x] != w[x + q]:
                x += 1
                continue
            y = x
            while y < n - q and w[y] == w[y + q]:
                y += 1
            s, e = x, y + q
            if e - s >= max(24, 3 * q) and not any(all(w[i] == w[i + d] for i in range(s, e - d)) for d in range(1, q)):
                out.append((s, e - s, q))
            x = y + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def found(docs, **kw):
    size = np.array([len(d) for d in docs], np.int64)
    flat = np.array([x for d in docs for x in d], np.int64)
    rows = P.runs(flat, np.cumsum(size) - size, size, **kw)
    return [[tuple(r[1:]) for r in rows.tolist() if r[0] == d] for d in range(len(docs))]


def made(rng):
    """Noise with repetitions in it, of a small alphabet, so that runs touch and overlap."""
    out = []
    for _ in range(rng.randint(1, 6)):
        if rng.random() < 0.4:
            out += [rng.randint(0, 3) for _ in range(rng.randint(0, 30))]
        else:
            q = rng.choice([1, 2, 3, 4, 5, 7, 8, 9, 12, 15, 16, 17, 24, 31, 33])
            root = [rng.randint(0, rng.choice([1, 2, 5])) for _ in range(q)]
            out += (root * 40)[: rng.randint(q, max(30, 5 * q))]
    return out


def test_runs_equal_brute_force():
    rng = random.Random(7)
    docs = [made(rng) for _ in range(400)] + [[], [1], [1] * 23, [1] * 24, [1] * 300, [0, 1] * 12, [0, 1] * 11 + [0], ([0] * 9 + [1]) * 3, ([0] * 9 + [1]) * 3 + [0]]
    assert found(docs) == [brute(d) for d in docs]


def test_roots_whose_seeds_all_recur_within_them():
    rng = random.Random(1)
    a, b = [rng.randint(0, 9) for _ in range(20)], [rng.randint(0, 9) for _ in range(20)]
    docs = [(a + a + b + a + b + b) * 4, (a + a + b) * 3 + (a + a + b + b) * 3, (a * 5 + b) * 3 + a * 5]
    assert found(docs) == [brute(d) for d in docs]


def test_wrong_digests_change_nothing(monkeypatch):
    """Digests that say equal too often: stretches are compared word by word."""
    monkeypatch.setattr(P.Digests, "at", lambda self, begin, size: np.zeros(len(begin), np.int64) + 0 * begin)
    rng = random.Random(9)
    docs = [[rng.randint(0, 2) for _ in range(10)] + [5, 6, 7] * 9 + [rng.randint(0, 2) for _ in range(10)]]
    assert found(docs) == [brute(d) for d in docs]


def test_one_word_a_hundred_thousand_times():
    assert found([[0] * 100_000, [0, 1, 2] * 50_000]) == [[(0, 100_000, 1)], [(0, 150_000, 3)]]


def want(doc_id, text):
    w = (text or "").encode().split()
    n = len(w)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[a + (i - a) % p] if i >= a else w[i] for i in range(n)]
    got = brute(w)
    best = min(got, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    drop = {i for s, k, q in got for i in range(s + q, s + k)}
    return (
        doc_id, len(got), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
        hashlib.sha256("".join(f"{s},{k},{q}\n" for s, k, q in got).encode()).hexdigest(),
        hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in drop)).hexdigest(),
    )


def key(row):
    return tuple(str(x) for x in row)


def test_table(spark, odd_docs, odd_rows, no_docs):
    long = {5}  # brute force of 20,000 words takes minutes
    got = sorted((tuple(r) for r in P.periodic_runs(odd_docs, plant=True).collect() if r[0] not in long), key=key)
    assert got == sorted((want(i, t) for i, t, _, _ in odd_rows if i not in long), key=key)
    assert P.periodic_runs(no_docs, plant=True).count() == 0


@pytest.mark.parametrize("plant", [True, False])
def test_texts_with_runs(spark, plant):
    rng = random.Random(4)
    rows = [(i, " ".join(f"w{x}" for x in made(rng))) for i in range(120)]
    got = sorted(tuple(r) for r in P.periodic_runs(spark.createDataFrame(rows, "doc_id long, text string"), plant).collect())
    expected = sorted(want(i if plant else None, t)[1:] for i, t in rows)
    assert sorted(r[1:] for r in got) == expected
