import random

import numpy as np
import pytest

from postroom.llm import minhash as M

from .conftest import prose

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def shingles(text, n):
    w = (text or "").encode().translate(LOWER).split()
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def brute(rows, n=2, percent=80):
    """Rows (doc_id, text) with set size, the smallest id of their component, and kept."""
    sets = [shingles(t, n) for _, t in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * min(len(a), len(sets[j])) >= percent * max(len(a), len(sets[j])):
                shared = len(a & sets[j])
                if 100 * shared >= percent * (len(a) + len(sets[j]) - shared):
                    label[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = root(i)
        least[r] = min((x for x in (least.get(r), d) if x is not None), default=None)
    return sorted(((d, len(s), least[root(i)], d == least[root(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=str)


def corpus(rng, groups, members, words=60):
    """Groups of near copies around the limit, with passages that many texts share."""
    passage = prose(rng, 25)
    rows = []
    for _ in range(groups):
        base = prose(rng, rng.randint(3, words)).split()
        if rng.random() < 0.4:
            base += passage.split()
        for _ in range(rng.randint(1, members)):
            w = list(base)
            for _ in range(rng.randint(0, 1 + len(w) // 12)):
                w[rng.randrange(len(w))] = prose(rng, 1)
            rows.append(" ".join(w).upper() if rng.random() < 0.2 else "  ".join(w))
    return list(enumerate(rows))


@pytest.mark.parametrize("short_rows, part_rows, part_values", [(64, 4096, 1_000_000), (1, 6, 100)])
def test_components_equal_brute_force(spark, short_rows, part_rows, part_values):
    rows = corpus(random.Random(short_rows), 40, 12)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(M.near_duplicates(df, 2, short_rows=short_rows, part_rows=part_rows, part_values=part_values)) == brute(rows)


def test_long_texts_and_a_large_group(spark):
    rng = random.Random(5)
    base = prose(rng, 400).split()
    rows = []
    for i in range(300):
        w = list(base)
        for _ in range(rng.randint(0, 40)):
            w[rng.randrange(400)] = prose(rng, 1)
        rows.append((1000 - i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(M.near_duplicates(df, 2, short_rows=20)) == brute(rows)


def test_table(odd_docs, odd_rows, no_docs):
    rows = [(i, t) for i, t, _, _ in odd_rows]
    assert got(M.near_duplicates(odd_docs, 2)) == brute(rows)
    assert M.near_duplicates(no_docs, 2).count() == 0


def test_ids_that_are_null_or_shared(spark):
    rows = [(None, "a b c d e f g h"), (None, "a b c d e f g h"), (None, "x y z"), (4, "q r s t"), (4, "a b c d e f g h"), (4, "m n o"), (9, "a b c d e f g h i")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(M.near_duplicates(df, 2)) == [(4, 2, 4, True), (4, 3, 4, True), (4, 7, 4, True), (9, 8, 4, False), (None, 2, None, True), (None, 7, 4, False), (None, 7, 4, False)]


def test_union_sketch_and_its_bound():
    rng = np.random.default_rng(0)
    for size in (20, 60, 500):
        a = rng.integers(0, 2**63, size, dtype=np.uint64)
        b = np.concatenate([a[: size * 9 // 10], rng.integers(0, 2**63, size // 10, dtype=np.uint64)])
        x, y = np.unique(a), np.unique(b)
        low = np.union1d(x, y)[: M.SKETCH]
        want = np.isin(low, x) & np.isin(low, y)
        sig = [M.values([M.signature(s)]) for s in (x, y)]
        assert M.union_sketch(*sig)[0][0] == want.sum()
        if max(len(x), len(y)) <= M.SKETCH:
            assert M.union_sketch(*sig)[1][0] == len(np.intersect1d(x, y))
    assert M.least_common(32) == 10 and 25 < M.least_common(64) < 36 and M.SKETCH >= M.KEYS and M.least_common(32, 100) == 32
