import random
from collections import Counter

import numpy as np

from postroom.llm import common, quality_rules as Q

from .conftest import frame, prose


def brute(t):
    t = t or ""
    w = [x.decode() for x in t.encode().split()]
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    n = Counter(windows)
    inside = {k for i, x in enumerate(windows) if n[x] > 1 for k in range(i, i + 5)}
    lines = [x for x in t.split("\n") if x.encode().split()]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(inside)


def test_statistics(odd_docs, odd_rows, no_docs):
    got = Counter(tuple(r)[:6] for r in Q.quality_rules(odd_docs).collect())
    assert got == Counter((i, *brute(t)) for i, t, _, _ in odd_rows)
    assert Q.quality_rules(no_docs).count() == 0


def test_random_statistics():
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab  \n\x1c #é") for _ in range(rng.randint(0, 80))) for _ in range(500)]
    found = Q.statistics(texts)
    for i, t in enumerate(texts):
        assert tuple(int(found[k][i]) for k in Q.BASE) == brute(t), repr(t)


def test_outliers_go_and_clean_rows_stay(spark):
    rng = random.Random(4)
    rows = [(i, prose(rng, rng.randint(12, 400)), "en", "hot" if i % 3 else f"s{i % 7}") for i in range(400)]
    bad = [(1000 + i, " ".join(w + "***" for w in prose(rng, 80).split()), "en", "hot") for i in range(15)]
    bad += [(2000 + i, prose(rng, 80).upper().replace(" ", "!! "), "en", "s1") for i in range(15)]
    got = {r["doc_id"]: r for r in Q.quality_rules(frame(spark, rows + bad)).collect()}
    assert all(got[i]["kept"] for i, t, _, _ in rows)
    assert not any(got[i]["kept"] for i, _, _, _ in bad)


def lowest(v, q):
    return np.sort(v)[max(0, int(np.ceil(q * len(v))) - 1)]


FLOOR = np.array(list(Q.FEATURES.values()))


def brute_fit(rows, center):
    y = rows - center
    cov = (y.T @ y / len(y) - np.outer(y.mean(0), y.mean(0))) * Q.CONSISTENCY + np.diag(FLOOR**2)
    return center + y.mean(0), np.linalg.inv(cov), np.linalg.slogdet(cov)[1]


def brute_step(x, fit):
    d = np.einsum("ni,ij,nj->n", x - fit[0], fit[1], x - fit[0])
    return brute_fit(x[d <= lowest(d, Q.SHARE)], fit[0])


def brute_starts(x):
    center = np.array([lowest(c, 0.5) for c in x.T])
    spread = np.array([max((lowest(c, 0.75) - lowest(c, 0.25)) / 1.349, f) for c, f in zip(x.T, FLOOR)])
    z = (x - center) / spread
    size = np.maximum(np.sqrt((z * z).mean(1)), 1e-9)[:, None]
    scatters = [x, center + np.tanh(z) * spread, center + (x - center) / size]
    return [(center, np.diag(1 / spread**2), np.inf), *(brute_fit(y, center) for y in scatters)]


def brute_estimate(x):
    tried = [brute_step(x, brute_step(x, s)) for s in brute_starts(x)]
    found = min(tried, key=lambda f: f[2])
    while (after := brute_step(x, found))[2] < found[2] - Q.STILL:
        found = after
    return found, tried


def test_estimates_have_the_least_determinant(spark):
    rng = random.Random(5)
    rows = [(i, prose(rng, rng.randint(12, 300)) + " |" * (i % 11 == 0), "en", "a") for i in range(150)]
    rows += [(1000 + i, prose(rng, rng.randint(12, 90)) + ("!! " * 20 if i % 3 == 0 else ""), "de", "b") for i in range(120)]
    vectors = common.staged(Q._keyed(Q.transformed(Q.document_statistics(frame(spark, rows)))), "vectors")
    held = {}
    for r in vectors.collect():
        held.setdefault(r["key"], []).append([r[f] for f in Q.FEATURES])
    got = {r["key"]: r for r in Q.estimates(vectors).collect()}
    assert set(got) == set(held) and len(got) == 2
    for key, x in held.items():
        (center, precision, log_det), tried = brute_estimate(np.array(x))
        r = got[key]
        assert abs(r["log_det"] - log_det) < 1e-6
        assert all(r["log_det"] <= f[2] + 1e-6 for f in tried)
        np.testing.assert_allclose(r["center"], center, rtol=1e-6, atol=1e-9)
        np.testing.assert_allclose(r["precision"], [precision[i, j] for i, j in Q.PAIRS], rtol=1e-4, atol=1e-4)


def test_a_cluster_of_outliers_does_not_hold_the_estimate(spark):
    """A fifth of the rows lie together beside the line that the others are spread along."""
    rng = np.random.default_rng(3)
    n, p = 400, len(Q.FEATURES)
    x = rng.normal(size=(n, p)) * 0.5
    x[:, 1] = x[:, 0] * 2 + rng.normal(size=n) * 0.05
    x[: n // 5, 0], x[: n // 5, 1] = 2 + rng.normal(size=n // 5) * 0.05, -4 + rng.normal(size=n // 5) * 0.05
    vectors = spark.createDataFrame([("k", *map(float, v)) for v in x], ["key", *Q.FEATURES])
    (r,) = Q.estimates(vectors).collect()
    precision = np.zeros((p, p))
    for k, (i, j) in enumerate(Q.PAIRS):
        precision[i, j] = precision[j, i] = r["precision"][k]
    d = np.einsum("ni,ij,nj->n", x - r["center"], precision, x - r["center"])
    assert (d[: n // 5] > Q.CUTOFF).all() and (d[n // 5 :] > Q.CUTOFF).mean() < 0.05
    assert Q.estimates(vectors.limit(0)).count() == 0


def test_chi_squared():
    assert abs(Q.chi2_cdf(Q.chi2_quantile(0.95, 6), 6) - 0.95) < 1e-9
    assert abs(Q.chi2_quantile(0.95, 2) - 5.991) < 1e-3


def test_short_junk_goes(spark):
    rng = random.Random(6)
    rows = [(i, prose(rng, rng.randint(12, 400)), "en", "a") for i in range(300)]
    bad = [(1000 + i, prose(rng, 25).upper().replace(" ", "!! ") + "!!", "en", "a") for i in range(5)]
    bad += [(2000 + i, " ".join(w + " |" for w in prose(rng, 30).split()), "en", "a") for i in range(5)]
    got = {r["doc_id"]: r for r in Q.quality_rules(frame(spark, rows + bad)).collect()}
    assert all(got[i]["kept"] for i, *_ in rows)
    assert not any(got[i]["kept"] for i, *_ in bad)
