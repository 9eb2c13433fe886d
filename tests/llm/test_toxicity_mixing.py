import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from postroom.llm import common, mixing, toxicity

from .conftest import frame, prose

BAD = ["grumf", "snarkle", "blorpid", "zwackel"]


@pytest.fixture(scope="module")
def toxic_rows():
    rng = random.Random(1)
    rows = []
    for i in range(260):
        words = prose(rng, rng.randint(5, 150)).split()
        if i % 4 == 0:
            for _ in range(3):
                words.insert(rng.randrange(len(words) + 1), rng.choice(BAD) + rng.choice(["", ",", "."]))
        rows.append((i, " ".join(words), "en", "a"))
    return rows


def test_gradients_are_the_slopes():
    net = toxicity.Network(["aa", "bb"], ["<aa", "aa>", "<bb"], seed=1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    words = net.features(["", "aa", "bb", "cc"])
    rng = np.random.default_rng(0)
    at, target = rng.integers(0, 4, (6, 5)), rng.integers(0, 2, 6).astype(float)
    at[0, :4] = range(4)

    def loss():
        logit, _ = net.forward(net.project(net.inputs(*words).astype(np.float64)), at)
        p = toxicity._sigmoid(logit)
        return float(-(target * np.log(p) + (1 - target) * np.log(1 - p)).mean())

    grad = net.gradients(words, at, target)
    for k, v in net.p.items():
        where = [tuple(rng.integers(0, n) for n in v.shape) for _ in range(6)]
        for w in where:
            if k in ("word", "gram") and w[0] == 0:
                continue
            held = v[w]
            v[w] = held + 1e-3
            up = loss()
            v[w] = held - 1e-3
            down = loss()
            v[w] = held
            assert abs((up - down) / 2e-3 - grad[k][w]) < 2e-4, k


def brute_score(net, text):
    """One word after the other, in double precision."""
    p = {k: v.astype(np.float64) for k, v in net.p.items()}
    words = toxicity.words_of(text)
    n, w, h = len(words), toxicity.WINDOW, toxicity.HIDDEN

    def read(word):
        if not word:
            return np.zeros(p["word"].shape[1] + p["gram"].shape[1])
        known = [p["gram"][net.grams[g]] for g in toxicity.grams(word) if g in net.grams]
        return np.concatenate([p["word"][net.words.get(word, 1)], np.mean(known, axis=0) if known else np.zeros(p["gram"].shape[1])])

    def sigmoid(x):
        return 1 / (1 + np.exp(-x))

    def walk(side, seq):
        state, out = np.zeros(h), []
        for x in seq:
            given, kept = x @ p["in"][side] + p["bias"][side, 0], state @ p["state"][side]
            update, reset = sigmoid(given[:h] + kept[:h]), sigmoid(given[h : 2 * h] + kept[h : 2 * h])
            state = (1 - update) * np.tanh(given[2 * h :] + reset * kept[2 * h :]) + update * state
            out.append(state)
        return out

    scores = []
    for begin in [0] if n <= w else [*range(0, n - w, toxicity.STRIDE), n - w]:
        seq = [read(x) for x in (words[begin : begin + w] + [""] * w)[:w]]
        both = [np.concatenate(x) for x in zip(walk(0, seq), walk(1, seq[::-1])[::-1])]
        worth = np.exp([np.tanh(x @ p["att"]) @ p["query"] for x in both])
        pooled = sum(a * x for a, x in zip(worth / worth.sum(), both))
        scores.append(sigmoid(pooled @ p["out"] + p["out_bias"][0]))
    return max(scores)


def test_scores_are_the_network_word_by_word():
    rng = random.Random(8)
    vocabulary = ["alpha", "beta", "gamma", "ünder", "zwackel"]
    net = toxicity.Network(vocabulary, sorted({g for w in vocabulary + ["unseen"] for g in toxicity.grams(w)})[::2], seed=3)
    draw = np.random.default_rng(5)
    for k in ("bias", "out_bias", "query", "out"):
        net.p[k] = (net.p[k] + draw.standard_normal(net.p[k].shape) * 0.5).astype(np.float32)
    # a network drawn at random says much the same of all texts: larger numbers tell them apart
    for k, by in (("word", 8), ("gram", 8), ("out", 4)):
        net.p[k] = net.p[k] * np.float32(by)
    texts = ["", "alpha", "unseen words only", *(" ".join(rng.choices([*vocabulary, "unseen", "x", "日本語"], k=k)) for k in (5, 31, 32, 33, 47, 48, 49, 64, 65, 130))]
    got = toxicity.Scorer(net).scores(texts)
    want = np.array([brute_score(net, t) for t in texts])
    assert want.max() - want.min() > 0.05
    np.testing.assert_allclose(got, want, atol=1e-4)


def test_held_out_texts(spark, toxic_rows):
    docs = frame(spark, toxic_rows)
    labels = docs.select("doc_id", (F.col("doc_id") % 4 == 0).cast("int").alias("toxic"), F.lit(1).alias("quality"))
    extra = [(900, None, "en", "a"), (901, "", "en", "a"), (902, " ".join(["er on the"] * 3000 + BAD + ["he in"] * 3000), "en", "a"), (903, "x" * 50_000, "en", "a"), (900, None, "en", "a")]
    labels = labels.unionByName(labels.limit(5)).unionByName(spark.createDataFrame([(5, None, 1), (None, 1, 1)], "doc_id long, toxic int, quality int"))
    found = toxicity.toxicity(frame(spark, toxic_rows + extra), labels.where(~toxicity.held_out())).select("*", toxicity.held_out().alias("held_out")).collect()
    assert len(found) == len(toxic_rows) + 5
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in found)
    apart = [r for r in found if r["held_out"] and r["doc_id"] < 900]
    assert len(apart) > 50
    right = np.mean([r["predicted"] == (r["doc_id"] % 4 == 0) for r in apart])
    assert right > 0.9, right
    by = {r["doc_id"]: r["predicted"] for r in found}
    # a few words in the middle of a very long text are found; nothing is found in no text
    assert by[902] == 1 and by[900] == by[901] == 0


def test_without_labels(spark, odd_docs, odd_rows, no_docs):
    labels = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    found = toxicity.toxicity(odd_docs, labels).collect()
    assert len(found) == len(odd_rows) and all(r["score"] == 0 for r in found)
    assert toxicity.toxicity(no_docs, labels).count() == 0


def test_windows_cover_and_overlap():
    for n in (0, 1, 31, 32, 33, 48, 100, 1000):
        begin = toxicity.starts(n)
        assert begin[0] == 0 and max(begin) + toxicity.WINDOW >= n
        assert all(0 < b - a <= toxicity.STRIDE for a, b in zip(begin, begin[1:]))


@pytest.fixture(scope="module")
def mixed(spark):
    rng = random.Random(2)
    rows = [(i, prose(rng, rng.randint(5, 120), "de" if i % 5 == 0 else "en"), "de" if i % 5 == 0 else "en", "a") for i in range(200)]
    rows += [(500, None, "en", "a"), (501, "", None, "a"), (None, "the er on an", "en", "a"), (7, rows[7][1], "en", "a")]
    docs = frame(spark, rows)
    return docs, docs.where("doc_id < 100").select("doc_id", F.col("lang").alias("domain")), rows


@pytest.mark.parametrize("weights", [None, {"de": 0.6, "en": 0.4}, {"de": 1.0}])
def test_targets_are_met(mixed, weights):
    docs, labelled, rows = mixed
    mixture, members = mixing.mixture_of(docs, labelled, weights)
    held = members.collect()
    assert len(held) == len(rows) and mixture.domains == ["de", "en"]
    p, t = np.array([r["posterior"] for r in held]), np.array([r["tokens"] for r in held], float)
    r = mixture.rates(p)
    assert (r >= 0).all()
    got = (r * t) @ p / (r * t).sum()
    if weights == {"de": 1.0}:
        # a target that nonnegative rates can't meet: steps end, and say how far off they are
        assert got[0] > 0.9 and mixture.residual > mixing.CLOSE
        return
    assert mixture.residual <= mixing.CLOSE
    want = np.array([weights["de"], weights["en"]]) if weights else (t @ p / t.sum()) ** mixing.TEMPER
    np.testing.assert_allclose(got, want / want.sum(), atol=1e-4)
    # the same steps by brute force over all rows at once
    x, total = np.ones(len(t)), want / want.sum() * (r * t).sum()
    inverse = np.linalg.pinv((p * t[:, None]).T @ p)
    for _ in mixture.steps:
        x = np.maximum(0, x + p @ (inverse @ (total - (x * t) @ p)))
    np.testing.assert_allclose(r, x, atol=1e-3)
    if weights is None:
        assert r[t > 0].min() > 0.99


def test_any_number_of_domains(spark):
    rows = [(i, f"text of domain number {i % 80} " * 5, "en", "a") for i in range(240)]
    docs = frame(spark, rows)
    labelled = docs.selectExpr("doc_id", "concat('d', doc_id % 80) AS domain")
    found = mixing.classifier(docs, labelled)
    assert len(found.domains) == 80 and found.weights.shape == (80, mixing.BUCKETS)


def test_languages_are_told_apart(mixed):
    docs, labelled, rows = mixed
    mixture, members = mixing.mixture_of(docs, labelled)
    lang = {i: la for i, _, la, _ in rows}
    long = [r for r in members.collect() if r["doc_id"] is not None and 100 <= r["doc_id"] < 200]
    assert np.mean([mixture.domains[int(np.argmax(r["posterior"]))] == lang[r["doc_id"]] for r in long]) > 0.95


def test_mix_repeats_rows(mixed, no_docs, odd_docs):
    docs, labelled, rows = mixed
    out = mixing.mix(docs, labelled)
    assert out.columns == docs.columns
    n = {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert set(n) == {r[0] for r in rows} and max(n.values()) > 1
    assert out.exceptAll(docs).distinct().join(docs, "doc_id").count() >= 0
    assert mixing.mix(no_docs, labelled).count() == 0
    assert mixing.mix(odd_docs, labelled.where("false")).count() == odd_docs.count()


def test_staged_tables_are_shared(spark):
    assert common.staged(spark.range(3), "t").count() == 3
