import math
import random
import zlib
from collections import Counter, defaultdict

from postroom.llm import perplexity as K

from .conftest import frame, prose


class Brute:
    """Interpolated modified Kneser-Ney, by its formulas, one n-gram at a time."""

    def __init__(self, texts):
        top = Counter()
        for t in texts:
            s = K.BEFORE * (K.ORDER - 1) + t + K.AFTER
            top.update(s[i - K.ORDER + 1 : i + 1] for i in range(K.ORDER - 1, len(s)))
        self.counts = {K.ORDER: top}
        for n in range(K.ORDER - 1, 0, -1):
            self.counts[n] = Counter(g[1:] for g in self.counts[n + 1])
        self.cut = {}
        for n, held in self.counts.items():
            c = Counter(held.values())
            y = c[1] / (c[1] + 2 * c[2]) if c[1] else 0
            self.cut[n] = [min(max(i - (i + 1) * y * c[i + 1] / c[i] if c[1] and c[i] else 0.75, 0.05), i - 0.05) for i in (1, 2, 3)]
        self.after = defaultdict(list)
        for n, held in self.counts.items():
            for g, c in held.items():
                self.after[g[:-1]].append((c, self.cut[n][min(c, 3) - 1]))
        self.signs = len(self.counts[1]) + 1

    def p(self, g):
        if not g:
            return 1 / self.signs
        lower = self.p(g[1:])
        held = self.after.get(g[:-1])
        if not held:
            return lower
        total, back = sum(c for c, _ in held), sum(d for _, d in held)
        c = self.counts[len(g)][g]
        return (c - (self.cut[len(g)][min(c, 3) - 1] if c else 0) + back * lower) / total

    def logp(self, t):
        s = K.BEFORE * (K.ORDER - 1) + t + K.AFTER
        return sum(math.log(self.p(s[i - K.ORDER + 1 : i + 1])) for i in range(K.ORDER - 1, len(s)))


def test_log_probabilities(spark):
    rng = random.Random(1)
    rows = [(i, prose(rng, 30, "de" if i % 3 == 0 else "en"), "de" if i % 3 == 0 else "en", "a") for i in range(40)]
    rows += [(100, "", "en", "a"), (101, "¿unseen✓ signs", "en", "a"), (102, None, "de", "a")]
    docs = frame(spark, rows)
    known = K.model(K.gram_counts(K._text_rows(docs.where("doc_id < 20"))))
    got = {r["doc_id"]: r["logp"] for r in K.document_log_probabilities(docs, known).collect()}
    for lang in ("en", "de"):
        brute = Brute([t for i, t, la, _ in rows if i < 20 and la == lang])
        for i, t, la, _ in rows:
            if la == lang:
                assert math.isclose(got[i], brute.logp(t or ""), rel_tol=1e-9), (i, lang)
        # over all that can follow a context the probabilities are one
        for context in ("", "e", "the", "\x02" * 4):
            signs = list(brute.counts[1])
            assert math.isclose(sum(brute.p(context + s) for s in signs) + brute.p(context + "✗"), 1, rel_tol=1e-9)


def test_junk_goes_and_clean_stays(spark):
    rng = random.Random(2)
    good = [(i, prose(rng, rng.randint(5, 200)), "en", "hot") for i in range(400)]
    bad = [(1000 + i, prose(rng, 80).upper().replace(" ", "$$$ "), "en", "hot") for i in range(20)]
    docs = frame(spark, good + bad)
    got = {r["doc_id"]: r for r in K.quality_classifier(docs, docs.where("doc_id < 300").select("doc_id")).collect()}
    assert all(got[i]["kept"] for i, *_ in good)
    assert not any(got[i]["kept"] for i, *_ in bad)


def test_junk_without_a_language_goes(spark):
    rng = random.Random(4)
    good = [(i, prose(rng, rng.randint(20, 120)), "en", "a") for i in range(300)] + [(500, prose(rng, 60), None, "a"), (501, prose(rng, 60), "xx", "a")]
    bad = [(900, "$$$ ### " * 40, None, "a"), (901, "$$$ ### " * 40, "xx", "a"), (None, "$$$ ### " * 40, "en", "a")]
    docs = frame(spark, good + bad)
    got = K.quality_classifier(docs, docs.where("doc_id < 300").select("doc_id")).collect()
    assert {(r["doc_id"], r["kept"]) for r in got} == {(i, True) for i, *_ in good} | {(900, False), (901, False), (None, False)}


def test_threshold_is_the_held_out_quantile(spark):
    rng = random.Random(7)
    good = [(i, prose(rng, rng.randint(20, 200)), "en", "a") for i in range(600)]
    # far beyond every held-out text, but not by three times
    bad = [(2000 + i, " ".join(w if k % 10 else w.upper() for k, w in enumerate(prose(rng, 150).split())), "en", "a") for i in range(10)]
    docs = frame(spark, good + bad)
    rows = K.quality_classifier(docs, docs.where("doc_id < 600").select("doc_id"), high=0.98).collect()
    held = sorted(r["loss"] for r in rows if r["doc_id"] < 600 and zlib.crc32(str(r["doc_id"]).encode()) % K.HELD_OUT == 0)
    (threshold,) = {r["threshold"] for r in rows}
    assert len(held) >= 50 and math.isclose(threshold, held[math.ceil(0.98 * len(held)) - 1], rel_tol=1e-9)
    assert not any(r["kept"] for r in rows if r["doc_id"] >= 2000)


def test_odd_tables(spark, odd_docs, odd_rows, no_docs):
    trusted = odd_docs.where("doc_id >= 20").select("doc_id")
    got = K.quality_classifier(odd_docs, trusted).collect()
    assert sorted(map(str, (r["doc_id"] for r in got))) == sorted(str(r[0]) for r in odd_rows)
    assert sorted(r["n_chars"] for r in got) == sorted(len(t or "") + 1 for _, t, _, _ in odd_rows)
    # languages without trusted texts, and none, are held against all languages together
    strange = [r for r in got if r["lang"] == K.POOLED]
    assert sorted(r["doc_id"] for r in strange) == [3, 8, 9] and all(r["perplexity"] is not None for r in strange)
    # no trusted text at all, and no document at all
    assert all(r["kept"] for r in K.quality_classifier(odd_docs, trusted.where("false")).collect())
    assert K.quality_classifier(no_docs, trusted).count() == 0


def test_many_blocks_agree(spark):
    rng = random.Random(3)
    rows = [(i, prose(rng, 20), "en" if i % 4 else "de", "a") for i in range(60)] + [(100, "", "en", "a"), (101, prose(rng, 3000), "en", "a")]
    docs = frame(spark, rows)
    known = K.model(K.gram_counts(docs))
    few = K.gram_counts(docs.coalesce(1), block_chars=700)
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, K.gram_counts(docs).collect()))
    one = {r["doc_id"]: r["logp"] for r in K.document_log_probabilities(docs, known).collect()}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        many = {r["doc_id"]: r["logp"] for r in K.document_log_probabilities(docs.coalesce(2), known, block_chars=300).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1024")
    assert one.keys() == many.keys() and all(math.isclose(one[k], many[k], rel_tol=1e-9) for k in one)
