"""Toxicity by a bidirectional gated recurrent network with attention pooling.

A word's input is its own vector, if it is among the ``WORDS`` most frequent of the training sample,
beside the mean of the vectors of its character 3- and 4-grams. The network reads windows of
``WINDOW`` words, every ``STRIDE`` words, so that each word stands in two windows, over whole texts;
a text's score is that of its worst window.

Training is in numpy on a bounded sample of labelled rows (``TOXIC_DOCS``, ``CLEAN_DOCS``, and
``DOC_WINDOWS`` windows of each, evenly over the whole text). Labels are of texts, not of windows: a toxic text's
witness is first the window with the most telling word, later the one that the network scores
highest, and clean windows that it scores highest are learned again. Scoring is a narrow pass.

Defined results: null and empty texts have one window of padding; repeated rows one row each, and
count once in training (toxic if one label says so); null labels are not learned; without labels of
both kinds every score is 0; an empty table gives no rows; other columns are never read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postroom.llm import common

WINDOW, STRIDE = 32, 16
TOXIC_DOCS, CLEAN_DOCS, DOC_WINDOWS = 800, 1200, 32
WORDS, GRAMS = 4000, 16_000
HIDDEN, WORD_DIM, GRAM_DIM, ATTENTION = 12, 12, 16, 8
STEPS, BATCH, RATE, DECAY = 360, 129, 0.01, 0.05
#: The part of words that a training step takes for rare ones, so that their grams are learned too.
RARE = 0.3
#: Steps at which witnesses and the clean windows that score highest are chosen anew.
MINED = tuple(STEPS * k // 6 for k in (2, 3, 4, 5))
#: One in so many texts of the sample is left out of training, to place the threshold.
HELD_OUT = 5
THRESHOLD = 0.7
#: Words whose inputs a worker remembers, and windows that it scores at a time.
MEMO = 150_000
BLOCK = 2048
EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "«»“”„‘’…–—¡¿"


def words_of(text: str) -> list[str]:
    return [x for w in text.lower().split() if (x := w.strip(EDGES))]


def starts(n: int) -> list[int]:
    """Where windows over n words begin: the last one ends with the text."""
    return [0] if n <= WINDOW else [*range(0, n - WINDOW, STRIDE), n - WINDOW]


def grams(word: str) -> list[str]:
    w = f"<{word}>"
    return [w[i : i + n] for n in (3, 4) for i in range(len(w) - n + 1)]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


class Network:
    """The network's numbers (float32) and vocabularies; word 0 is padding, 1 any rare word."""

    def __init__(self, words: list[str], gram_list: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.words = {w: i + 2 for i, w in enumerate(words)}
        self.grams = {g: i + 1 for i, g in enumerate(gram_list)}
        inputs = WORD_DIM + GRAM_DIM

        def draw(*shape: int, by: float) -> np.ndarray:
            return (rng.standard_normal(shape) * by).astype(np.float32)

        self.p = {
            "word": draw(len(words) + 2, WORD_DIM, by=0.1), "gram": draw(len(gram_list) + 1, GRAM_DIM, by=0.3),
            "in": draw(2, inputs, 3 * HIDDEN, by=inputs**-0.5), "bias": np.zeros((2, 1, 3 * HIDDEN), np.float32),
            "state": draw(2, HIDDEN, 3 * HIDDEN, by=HIDDEN**-0.5),
            "att": draw(2 * HIDDEN, ATTENTION, by=(2 * HIDDEN) ** -0.5), "query": draw(ATTENTION, by=0.5),
            "out": draw(2 * HIDDEN, by=0.3), "out_bias": np.full(1, -1.0, np.float32),
        }
        self.p["word"][0] = 0
        self.p["gram"][0] = 0

    def features(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of words: their numbers, the numbers of their grams, flat, and how many each has."""
        own = [[g for x in grams(w) if (g := self.grams.get(x))] if w else [] for w in words]
        flat = np.fromiter((g for held in own for g in held), np.int64)
        number = np.fromiter(((self.words.get(w, 1) if w else 0) for w in words), np.int64, len(words))
        return number, flat, np.fromiter(map(len, own), np.int64, len(own))

    def inputs(self, number: np.ndarray, flat: np.ndarray, n: np.ndarray) -> np.ndarray:
        """What the network reads of each word."""
        total = np.zeros((len(n), GRAM_DIM), np.float32)
        some = np.flatnonzero(n)
        if len(some):
            total[some] = np.add.reduceat(self.p["gram"][flat], (np.cumsum(n) - n)[some], axis=0)
        return np.concatenate([self.p["word"][number], total / np.maximum(n, 1)[:, None]], axis=1, dtype=np.float32)

    def forward(self, table: np.ndarray, at: np.ndarray, keep: bool = False) -> tuple[np.ndarray, tuple]:
        """Logits of windows ``at`` (rows of the table of input projections, shape (2, words, 3h));
        with ``keep`` also what the backward pass needs."""
        b, t = at.shape
        h = np.zeros((2, b, HIDDEN), np.float32)
        states = np.empty((t, 2, b, HIDDEN), np.float32)
        held = []
        for k in range(t):
            x = np.stack([table[0][at[:, k]], table[1][at[:, t - 1 - k]]])
            u = h @ self.p["state"]
            gates = _sigmoid(x[..., : 2 * HIDDEN] + u[..., : 2 * HIDDEN])
            z, r, un = gates[..., :HIDDEN], gates[..., HIDDEN:], u[..., 2 * HIDDEN :]
            n = np.tanh(x[..., 2 * HIDDEN :] + r * un)
            if keep:
                held.append((h, z, r, un, n))
            h = n + z * (h - n)
            states[k] = h
        both = np.concatenate([states[:, 0], states[::-1, 1]], axis=2)
        a = np.tanh(both @ self.p["att"])
        weight = a @ self.p["query"]
        weight = np.exp(weight - weight.max(0))
        weight /= weight.sum(0)
        pooled = np.einsum("tb,tbh->bh", weight, both)
        return pooled @ self.p["out"] + self.p["out_bias"], (held, both, a, weight, pooled)

    def project(self, inputs: np.ndarray) -> np.ndarray:
        return inputs[None] @ self.p["in"] + self.p["bias"]

    def gradients(self, words: tuple, at: np.ndarray, target: np.ndarray) -> dict[str, np.ndarray]:
        p, (number, flat, n) = self.p, words
        inputs = self.inputs(number, flat, n)
        logit, (held, both, a, weight, pooled) = self.forward(self.project(inputs), at, keep=True)
        b, t = at.shape
        d = ((_sigmoid(logit) - target) / b).astype(np.float32)
        g = {"out": pooled.T @ d, "out_bias": d.sum(keepdims=True)}
        d_pooled = d[:, None] * p["out"]
        d_weight = np.einsum("bh,tbh->tb", d_pooled, both)
        d_both = weight[..., None] * d_pooled
        d_score = weight * (d_weight - (weight * d_weight).sum(0))
        g["query"] = np.einsum("tb,tbk->k", d_score, a)
        d_a = d_score[..., None] * p["query"] * (1 - a * a)
        g["att"] = np.einsum("tbh,tbk->hk", both, d_a, optimize=True)
        d_both += d_a @ p["att"].T
        d_states = np.stack([d_both[..., :HIDDEN], d_both[::-1, :, HIDDEN:]], axis=1)
        g["state"] = np.zeros_like(p["state"])
        d_read = np.empty((t, 2, b, 3 * HIDDEN), np.float32)
        dh = np.zeros((2, b, HIDDEN), np.float32)
        for k in reversed(range(t)):
            h, z, r, un, new = held[k]
            dh = dh + d_states[k]
            dn = dh * (1 - z) * (1 - new * new)
            dz = dh * (h - new) * z * (1 - z)
            dr = dn * un * r * (1 - r)
            np.concatenate([dz, dr, dn], axis=2, out=d_read[k])
            du = np.concatenate([dz, dr, dn * r], axis=2)
            g["state"] += h.transpose(0, 2, 1) @ du
            dh = dh * z + du @ p["state"].transpose(0, 2, 1)
        # windows hold every row of the table, so the sorted runs are the rows in order
        d_table = np.stack([_sums(at.T, d_read[:, 0]), _sums(at.T[::-1], d_read[:, 1])])
        g["in"] = inputs.T[None] @ d_table
        g["bias"] = d_table.sum(1, keepdims=True)
        d_inputs = (d_table @ p["in"].transpose(0, 2, 1)).sum(0)
        g["word"] = np.zeros_like(p["word"])
        np.add.at(g["word"], number, d_inputs[:, :WORD_DIM])
        g["gram"] = np.zeros_like(p["gram"])
        if len(flat):
            used = np.unique(flat)
            g["gram"][used] = _sums(np.searchsorted(used, flat), np.repeat(d_inputs[:, WORD_DIM:] / np.maximum(n, 1)[:, None], n, axis=0))
        g["word"][0] = 0
        return g


def _sums(key: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of values by key; the keys are 0 to some number, all of them."""
    key, values = key.ravel(), values.reshape(-1, values.shape[-1])
    order = np.argsort(key, kind="stable")
    return np.add.reduceat(values[order], np.flatnonzero(np.append(True, np.diff(key[order]) != 0)), axis=0)


def _pieces(words: tuple, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    number, flat, n = words
    size, begin = n[chosen], (np.cumsum(n) - n)[chosen]
    at = np.arange(int(size.sum())) + np.repeat(begin - (np.cumsum(size) - size), size)
    return number[chosen], flat[at], size


def train(sample: list[tuple[int, list[list[str]]]]) -> Network | None:
    """A network from texts as (label, windows of words); None without both kinds. Its last bias is
    such that THRESHOLD parts the texts left out of training best."""
    by_label = [[x for x in sample if x[0] == y] for y in (1, 0)]
    apart = [x for held in by_label for x in held[HELD_OUT - 1 :: HELD_OUT]]
    net = learn([x for held in by_label for i, x in enumerate(held) if i % HELD_OUT != HELD_OUT - 1])
    if net and len({y for y, _ in apart}) == 2:
        found = Scorer(net).scores([" ".join(w for held in windows for w in held) for _, windows in apart])
        label = np.array([y for y, _ in apart])
        logit = np.log(np.clip(found, 1e-9, 1 - 1e-9)) - np.log1p(-np.clip(found, 1e-9, 1 - 1e-9))
        cuts = np.sort(logit)
        cuts = np.concatenate([[cuts[0] - 1], (cuts[1:] + cuts[:-1]) / 2, [cuts[-1] + 1]])
        # a clean text lost weighs more than a toxic one missed
        worth = np.array([(logit[label == 1] > t).mean() - 3 * (logit[label == 0] > t).mean() for t in cuts])
        good = cuts[worth >= worth.max() - 1e-9]
        net.p["out_bias"] += np.float32(np.log(THRESHOLD / (1 - THRESHOLD)) - (good[0] + good[-1]) / 2)
    return net


def learn(sample: list[tuple[int, list[list[str]]]]) -> Network | None:
    if len({label for label, _ in sample}) < 2:
        return None
    seen = [{w for held in windows for w in held} for _, windows in sample]
    docs, toxic = Counter(w for s in seen for w in s), Counter(w for (y, _), s in zip(sample, seen) for w in s if y)
    by_gram: Counter[str] = Counter()
    gram_docs: Counter[str] = Counter()
    for (y, _), s in zip(sample, seen):
        held = {g for w in s for g in grams(w)}
        gram_docs.update(held)
        if y:
            by_gram.update(held)
    n_toxic = sum(y for y, _ in sample)
    n_clean = len(sample) - n_toxic

    def tells(t: int, n: int) -> float:
        """How far it speaks for toxic texts; nothing if seen in one only."""
        odds = np.log((t + 0.5) / (n_toxic + 1)) - np.log((n - t + 0.5) / (n_clean + 1))
        return float(max(odds, 0) * t) if t > 1 else 0.0

    # rarer words are known by their grams
    listed = [w for w, c in sorted(docs.items(), key=lambda x: (-tells(toxic[x[0]], x[1]), -x[1], x[0]))[: WORDS // 4] if c > 2]
    listed += [w for w, c in sorted(docs.items(), key=lambda x: (-x[1], x[0]))[: WORDS * 3 // 4] if c > 2]
    known = [g for g, c in sorted(gram_docs.items(), key=lambda x: (-x[1], x[0]))[:GRAMS] if c > 2]
    net = Network(list(dict.fromkeys(listed)), known)

    vocabulary = ["", *sorted(docs)]
    place = {w: i for i, w in enumerate(vocabulary)}
    words = net.features(vocabulary)
    told = np.array([0.0] + [max([tells(toxic[w], docs[w]), *(tells(by_gram[g], gram_docs[g]) for g in grams(w))]) for w in vocabulary[1:]])
    rows, owner, label = [], [], []
    for i, (y, windows) in enumerate(sample):
        for held in windows:
            rows.append([place[w] for w in held] + [0] * (WINDOW - len(held)))
            owner.append(i)
            label.append(y)
    rows.append([0] * WINDOW)  # an empty text is clean
    at, owner, label = np.array(rows), np.array([*owner, -1]), np.array([*label, 0])
    clean = np.flatnonzero(label == 0)
    bad = np.flatnonzero(label == 1)
    worth = told[at].max(1)

    def witnesses(score: np.ndarray) -> np.ndarray:
        order = bad[np.lexsort((-score[bad], owner[bad]))]
        return order[np.append(True, owner[order][1:] != owner[order][:-1])]

    rng = np.random.default_rng(11)
    chosen, hard = witnesses(worth), clean[np.argsort(-worth[clean], kind="stable")][:2000]
    m = {k: np.zeros_like(v) for k, v in net.p.items()}
    v = {k: np.zeros_like(x) for k, x in net.p.items()}
    for step in range(1, STEPS + 1):
        if step in MINED:
            score = score_windows(net, net.project(net.inputs(*words)), at)
            chosen = witnesses(score)
            hard = clean[np.argsort(-score[clean], kind="stable")][:2000]
        picked = np.concatenate([rng.choice(chosen, BATCH // 3), rng.choice(clean, BATCH // 3), rng.choice(hard, BATCH // 3)])
        shown = at[picked]
        # in half of the toxic windows, clean words stand around the most telling word instead
        for i in range(0, BATCH // 3, 2):
            word = shown[i, np.argmax(told[shown[i]])]
            shown[i] = at[rng.choice(clean)]
            shown[i, rng.integers(max(1, int((shown[i] > 0).sum())))] = word
        used, inverse = np.unique(shown, return_inverse=True)
        number, flat, n = _pieces(words, used)
        number = np.where((number > 1) & (rng.random(len(number)) < RARE), 1, number)
        grad = net.gradients((number, flat, n), inverse.reshape(len(picked), WINDOW), label[picked].astype(np.float32))
        rate = RATE * min(1, 2 * (1 - step / (STEPS + 1)))
        size = np.sqrt(sum(float((x * x).sum()) for x in grad.values()))
        for k, x in grad.items():
            x = x / max(1.0, size)
            m[k] = 0.9 * m[k] + 0.1 * x
            v[k] = 0.99 * v[k] + 0.01 * x * x
            net.p[k] -= (rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
        for k in ("word", "gram"):
            net.p[k] *= 1 - rate * DECAY
            net.p[k][0] = 0
    return net


def score_windows(net: Network, table: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.concatenate([_sigmoid(net.forward(table, at[i : i + BLOCK])[0].astype(np.float64)) for i in range(0, len(at), BLOCK)])


class Scorer:
    """Scores of texts; remembers the input projections of words."""

    def __init__(self, net: Network):
        self.net = net
        self.known: dict[str, int] = {}

    def _rows(self, words: list[str]) -> np.ndarray:
        known = self.known
        if not known or len(known) > MEMO:
            known.clear()
            known[""] = 0
            self.table = np.empty((2, MEMO + 1, 3 * HIDDEN), np.float32)
            self.table[:, :1] = self.net.project(self.net.inputs(*self.net.features([""])))
        found = [known.get(w, -1) for w in words]
        if -1 in found and (new := list(dict.fromkeys(w for w, k in zip(words, found) if k < 0))):
            first = len(known)
            if first + len(new) > self.table.shape[1]:
                # the memory grows for this chunk alone; the next call starts anew
                self.table = np.concatenate([self.table, np.empty((2, len(new), 3 * HIDDEN), np.float32)], axis=1)
            for i in range(0, len(new), 20_000):
                part = new[i : i + 20_000]
                self.table[:, first + i : first + i + len(part)] = self.net.project(self.net.inputs(*self.net.features(part)))
            known.update(zip(new, range(first, first + len(new))))
            found = [known[w] if k < 0 else k for w, k in zip(words, found)]
        return np.array(found, np.int64)

    def scores(self, texts: list[str]) -> np.ndarray:
        held = [words_of(t) for t in texts]
        n = np.fromiter(map(len, held), np.int64, len(held))
        rows = np.append(self._rows([w for h in held for w in h]), 0)
        begin, size = np.cumsum(n) - n, np.where(n <= WINDOW, 1, -(-(n - WINDOW) // STRIDE) + 1)
        owner = np.repeat(np.arange(len(texts)), size)
        start = np.minimum((np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)) * STRIDE, np.maximum(n - WINDOW, 0)[owner])
        out = np.zeros(len(texts))
        step = np.arange(WINDOW)
        for i in range(0, len(owner), BLOCK):
            who = owner[i : i + BLOCK]
            inside = start[i : i + BLOCK, None] + step
            at = np.where(inside < n[who][:, None], inside + begin[who][:, None], len(rows) - 1)
            np.maximum.at(out, who, _sigmoid(self.net.forward(self.table, rows[at])[0].astype(np.float64)))
        return out


def training_sample(docs: DataFrame, labels: DataFrame) -> list[tuple[int, list[list[str]]]]:
    """Windows of a bounded sample of labelled texts: those whose doc_id hashes lowest."""
    given = labels.where("toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = given.where("toxic = 1").orderBy(*order).limit(TOXIC_DOCS).unionByName(given.where("toxic = 0").orderBy(*order).limit(CLEAN_DOCS))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            kept = []
            for t in frame["text"]:
                words = words_of(t or "")
                begin = starts(len(words))
                if len(begin) > DOC_WINDOWS:
                    begin = [begin[i * len(begin) // DOC_WINDOWS] for i in range(DOC_WINDOWS)]
                kept.append([" ".join(words[b : b + WINDOW]) for b in begin])
            yield pd.DataFrame({"doc_id": frame["doc_id"], "toxic": frame["toxic"], "windows": kept})

    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    found = rows.mapInPandas(cut, "doc_id long, toxic int, windows array<string>")
    # of rows with one id the one whose windows sort first, so that every run learns the same
    found = found.groupBy("doc_id").agg(F.min(F.struct("windows", "toxic")).alias("r")).select("doc_id", "r.windows", "r.toxic")
    held = found.orderBy("doc_id").limit(TOXIC_DOCS + CLEAN_DOCS).collect()
    return [(r["toxic"], [w.split(" ") if w else [] for w in r["windows"]]) for r in held]


def held_out() -> Column:
    """The rows that labels are not learned from; a null id is none of them."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, score, predicted, text_hash`` for each row of ``docs``; ``labels`` (doc_id, toxic) are
    all learned from; text_hash tells rows of one id apart."""
    net = train(training_sample(docs, labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(net) if net else None
        for batch in batches:
            for ids, texts in common.chunks(batch, ["doc_id", "text"]):
                found = scorer.scores(texts) if scorer else np.zeros(len(texts))
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(ids, pa.int64()), "score": pa.array(found, pa.float64()),
                    "predicted": pa.array((found >= threshold).astype(np.int32), pa.int32()), "text_hash": pa.array([common.text_hash(t) for t in texts], pa.int64()),
                })

    return docs.select("doc_id", "text").mapInArrow(common.lean(run), "doc_id long, score double, predicted int, text_hash long")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels")
    return toxicity(docs, labels.where(~held_out())).select("doc_id", held_out().alias("held_out"), "score", "predicted")
