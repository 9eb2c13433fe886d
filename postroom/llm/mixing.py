"""Mixing sources to target weights with soft membership.

A naive Bayes classifier over hashed byte trigrams, learned from labelled rows, gives each document
posteriors of the domains; its temperature is fitted on held-out labelled rows. Document rates are
then fitted by projected-gradient least squares: nonnegative rates r so that the expected tokens of
each domain, sum of r * tokens * posterior, meet the targets. The residual has one number a domain,
so a step sends only that: a document's rate is replayed from the steps so far, and is a function of
its posterior alone.

Gradients are scaled by 1 / tokens for a document and measured by the inverse of the domains' second
moments; in that metric the step length is 1. Steps end when the targets are met (``CLOSE``) or when
they come no closer because rates may not be negative; ``residual`` says how far off they then are.

Targets are given weights, or else natural shares to the power ``TEMPER``; their total is the least
that asks no document to be given up. A document is taken floor(rate) times and once more with
the chance of the remainder, by a hash of its id.

Defined results: null and empty texts have equal posteriors and no tokens; domains without labelled
rows don't exist; without labelled rows all rates are 1; repeated rows one row each; an empty table
gives no rows; other columns pass through ``mix`` unread. Texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postroom.llm import common
from postroom.llm.token_counts import CHUNK_CHARS, VOCABULARY, count_tokens

BUCKETS = 4096
TEMPER = 0.7
#: Labelled rows that the temperature is fitted on at most; one in so many.
FIT_ROWS, HELD_OUT = 2000, 5
#: The residual, as a part of all targets, that is as good as none; steps that must halve it, or it
#: is about the least that nonnegative rates reach.
CLOSE, PATIENCE = 1e-6, 8
#: Trigrams that a text is given beside its own, of no domain.
PRIOR_TRIGRAMS = 50


def bucket_of(flat: np.ndarray) -> np.ndarray:
    """The bucket of the trigram that starts at each byte but the last two."""
    key = flat[:-2] << np.uint32(16) | flat[1:-1] << np.uint32(8) | flat[2:]
    return (key * np.uint32(2654435761) >> np.uint32(20)).astype(np.int64)


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all byte trigrams within the texts, flat; their text; how many each text has."""
    raw = [t.encode() for t in texts]
    size = np.fromiter(map(len, raw), np.int64, len(raw))
    flat = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint32)
    n = np.maximum(size - 2, 0)
    owner = np.repeat(np.arange(len(raw)), n)
    at = np.arange(int(n.sum())) + np.repeat((np.cumsum(size) - size) - (np.cumsum(n) - n), n)
    key = flat[at] << np.uint32(16) | flat[at + 1] << np.uint32(8) | flat[at + 2] if len(at) else flat[:0]
    return (key * np.uint32(2654435761) >> np.uint32(20)).astype(np.int64), owner, n


@dataclass
class Mixture:
    """Domains, their log odds by bucket, the temperature, and the steps of the rates so far."""

    domains: list[str]
    weights: np.ndarray
    beta: float = 1.0
    steps: list[np.ndarray] = field(default_factory=list)
    #: The largest difference between targets and expected tokens, as a part of all targets.
    residual: float = 0.0

    def evidence(self, texts: list[str]) -> np.ndarray:
        """Mean log probability of a text's trigrams by domain."""
        raw = [t.encode() for t in texts]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        n, start = np.maximum(size - 2, 0), np.cumsum(size) - size
        some = np.flatnonzero(n)
        total = np.zeros((len(texts), len(self.weights)))
        if len(some):
            # trigrams over all bytes at once; those across two texts stand between the summed spans
            bucket = bucket_of(np.frombuffer(b"".join(raw), np.uint8).astype(np.uint32))
            spans = np.stack([start[some], start[some] + n[some]], axis=1).ravel()
            held = np.zeros(len(bucket) + 1)
            for d, w in enumerate(self.weights):
                np.take(w, bucket, out=held[:-1])
                total[some, d] = np.add.reduceat(held, spans)[::2]
        return total / (n + PRIOR_TRIGRAMS)[:, None]

    def posteriors(self, texts: list[str]) -> np.ndarray:
        return softmax(self.beta * self.evidence(texts))

    def rates(self, posteriors: np.ndarray) -> np.ndarray:
        r = np.ones(len(posteriors))
        for step in self.steps:
            r = np.maximum(0, r + posteriors @ step)
        return r


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def copies(doc_ids: list, rates: np.ndarray) -> np.ndarray:
    """Whole copies by a hash of the id (splitmix64)."""
    x = np.array([i or 0 for i in doc_ids], np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    chance = (x ^ x >> np.uint64(31)) / 2.0**64
    # a rate that the solver left just below a whole number is that number
    rates = np.round(rates, 4)
    return (np.floor(rates) + (chance < rates % 1)).astype(np.int64)


def classifier(docs: DataFrame, labelled: DataFrame) -> Mixture:
    """Learned from the rows of ``docs`` that ``labelled`` (doc_id, domain) names."""
    ids = labelled.where("doc_id is not null and domain is not null").groupBy("doc_id").agg(F.min(F.col("domain").cast("string")).alias("domain"))
    rows = docs.select("doc_id", "text").join(common.small(ids), "doc_id")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(HELD_OUT)) == 0

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for domains, texts in common.chunks(batch, ["domain", "text"]):
                bucket, owner, _ = trigrams(texts)
                which, names = pd.factorize(np.array(domains, object))
                n = np.bincount(which[owner] * BUCKETS + bucket, minlength=len(names) * BUCKETS)
                some = np.flatnonzero(n)
                yield pa.RecordBatch.from_pydict({"domain": pa.array(names[some // BUCKETS], pa.string()), "bucket": pa.array(some % BUCKETS, pa.int32()), "n": pa.array(n[some], pa.int64())})

    counted = rows.where(~held).select("domain", "text").mapInArrow(common.lean(count), "domain string, bucket int, n long")
    sums = counted.groupBy("domain", "bucket").agg(F.sum("n").alias("n"))
    # domains * BUCKETS numbers, however many rows there are
    names = [r["domain"] for r in ids.select("domain").distinct().orderBy("domain").collect()]
    if not names:
        return Mixture([], np.zeros((0, BUCKETS)))
    table = np.ones((len(names), BUCKETS))
    place = {name: k for k, name in enumerate(names)}
    for r in sums.collect():
        table[place[r["domain"]], r["bucket"]] += r["n"]
    found = Mixture(names, np.log(table / table.sum(1, keepdims=True)))

    def show(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_ids, domains, texts in common.chunks(batch, ["doc_id", "domain", "text"]):
                yield pa.RecordBatch.from_pydict({"doc_id": pa.array(doc_ids, pa.int64()), "domain": pa.array(domains, pa.string()), "x": pa.array(found.evidence(texts).tolist(), pa.list_(pa.float64()))})

    some = rows.where(held).mapInArrow(common.lean(show), "doc_id long, domain string, x array<double>")
    shown = some.orderBy(F.xxhash64("doc_id"), "doc_id", "x").limit(FIT_ROWS).collect()
    if shown:
        x, y = np.array([r["x"] for r in shown]), np.array([place[r["domain"]] for r in shown])
        k = len(names)

        def loss(beta: float) -> float:
            p = softmax(beta * x) * (1 - 0.01) + 0.01 / k
            return -float(np.log(p[np.arange(len(y)), y]).mean())

        # the flattest of the temperatures that do about as well as the best
        tried = {b: loss(b) for b in np.geomspace(1, 1000, 31)}
        found.beta = float(min(b for b, v in tried.items() if v <= min(tried.values()) + 0.002))
    return found


def memberships(docs: DataFrame, mixture: Mixture, path: str | None = None) -> DataFrame:
    """``doc_id, tokens, posterior`` for each row of ``docs``; a narrow pass."""
    path = path or public_tokenizers.path(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in common.chunks(batch, ["doc_id", "text"], most=CHUNK_CHARS):
                p = mixture.posteriors(texts) if mixture.domains else np.zeros((len(texts), 0))
                yield pa.RecordBatch.from_pydict({"doc_id": pa.array(ids, pa.int64()), "tokens": pa.array(count_tokens(texts, path)), "posterior": pa.array(p.tolist(), pa.list_(pa.float64()))})

    return docs.select("doc_id", "text").mapInArrow(common.lean(run), "doc_id long, tokens long, posterior array<double>")


def _sums(members: DataFrame, mixture: Mixture, second: bool = False) -> np.ndarray:
    """Expected tokens by domain at the rates so far, or the second moments of the domains."""
    k = len(mixture.domains)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(k * k if second else k)
        for frame in batches:
            p, t = np.array(frame["posterior"].tolist(), float).reshape(-1, k), frame["tokens"].to_numpy(float)
            total += ((p * t[:, None]).T @ p).ravel() if second else (t * mixture.rates(p)) @ p
        yield pd.DataFrame({"i": np.arange(len(total)), "v": total})

    out = np.zeros(k * k if second else k)
    for r in members.select("tokens", "posterior").mapInPandas(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():
        out[r["i"]] = r["v"]
    return out.reshape(k, k) if second else out


def fit_rates(members: DataFrame, mixture: Mixture, weights: dict[str, float] | None = None) -> Mixture:
    """The mixture with the steps that lead to the targets; ``members`` is read once a step."""
    if not mixture.domains:
        return mixture
    natural = _sums(members, mixture)
    if not natural.sum():
        return mixture
    share = natural / natural.sum()
    wanted = np.array([weights.get(d, 0.0) for d in mixture.domains]) if weights else share**TEMPER
    wanted = wanted / wanted.sum()
    moments = _sums(members, mixture, second=True)
    inverse = np.linalg.pinv(moments, rcond=1e-10, hermitian=True)
    # rates that reach c * wanted are 1 + posterior @ (c * need - 1): the least c that lets no
    # wanted domain's documents fall below one copy
    need = inverse @ (wanted * natural.sum())
    targets = wanted * natural.sum() / need[need > 0].min()
    off = lambda reached: float(np.abs(targets - reached).max() / targets.sum())
    reached, errors = natural, [off(natural)]
    # until the targets are met, or rates that may not fall below zero can't come closer
    while errors[-1] > CLOSE and (len(errors) <= PATIENCE or errors[-1] < 0.5 * errors[-1 - PATIENCE]):
        mixture.steps.append(inverse @ (targets - reached))
        reached = _sums(members, mixture)
        errors.append(off(reached))
    mixture.residual = errors[-1]
    return mixture


def mixture_of(docs: DataFrame, labelled: DataFrame, weights: dict[str, float] | None = None) -> tuple[Mixture, DataFrame]:
    """The fitted mixture and the staged memberships of ``docs``."""
    found = classifier(docs, labelled)
    members = common.staged(memberships(docs, found), "memberships")
    return fit_rates(members, found, weights), members


def mix(docs: DataFrame, labelled: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """``docs`` with each row as often as its rate says; a narrow pass over whole rows."""
    mixture, _ = mixture_of(docs, labelled, weights)
    if not mixture.steps:
        return docs
    schema = docs.schema
    ids, texts = docs.columns.index("doc_id"), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begin = 0
            for (part,) in common.chunks(batch.select([texts]).rename_columns(["text"]), ["text"]):
                held = batch.slice(begin, len(part))
                n = copies(held.column(ids).to_pylist(), mixture.rates(mixture.posteriors(part)))
                begin += len(part)
                yield held.take(pa.array(np.repeat(np.arange(len(part)), n)))

    return docs.mapInArrow(common.lean(run), schema)


def trusted_languages(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The labelled table of the queries: the language of good, clean documents as their domain."""
    good = labels.where("quality = 1 and toxic = 0").select("doc_id").distinct()
    return docs.select("doc_id", F.col("lang").alias("domain")).join(common.small(good), "doc_id", "left_semi")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels")
    mixture, members = mixture_of(docs, trusted_languages(docs, labels))
    names = np.array([*mixture.domains, None], object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = np.array(batch.column("posterior").to_pylist(), float).reshape(len(batch), -1)
            r = mixture.rates(p)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "tokens": batch.column("tokens"),
                "domain": pa.array(names[p.argmax(1)] if p.shape[1] else [None] * len(r), pa.string()),
                "rate": pa.array(r), "copies": pa.array(copies(batch.column("doc_id").to_pylist(), r)), "residual": pa.array(np.full(len(r), mixture.residual)),
            })

    return members.mapInArrow(common.lean(run), "doc_id long, tokens long, domain string, rate double, copies long, residual double")
