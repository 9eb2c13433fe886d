"""Quality rules: text statistics, fixed base rules, and robust multivariate outliers.

Each document has a vector of transformed statistics. Per language and source the minimum covariance
determinant estimate of location and scatter is found: concentration steps take the ``SHARE`` of rows
nearest by Mahalanobis distance and fit mean and covariance to them. Each of four starts makes
``TRIAL_STEPS`` of them; the one with the least determinant goes on until its determinant falls no
more. A document beyond ``CUTOFF`` of the chi-squared distribution is rejected.

The starts are the coordinate medians with quartile ranges, and three scatters about the medians: of
the rows themselves, of rows whose coordinates are bent to a bounded range, and of their directions.
The determinant is of the covariance with the least variances (``FEATURES``) added, as the distances
are; concentration lowers that one too.

Every step is a grouped aggregate with map-side partial sums, so a source with a third of all rows
is never gathered. Groups under ``LEAST_ROWS`` rows are pooled by language, then over all; where a
pool is smaller still, only the base rules decide.

Defined results: a null text has no words, so it fails the base rules, as an empty one does; null
``lang`` or ``source`` count as the empty string; repeated rows one row each; an empty table gives no
rows; other columns are never read. Texts of any length are read whole.
"""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postroom.llm import common

#: The symbols that are counted.
SYMBOLS = "#*$%&|<>"
WINDOW = 5
SHARE = 0.75
#: Steps from every start; a fall of the log determinant that is as good as none.
TRIAL_STEPS, STILL = 2, 1e-6
LEAST_ROWS = 60
#: The part of the normal distribution beyond the cutoff.
BEYOND = 1e-3
#: The transformed statistics, and the least standard deviation each is taken to have: what most
#: documents lack altogether has no spread of its own.
FEATURES = {"f_word": 0.25, "f_symbol": 0.03, "f_dup": 0.1, "f_repeat": 0.05, "f_upper": 0.05, "f_mark": 0.05}
#: Words (lines, characters) that are added to a document's own in a ratio, so that the ratios of
#: short texts vary no more than those of long ones.
PRIOR_WORDS, PRIOR_CHARS, PRIOR_WORD_SIZE, PRIOR_LINES = 50, 250, 5, 5
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
COUNTS = (*BASE, "n_lines", "n_upper", "n_marks")


@lru_cache(1)
def _signs() -> tuple[np.ndarray, np.ndarray]:
    """By code point: capital letters, and signs that are neither letters, numbers nor space."""
    kinds = [unicodedata.category(chr(c)) for c in range(0x110000)] + ["Cc"]
    return np.array([k in ("Lu", "Lt") for k in kinds]), np.array([k[0] in "PS" for k in kinds])


def statistics(texts: list[str]) -> dict[str, np.ndarray]:
    w = common.Words(texts)
    n = len(texts)
    out = {"n_words": np.bincount(w.text_of, minlength=n), "word_chars": np.bincount(w.text_of, w.size, n).astype(np.int64)}
    upper, marks = _signs()
    for name, flag in (("n_symbols", np.isin(w.codes, [ord(c) for c in SYMBOLS])), ("n_upper", upper[w.codes]), ("n_marks", marks[w.codes])):
        out[name] = np.bincount(np.searchsorted(w.ends, np.flatnonzero(flag)), minlength=n)

    # lines that hold a word
    stop = np.flatnonzero((w.codes == 0x0A) | (w.codes == w.SENTINEL))
    line = np.unique(np.searchsorted(stop, w.begin))
    begin = np.where(line > 0, stop[line - 1] + 1, 0)
    owner = np.searchsorted(w.ends, begin)
    kind, _ = common.same(w.joined, w.codes, begin, stop[line] - begin)
    out["n_lines"] = np.bincount(owner, minlength=n)
    _, first = np.unique(owner * (len(line) + 1) + kind, return_index=True)
    out["n_dup_lines"] = out["n_lines"] - np.bincount(owner[first], minlength=n)

    # windows: equal pairs of words get one number, then equal fours, then fives within a text
    covered = np.zeros(len(w.begin) + 1, np.int64)
    if len(w.begin) >= WINDOW:
        k = w.kind.astype(np.int64)
        two = pd.factorize(k[:-1] * (k.max() + 1) + k[1:])[0].astype(np.int64)
        four = pd.factorize(two[:-2] * (two.max() + 1) + two[2:])[0].astype(np.int64)
        five = pd.factorize(four[:-1] * (k.max() + 1) + k[4:])[0].astype(np.int64)
        at = np.flatnonzero(w.text_of[:-4] == w.text_of[4:])
        seen = pd.factorize(five[at] * n + w.text_of[at])[0]
        at = at[np.bincount(seen)[seen] > 1] if len(seen) else at
        np.add.at(covered, at, 1)
        np.add.at(covered, at + WINDOW, -1)
    inside = np.cumsum(covered[:-1]) > 0
    out["n_repeat_words"] = np.bincount(w.text_of[inside], minlength=n)
    return out


def document_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id, lang, source`` and the counts of every text; a narrow pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, langs, sources, texts in common.chunks(batch, ["doc_id", "lang", "source", "text"]):
                found = statistics(texts)
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": pa.array(ids, pa.int64()), "lang": pa.array([x or "" for x in langs], pa.string()), "source": pa.array([x or "" for x in sources], pa.string())}
                    | {k: pa.array(found[k], pa.int64()) for k in COUNTS}
                )

    schema = "doc_id long, lang string, source string, " + ", ".join(f"{k} long" for k in COUNTS)
    return docs.select("doc_id", F.col("lang").cast("string"), F.col("source").cast("string"), "text").mapInArrow(common.lean(run), schema)


def transformed(stats: DataFrame) -> DataFrame:
    c = F.col
    return stats.withColumns({
        "f_word": F.log((c("word_chars") + PRIOR_WORDS * PRIOR_WORD_SIZE) / (c("n_words") + PRIOR_WORDS)),
        "f_symbol": c("n_symbols") / (c("n_words") + PRIOR_WORDS),
        "f_dup": c("n_dup_lines") / (c("n_lines") + PRIOR_LINES),
        "f_repeat": c("n_repeat_words") / (c("n_words") + PRIOR_WORDS),
        "f_upper": c("n_upper") / (c("word_chars") + PRIOR_CHARS),
        "f_mark": c("n_marks") / (c("n_words") + PRIOR_WORDS),
    })


def chi2_cdf(x: float, p: int) -> float:
    """For an even number of degrees."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(p // 2))


def chi2_quantile(q: float, p: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, p) < q else (low, mid)
    return high


P = len(FEATURES)
CUTOFF = chi2_quantile(1 - BEYOND, P)
#: The covariance of the nearest SHARE of a normal distribution is smaller than the whole one's.
CONSISTENCY = SHARE / chi2_cdf(chi2_quantile(SHARE, P), P + 2)
PAIRS = [(i, j) for i in range(P) for j in range(i, P)]


def _distance() -> Column:
    """Squared Mahalanobis distance, by the columns center and precision of the row's group."""
    diff = [F.col(f) - F.col("center")[i] for i, f in enumerate(FEATURES)]
    return sum(diff[i] * diff[j] * F.col("precision")[k] * (1 if i == j else 2) for k, (i, j) in enumerate(PAIRS))


ESTIMATE = "key string, start int, center array<double>, precision array<double>, log_det double"


def _estimates(moments: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Center, inverse covariance and its determinant for each key and start, from the means and mean
    products of differences from the center before."""
    floor = np.array(list(FEATURES.values())) ** 2
    for frame in moments:
        mean = np.array(frame["m1"].tolist(), float).reshape(-1, P)
        second = np.array(frame["m2"].tolist(), float).reshape(-1, len(PAIRS))
        cov = np.zeros((len(frame), P, P))
        for k, (i, j) in enumerate(PAIRS):
            cov[:, i, j] = cov[:, j, i] = second[:, k] - mean[:, i] * mean[:, j]
        cov = cov * CONSISTENCY + np.diag(floor)
        inverse = np.linalg.inv(cov)
        yield pd.DataFrame({
            "key": frame["key"], "start": frame["start"], "center": list(mean + np.array(frame["center"].tolist(), float).reshape(-1, P)),
            "precision": [[x[i, j] for i, j in PAIRS] for x in inverse], "log_det": np.linalg.slogdet(cov)[1],
        })


def _fitted(rows: DataFrame, centers: DataFrame) -> DataFrame:
    """Estimates from rows of ``key, start`` and their differences ``y`` from the center."""
    y = [F.col("y")[i] for i in range(P)]
    sums = rows.groupBy("key", "start").agg(*[F.avg(v).alias(f"m_{i}") for i, v in enumerate(y)], *[F.avg(y[i] * y[j]).alias(f"m_{i}_{j}") for i, j in PAIRS])
    sums = sums.select("key", "start", F.array(*[f"m_{i}" for i in range(P)]).alias("m1"), F.array(*[f"m_{i}_{j}" for i, j in PAIRS]).alias("m2"))
    return sums.join(centers, [c for c in ("key", "start") if c in centers.columns]).mapInPandas(_estimates, ESTIMATE)


def _keyed(vectors: DataFrame) -> DataFrame:
    """A key for each row: its language and source, or a pool of small groups."""
    sizes = vectors.groupBy("lang", "source").agg(F.count("*").alias("n"))
    by_lang = F.sum(F.when(F.col("n") < LEAST_ROWS, F.col("n")))
    pools = sizes.groupBy("lang").agg(by_lang.alias("pool"))
    keys = sizes.join(common.small(pools), "lang").select(
        "lang", "source",
        F.when(F.col("n") >= LEAST_ROWS, F.to_json(F.struct("lang", "source")))
        .when(F.col("pool") >= LEAST_ROWS, F.to_json(F.struct("lang"))).otherwise("").alias("key"),
    )
    return vectors.join(common.small(keys), ["lang", "source"])


def starts(vectors: DataFrame) -> DataFrame:
    """Four first estimates for each key that has enough rows."""
    names = list(FEATURES)
    quartiles = vectors.groupBy("key").agg(*[F.percentile_approx(f, [0.25, 0.5, 0.75], 1000).alias(f) for f in names], F.count("*").alias("n"))
    spread = [F.greatest((F.col(f)[2] - F.col(f)[0]) / 1.349, F.lit(s)) for f, s in FEATURES.items()]
    first = quartiles.where(F.col("n") >= LEAST_ROWS).select("key", F.array(*[F.col(f)[1] for f in names]).alias("center"), F.array(*spread).alias("spread"))
    first = common.staged(first, "mcd")
    plain = first.select(
        "key", F.lit(0).alias("start"), "center", F.array(*[1 / F.col("spread")[i] ** 2 if i == j else F.lit(0.0) for i, j in PAIRS]).alias("precision"),
        F.lit(float("inf")).alias("log_det"),
    )
    diff = [F.col(f) - F.col("center")[i] for i, f in enumerate(names)]
    scaled = [d / F.col("spread")[i] for i, d in enumerate(diff)]
    size = F.greatest(F.sqrt(sum(z * z for z in scaled) / P), F.lit(1e-9))
    bent = [F.tanh(z) * F.col("spread")[i] for i, z in enumerate(scaled)]
    scatters = F.posexplode(F.array(F.array(*diff), F.array(*bent), F.array(*[d / size for d in diff]))).alias("at", "y")
    rows = vectors.join(_mark(first), "key").select("key", scatters).withColumn("start", F.col("at") + 1)
    return plain.unionByName(_fitted(rows, first.select("key", "center")))


def _mark(found: DataFrame) -> DataFrame:
    """A staged table for the rows' tasks, as long as it is counted to be small."""
    return F.broadcast(found) if found.count() <= common.BROADCAST_ROWS // 10 else found


def concentrated(vectors: DataFrame, found: DataFrame) -> DataFrame:
    """One concentration step for each key and start of ``found``."""
    near = vectors.join(_mark(found), "key").withColumn("d", _distance())
    cut = common.staged(near.groupBy("key", "start").agg(F.percentile_approx("d", SHARE, 10000).alias("cut")), "mcd")
    kept = near.join(_mark(cut), ["key", "start"]).where(F.col("d") <= F.col("cut"))
    diff = F.array(*[F.col(f) - F.col("center")[i] for i, f in enumerate(FEATURES)]).alias("y")
    return common.staged(_fitted(kept.select("key", "start", diff), found.select("key", "start", "center")), "mcd")


def estimates(vectors: DataFrame) -> DataFrame:
    """``key, start, center, precision, log_det`` of each key: the least determinant that
    concentration finds; ``vectors`` has a key."""
    vectors = vectors.select("key", *FEATURES)
    found = common.staged(starts(vectors), "mcd")
    for _ in range(TRIAL_STEPS):
        found = concentrated(vectors, found)
    columns = ["key", "start", "center", "precision", "log_det"]
    best = F.min(F.struct("log_det", "start", "center", "precision")).alias("r")
    found = common.staged(found.groupBy("key").agg(best).select("key", "r.*").select(columns), "mcd")
    ended = found.limit(0)
    while True:
        after = concentrated(vectors, found).select("key", *[F.col(c).alias(f"new_{c}") for c in columns[1:]])
        both = common.staged(found.join(after, "key"), "mcd")
        falls = F.col("new_log_det") < F.col("log_det") - STILL
        ended = ended.unionByName(both.where(~falls).select(columns))
        found = both.where(falls).select("key", *[F.col(f"new_{c}").alias(c) for c in columns[1:]])
        if found.isEmpty():
            return common.staged(ended, "mcd")


def quality_rules(docs: DataFrame) -> DataFrame:
    """``doc_id``, the counts, ``base_failed``, ``kept`` and ``distance`` (null without an estimate)
    for each row of ``docs``."""
    vectors = common.staged(transformed(document_statistics(docs)), "statistics")
    # one aggregate over few numbers a row decides the groups; texts are not read again
    keyed = _keyed(vectors)
    found = estimates(keyed)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    scored = keyed.join(common.small(found), "key", "left").withColumn("distance", _distance())
    return scored.select("doc_id", *BASE, failed.alias("base_failed"), (~failed & ~F.coalesce(F.col("distance") > CUTOFF, F.lit(False))).alias("kept"), "distance")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(common.table(spark, sf_dir, "documents"))
