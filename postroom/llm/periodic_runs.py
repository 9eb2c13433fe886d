"""Periodic runs of words, by seeds extended along diagonals.

A run of smallest period q is a stretch of a diagonal: words i and i + q are equal for at least
``max(LEAST - q, (TIMES - 1) * q)`` places in a row. Lags are taken an octave [L, 2L) at a time. The
least overlap of an octave bounds the length of a k-gram that stands whole in each of its stretches
at a multiple of k; those k-grams are the seeds. A seed meets its occurrences between L and 2L - 1
words on, within its document: one comparison of rolling digests for all seeds and lags. For each
lag, seeds that follow each other belong to one stretch; a table of how far a lag is covered keeps
the first, so that each stretch is extended once, to the left and to the right, by bisection.
Pairs inside a known run of a smaller period can't be a run of their own (Fine and Wilf) and are
dropped before extension, so a text of one repeated word costs no more than any other. Digests are
of 62 bits; stretches are compared word by word at the end and, should one differ, found without
digests.

A chunk of documents is worked on at once, word numbers end to end with a number of its own after
each document. The work is a narrow pass, O(n log n) a document.

Defined results: null and empty texts have no runs, null run columns and the digests of the empty
string; a null ``doc_id`` has no planted copies (``repeated``); repeated rows one row each; an empty
table gives no rows; other columns are never read. Texts of any length are read whole.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from postroom.llm import common

#: A run has at least so many words, and at least so many times its period.
LEAST, TIMES = 24, 3
#: Two primes below 2^31 and the bases of their digests.
PRIMES = (np.int64(2147483647), np.int64(2147483629))
BASES = (np.int64(1103515245), np.int64(1812433253))
#: Seeds times lags compared at a time.
BLOCK_PAIRS = 1_000_000


class Digests:
    """Digests of all stretches of a sequence of nonnegative numbers."""

    def __init__(self, w: np.ndarray):
        n = len(w)
        self.sums, self.inverse = [], []
        for prime, base in zip(PRIMES, BASES):
            power = _powers(base, n + 1, prime)
            self.sums.append(np.append(0, np.cumsum((w + 1) % prime * power[:n] % prime)))
            # times base^(n - i): stretches at different places compare
            self.inverse.append(power[::-1])

    def at(self, begin: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        one, two = ((s[begin + size] - s[begin]) % prime * inverse[begin] % prime for s, inverse, prime in zip(self.sums, self.inverse, PRIMES))
        return one << 31 | two


def _powers(base: np.int64, n: int, prime: np.int64) -> np.ndarray:
    out = np.ones(n, np.int64)
    have = 1
    while have < n:
        step = np.int64(pow(int(base), have, int(prime)))
        more = min(have, n - have)
        out[have : have + more] = out[:more] * step % prime
        have += more
    return out


def _octaves(longest: int, least: int, times: int) -> Iterator[tuple[int, int, int]]:
    """First and last lag of each octave, and the length of its seeds."""
    low = 1
    while times * low <= longest:
        last = min(2 * low - 1, longest // times)
        overlap = min(max(least, times * q) - q for q in {low, last, *(q for q in (least // times, least // times + 1) if low <= q <= last)})
        yield low, last, max(1, (overlap + 1) // 2)
        low *= 2


def _extended(w: Digests, begin: np.ndarray, lag: np.ndarray, most: np.ndarray, left: bool) -> np.ndarray:
    """How many places on, up to ``most``, words at ``begin`` (or before it) and ``lag`` further on
    agree: bisection over digests."""
    low, high = np.zeros(len(begin), np.int64), most.copy()
    while (open_ := low < high).any():
        mid = (low + high + 1) // 2
        at = begin - mid if left else begin
        same = w.at(at, mid) == w.at(at + lag, mid)
        low = np.where(open_ & same, mid, low)
        high = np.where(open_ & ~same, mid - 1, high)
    return low


def _stretches(w: np.ndarray, q: int) -> tuple[np.ndarray, np.ndarray]:
    """All maximal stretches of a lag, word by word."""
    edge = np.diff(np.concatenate([[0], (w[:-q] == w[q:]).astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def runs(w: np.ndarray, begin: np.ndarray, size: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """Rows ``document, start, length, period`` of all runs of documents whose word numbers stand in
    ``w`` at ``begin``, ``size`` of them, ordered by document, start and period."""
    found: list[np.ndarray] = []
    for first, last, k in _octaves(int(size.max(initial=0)), least, times):
        some = np.flatnonzero(size >= max(least, times * first))
        if len(some):
            known = np.concatenate(found) if found else np.zeros((0, 4), np.int64)
            found.append(_octave(w, begin, size, some, known, first, last, k, least, times))
    if not found:
        return np.zeros((0, 4), np.int64)
    every = np.concatenate(found)
    return every[np.lexsort((every[:, 3], every[:, 1], every[:, 0]))]


def _octave(w, begin, size, some, known, first, last, k, least, times) -> np.ndarray:
    """The runs with a period of one octave, in the documents ``some`` that are long enough."""
    n = size[some]
    # documents end to end, a number of its own after each
    place = np.cumsum(n + 1) - (n + 1)
    total = int((n + 1).sum())
    owner = np.repeat(np.arange(len(some)), n + 1)
    inside = np.arange(total) - place[owner]
    real = inside < n[owner]
    seq = np.full(total, -1, np.int64)
    seq[real] = w[begin[some[owner[real]]] + inside[real]]
    seq[~real] = int(w.max(initial=0)) + 1 + np.arange(len(some))
    digests = Digests(seq)

    # how far known runs of smaller periods reach from each place
    reach = np.zeros(total, np.int64)
    slot = np.full(len(size), -1)
    slot[some] = np.arange(len(some))
    held = known[slot[known[:, 0]] >= 0]

    def cover(rows: np.ndarray) -> None:
        at = place[slot[rows[:, 0]]] + rows[:, 1]
        np.maximum.at(reach, at, at + rows[:, 2])

    cover(held)
    reach = np.maximum.accumulate(reach)

    # seeds: whole k-grams at multiples of k within a document, with room for the smallest lag
    seeds = np.flatnonzero(real & (inside % k == 0) & (inside + k + first <= n[owner]))
    grams = digests.at(np.arange(total - k + 1), k) if total >= k else np.zeros(0, np.int64)
    lags = np.arange(first, last + 1)
    hits_at, hits_lag = [], []
    step = max(1, BLOCK_PAIRS // len(lags))
    for b in range(0, len(seeds), step):
        part = seeds[b : b + step]
        to = part[:, None] + lags
        room = to + k <= (place + n)[owner[part]][:, None]
        equal = room & (grams[np.where(room, to, 0)] == grams[part][:, None])
        # inside a known run of a smaller period: no run of its own
        equal &= reach[part][:, None] < to + k
        row, lag = np.nonzero(equal)
        hits_at.append(part[row])
        hits_lag.append(lags[lag])
    if not hits_at:
        return np.zeros((0, 4), np.int64)
    at, lag = np.concatenate(hits_at), np.concatenate(hits_lag)
    # covered already by the seed before it on the same lag: one extension a stretch
    order = np.lexsort((at, lag))
    at, lag = at[order], lag[order]
    new = np.ones(len(at), bool)
    new[1:] = (lag[1:] != lag[:-1]) | (at[1:] != at[:-1] + k) | (owner[at[1:]] != owner[at[:-1]])
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(at)) - 1 if len(head) else head
    lag, start, end = lag[head], at[head], at[tail] + k if len(head) else at[tail]
    doc = owner[start]
    to_left = _extended(digests, start, lag, start - place[doc], True)
    to_right = _extended(digests, end, lag, place[doc] + n[doc] - lag - end, False)
    x, y = start - to_left, end + to_right
    # digests can only make a stretch too long or join two: compare word by word
    wrong = set()
    for i in np.flatnonzero(y - x + lag >= np.maximum(least, times * lag)).tolist():
        if not np.array_equal(seq[x[i] : y[i]], seq[x[i] + lag[i] : y[i] + lag[i]]):
            wrong.add(int(lag[i]))
    if wrong:
        keep = ~np.isin(lag, list(wrong))
        more = [(*_stretches(seq, q), q) for q in sorted(wrong)]
        lag = np.concatenate([lag[keep], *(np.full(len(a), q) for a, _, q in more)])
        x, y = np.concatenate([x[keep], *(a for a, _, _ in more)]), np.concatenate([y[keep], *(b for _, b, _ in more)])
        doc = owner[x]
    long = y - x + lag >= np.maximum(least, times * lag)
    x, y, lag, doc = x[long], y[long], lag[long], doc[long]
    # not its smallest period: a known run holds all of it; a period divides any larger one
    own = reach[x] < y + lag
    rows = np.stack([some[doc], x - place[doc], y - x + lag, lag], axis=1)[own]
    return np.unique(rows, axis=0)


def repeated(n: int, doc_id: int | None) -> np.ndarray | None:
    """Which original word stands at each place of a text that gets planted repetitions, or None."""
    if doc_id is None or not n or (h := zlib.crc32(str(doc_id).encode())) % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    return np.where(at >= a, a + (at - a) % p, at)


SCHEMA = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def _described(ids: list, texts: list[str], plant: bool) -> pa.RecordBatch:
    words: list[list[bytes]] = []
    for i, text in zip(ids, texts):
        held = text.encode().split()
        if plant and (at := repeated(len(held), i)) is not None:
            held = [held[k] for k in at.tolist()]
        words.append(held)
    size = np.fromiter(map(len, words), np.int64, len(words))
    begin = np.cumsum(size) - size
    flat = [w for held in words for w in held]
    numbers = pd.factorize(np.array(flat, object))[0].astype(np.int64) if flat else np.zeros(0, np.int64)
    found = runs(numbers, begin, size)
    edge = np.searchsorted(found[:, 0], np.arange(len(words) + 1))
    columns: dict[str, list] = {c.split()[0]: [] for c in SCHEMA.split(", ")}
    for d, held in enumerate(words):
        mine = found[edge[d] : edge[d + 1], 1:]
        best = (None, None, None, None)
        if len(mine):
            dropped = np.zeros(len(held) + 1, np.int64)
            np.add.at(dropped, mine[:, 0] + mine[:, 2], 1)
            np.add.at(dropped, mine[:, 0] + mine[:, 1], -1)
            held = [held[k] for k in np.flatnonzero(np.cumsum(dropped[:-1]) == 0).tolist()]
            start, length, period = mine[0].tolist()
            for s, n, q in mine.tolist():  # by start, then period: only a greater exponent goes ahead
                if n * period > length * q:
                    start, length, period = s, n, q
            best = (start, length, period, 1000 * length // period)
        values = (ids[d], len(mine), *best, hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in mine.tolist()).encode()).hexdigest(), hashlib.sha256(b" ".join(held)).hexdigest())
        for c, v in zip(columns.values(), values):
            c.append(v)
    kinds = {"long": pa.int64(), "string": pa.string()}
    return pa.RecordBatch.from_pydict({name: pa.array(columns[name], kinds[kind]) for name, kind in (c.split() for c in SCHEMA.split(", "))})


def periodic_runs(docs: DataFrame, plant: bool = False) -> DataFrame:
    """The rows of ``SCHEMA`` for each row of ``docs``; with ``plant`` a tenth of the texts, by their
    id, repeat a part of themselves first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in common.chunks(batch, ["doc_id", "text"]):
                yield _described(ids, texts, plant)

    return docs.select("doc_id", "text").mapInArrow(common.lean(run), SCHEMA)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs(common.table(spark, sf_dir, "documents"), plant=True)
