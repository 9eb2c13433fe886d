"""Best-fit packing of documents into sequences of at most ``capacity`` tokens.

A document longer than a sequence is cut into full pieces, its first piece being the shorter one.
Pieces above a third of the capacity are matched, at most two in a sequence, the longest with the
longest that fits beside it; smaller pieces then go, longest first, to the tightest gap.

Which lengths stand together depends only on how many pieces there are of each length, so the plan
is made from that count (at most ``capacity`` numbers), whatever the number of documents. Each piece
finds its place by its length and its rank among the pieces of that length. Ranks are counted within
salted groups, so a length that most pieces have is spread over many tasks.

Defined results: null and empty texts are one piece with the end token alone; repeated rows are
packed each for itself; an empty table gives no rows; other columns are never read.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postroom.llm import common, pretokens
from postroom.llm.token_counts import CHUNK_CHARS, VOCABULARY, merges

CAPACITY = 1024
END_ID = 2
#: Pieces in a salted group, on average, at most.
GROUP_ROWS = 100_000


def token_ids(texts: list[str], path: str, end_id: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts, each with ``end_id`` after it, flat, and where each text's ids end."""
    own = merges(path)
    parts, owner = pretokens.units(texts)
    pieces = pretokens.Pieces(parts)
    ids, n = own.tokens(pieces)
    last = np.append(owner[1:] != owner[:-1], True)
    after = np.cumsum(np.bincount(pieces.text_of, n, len(parts)).astype(np.int64))
    ids = np.insert(ids, after, np.where(last, end_id, own.special[pretokens.SPECIAL]))
    return ids, (after + np.arange(1, len(parts) + 1))[last]


def token_pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """``doc_id, piece, start, length, ids``: the pieces of every document and their ids as
    little-endian unsigned 32-bit numbers; a narrow pass."""
    path = path or public_tokenizers.path(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_ids, texts in common.chunks(batch, ["doc_id", "text"], most=CHUNK_CHARS):
                ids, stop = token_ids(texts, path, end_id)
                total = np.diff(stop, prepend=0)
                n = -(-total // capacity)
                owner = np.repeat(np.arange(len(texts)), n)
                piece = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
                head = (total - (n - 1) * capacity)[owner]
                start = np.where(piece == 0, 0, head + (piece - 1) * capacity)
                length = np.where(piece == 0, head, capacity)
                # the pieces lie in ``ids`` one after another; views of it put into an array by pyarrow are never freed
                ends = np.append(0, np.cumsum(length * 4)).astype(np.int32)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(doc_ids, pa.int64()).take(pa.array(owner)),
                    "piece": pa.array(piece, pa.int32()),
                    "start": pa.array(start, pa.int64()),
                    "length": pa.array(length, pa.int64()),
                    "ids": pa.Array.from_buffers(pa.binary(), len(owner), [None, pa.py_buffer(ends), pa.py_buffer(ids)]),
                })

    return docs.select("doc_id", "text").mapInArrow(common.lean(run), "doc_id long, piece int, start long, length long, ids binary")


@dataclass
class Plan:
    """Runs of equal sequences. For each run and each of its pieces: the piece's length, the first
    rank of that length and the first sequence that the run takes, and the offset of the piece."""

    length: np.ndarray
    rank: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    left = {k: n for k, n in counts.items() if n}
    runs: list[tuple[int, list[int]]] = []
    large = sorted(k for k in left if 3 * k > capacity)
    for a in reversed(large):
        while left[a]:
            fits = [b for b in large[: bisect_left(large, min(a, capacity - a) + 1)] if left[b] > (a == b)]
            if not fits:
                runs.append((left[a], [a]))
                left[a] = 0
                continue
            b = fits[-1]
            n = left[a] // 2 if a == b else min(left[a], left[b])
            runs.append((n, [a, b]))
            left[a] -= n
            left[b] -= n

    # by gap, the runs of sequences that have it
    gaps: dict[int, list[tuple[int, list[int]]]] = {}
    order: list[int] = []

    def put(n: int, held: list[int]) -> None:
        gap = capacity - sum(held)
        if gap not in gaps:
            gaps[gap] = []
            insort(order, gap)
        gaps[gap].append((n, held))

    for n, held in runs:
        put(n, held)
    for s in sorted((k for k in left if 3 * k <= capacity), reverse=True):
        rest = left[s]
        while rest:
            k = bisect_left(order, s)
            if k == len(order):
                # only new sequences: as many of this length in each as fit
                most = capacity // s
                if rest >= most:
                    put(rest // most, [s] * most)
                if rest % most:
                    put(1, [s] * (rest % most))
                break
            gap = order[k]
            n, held = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap], order[k]
            # a gap that took one is the tightest for the next as long as it fits
            most = min(gap // s, rest)
            take = min(n, rest // most)
            if n > take:
                put(n - take, held)
            put(take, [*held, *[s] * most])
            rest -= take * most

    used = dict.fromkeys(left, 0)
    rows, first = [], 0
    for gap in order:
        for n, held in gaps[gap]:
            offset = 0
            for k in held:
                rows.append((k, used[k], first, offset))
                used[k] += n
                offset += k
            first += n
    table = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return Plan(*table.T, sequences=first)


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``pieces`` (``doc_id, piece, length`` and any others, read several times: stage them before)
    with ``sequence_id`` and ``offset``."""
    counts = {int(r["length"]): int(r["n"]) for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    if counts and not 0 < min(counts) <= max(counts) <= capacity:
        raise ValueError(f"a piece is longer than {capacity} tokens or empty")
    plan = best_fit(counts, capacity)
    salts = max(8, -(-sum(counts.values()) // group_rows))
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    before = (
        salted.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
        .withColumn("_before", F.sum("_n").over(Window.partitionBy("length").orderBy("_salt")) - F.col("_n"))
        .drop("_n")
    )
    within = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", F.xxhash64(*pieces.columns))
    ranked = salted.withColumn("_rank", F.row_number().over(within) - 1).join(common.small(before), ["length", "_salt"])
    key = plan.length << 44 | plan.rank

    kept = [c for c in pieces.columns if c not in ("sequence_id", "offset")]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank = batch.column("_at").to_numpy()
            at = np.searchsorted(key, (batch.column("_length").to_numpy() << 44) | rank, "right") - 1
            found = [pa.array(plan.sequence[at] + rank - plan.rank[at], pa.int64()), pa.array(plan.offset[at], pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *found], [*kept, "sequence_id", "offset"])

    rows = ranked.select(*kept, F.col("length").cast("long").alias("_length"), (F.col("_before") + F.col("_rank")).alias("_at"))
    schema = T.StructType([*pieces.select(*kept).schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return rows.mapInArrow(common.lean(place), schema)


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_digests(common.table(spark, sf_dir, "documents"))


def packed_digests(docs: DataFrame) -> DataFrame:
    pieces = token_pieces(docs).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return pack(common.staged(pieces, "pieces"))
