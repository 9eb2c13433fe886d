"""Whitening of embeddings from an exact, bit-sliced scatter matrix.

Components become whole numbers, ``floor(SCALE * c) + OFFSET``, less the least of their dimension.
Each task packs the bit planes of its rows' dimensions across rows into 64-bit words: the sum over
rows of x_i * x_j is the sum over planes b of i and c of j of 2^(b + c) times the number of bits set
in both, so AND and popcount give it exactly. Spark adds the tasks' sums as whole numbers. Centring,
n * sum(x_i x_j) - S_i S_j, stays in whole numbers; only then is the matrix divided by n^2 and its
eigenvectors are taken. Rows are projected in a narrow pass; what every task holds is the mean and a
dimensions x components matrix, never rows.

Defined results: vectors that are null, or hold a null or non-finite component or one whose whole
number is beyond 2^62, take no part, nor do empty ones; a null ``vec_id`` stays null; repeated rows
one row each. Vectors of each length are fitted and whitened among themselves. A component without
variance (eigenvalue at most ``FLAT`` of the largest) has whitened null and takes no part in the
identity's error. A deviation beyond 2^63 - 1 is null. An empty table gives no rows; other columns
are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postroom.llm import common

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
#: Rows whose bit planes a task holds at a time.
BLOCK_ROWS = 8192
#: Words of AND-ed planes held at a time.
BLOCK_WORDS = 4_000_000
#: The part of the largest eigenvalue at or below which a component has no variance.
FLAT = 1e-13


@dataclass
class Whitening:
    """What rows of one length are whitened with. Columns of ``axes`` are eigenvectors by falling
    eigenvalue; ``explained`` their part of the trace; ``scale`` 1 / sqrt(eigenvalue), nan if flat."""

    n: int
    sums: list[int]
    mean: np.ndarray
    axes: np.ndarray
    scale: np.ndarray
    explained: np.ndarray

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) @ self.axes) * self.scale


def valid_vectors(rows: DataFrame, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """``vec_id, size, x`` (whole numbers) of the rows that take part."""
    finite = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double") * scale) < 2.0**62))
    held = rows.where(F.col("embedding").isNotNull() & (F.size("embedding") > 0)).where(finite)
    whole = F.transform("embedding", lambda c: F.floor(c.cast("double") * scale).cast("long") + F.lit(offset).cast("long"))
    return held.select("vec_id", F.size("embedding").alias("size"), whole.alias("x"))


def _matrix(batch: pa.RecordBatch, size: int) -> np.ndarray:
    held = batch.column(batch.schema.get_field_index("x"))
    return held.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(len(batch), size)


def planes(x: np.ndarray, bits: int) -> np.ndarray:
    """Bit planes ``[dimension, bit, word]`` of nonnegative numbers ``x[row, dimension]``, packed
    across rows."""
    rows, size = x.shape
    words = -(-rows // 64)
    out = np.zeros((size, bits, words * 8), np.uint8)
    for b in range(bits):
        packed = np.packbits((x >> b & 1).astype(np.uint8), axis=0, bitorder="little")
        out[:, b, : packed.shape[0]] = packed.T
    return out.view(np.uint64)


def scatter(x: np.ndarray) -> list[int]:
    """Sums over rows of x_i * x_j for i <= j, row by row of the triangle, exact."""
    size = x.shape[1]
    bits = max(1, int(x.max(initial=0)).bit_length())
    held = planes(x, bits)
    flat = held.reshape(size * bits, -1)
    words = flat.shape[1]
    weight = np.arange(bits)
    out: list[int] = []
    for i in range(size):
        rest = flat[i * bits :]
        count = np.empty((bits, len(rest)), np.int64)
        step = max(1, BLOCK_WORDS // max(1, words))
        for b in range(bits):
            for k in range(0, len(rest), step):
                count[b, k : k + step] = np.bitwise_count(rest[k : k + step] & held[i, b]).sum(1, dtype=np.int64)
        # by power of two, so that no product leaves 64 bits
        powers = np.zeros((size - i, 2 * bits - 1), np.int64)
        by_plane = count.reshape(bits, size - i, bits)
        for b in range(bits):
            powers[:, b + weight] += by_plane[b]
        if 2 * bits + len(x).bit_length() < 62:
            out += (powers << np.arange(2 * bits - 1)).sum(1).tolist()
        else:
            out += [sum(int(v) << k for k, v in enumerate(row)) for row in powers]
    return out


def exact_scatter(held: DataFrame, size: int, low: list[int]) -> dict[tuple[int, int], int]:
    """Sums of products of the dimensions less ``low``, by pair of dimensions."""
    base = np.array(low, np.int64)
    first, second = np.triu_indices(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * len(first)
        block: list[np.ndarray] = []

        def add() -> None:
            nonlocal total
            if block:
                total = list(map(int.__add__, total, scatter(np.concatenate(block) - base)))
                block.clear()

        for batch in batches:
            if len(batch):
                block.append(_matrix(batch, size))
            if sum(map(len, block)) >= BLOCK_ROWS:
                add()
        add()
        yield pa.RecordBatch.from_pydict({
            "i": pa.array(first, pa.int32()), "j": pa.array(second, pa.int32()),
            "high": pa.array([v >> 60 for v in total], pa.decimal128(38, 0)), "low": pa.array([v & (1 << 60) - 1 for v in total], pa.decimal128(38, 0)),
        })

    kind = "decimal(38,0)"
    parts = held.select("x").mapInArrow(common.lean(run), f"i int, j int, high {kind}, low {kind}")
    sums = parts.groupBy("i", "j").agg(F.sum(F.col("high")).alias("high"), F.sum(F.col("low")).alias("low"))
    return {(r["i"], r["j"]): (int(r["high"]) << 60) + int(r["low"]) for r in sums.collect()}


def fit(held: DataFrame, size: int, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of rows of one length: one pass for ranges and sums, one for the scatter."""
    # all dimensions in one row: a number each
    picks = [F.struct(F.min(c).alias("low"), F.sum(c.cast("decimal(38,0)")).alias("sum")) for c in (F.col("x")[i] for i in range(size))]
    row = held.agg(F.count("*").alias("n"), F.array(*picks).alias("d")).first()
    n = row["n"]
    if not n:
        return None
    low, sums = [d["low"] for d in row["d"]], [int(d["sum"]) for d in row["d"]]
    products = exact_scatter(held, size, low)
    shifted = [s - n * a for s, a in zip(sums, low)]
    v = np.empty((size, size))
    for (i, j), product in products.items():
        # whole numbers up to here; one rounding
        v[i, j] = v[j, i] = (n * product - shifted[i] * shifted[j]) / (n * n)
    value, axes = np.linalg.eigh(v)
    value, axes = value[::-1], axes[:, ::-1]
    kept = min(components, size)
    value, axes = value[:kept], np.ascontiguousarray(axes[:, :kept])
    trace = float(np.trace(v))
    flat = value <= max(value[0], 0.0) * FLAT
    with np.errstate(divide="ignore", invalid="ignore"):
        scale = np.where(flat, np.nan, 1 / np.sqrt(value))
    explained = np.maximum(value, 0) / trace if trace > 0 else np.full(kept, np.nan)
    return Whitening(n, sums, np.array([s / n for s in sums]), axes, scale, explained)


def identity_error(held: DataFrame, found: Whitening, size: int) -> float | None:
    """The largest entry of the whitened rows' covariance less the identity, measured on the rows."""
    live = np.flatnonzero(~np.isnan(found.scale))
    k = len(live)
    if not k:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            if len(batch):
                z = found.whitened(_matrix(batch, size))[:, live]
                total[:k] += z.T @ z
                total[k] += z.sum(0)
        yield pa.RecordBatch.from_pydict({"at": pa.array(np.arange(total.size), pa.int32()), "v": pa.array(total.ravel())})

    total = np.zeros((k + 1) * k)
    for r in held.select("x").mapInArrow(common.lean(run), "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).collect():
        total[r["at"]] = r["v"]
    total = total.reshape(k + 1, k) / found.n
    return float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max())


SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(rows: DataFrame, components: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """The rows of ``SCHEMA`` for each row of ``vec_id, embedding`` that takes part."""
    held = common.staged(valid_vectors(rows, scale, offset), "whole-vectors")
    out = None
    # lengths there are, not rows
    for size in [r["size"] for r in held.select("size").distinct().orderBy("size").collect()]:
        same = held.where(F.col("size") == size)
        found = fit(same, size, components)
        error = identity_error(same, found, size)
        part = _projected(same, found, size, error)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else rows.sparkSession.createDataFrame([], SCHEMA)


def _projected(held: DataFrame, found: Whitening, size: int, error: float | None) -> DataFrame:
    kept = found.axes.shape[1]

    def deviations(x: np.ndarray) -> list[int | None]:
        """Sums of squares of n * x - S, from the least of each dimension on: n * x and S themselves
        are far larger than their difference."""
        low = x.min(0)
        base = [found.n * int(v) - s for v, s in zip(low, found.sums)]
        if int((x - low).max(initial=0)) * found.n + max(map(abs, base)) < 1 << 62:
            far = found.n * (x - low) + np.array(base, np.int64)
            if size * int(np.abs(far).max()) ** 2 < 1 << 63:
                return (far * far).sum(1).tolist()
        exact = [sum((found.n * v - s) ** 2 for v, s in zip(row, found.sums)) for row in x.tolist()]
        return [v if v < 1 << 63 else None for v in exact]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            x = _matrix(batch, size)
            n = len(batch)
            ids = batch.column(batch.schema.get_field_index("vec_id"))
            z = found.whitened(x).ravel()
            yield pa.RecordBatch.from_pydict({
                "vec_id": ids.take(pa.array(np.repeat(np.arange(n), kept))).cast(pa.int64()), "component": pa.array(np.tile(np.arange(1, kept + 1), n), pa.int32()),
                "n": pa.array(np.full(n * kept, found.n)), "deviation": pa.array(deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(n), kept))),
                "whitened": pa.array(z, mask=np.isnan(z)), "explained": pa.array(np.tile(found.explained, n), mask=np.tile(np.isnan(found.explained), n)),
                "identity_error": pa.array([error] * (n * kept), pa.float64()),
            })

    return held.select("vec_id", "x").mapInArrow(common.lean(run), SCHEMA)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(common.table(spark, sf_dir, "embeddings"))
