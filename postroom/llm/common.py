"""Helpers shared by the operators: tables, shared work folder, checked broadcasts."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postroom.session import apply_defaults, work_path

#: Characters of text that one vectorised step holds at a time.
CHUNK_CHARS = 800_000
#: Rows up to which a side made of a few numbers a row is broadcast; beyond, the join shuffles.
BROADCAST_ROWS = 1_000_000
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings every operator relies on: package on the workers, and Arrow batches small
    enough that a batch of long texts fits a Python worker."""
    apply_defaults(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1024")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    except Exception:  # a Spark without that setting
        pass
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def release() -> None:
    """Give freed memory back to the system: a Python worker lives on after its task, and what it
    keeps for itself is missing to the tasks that come after."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library
        ctypes.CDLL(None).malloc_trim(0)


def lean(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function for mapInArrow that gives its memory back at the end of the task."""

    def whole(batches: Iterator) -> Iterator:
        yield from run(batches)
        release()

    return whole


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the folder that all executors share and read it back: later jobs
    reread it instead of computing it anew, and a lost executor loses nothing."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it is counted to have at most ``rows`` rows, else as it is."""
    n = df.limit(rows + 1).count()
    return F.broadcast(df) if n <= rows else df


def text_hash(text: str | None) -> int:
    """Spark's ``xxhash64`` of a text, null like empty: with the id it tells rows apart."""
    n = xxhash.xxh64_intdigest((text or "").encode(), 42)
    return n - (1 << 64) if n >> 63 else n


def chunks(batch: pa.RecordBatch, columns: list[str], text: str = "text", most: int = CHUNK_CHARS) -> Iterator[tuple[list, ...]]:
    """Lists of column values in runs of about ``most`` characters; a null text comes as the empty
    string. A longer text is a run of its own, whole."""
    cols = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in columns]
    k = columns.index(text)
    cols[k] = [t or "" for t in cols[k]]
    start = held = 0
    for i, t in enumerate(cols[k]):
        if held and held + len(t) > most:
            yield tuple(c[start:i] for c in cols)
            start, held = i, 0
        held += len(t) + 1
    if start < len(cols[k]):
        yield tuple(c[start:] for c in cols)


def code_points(texts: Iterable[str], sentinel: int) -> tuple[str, np.ndarray, np.ndarray]:
    """All texts in one string and one array of code points, with ``sentinel`` after each text,
    and the places of the sentinels."""
    texts = list(texts)
    joined = "\0".join([*texts, ""])
    codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32).copy()
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1) - 1
    codes[ends] = sentinel
    return joined, codes, ends


def same(joined: str, codes: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for each piece that equal pieces share, and the first piece with each number.
    Pieces are put together by a 64-bit hash, then compared with the first one code by code."""
    if not len(begin):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # 32 bits number the places of a chunk: half the memory of the arrays that have one a character
    small_int = np.int32 if len(codes) < 1 << 31 else np.int64
    before = np.cumsum(size) - size
    place = np.arange(int(size.sum()), dtype=small_int)

    def codes_at(start: np.ndarray) -> np.ndarray:
        return codes[place + np.repeat((start - before).astype(small_int), size)]

    own, inside = codes_at(begin), place - np.repeat(before.astype(small_int), size)
    power = np.cumprod(np.full(int(size.max()), MULTIPLIER))
    hashed = np.add.reduceat((own + np.uint64(1)) * power[inside], before)
    hashed ^= hashed >> np.uint64(29)
    kind, distinct = pd.factorize(hashed)
    first = np.empty(len(distinct), np.int64)
    first[kind[::-1]] = np.arange(len(kind))[::-1]
    chosen = first[kind]
    if not (np.array_equal(size[chosen], size) and np.array_equal(codes_at(begin[chosen]), own)):
        kind, _ = pd.factorize(np.array([joined[a : a + n] for a, n in zip(begin.tolist(), size.tolist())], object))
        first = np.unique(kind, return_index=True)[1]
    return kind, first


class Words:
    """All words ``[^\\x20\\x09-\\x0D]+`` of a list of texts: where they begin, their size, the number
    of their text, and a number for each that equal words share."""

    SENTINEL = 0x110000

    def __init__(self, texts: list[str]):
        self.joined, self.codes, self.ends = code_points(texts, self.SENTINEL)
        gap = (self.codes == 0x20) | ((self.codes >= 0x09) & (self.codes <= 0x0D)) | (self.codes == self.SENTINEL)
        edge = np.diff(np.concatenate([[True], gap]).astype(np.int8))
        self.begin = np.flatnonzero(edge == -1)
        self.size = np.flatnonzero(edge == 1) - self.begin
        self.text_of = np.searchsorted(self.ends, self.begin)
        self.kind, self.first = same(self.joined, self.codes, self.begin, self.size)
