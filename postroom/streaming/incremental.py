"""Incremental loads with Structured Streaming.

The reference re-runs a polling batch over a time window and labels the
messages it delivered. Here a file-source stream does that bookkeeping:
its checkpoint remembers which files were processed (R1), each micro
batch is written to a folder keyed by its batch id so a replay after a
crash overwrites rather than duplicates (R2), and the window filter stays
an ordinary predicate inside the batch function (R3).

Windows overlap and exports come again, so a message may stand in several
files. :func:`load_once` keeps the ids it has taken as streaming state, which
expires with the watermark: each id is taken once, late ones until then.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TIME = "_event_time"


def incremental_load(
    spark: SparkSession,
    source_dir: str,
    schema: T.StructType,
    checkpoint: str,
    sink_dir: str,
    fn: Callable[[DataFrame], DataFrame] = lambda df: df,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
    timeout_s: float | None = None,
) -> int:
    """Process every file not seen before, exactly once per batch id;
    returns when all available files are done (``availableNow``). Returns
    the number of micro batches that ran. Raises ``TimeoutError``, with the
    query stopped, when they are not done in ``timeout_s``."""
    stream = _source(spark, source_dir, schema, fmt, max_files_per_trigger)
    return len(_run(stream, checkpoint, sink_dir, fn, timeout_s))


class Loaded(NamedTuple):
    """Of one run: micro batches, rows dropped because their id was taken
    before, rows dropped because they came later than the watermark, and the
    ids that are held when it ends."""

    batches: int
    repeated: int
    late: int
    held: int


def load_once(
    spark: SparkSession,
    source_dir: str,
    schema: T.StructType,
    checkpoint: str,
    sink_dir: str,
    key: Sequence[str],
    time_col: str,
    lateness: str,
    fn: Callable[[DataFrame], DataFrame] = lambda df: df,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
    timeout_s: float | None = None,
) -> Loaded:
    """As :func:`incremental_load`, but rows whose ``key`` was taken
    before, in this file or an earlier one, are left out. ``lateness`` (an
    interval such as ``10 days``) bounds the state: behind the greatest
    ``time_col`` of earlier batches by more than that, rows are late, dropped
    and counted, and ids are forgotten. Rows with a null key are one key; a null
    time fails the batch."""
    stream = _source(spark, source_dir, schema, fmt, max_files_per_trigger)
    when = F.col(time_col).cast("timestamp")
    timed = stream.withColumn(_TIME, F.when(when.isNull(), F.raise_error(F.lit(f"{time_col} is null")).cast("timestamp")).otherwise(when))
    once = timed.withWatermark(_TIME, lateness).dropDuplicatesWithinWatermark(list(key)).drop(_TIME)
    progress = _run(once, checkpoint, sink_dir, fn, timeout_s)
    states = {i: p["stateOperators"][0] for i, p in progress.items() if p and p["stateOperators"]}
    return Loaded(
        len(progress),
        sum(int(s["customMetrics"].get("numDroppedDuplicateRows", 0)) for s in states.values()),
        sum(int(s["numRowsDroppedByWatermark"]) for s in states.values()),
        int(states[max(states)]["numRowsTotal"]) if states else 0,
    )


def _source(spark: SparkSession, source_dir: str, schema: T.StructType, fmt: str, max_files: int | None) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", int(max_files))
    return reader.load(source_dir)


def _run(stream: DataFrame, checkpoint: str, sink_dir: str, fn: Callable[[DataFrame], DataFrame], timeout_s: float | None) -> dict:
    """Each micro batch that ran, with its progress where Spark gave one."""
    sink = sink_dir.rstrip("/")
    ran: dict[int, dict | None] = {}
    queries: list = []

    def note() -> None:
        # Spark keeps the last hundred only: taken batch by batch
        for q in queries:
            ran.update({p["batchId"]: p for p in q.recentProgress if p["batchId"] in ran})

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        fn(batch).write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")
        note()
        ran[batch_id] = None

    q = (
        stream.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    queries.append(q)
    if timeout_s is None:
        q.awaitTermination()
    elif not q.awaitTermination(timeout_s):
        q.stop()
        raise TimeoutError(f"load not done after {timeout_s} s; {len(ran)} batches are written")
    note()
    return ran


def read_sink(spark: SparkSession, sink_dir: str, schema: T.StructType | None = None) -> DataFrame:
    """All batches written so far (``batch_id`` as a column)."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(sink_dir)
