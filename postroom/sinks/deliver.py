"""Delivery to several channels and the processed-state table
(SURVEY 2.2 K13-K15, 2.6 A3)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postroom.session import work_path
from postroom.sinks.tables import load_table, split_partition_suffix, write_blobs, write_delimited, write_files

STATUS_SCHEMA = T.StructType(
    [
        T.StructField("channel", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("error", T.StringType()),
    ]
)


class NoFilesError(Exception):
    pass


def _deliver_one(df: DataFrame, ch: Mapping, n: int) -> int:
    """Delivers and returns how many rows (files, for blobs) were written."""
    kind = ch.get("protocol", "files")
    if kind == "files":
        return _counted(df, n, lambda rows: write_files(rows, ch["dir"], ch.get("format", "parquet"), ch.get("mode", "overwrite"), **ch.get("options", {})))
    elif kind == "delimited":
        return _counted(df, n, lambda rows: write_delimited(rows, ch["dir"], sep=ch.get("sep", "\t"), header=ch.get("header", True), quote=ch.get("quote", "minimal")))
    elif kind == "table":
        return _load(df, ch, ch.get("path_col"))
    elif kind == "blobs":
        return _write_all(df, ch["dir"])
    elif kind == "records":
        return _load_cells(df, ch) if CELL_COLUMNS <= set(df.columns) else _load_records(df, ch)
    else:
        raise ValueError(f"unknown protocol {kind!r}")


def _counted(df: DataFrame, n: int, write) -> int:
    """The rows that a write wrote, by its own metric."""
    if not n:  # a plan that Spark finds empty has no metric
        write(df)
        return 0
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("n")))
    return seen.get["n"]


# What a table of workbook cells has (``xlsx2csv``).
CELL_COLUMNS = {"file", "sheet_no", "row", "col", "value"}


def _load_cells(cells: DataFrame, ch: Mapping) -> int:
    """A table load of workbook cells: the rows of each sheet, typed by the
    channel's schema, without the detour over delimited files. A workbook
    that could not be read, or a value that does not fit, fails the load."""
    from postroom.operators.cells import cells_to_rows
    from postroom.operators.schema import cast_to_schema, load_schema

    if "error" in cells.columns:
        bad = cells.where(F.col("error").isNotNull()).agg(F.min("error")).first()[0]
        if bad is not None:
            raise OSError(bad)
    schema = load_schema(ch["schema"])[0]
    rows = cells_to_rows(cells, schema.names).drop("sheet_no", "row").withColumnRenamed("file", "_file_path")
    typed = cast_to_schema(rows, T.StructType([T.StructField("_file_path", T.StringType()), *schema.fields]), on_error="fail")
    return _load(typed, ch, "_file_path")


def _write_all(files: DataFrame, dest: str) -> int:
    """Every file is written, or the first error is raised."""
    done = write_blobs(files, dest).agg(F.count("*").alias("n"), F.min("error").alias("error")).first()
    if done["error"] is not None:
        raise OSError(done["error"])
    return done["n"]


def _load(df: DataFrame, ch: Mapping, path_col: str | None) -> int:
    """A channel's table load, and its rows. The partition is the channel's ``partition``
    rule, else its ``time_partitioning_field``."""
    dest, suffix = split_partition_suffix(ch.get("dir") or ch["table_id"])
    partition = suffix or ch.get("partition") or ch.get("time_partitioning_field")
    done = load_table(df, dest, ch.get("load_method") or "append", partition, path_col, ch.get("keys"),
                      ch.get("clustering_fields"), order_by=ch.get("order_by"), run_day=ch.get("run_day"), unit=ch.get("time_partitioning_type") or "DAY")
    return done.rows


def _load_records(files: DataFrame, ch: Mapping) -> int:
    """A table load from file rows, as the reference loads delivered files:
    the files are staged under the shared work folder, read as delimited or
    JSON records against the channel's schema (any bad row fails the load),
    and loaded by the channel's method and partition rule (the partition
    regex sees each staged file's path). ``multi_file='last'``: only the file
    with the last name is loaded, as if each replaced the one before."""
    from postroom.operators.schema import load_schema
    from postroom.sources.records import read_records

    spark = files.sparkSession
    stage = work_path(spark, "stage")
    if ch.get("multi_file") == "last":
        last = files.agg(F.max("file_name")).first()[0]
        files = files.where(F.col("file_name") == last)
    _write_all(files, stage)
    schema = load_schema(ch["schema"])[0] if ch.get("schema") else None
    opts = {k: ch[k] for k in ("field_delimiter", "skip_leading_rows", "allow_quoted_newlines", "ignore_unknown_values",
                               "allow_jagged_rows", "null_marker", "quote_character") if ch.get(k) is not None}
    fmt = ch.get("format", "csv")
    if str(fmt).lower() == "json":
        recs = read_records(spark, stage, "json", schema, path_col="_file_path")
    else:
        recs = read_records(spark, stage, fmt, schema, on_error="fail" if schema is not None else "drop", path_col="_file_path", **opts)
    return _load(recs, ch, "_file_path")


def fan_out(df: DataFrame, channels: Sequence[Mapping] | Mapping) -> DataFrame:
    """The same data to every channel; a failing channel does not stop
    the others. The input is written once to the shared work folder, where a
    lost executor can't lose it, and each channel reads it there. Returns one
    status row per channel, with the rows that it wrote by its own count:
    none by a failed one."""
    if isinstance(channels, Mapping):
        channels = [channels]
    spark = df.sparkSession
    stage = work_path(spark, "delivery")
    df.write.parquet(stage)
    staged = spark.read.schema(df.schema).parquet(stage)
    n = staged.count()
    out = []
    for ch in channels:
        name = ch.get("name") or ch.get("dir")
        try:
            out.append((name, "ok", _deliver_one(staged, ch, n), None))
        except Exception as e:  # the channel failed; go on with the rest
            out.append((name, "failed", 0, f"{type(e).__name__}: {e}"))
    return spark.createDataFrame(out, STATUS_SCHEMA)


def failed_count(statuses: DataFrame) -> int:
    """A3: number of failed channels."""
    return statuses.agg(F.count_if(F.col("status") == "failed")).first()[0]


def mark_processed(messages: DataFrame, job: str, run_ts, state_path: str, statuses: DataFrame | None = None) -> bool:
    """Append ``(message_id, job, run_ts)`` to the processed table, only
    when no channel failed. Returns whether it marked."""
    if statuses is not None and failed_count(statuses) > 0:
        return False
    rows = messages.select("message_id", F.lit(job).alias("job"), F.lit(run_ts).cast("timestamp_ntz").alias("run_ts")).distinct()
    load_table(rows, state_path, "append")
    return True


def guard_empty(df: DataFrame, hour: int, ignore_after: int = 23) -> str:
    """A batch with no files is an error, unless the hour is at or past
    ``ignore_after`` (then the run counts as done)."""
    if not df.isEmpty():
        return "ok"
    if hour >= ignore_after:
        return "skipped"
    raise NoFilesError("no expected files matched")


def processed_ids(spark: SparkSession, state_path: str) -> DataFrame:
    from postroom.sinks.tables import read_table, table_exists

    if not table_exists(spark, state_path):
        return spark.createDataFrame([], "message_id string, job string, run_ts timestamp_ntz")
    return read_table(spark, state_path)
