"""Table and file sinks.

A table is a folder of snapshots (``sinks.snapshots``) on any Hadoop file
system: loads become visible at once or not at all, and a table is never
rewritten while it is read. Rows of a partitioned table carry their
partition in the column ``ds``.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postroom.functions.timewin import partition_stamp
from postroom.session import work_path
from postroom.sinks import snapshots as SN
from postroom.sinks.snapshots import file_system as _fs
from postroom.sinks.snapshots import versions as _versions

PARTITION_COL = "ds"
METHODS = ("append", "replace", "merge")


class Load(NamedTuple):
    """What a load made: the version, and the rows of the batch in it."""

    version: int
    rows: int


def table_exists(spark: SparkSession, dest: str) -> bool:
    return bool(_versions(spark, dest))


def read_table(spark: SparkSession, dest: str, schema: T.StructType | None = None, version: int | None = None, ranges=None) -> DataFrame:
    """The table's newest snapshot, or a given one; a folder of parquet
    files without snapshots as it is. ``ranges``: see ``snapshots.read``."""
    if _versions(spark, dest):
        return SN.read(spark, dest, version, ranges, schema)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(dest)
    return df.withColumn(PARTITION_COL, F.col(PARTITION_COL).cast("string")) if PARTITION_COL in df.columns else df


# -- partition ids (K6, K7, K8) -----------------------------------------------------

# Partition stamps of a date field, by the channel's time_partitioning_type.
STAMPS = {"HOUR": "yyyyMMddHH", "DAY": "yyyyMMdd", "MONTH": "yyyyMM", "YEAR": "yyyy"}


def partition_id(spec, path_col: str | None = None, unit: str = "DAY") -> Column | None:
    """K6: eight digits are the partition; K7: ``regex:<expr>`` takes group
    1 of a search in the file path; any other spec names a date field whose
    day (hour, month, year by ``unit``) is the partition (K8)."""
    if spec is None or spec == "":
        return None
    s = str(spec)
    if s.isdigit() and len(s) == 8:
        return F.lit(s)
    if s.startswith("regex:"):
        if not path_col:
            raise ValueError("regex partition needs the file path column")
        return F.nullif(F.regexp_extract(F.col(path_col), s[len("regex:"):], 1), F.lit(""))
    unit = str(unit or "DAY").upper()
    return partition_stamp(F.col(s)) if unit == "DAY" else F.date_format(s, STAMPS[unit])


def load_table(
    df: DataFrame,
    dest: str,
    method: str = "append",
    partition=None,
    path_col: str | None = None,
    keys: Sequence[str] | None = None,
    cluster_by: Sequence[str] | str | None = None,
    order_by: str | None = None,
    run_day: str | None = None,
    unit: str = "DAY",
    file_rows: int | None = None,
) -> Load:
    """Load ``df`` into the table at ``dest``.

    ``append`` adds files; ``replace`` without a partition replaces the
    table; with one literal partition it replaces only that one (an empty
    input clears it); with partitions computed per row (regex on the file
    path, day of a field) each partition present in the batch is replaced
    once, all in one snapshot; only files that hold such a partition are
    rewritten, without it. ``run_day`` is the partition of rows for
    which the rule finds none, and a ``path_col`` that begins with ``_`` is
    not loaded. ``merge`` upserts on ``keys``; any other word is an error.
    ``cluster_by`` arranges the rows (K9: see ``snapshots.arranged``);
    ``file_rows`` is the most rows of a file.
    """
    if isinstance(cluster_by, str):
        cluster_by = [c.strip() for c in cluster_by.split(",") if c.strip()]
    method = (method or "append").lower()
    if method not in METHODS:
        raise ValueError(f"unknown load method {method!r}")
    spark = df.sparkSession
    if method == "merge":
        if not keys:
            raise ValueError("merge needs keys")
        return merge_table(df, dest, keys, order_by=order_by, file_rows=file_rows)
    old = _files(spark, dest)
    pid = partition_id(partition, path_col, unit)
    if path_col and path_col.startswith("_") and path_col in df.columns:
        df = df.withColumn(PARTITION_COL, pid).drop(path_col) if pid is not None else df.drop(path_col)
        pid = F.col(PARTITION_COL) if pid is not None else None
    if pid is not None and run_day:
        pid = F.coalesce(pid, F.lit(run_day))
    out = df if pid is None else df.withColumn(PARTITION_COL, pid)
    fields = list(cluster_by or ([PARTITION_COL] if pid is not None else []))
    told = [*fields, *([PARTITION_COL] if pid is not None else []), *(SN.told_columns(old) if old is not None else [])]
    new = SN.write(out, dest, [c for c in told if c in out.columns], fields, file_rows)
    stage = work_path(spark, "new-files")
    new.write.parquet(stage)
    new = spark.read.schema(new.schema).parquet(stage)
    rows = new.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    schema = out.schema
    if old is None or method == "replace" and pid is None:
        return Load(SN.commit(spark, dest, schema, new), rows)
    schema = _widened(SN.schema_of(spark, dest), schema)
    if method == "append":
        return Load(SN.commit(spark, dest, schema, old, new), rows)
    literal = str(partition) if partition is not None and str(partition).isdigit() and len(str(partition)) == 8 else None
    days = _days(SN.read_files(spark, dest, new, out.schema)) if literal is None else spark.createDataFrame([(literal,)], "day string")
    kept, rest = _without_days(spark, dest, old, days, schema, told, file_rows)
    return Load(SN.commit(spark, dest, schema, kept, rest, new), rows)


def _files(spark: SparkSession, dest: str) -> DataFrame | None:
    """The table's manifest; None for a new table."""
    if _versions(spark, dest):
        return SN.manifest(spark, dest)
    fs, p, _ = _fs(spark, dest)
    if fs.exists(p) and any(not st.getPath().getName().startswith(("_", ".")) and st.getPath().getName() != SN.DATA for st in fs.listStatus(p)):
        raise ValueError(f"{dest} holds files that are no snapshot's")
    return None


def _widened(old: T.StructType, new: T.StructType) -> T.StructType:
    """The table's columns, then those it hasn't had."""
    return T.StructType([*old.fields, *[f for f in new.fields if f.name not in old.names]])


def _days(df: DataFrame) -> DataFrame:
    """The partitions there are; rows without one are a partition too."""
    return df.select(F.coalesce(F.col(PARTITION_COL), F.lit("")).alias("day")).distinct()


def _without_days(spark, dest, old, days, schema, told, file_rows):
    """The files that hold none of the days, and new ones of the others'
    rows without them (None where there is no such file)."""
    if f"min_{PARTITION_COL}" not in old.columns:
        hit = old
    else:
        least, most, nulls = (F.col(f"{x}_{PARTITION_COL}") for x in ("min", "max", "nulls"))
        least = F.when(F.coalesce(nulls, F.lit(1)) > 0, "").otherwise(least)
        few = [r["day"] for r in days.limit(SN.MOST_VALUES + 1).collect()]
        if len(few) > SN.MOST_VALUES:
            few = list(days.agg(F.min("day"), F.max("day")).first())
            holds = (least <= few[1]) & (most >= few[0]) | (least == "")
        else:
            holds = F.exists(F.array(*[F.lit(d) for d in few]).cast("array<string>"), lambda d: (d >= least) & (d <= F.coalesce(most, F.lit(""))))
        hit = old.where(holds)
    paths = hit.select("path")
    if hit.isEmpty():
        return old, None
    rest = SN.read_files(spark, dest, hit, schema).withColumn("_day", F.coalesce(F.col(PARTITION_COL), F.lit("")))
    rest = rest.join(days.withColumnRenamed("day", "_day"), "_day", "left_anti").drop("_day").select(*schema.names)
    return old.join(paths, "path", "left_anti"), SN.write(rest, dest, [c for c in told if c in rest.columns], [PARTITION_COL], file_rows)


class DuplicateKeyError(Exception):
    pass


def dedupe_keys(src: DataFrame, keys: Sequence[str], order_by: str | None = None) -> DataFrame:
    """One row per key: the last by ``order_by`` when given (ties by the
    other columns). Without it a key that comes twice is an error: any
    choice could differ when a task runs again. Partial + final aggregate,
    so a hot key is combined map-side."""
    if order_by:
        others = [c for c in src.columns if c not in keys]
        plain = [f.name for f in src.schema.fields if f.name in others and not isinstance(f.dataType, (T.MapType, T.VariantType))]
        agg = src.groupBy(*keys).agg(F.max_by(F.struct(*others), F.struct(order_by, *plain)).alias("_r"))
        return agg.select(*keys, "_r.*")
    twice = src.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").limit(1).collect()
    if twice:
        raise DuplicateKeyError(f"{ {k: twice[0][k] for k in keys} } comes {twice[0]['n']} times; give order_by")
    return src


def _same_keys(df: DataFrame, src: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on equal keys; null equals null."""
    other = src.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)])
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_key{i}"))
    return df.join(other, same, how)


def merge_table(src: DataFrame, dest: str, keys: Sequence[str], order_by: str | None = None, file_rows: int | None = None) -> Load:
    """K5: keyed upsert; a null key equals a null key. The manifest tells
    which files may hold a key of ``src`` (least and greatest value); the key
    columns of those tell which do; only those are read whole and rewritten,
    and all other files go on into the new snapshot. Files are sorted by the
    keys, so a merge of near keys touches few. Joins shuffle on the keys,
    with AQE splitting a hot one; nothing is broadcast unless AQE measures
    it small."""
    spark = src.sparkSession
    keys = list(keys)
    stage = work_path(spark, "merge-source")
    once = dedupe_keys(src, keys, order_by)
    once.write.parquet(stage)
    src1 = spark.read.schema(once.schema).parquet(stage)
    rows = src1.count()
    old = _files(spark, dest)
    if old is None:
        return Load(SN.commit(spark, dest, src1.schema, SN.write(src1, dest, keys, keys, file_rows)), rows)
    schema = SN.schema_of(spark, dest)
    bounds = src1.agg(*[x for i, k in enumerate(keys) for x in (F.min(k).alias(f"low{i}"), F.max(k).alias(f"high{i}"), F.count_if(F.col(k).isNull()).alias(f"nulls{i}"))]).first()
    some = old
    for i, k in enumerate(keys):
        if f"min_{k}" not in old.columns:
            continue
        unknown = F.col(f"nulls_{k}").isNull()
        inside = F.lit(False) if bounds[f"low{i}"] is None else (F.col(f"min_{k}") <= F.lit(bounds[f"high{i}"])) & (F.col(f"max_{k}") >= F.lit(bounds[f"low{i}"]))
        some = some.where(unknown | F.coalesce(inside, F.lit(False)) | (F.lit(bounds[f"nulls{i}"] > 0) & (F.col(f"nulls_{k}") > 0)))
    held = SN.read_files(spark, dest, some, schema)
    told = [*keys, *SN.told_columns(old)]
    if some.isEmpty():
        return Load(SN.commit(spark, dest, schema, old, SN.write(src1.select(*schema.names), dest, told, keys, file_rows)), rows)
    hit = _same_keys(held.select(*keys, SN.relative_path().alias("path")), src1, keys, "left_semi").select("path").distinct()
    touched = work_path(spark, "touched-files")
    hit.write.parquet(touched)
    hit = spark.read.schema(hit.schema).parquet(touched)
    kept = _same_keys(SN.read_files(spark, dest, hit, schema), src1, keys, "left_anti")
    merged = kept.select(*schema.names).unionByName(src1.select(*schema.names))
    return Load(SN.commit(spark, dest, schema, old.join(hit, "path", "left_anti"), SN.write(merged, dest, told, keys, file_rows)), rows)


# -- files (K1, K11, K12) ---------------------------------------------------------------

def write_files(df: DataFrame, dest: str, fmt: str = "parquet", mode: str = "overwrite", **options) -> str:
    """K1: deliver a DataFrame as files under ``dest`` in any format."""
    df.write.format(fmt).mode(mode).options(**options).save(dest)
    return dest


_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def write_delimited(df: DataFrame, dest: str, sep: str = "\t", header: bool = True, quote: str = "minimal", null_value: str = "", mode: str = "overwrite") -> str:
    """Delimited text. ``quote='nonnumeric'`` quotes every
    non-numeric value (and the header), numbers stay bare; quotes inside
    values are doubled. Each output file has its own header line."""
    if quote != "nonnumeric":
        # a quote inside a value is doubled, as the loads read it
        w = df.write.mode(mode).option("sep", sep).option("header", header).option("nullValue", null_value).option("escape", '"')
        if quote == "all":
            w = w.option("quoteAll", "true")
        w.csv(dest)
        return dest

    def q(c: Column) -> Column:
        return F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))

    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`").cast("string")
        cols.append(F.coalesce(c if isinstance(f.dataType, _NUMERIC) else q(c), F.lit(null_value)))
    line = F.concat_ws(sep, *cols)
    if header:
        # a task writes one file: the names go before its first row
        names = sep.join('"' + n.replace('"', '""') + '"' for n in df.columns)
        first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
        line = F.when(first, F.concat(F.lit(names + "\n"), line)).otherwise(line)
    df.select(line.alias("value")).write.mode(mode).text(dest)
    return dest


_TABLE_NAME = re.compile(r"\$(\d{8})$")


def split_partition_suffix(table_id: str) -> tuple[str, str | None]:
    """``name$YYYYMMDD`` to ``(name, 'YYYYMMDD')``."""
    m = _TABLE_NAME.search(table_id)
    return (table_id[: m.start()], m.group(1)) if m else (table_id, None)


BLOB_STATUS = T.StructType(
    [
        T.StructField("file_name", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("size", T.LongType()),
        T.StructField("error", T.StringType()),
    ]
)


# What tells files of one name apart, as far as a table has it.
CLASH_COLUMNS = ("message_id", "pos")


def unique_names(files: DataFrame, name_col: str = "file_name") -> DataFrame:
    """The clash rule: files whose name comes more than once get the id of
    their message, and their place in it, before the extension. Names that
    are still equal are an error, never an overwritten file."""
    from postroom.functions.names import splitext_root

    def twice(df: DataFrame) -> DataFrame:
        return df.where(F.col(name_col).isNotNull()).groupBy(name_col).agg(F.count("*").alias("_n")).where("_n > 1").select(name_col)

    clash = twice(files)
    if clash.isEmpty():
        return files
    by = [c for c in CLASH_COLUMNS if c in files.columns]
    few = clash.limit(1_000_001).count() <= 1_000_000
    marked = files.join((F.broadcast(clash) if few else clash).withColumn("_twice", F.lit(True)), name_col, "left")
    root = splitext_root(name_col)
    extension = F.substring(F.col(name_col), F.char_length(root) + 1, F.char_length(name_col))
    longer = F.concat(F.concat_ws("_", root, *[F.col(c).cast("string") for c in by]), extension)
    out = marked.withColumn(name_col, F.when(F.col("_twice"), longer).otherwise(F.col(name_col))).select(*files.columns)
    left = twice(out).limit(1).collect()
    if left:
        raise DuplicateKeyError(f"more than one file is called {left[0][0]}")
    return out


def write_blobs(files: DataFrame, dest: str, name_col: str = "file_name", content_col: str = "content") -> DataFrame:
    """K1 for file rows: each row's bytes become the file ``dest/<name>``,
    names made unique by :func:`unique_names`.

    Names come from mails: only what follows the last slash or backslash of
    a name is taken, without control signs; a name that is null or nothing
    then, or ``.`` or ``..``, is an error, and nothing is written for it.

    ``dest`` is resolved by the session's default file system; tasks write
    their own rows there through ``pyarrow.fs`` (local files, ``hdfs``,
    ``s3`` also as ``s3a`` and ``s3n``, ``gs``, ``abfs``; others are an
    error), so the work splits over the files and a retried task just
    rewrites the same files. Returns one status row per file (lazy: run an
    action over all of it to deliver)."""
    import pandas as pd

    fs, path, _ = _fs(files.sparkSession, dest)
    base = fs.makeQualified(path).toString().rstrip("/")
    base = "file://" + base[5:] if base.startswith("file:/") and not base.startswith("file:///") else base
    base = re.sub(r"^s3[an]://", "s3://", base)
    plain = F.regexp_replace(F.regexp_extract(F.col(name_col), r"([^/\\\\]*)$", 1), r"[\x00-\x1f\x7f]", "")
    files = unique_names(files.withColumn(name_col, F.when(~plain.isin("", ".", ".."), plain)), name_col)

    def run(batches):
        from pyarrow import fs as pafs

        filesystem, root = pafs.FileSystem.from_uri(base)
        filesystem.create_dir(root, recursive=True)
        for pdf in batches:
            out = []
            for name, data in zip(pdf[name_col].tolist(), pdf[content_col].tolist()):
                if name is None or name != name:
                    out.append((None, None, None, "ValueError: a file without a usable name"))
                    continue
                path = f"{root}/{name}"
                try:
                    with filesystem.open_output_stream(path) as fh:
                        fh.write(bytes(data))
                    out.append((name, path, len(data), None))
                except Exception as e:  # reported per file
                    out.append((name, path, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=[f.name for f in BLOB_STATUS.fields])

    return files.select(name_col, content_col).mapInPandas(run, BLOB_STATUS)
