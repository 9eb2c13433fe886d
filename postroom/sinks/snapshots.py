"""Snapshots of a table.

A table is a folder of data files and a manifest per version: one row a
file, with its path, rows, bytes, and the least and greatest value (and the
nulls) of the columns that loads are told by: the partition, merge keys,
clustering fields. A load writes its files, then its manifest; readers plan
from the newest complete manifest and list no folder. So a load of many
partitions, or a merge, becomes visible at once or not at all, old snapshots
can be read, and days share files: the rows of a file are sorted by day, and
replacing a day rewrites only the files that hold it.

    <table>/data/<load>/part-*.parquet
    <table>/_manifest/000001/{schema,files}

Two loads that would make the same version can't both: the second finds its
manifest's folder taken and fails. What a failed load wrote is never read.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFEST, DATA = "_manifest", "data"
#: Values up to which files are tested for each; beyond, for their range.
MOST_VALUES = 500
#: Bits of a field's rank in a clustering curve.
RANK_BITS = 6
_ORDERED = (T.StringType, T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of ``path``, the path in it, and the JVM."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def versions(spark: SparkSession, dest: str) -> list[int]:
    """The complete versions of the table, oldest first."""
    fs, p, jvm = file_system(spark, f"{dest.rstrip('/')}/{MANIFEST}")
    if not fs.exists(p):
        return []
    found = [st.getPath() for st in fs.listStatus(p)]
    return sorted(int(f.getName()) for f in found if fs.exists(jvm.org.apache.hadoop.fs.Path(f, "files/_SUCCESS")))


def _folder(dest: str, version: int) -> str:
    return f"{dest.rstrip('/')}/{MANIFEST}/{version:06d}"


def manifest(spark: SparkSession, dest: str, version: int | None = None) -> DataFrame:
    """One row a data file of a version (the newest): ``path, rows, bytes``
    and ``min_<c>, max_<c>, nulls_<c>`` of the columns that are told."""
    return spark.read.parquet(f"{_folder(dest, version or versions(spark, dest)[-1])}/files")


def schema_of(spark: SparkSession, dest: str, version: int | None = None) -> T.StructType:
    import json

    text = spark.read.text(f"{_folder(dest, version or versions(spark, dest)[-1])}/schema").first()[0]
    return T.StructType.fromJson(json.loads(text))


def overlapping(files: DataFrame, ranges: Mapping[str, tuple]) -> DataFrame:
    """The manifest rows of files that may hold a row with every column of
    ``ranges`` between its two bounds."""
    for name, (low, high) in ranges.items():
        if f"min_{name}" in files.columns:
            least, most = F.col(f"min_{name}"), F.col(f"max_{name}")
            files = files.where((least <= F.lit(high)) & (most >= F.lit(low)) | least.isNull() & (F.col(f"nulls_{name}").isNull()))
    return files


def read_files(spark: SparkSession, dest: str, files: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows of the files of some manifest rows."""
    paths = [f"{dest.rstrip('/')}/{r['path']}" for r in files.select("path").collect()]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def read(spark: SparkSession, dest: str, version: int | None = None, ranges: Mapping[str, tuple] | None = None, schema: T.StructType | None = None) -> DataFrame:
    """A snapshot; with ``ranges`` only files that may hold such rows are
    read (their other rows come too)."""
    version = version or versions(spark, dest)[-1]
    return read_files(spark, dest, overlapping(manifest(spark, dest, version), ranges or {}), schema or schema_of(spark, dest, version))


def _ordinal(c: Column, kind: T.DataType) -> Column:
    """A number in the order of the values."""
    if isinstance(kind, T.StringType):
        return F.conv(F.rpad(F.hex(F.substring(c.cast("binary"), 1, 6)), 12, "0"), 16, 10).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    return F.unix_date(c).cast("double") if isinstance(kind, T.DateType) else c.cast("double")


def _below(c: Column):
    return lambda bound: bound < c


def curve(df: DataFrame, fields: Sequence[str]) -> Column:
    """K9: a place on a space-filling curve: each field's rank among its
    quantiles, their bits interleaved, so that a stretch of the curve is
    narrow in every field. One aggregate finds the quantiles."""
    cuts = [i / 2**RANK_BITS for i in range(1, 2**RANK_BITS)]
    numbers = {f: _ordinal(F.col(f), df.schema[f].dataType) for f in fields}
    found = df.agg(*[F.percentile_approx(n, cuts, 10_000).alias(f) for f, n in numbers.items()]).first()
    out = F.lit(0)
    for k, (f, n) in enumerate(numbers.items()):
        bounds = F.array(*[F.lit(x) for x in found[f] or []]).cast("array<double>")
        rank = F.coalesce(F.size(F.filter(bounds, _below(n))), F.lit(0))
        for bit in range(RANK_BITS):
            out = out + F.shiftleft(F.shiftright(rank, bit).bitwiseAND(F.lit(1)), bit * len(fields) + len(fields) - 1 - k)
    return out


def arranged(df: DataFrame, fields: Sequence[str], file_rows: int | None = None) -> DataFrame:
    """Rows range-partitioned and sorted by the fields (along a curve for
    several), so that each file is narrow in them. Rows of one value, a hot
    day, spread over tasks by a hash of the row."""
    if not fields:
        return df
    plain = [f.name for f in df.schema.fields if isinstance(f.dataType, _ORDERED)]
    spread = F.xxhash64(*plain) if plain else F.lit(0)
    place = [F.col(fields[0])] if len(fields) == 1 else [curve(df, fields)]
    count = [max(1, -(-df.count() // file_rows))] if file_rows else []
    return df.repartitionByRange(*count, *place, spread).sortWithinPartitions(*place)


def write(df: DataFrame, dest: str, told: Sequence[str], fields: Sequence[str] = (), file_rows: int | None = None) -> DataFrame:
    """Write the rows as data files, not visible yet; their manifest rows."""
    load = uuid.uuid4().hex
    folder = f"{dest.rstrip('/')}/{DATA}/{load}"
    out = arranged(df, fields, file_rows).write.mode("error")
    (out.option("maxRecordsPerFile", file_rows) if file_rows else out).parquet(folder)
    rows = df.sparkSession.read.schema(df.schema).parquet(folder)
    told = [c for c in dict.fromkeys(told) if isinstance(df.schema[c].dataType, _ORDERED)]
    values = [x for c in told for x in (F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}"), F.count_if(F.col(c).isNull()).alias(f"nulls_{c}"))]
    per = rows.groupBy(F.col("_metadata.file_name").alias("name"), F.col("_metadata.file_size").alias("bytes")).agg(F.count("*").alias("rows"), *values)
    return per.withColumn("path", F.concat(F.lit(f"{DATA}/{load}/"), "name")).drop("name")


def commit(spark: SparkSession, dest: str, schema: T.StructType, *files: DataFrame | None) -> int:
    """Publish a version whose files are the given manifest rows."""
    version = (versions(spark, dest) or [0])[-1] + 1
    every = None
    for part in files:
        if part is not None:
            every = part if every is None else every.unionByName(part, allowMissingColumns=True)
    folder = _folder(dest, version)
    # the first to make the folder has the version
    spark.createDataFrame([(schema.json(),)], "schema string").coalesce(1).write.mode("error").text(f"{folder}/schema")
    every.coalesce(1).write.mode("error").parquet(f"{folder}/files")
    return version


def told_columns(files: DataFrame) -> list[str]:
    return [c[len("min_"):] for c in files.columns if c.startswith("min_")]


def relative_path() -> Column:
    """The manifest's path of the file a row is read from."""
    return F.regexp_extract(F.col("_metadata.file_path"), f"({DATA}/[^/]+/[^/]+)$", 1)


def expire(spark: SparkSession, dest: str, keep: int = 1) -> int:
    """Remove all but the newest ``keep`` versions, and the files that only
    they have; the number of files removed."""
    every = versions(spark, dest)
    gone, stay = every[:-keep], every[-keep:]
    if not gone:
        return 0
    paths = lambda vs: [manifest(spark, dest, v).select("path") for v in vs]
    union = lambda parts: parts[0] if len(parts) == 1 else union([parts[0].union(parts[1]), *parts[2:]])
    dead = union(paths(gone)).distinct().join(union(paths(stay)).distinct(), "path", "left_anti")
    fs, _, jvm = file_system(spark, dest)
    n = 0
    for r in dead.toLocalIterator():
        n += fs.delete(jvm.org.apache.hadoop.fs.Path(f"{dest.rstrip('/')}/{r['path']}"), False)
    for v in gone:
        fs.delete(jvm.org.apache.hadoop.fs.Path(_folder(dest, v)), True)
    return n
