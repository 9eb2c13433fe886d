"""Delimited files without a schema.

Each file's first line names its columns; files may name others, or the same
ones in another order. The result has every name once, by the first place it
has anywhere, and null where a file lacks it. Types are inferred from every
value of every file (``operators.infer``). Three scans of the text: first
lines, types, and the load.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postroom.operators.infer import joined, type_of, typed
from postroom.session import work_path
from postroom.sources.blocks import PATH, _pieces


class HeaderError(ValueError):
    """Names and values of a file don't go together."""


def first_lines(spark: SparkSession, path, sep: str, quote: str, encoding: str = "UTF-8") -> DataFrame:
    """``_path, names``: each file's column names in order, null where one is
    blank. One short row a file, written once to the shared work folder."""
    line = F.regexp_replace(F.min_by("value", "_row"), "^﻿|\\r$", "")
    found = _pieces(spark, path, "\n", encoding).where("_block = 0").groupBy(PATH).agg(line.alias("line"))
    dest = work_path(spark, "first-lines")
    found.write.parquet(dest)
    found = spark.read.schema(found.schema).parquet(dest)
    gaps = (F.length("line") - F.length(F.replace("line", F.lit(sep)))) / len(sep)
    width = int(found.agg(F.max(gaps)).first()[0] or 0) + 1
    cells = F.from_csv("line", ", ".join(f"c{i} string" for i in range(width)), {"sep": sep, "quote": quote, "escape": quote})
    names = F.array(*[F.trim(cells[f"c{i}"]) for i in range(width)])
    return found.select(PATH, F.transform(names, lambda n: F.when(n != "", n)).alias("names"))


def read_inferred(spark: SparkSession, path, sep: str = ",", quote: str = '"', null_marker: str | None = None, encoding: str = "UTF-8", path_col: str | None = None) -> DataFrame:
    """The typed rows of all files. A value without a column name, or a
    name given twice in a file, raises :class:`HeaderError`; missing fields
    at the end of a row are null; files without a line give no rows."""
    headers = first_lines(spark, path, sep, quote, encoding)
    named = F.filter("names", lambda n: n.isNotNull())
    twice = headers.where(F.size(F.array_distinct(named)) < F.size(named)).first()
    if twice:
        raise HeaderError(f"a column name is given twice: {twice[PATH]}")
    # names are as few as a schema's
    found = headers.select(F.posexplode("names").alias("place", "name")).where("name is not null").groupBy("name").agg(F.min("place").alias("place"))
    order = [r["name"] for r in found.orderBy("place", "name").collect()]
    layouts = headers.select("names").distinct().limit(2).collect()
    width = headers.select(F.size("names").alias("n")).first()
    if not order or width is None:
        return spark.createDataFrame([], T.StructType([]))

    fields = [f"c{i}" for i in range(width["n"] + 1)]
    options = {"sep": sep, "quote": quote, "escape": quote, "encoding": encoding, "header": "true", "mode": "PERMISSIVE"}
    if null_marker is not None:
        options["nullValue"] = null_marker
    raw = spark.read.options(**options).schema(", ".join(f"{f} string" for f in fields)).csv(path).withColumn(PATH, F.col("_metadata.file_path"))
    if len(layouts) == 1:
        place = {n: i for i, n in enumerate(layouts[0]["names"]) if n is not None}
        values: dict[str, Column] = {n: F.col(fields[place[n]]) for n in order}
        spare = [F.col(f).isNotNull() for i, f in enumerate(fields) if i not in place.values()]
    else:
        # one row a file: broadcast where Spark finds them small, else split by file
        raw = raw.join(headers, PATH)
        row = F.array(*[F.col(f) for f in fields])
        # a place of 0 is none: get() of -1 is null
        values = {n: F.get(row, F.array_position("names", n).cast("int") - 1) for n in order}
        spare = [F.col(f).isNotNull() & F.get("names", F.lit(i)).isNull() for i, f in enumerate(fields)]
    beyond = F.lit(False)
    for s in spare:
        beyond = beyond | s
    # by number: any name may stand in a header
    numbered = {f"v{i}": values[n] for i, n in enumerate(order)}
    got = raw.agg(*joined(numbered), F.max_by(PATH, beyond).alias("file"), F.max(beyond).alias("beyond")).first()
    if got["beyond"]:
        raise HeaderError(f"a value has no column name: {got['file']}")
    carried = [F.col(PATH).alias(path_col)] if path_col else []
    return raw.select(*[typed(c, type_of(got[v])).alias(n) for (v, c), n in zip(numbered.items(), order)], *carried)
