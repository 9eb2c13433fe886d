"""Delimited and JSON record loads against a declared schema
(SURVEY 2.1 S5-S7, 2.5 E19, 2.6 U1; 7.4 "Jagged vs unknown fields").

Rules of the load: a row with more fields than the schema is an error
unless ``ignore_unknown_values`` (extra fields dropped); a row with fewer is
an error unless ``allow_jagged_rows`` (missing fields NULL); a value that
does not fit its type is an error. Errors go to the error split with a
reason, or fail the load (``on_error='fail'``).

Splittable path (``skip_leading_rows`` 0 or 1): Spark's CSV reader in
PERMISSIVE mode reads every field as text, with ``columnNameOfCorruptRecord``
marking rows whose field count is wrong; only those are re-read with
``from_csv`` and one spare column to tell long rows from short ones. Types
come from ``try_cast`` in the same pass.

With ``allow_quoted_newlines`` a row is not a line, and more than one leading
row has no reader option: the files are cut into records first, splittable
all the same (``sources.blocks``; ``_lines_after`` without quoted line ends),
and ``from_csv`` reads the records. The same goes for JSON arrays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postroom.session import work_path
from postroom.sources.blocks import PATH, _pieces, json_objects, quoted_records
from postroom.sources.inferred import read_inferred

EXTRA = "_extra"


class LoadError(Exception):
    pass


def _sep(field_delimiter) -> str:
    if field_delimiter is None:
        return ","
    if field_delimiter in ("tab", "\\t", "\t"):
        return "\t"
    return field_delimiter


def _string_schema(schema: T.StructType, extra: bool) -> T.StructType:
    fields = [T.StructField(f.name, T.StringType()) for f in schema.fields]
    if extra:
        fields.append(T.StructField(EXTRA, T.StringType()))
    return T.StructType(fields)


def _classify(shape: Column, values: Column, schema: T.StructType, ignore_unknown: bool, allow_jagged: bool) -> Column:
    """Reason a row is bad (NULL when good). ``shape`` is ``long``,
    ``short`` or NULL; ``values`` the fields after the null marker."""
    bad_type = F.lit(False)
    bad_cols = []
    for f in schema.fields:
        v = values[f.name]
        if isinstance(f.dataType, T.StringType):
            continue
        fail = v.isNotNull() & (F.trim(v) != "") & v.try_cast(f.dataType).isNull()
        bad_type = bad_type | fail
        bad_cols.append(F.when(fail, F.lit(f.name)))
    reason = F.when((shape == "long") & F.lit(not ignore_unknown), F.lit("too many fields"))
    reason = reason.when((shape == "short") & F.lit(not allow_jagged), F.lit("too few fields"))
    reason = reason.when(bad_type, F.concat(F.lit("bad value: "), F.concat_ws(",", *bad_cols)) if bad_cols else F.lit("bad value"))
    return reason


def _apply_null_marker(c: Column, null_marker: str | None) -> Column:
    """The marker (default: the empty string) is NULL."""
    return F.when(c == F.lit("" if null_marker is None else null_marker), F.lit(None).cast("string")).otherwise(c)


CORRUPT = "_corrupt_record"


def read_delimited(
    spark: SparkSession,
    path,
    schema: T.StructType | None = None,
    field_delimiter=None,
    skip_leading_rows: int = 0,
    allow_quoted_newlines: bool = False,
    ignore_unknown_values: bool = False,
    allow_jagged_rows: bool = False,
    null_marker: str | None = None,
    quote_character: str | None = None,
    on_error: str = "split",
    encoding: str = "UTF-8",
    path_col: str | None = None,
    detect: bool = False,
):
    """S5 (S5a-S5g), E19. Without a schema the types are inferred (E19) by
    Spark's reader; with ``detect`` from all values, by the names in each
    file's own first line (``read_inferred``).

    Returns ``(good, bad)`` for ``on_error='split'`` (bad rows carry
    ``_raw`` and ``_reason``), the good rows for ``'drop'``, for ``'fail'``
    the good rows after checking there is no bad row, and for ``'tag'``
    every row (typed values, ``_raw``, ``_reason``) from one scan. With
    ``path_col`` the good rows carry their file's path.
    """
    carried = [F.col(PATH).alias(path_col)] if path_col else []
    sep = _sep(field_delimiter)
    skip = int(skip_leading_rows or 0)
    opts = {"sep": sep, "encoding": encoding}
    if quote_character is not None:
        # a quote inside a quoted value is doubled
        opts |= {"quote": quote_character, "escape": quote_character}
    if allow_quoted_newlines:
        opts["multiLine"] = "true"
    if schema is None:
        if null_marker is not None:
            opts["nullValue"] = null_marker
        if skip > 1:
            raise ValueError("more than one leading row needs a schema")
        if detect:
            if skip != 1 or allow_quoted_newlines:
                raise ValueError("detection needs one leading row, and rows that are lines")
            df = read_inferred(spark, path, sep, quote_character or '"', null_marker, encoding, path_col)
            return (df, None) if on_error == "split" else df
        df = spark.read.options(**opts).option("header", skip >= 1).option("inferSchema", "true").csv(path)
        if path_col:
            df = df.withColumn(path_col, F.col("_metadata.file_path"))
        return (df, None) if on_error == "split" else df

    # Every field as text: exactly the declared columns plus the
    # corrupt-record column, which Spark fills only when a row has the
    # wrong number of fields. Only those rows are re-read with one more
    # column to tell long from short. One scan; types by ``try_cast``.
    # CSV column pruning stays off for this read: with it, a row's
    # length is judged against only the columns a plan needs, so the
    # split would depend on the projection.
    opts.pop("multiLine", None)
    if null_marker is not None:
        opts["nullValue"] = null_marker
    fields = T.StructType(_string_schema(schema, False).fields + [T.StructField(CORRUPT, T.StringType())])
    if allow_quoted_newlines or skip > 1:
        if allow_quoted_newlines:
            quote = quote_character or '"'
            opts |= {"quote": quote, "escape": quote}
            lines = quoted_records(spark, path, sep, quote, skip, encoding)
        else:
            lines = _lines_after(spark, path, skip, encoding).where("value <> ''")
        row = F.from_csv("value", fields.simpleString(), {k: v for k, v in opts.items() if k != "encoding"} | {"columnNameOfCorruptRecord": CORRUPT, "mode": "PERMISSIVE"})
        # a generator's output: a filter on a column would otherwise parse the row again for each field it asks for
        raw = lines.select(PATH, F.inline(F.array(row)))
    else:
        raw = (
            spark.read.options(**opts).option("header", skip == 1).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", "false").schema(fields).csv(path)
            .withColumn(PATH, F.col("_metadata.file_path"))
        )
    csv_opts = {k: v for k, v in opts.items() if k in ("sep", "quote", "escape", "nullValue")}
    wide = F.from_csv(F.col(CORRUPT), _string_schema(schema, True).simpleString(), csv_opts)
    shape = F.when(F.col(CORRUPT).isNull(), F.lit(None).cast("string")).when(wide[EXTRA].isNotNull(), F.lit("long")).otherwise(F.lit("short"))
    line = F.coalesce(F.col(CORRUPT), F.concat_ws(sep, *[F.coalesce(F.col(n), F.lit("")) for n in schema.names]))
    strings = raw.select(PATH, *schema.names, shape.alias("_shape"), line.alias("_line"))
    values = F.struct(*[_apply_null_marker(F.col(f.name), null_marker).alias(f.name) for f in schema.fields])
    tagged = strings.withColumn("_v", values)
    tagged = tagged.withColumn("_reason", _classify(F.col("_shape"), F.col("_v"), schema, ignore_unknown_values, allow_jagged_rows))
    typed = [F.col("_v")[f.name].try_cast(f.dataType).alias(f.name) for f in schema.fields]
    if on_error == "tag":
        return tagged.select(*typed, F.col("_line").alias("_raw"), "_reason")
    good = tagged.where(F.col("_reason").isNull()).select(*typed, *carried)
    bad = tagged.where(F.col("_reason").isNotNull()).select(F.col("_line").alias("_raw"), "_reason")
    return _finish(good, bad, on_error)


def _finish(good, bad, on_error):
    if on_error == "split":
        return good, bad
    if on_error == "fail":
        # all tasks at once; a limit would look at one, then at four, ...
        first = bad.agg(F.min("_reason")).first()[0]
        if first is not None:
            raise LoadError(f"load rejected: {first}")
    return good


def _lines_after(spark: SparkSession, path, skip: int, encoding: str = "UTF-8") -> DataFrame:
    """``_path, value``: the lines of the files but each one's first
    ``skip``. Row ids of a file's block are consecutive; the lines of the
    blocks before, counted, tell which line of its file a row is. Only blocks
    that may hold leading rows, few or one a file, meet the lines."""
    lines = _pieces(spark, path, "\n", encoding).withColumn("value", F.regexp_replace("value", r"\r\z", ""))
    blocks = lines.groupBy(PATH, "_block").agg(F.count("*").alias("_n"), F.min("_row").alias("_first"))
    before = F.sum("_n").over(Window.partitionBy(PATH).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))
    leading = blocks.withColumn("_before", F.coalesce(before, F.lit(0))).where(F.col("_before") < skip).drop("_n")
    number = F.col("_before") + F.col("_row") - F.col("_first")
    return lines.join(leading, [PATH, "_block"], "left").where(number.isNull() | (number >= skip)).select(PATH, "value")


def read_json_records(spark: SparkSession, path, schema: T.StructType | None = None, array: bool | None = None, path_col: str | None = None) -> DataFrame:
    """JSON records. Files that hold one JSON array (each element a row)
    are cut into their objects, whatever splits they are read in;
    ``.ndjson`` / JSON lines are read as is. Without a schema the objects are
    written as lines first, for Spark to infer one from all of them."""
    if array is None:
        array = not str(path).endswith((".ndjson", ".jsonl"))
    if not array:
        reader = spark.read.schema(schema) if schema is not None else spark.read
        df = reader.json(path)
        return df.withColumn(path_col, F.col("_metadata.file_path")) if path_col else df
    objects = json_objects(spark, path)
    carried = [F.col(PATH).alias(path_col)] if path_col else []
    if schema is None:
        stage = work_path(spark, "json-lines")
        objects.select("value").write.text(stage)
        if not path_col:
            return spark.read.json(stage)
        schema = spark.read.json(stage).schema
    return objects.select(F.from_json("value", schema).alias("r"), *carried).select("r.*", *([path_col] if path_col else []))


def read_records(spark: SparkSession, path, fmt: str = "csv", schema: T.StructType | None = None, **opts):
    """``json`` reads JSON records, anything else delimited text."""
    if str(fmt).lower() == "json":
        return read_json_records(spark, path, schema, opts.get("array"), opts.get("path_col"))
    return read_delimited(spark, path, schema, **opts)
