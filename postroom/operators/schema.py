"""Declared schemas: type mapping, casting and required checks
(SURVEY 1 "Types", 2.5 E17-E19)."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
# Warehouse type names of schema files and their Spark types; any other
# name is a string.
TYPE_MAP = {
    "STRING": T.StringType(),
    "INTEGER": T.LongType(),
    "INT64": T.LongType(),
    "FLOAT": T.DoubleType(),
    "FLOAT64": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(),
    "DATETIME": T.TimestampNTZType(),
}
# ----------------------------------------------------------------------------


def spark_type(name: str) -> T.DataType:
    return TYPE_MAP.get(str(name).upper(), T.StringType())


def load_schema(spec) -> tuple[T.StructType, list[str]]:
    """A schema file (path or parsed list of ``{name, type, mode}``) to a
    StructType (all nullable) and the list of REQUIRED columns. Nested
    ``fields`` and ``policyTags`` are ignored, as in the reference."""
    if isinstance(spec, str):
        with open(spec) as fh:
            spec = json.load(fh)
    fields, required = [], []
    for f in spec:
        fields.append(T.StructField(f["name"], spark_type(f.get("type", "STRING")), True))
        if str(f.get("mode", "NULLABLE")).upper() == "REQUIRED":
            required.append(f["name"])
    return T.StructType(fields), required


def _present(c: Column) -> Column:
    return c.isNotNull() & (F.trim(c.cast("string")) != "")


def cast_to_schema(df: DataFrame, schema: T.StructType, on_error: str = "null", errors_col: str = "_errors"):
    """Every declared column ``try_cast`` to its type; ``errors_col``
    lists the columns whose non-empty value did not cast. Missing columns
    are NULL, undeclared ones dropped.

    ``on_error``: ``null`` returns the frame with NULLs and the list;
    ``split`` returns ``(good, bad)``; ``fail`` returns the frame, which
    raises at run time on the first bad value (ANSI ``cast``).
    """
    cols, errs = [], []
    for f in schema.fields:
        raw = F.col(f.name) if f.name in df.columns else F.lit(None).cast("string")
        if on_error == "fail":
            cols.append(raw.cast(f.dataType).alias(f.name))
            continue
        typed = raw.try_cast(f.dataType)
        cols.append(typed.alias(f.name))
        errs.append(F.when(_present(raw) & typed.isNull(), F.lit(f.name)))
    if on_error == "fail":
        return df.select(*cols)
    out = df.select(*cols, F.filter(F.array(*errs), lambda x: x.isNotNull()).alias(errors_col))
    if on_error == "split":
        return out.where(F.size(errors_col) == 0).drop(errors_col), out.where(F.size(errors_col) > 0)
    return out


def check_required(df: DataFrame, columns: Sequence[str], on_error: str = "null", missing_col: str = "_missing"):
    """REQUIRED columns must not be NULL. ``missing_col`` lists the
    NULL ones; ``split`` returns ``(good, bad)``."""
    miss = F.filter(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns]), lambda x: x.isNotNull()) if columns else F.array().cast("array<string>")
    out = df.withColumn(missing_col, miss)
    if on_error == "split":
        return out.where(F.size(missing_col) == 0).drop(missing_col), out.where(F.size(missing_col) > 0)
    return out


def schema_json(schema: T.StructType, required: Iterable[str] = ()) -> list[Mapping]:
    """StructType back to a schema file's list of fields."""
    rev = {v.simpleString(): k for k, v in TYPE_MAP.items() if k in ("STRING", "INTEGER", "FLOAT", "BOOLEAN", "DATE", "DATETIME")}
    req = set(required)
    return [{"name": f.name, "type": rev.get(f.dataType.simpleString(), "STRING"), "mode": "REQUIRED" if f.name in req else "NULLABLE"} for f in schema.fields]
