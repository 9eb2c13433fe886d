"""Types from values: a lattice as a grouped aggregate.

Every value has the set of types it fits, as bits; a column's type is the
lowest one that all its values fit, so the join of the lattice is ``bit_and``,
combined before any exchange. An integer fits FLOAT too, a date DATETIME, and
everything STRING; two types without one of these in common meet in STRING.

Rules: blank values and nulls say nothing, and a column of only such is a
STRING. Whole numbers beyond 64 bits are text, so that no digit is lost;
leading zeros don't make a number text. Dates are ``yyyy-mm-dd``, times follow
them after a blank or a T, without a zone.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postroom.operators.schema import TYPE_MAP

#: Types from the lowest up; a type's bit is its place.
LATTICE = ("BOOLEAN", "INTEGER", "FLOAT", "DATE", "DATETIME", "STRING")

_DAY = "[0-9]{4}-[0-9]{2}-[0-9]{2}"
_TIME = "[0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,6})?)?"


def fits(c: Column) -> Column:
    """The types that a text fits, as bits; null for a blank one."""
    v = F.trim(c)
    whole = v.rlike("^[+-]?[0-9]+$")
    number = v.rlike("^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$") & v.try_cast("double").isNotNull()
    integer = whole & v.try_cast("long").isNotNull()
    day = v.rlike(f"^{_DAY}$") & v.try_cast("date").isNotNull()
    moment = v.rlike(f"^{_DAY}[ T]{_TIME}$") & v.try_cast("timestamp_ntz").isNotNull()
    held = {
        "BOOLEAN": F.lower(v).isin("true", "false"),
        "INTEGER": integer,
        "FLOAT": integer | (number & ~whole),
        "DATE": day,
        "DATETIME": day | moment,
        "STRING": F.lit(True),
    }
    bits = F.lit(0)
    for place, name in enumerate(LATTICE):
        bits = bits + F.when(held[name], F.lit(1 << place)).otherwise(F.lit(0))
    return F.when(v != "", bits)


def joined(values: Mapping[str, Column]) -> list[Column]:
    """One aggregate a column: the types that all its values fit."""
    return [F.bit_and(fits(c)).alias(name) for name, c in values.items()]


def type_of(bits: int | None) -> T.DataType:
    """The lowest type of a set; of no values at all, STRING."""
    if bits is None:
        return TYPE_MAP["STRING"]
    return TYPE_MAP[next(name for place, name in enumerate(LATTICE) if bits >> place & 1)]


def infer_types(df: DataFrame, columns: Sequence[str] | None = None) -> T.StructType:
    """The schema that the texts in ``columns`` (default: all) have."""
    names = list(df.columns if columns is None else columns)
    if not names:
        return T.StructType([])
    row = df.agg(*joined({n: F.col(f"`{n}`").cast("string") for n in names})).first()
    return T.StructType([T.StructField(n, type_of(row[n])) for n in names])


def typed(c: Column, kind: T.DataType) -> Column:
    """A text as its column's type; texts stay as they are."""
    return c if isinstance(kind, T.StringType) else F.trim(c).try_cast(kind)
