"""Record checks.

The reference validates job documents against a rule schema; here the same
rule kinds run over the rows of a table. ``rules`` maps a column to its
rules: ``required``, ``nullable``, ``type`` (one name or several),
``allowed``, ``min``/``max``, ``dependencies`` (a list of columns, or
``{column: [values]}``), ``oneof`` (list of rule sets, exactly one must
hold) and ``match_filename`` (value equals the stem of the row's file).
A table has no "absent" value, so absent and NULL are the same here.
Every check is a Column expression; ``violations`` is an array of
``"column: rule"`` strings, empty when the row is valid.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postroom.functions.names import splitext_stem

# --- fixed values -----------------------------------------------------------
# Rule type names and the Spark type a value must cast to.
RULE_TYPES = {
    "integer": "bigint",
    "float": "double",
    "number": "double",
    "boolean": "boolean",
    "date": "date",
    "datetime": "timestamp_ntz",
}
# Rule types that are about how a value is held, as patterns of Spark types.
HELD_AS = {"string": "^(string|char|varchar)", "list": "^array", "dict": "^(struct|map)"}
NESTED = "^(array|struct|map)"
# ----------------------------------------------------------------------------


def _type_ok(c: Column, types) -> Column:
    """A value fits a type that its text can be cast to; it is a string only
    if that is how it is held, and a list or dict likewise."""
    types = [types] if isinstance(types, str) else list(types)
    ok = F.lit(False)
    for t in types:
        if t in HELD_AS:
            ok = ok | F.typeof(c).rlike(HELD_AS[t])
        else:
            ok = ok | ~F.typeof(c).rlike(NESTED) & c.cast("string").try_cast(RULE_TYPES[t]).isNotNull()
    return c.isNull() | ok


def _rule_checks(name: str, rule: Mapping, file_col: str | None, c: Column | None = None, kind: T.DataType | None = None, beside=F.col, allow_unknown: bool = True) -> list[tuple[str, Column]]:
    """(rule name, passes) pairs for one column's rules, or for the part
    ``c`` of a column, of type ``kind`` where that is known; ``beside`` gives
    a sibling of it by name."""
    c = F.col(name) if c is None else c
    out = []
    if rule.get("required"):
        out.append(("required", c.isNotNull()))
    if rule.get("nullable") is False:
        out.append(("nullable", c.isNotNull()))
    if "type" in rule:
        out.append(("type", _type_ok(c, rule["type"])))
    if "allowed" in rule:
        out.append(("allowed", c.isNull() | c.isin(*rule["allowed"])))
    if "min" in rule:
        out.append(("min", c.isNull() | (c >= F.lit(rule["min"]))))
    if "max" in rule:
        out.append(("max", c.isNull() | (c <= F.lit(rule["max"]))))
    dep = rule.get("dependencies")
    if dep:
        if isinstance(dep, str):
            dep = [dep]
        if isinstance(dep, Mapping):
            cond = F.lit(True)
            for other, vals in dep.items():
                vals = vals if isinstance(vals, (list, tuple)) else [vals]
                cond = cond & F.coalesce(beside(other).isin(*vals), F.lit(False))
        else:
            cond = F.lit(True)
            for other in dep:
                cond = cond & beside(other).isNotNull()
        out.append(("dependencies", c.isNull() | cond))
    below = rule.get("schema") or {}
    for key, inner in below.items():
        # a dict's keys, or every item of a list
        if key == "items":
            item = kind.elementType if isinstance(kind, T.ArrayType) else None
            out.append(("items", c.isNull() | F.forall(c, _item_check(name, inner, file_col, item, allow_unknown))))
        elif isinstance(kind, T.StructType) and key not in kind.names:
            # a key that no row has
            if inner.get("required"):
                out.append((f"{key}: required", c.isNull()))
        else:
            part = kind[key].dataType if isinstance(kind, T.StructType) else kind.valueType if isinstance(kind, T.MapType) else None
            checks = _rule_checks(name, inner, file_col, c[key], part, lambda other: _key(c, kind, other), allow_unknown)
            out.extend((f"{key}: {r}", c.isNull() | p) for r, p in checks)
    if below and "items" not in below and not allow_unknown:
        if isinstance(kind, T.StructType):
            out.extend((f"{k}: unknown field", c.isNull() | c[k].isNull()) for k in kind.names if k not in below)
        elif isinstance(kind, T.MapType):
            out.append(("unknown field", c.isNull() | F.forall(F.map_keys(c), lambda k: k.isin(*below))))
    if "oneof" in rule:
        passes = [_all(_rule_checks(name, sub, file_col, c, kind, beside, allow_unknown)) for sub in rule["oneof"]]
        n = sum((p.cast("int") for p in passes), F.lit(0))
        out.append(("oneof", n == 1))
    if rule.get("match_filename") and file_col:
        out.append(("match_filename", c.isNull() | (c == splitext_stem(F.col(file_col)))))
    return [(r, F.coalesce(p, F.lit(False))) for r, p in out]


def _key(c: Column, kind: T.DataType | None, key: str) -> Column:
    """A key of a dict; null if no row has it."""
    return F.lit(None) if isinstance(kind, T.StructType) and key not in kind.names else c[key]


def _item_check(name: str, rule: Mapping, file_col: str | None, kind: T.DataType | None, allow_unknown: bool):
    return lambda item: _all(_rule_checks(name, rule, file_col, item, kind, lambda other: _key(item, kind, other), allow_unknown))


def _all(checks) -> Column:
    ok = F.lit(True)
    for _, p in checks:
        ok = ok & p
    return ok


def violations(df: DataFrame, rules: Mapping[str, Mapping], allow_unknown: bool = False, file_col: str | None = None) -> Column:
    """The ``violations`` array for each row."""
    items = []
    for name, rule in rules.items():
        if name not in df.columns:
            if rule.get("required"):
                items.append(F.lit(f"{name}: required"))
            continue
        for r, p in _rule_checks(name, rule, file_col, None, df.schema[name].dataType, lambda other: F.col(other) if other in df.columns else F.lit(None), allow_unknown):
            items.append(F.when(~p, F.lit(f"{name}: {r}")))
    if not allow_unknown:
        skip = set(rules) | ({file_col} if file_col else set())
        for name in df.columns:
            if name not in skip:
                items.append(F.when(F.col(name).isNotNull(), F.lit(f"{name}: unknown field")))
    if not items:
        return F.array().cast("array<string>")
    return F.filter(F.array(*items), lambda x: x.isNotNull())


def check_records(df: DataFrame, rules: Mapping[str, Mapping], allow_unknown: bool = False, file_col: str | None = None) -> DataFrame:
    """V1-V8: the rows with their ``violations``."""
    return df.withColumn("violations", violations(df, rules, allow_unknown, file_col))


def check_counts(checked: DataFrame) -> DataFrame:
    """A4: total, valid and invalid row counts (one partial+final aggregate)."""
    bad = F.size("violations") > 0
    return checked.agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count_if(~bad).alias("n_valid"),
        F.count_if(bad).alias("n_invalid"),
    )
