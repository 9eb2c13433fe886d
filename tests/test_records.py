"""Delimited and JSON loads (FIXTURES.md 8)."""

import json
import os

import pytest

from postroom.operators.schema import check_required, load_schema
from postroom.sources import records as REC

SCHEMA, REQUIRED = load_schema([{"name": "a", "type": "INTEGER", "mode": "REQUIRED"}, {"name": "b", "type": "STRING"}])


def write(tmp_dir, name, text):
    p = os.path.join(tmp_dir, name)
    with open(p, "w") as fh:
        fh.write(text)
    return p


def load(spark, path, **kw):
    good, bad = REC.read_delimited(spark, path, SCHEMA, field_delimiter="tab", **kw)
    return sorted((tuple(r) for r in good.collect()), key=str), sorted(r._reason for r in bad.collect())


def test_plain_and_header(spark, tmp_dir):
    p = write(tmp_dir, "a.tsv", "a\tb\n1\tx\n2\t\n")
    assert load(spark, p, skip_leading_rows=1) == ([(1, "x"), (2, None)], [])


def test_short_and_long_rows(spark, tmp_dir):
    p = write(tmp_dir, "a.tsv", "1\tx\n2\n3\ty\tz\n")
    assert load(spark, p) == ([(1, "x")], ["too few fields", "too many fields"])
    assert load(spark, p, allow_jagged_rows=True, ignore_unknown_values=True) == ([(1, "x"), (2, None), (3, "y")], [])


def test_bad_value_and_null_marker(spark, tmp_dir):
    p = write(tmp_dir, "a.tsv", "x1\tq\n\\N\tw\n5\t\\N\n")
    assert load(spark, p, null_marker="\\N") == (sorted([(None, "w"), (5, None)], key=str), ["bad value: a"])


def test_quoted_newline(spark, tmp_dir):
    p = write(tmp_dir, "a.tsv", '1\t"two\nlines"\n2\tz\n')
    assert load(spark, p, allow_quoted_newlines=True) == ([(1, "two\nlines"), (2, "z")], [])


def test_two_leading_rows(spark, tmp_dir):
    p = write(tmp_dir, "a.tsv", "TITLE\na\tb\n1\tx\n2\ty\tz\n")
    assert load(spark, p, skip_leading_rows=2) == ([(1, "x")], ["too many fields"])
    assert load(spark, p, skip_leading_rows=2, ignore_unknown_values=True) == ([(1, "x"), (2, "y")], [])


def test_fail_mode(spark, tmp_dir):
    p = write(tmp_dir, "a.tsv", "1\tx\n2\n")
    with pytest.raises(REC.LoadError):
        REC.read_delimited(spark, p, SCHEMA, field_delimiter="\\t", on_error="fail")


def test_required(spark, tmp_dir):
    p = write(tmp_dir, "a.tsv", "1\tx\n\ty\n")
    good, _ = REC.read_delimited(spark, p, SCHEMA, field_delimiter="tab")
    out = check_required(good, REQUIRED)
    assert sorted((r.b, r._missing) for r in out.collect()) == [("x", []), ("y", ["a"])]


def test_json_array_and_ndjson(spark, tmp_dir):
    arr = write(tmp_dir, "a.json", json.dumps([{"a": 1}, {"a": 2, "b": "x"}]))
    nd = write(tmp_dir, "a.ndjson", '{"a": 1}\n{"a": 2}\n')
    assert sorted(tuple(r) for r in REC.read_json_records(spark, arr, SCHEMA).collect()) == [(1, None), (2, "x")]
    assert sorted(tuple(r) for r in REC.read_records(spark, nd, "json", SCHEMA).collect()) == [(1, None), (2, None)]


def test_infer_schema(spark, tmp_dir):
    p = write(tmp_dir, "a.csv", "a,b\n1,x\n2,y\n")
    df, _ = REC.read_delimited(spark, p, None, skip_leading_rows=1)
    assert dict(df.dtypes) == {"a": "int", "b": "string"}


def test_split_does_not_depend_on_projection(spark, tmp_dir):
    p = write(tmp_dir, "a.tsv", "1\tx\n2\n3\ty\tz\n4\t\n")
    good, bad = REC.read_delimited(spark, p, SCHEMA, field_delimiter="tab")
    assert good.count() == len(good.collect()) == good.select("a").count() == 2
    assert bad.count() == len(bad.collect()) == 2


def test_many_leading_rows_over_splits(spark, tmp_dir):
    """Two leading rows of files that are read in several splits, no Python
    worker; the path goes with the rows."""

    schema = load_schema([{"name": "k", "type": "INTEGER"}, {"name": "v", "type": "STRING"}])[0]
    for n in (0, 1):
        with open(os.path.join(tmp_dir, f"f{n}.tsv"), "w") as f:
            f.write("title\nk\tv\n" + "".join(f"{i}\trow {i}\n" for i in range(n, 20_000, 2)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    try:
        got = REC.read_delimited(spark, tmp_dir, schema, field_delimiter="tab", skip_leading_rows=2, on_error="fail", path_col="p")
        assert got.rdd.getNumPartitions() > 2
        rows = got.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(r.k for r in rows) == list(range(20_000))
    assert all(r.p.endswith(f"f{r.k % 2}.tsv") for r in rows)
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan
