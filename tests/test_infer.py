"""Types from values, and delimited files whose headers differ."""

import os

import pytest

from postroom.operators.infer import infer_types
from postroom.sources.inferred import HeaderError, read_inferred


@pytest.mark.parametrize(
    "values,want",
    [
        (["1", " 2 ", None, ""], "bigint"),
        (["1", "2.5", "1e3"], "double"),
        (["1", "true"], "string"),
        (["TRUE", "false"], "boolean"),
        (["2024-01-31", "2024-02-01"], "date"),
        (["2024-01-31", "2024-02-01 10:20"], "timestamp_ntz"),
        (["2024-02-30"], "string"),
        (["2024-01-31", "7"], "string"),
        (["9223372036854775807", "-9223372036854775808"], "bigint"),
        (["9223372036854775808"], "string"),
        (["1.5", "9223372036854775808"], "string"),
        (["007"], "bigint"),
        (["", None, "  "], "string"),
        ([], "string"),
    ],
)
def test_lattice(spark, values, want):
    df = spark.createDataFrame([(v,) for v in values], "`a.b` string")
    assert infer_types(df).fields[0].dataType.simpleString() == want


def put(folder, **files):
    for name, text in files.items():
        with open(os.path.join(folder, name + ".csv"), "w") as fh:
            fh.write(text)
    return folder


def test_headers_differ(spark, tmp_dir):
    df = read_inferred(spark, put(tmp_dir, a='k,"x, y"\n1,"p, ""q"""\n2\n', b="z,k\r\n2024-01-01,3\r\n", c="", d="k\n"))
    assert [(f.name, f.dataType.simpleString()) for f in df.schema] == [("k", "bigint"), ("z", "date"), ("x, y", "string")]
    assert sorted((r[0], str(r[1]), r[2]) for r in df.collect()) == [(1, "None", 'p, "q"'), (2, "None", None), (3, "2024-01-01", None)]


def test_last_file_decides_and_marker(spark, tmp_dir):
    df = read_inferred(spark, put(tmp_dir, a="k;v\n" + "1;2\n" * 500, z="k;v\n1;\\N\n1;x\n"), sep=";", null_marker="\\N")
    assert [f.dataType.simpleString() for f in df.schema] == ["bigint", "string"]
    assert df.where("v is null").count() == 1 and df.count() == 502


@pytest.mark.parametrize("text", ["a,b\n1,2,3\n", "a,a\n1,2\n", "a,,c\n1,2,3\n"])
def test_values_without_a_name(spark, tmp_dir, text):
    with pytest.raises(HeaderError):
        read_inferred(spark, put(tmp_dir, a=text))


def test_no_lines(spark, tmp_dir):
    assert read_inferred(spark, put(tmp_dir, a="")).columns == []
