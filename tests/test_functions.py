"""Scalar functions on the fixture values of FIXTURES.md 6 and 7."""

from pyspark.sql import functions as F

from postroom.functions import names as N
from postroom.functions import text as X
from postroom.functions import timewin as W
from postroom.operators.cells import cell_value


def one(spark, values, fn):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    return [r[0] for r in df.select(fn(F.col("s"))).collect()]


def test_secure_filename(spark):
    assert one(spark, ["dir/My  report.csv", ".._x_.", "a b\tc", "été.txt", None], N.secure_filename) == [
        "dir_My_report.csv", "x", "a_b_c", "t.txt", None]


def test_safe_name(spark):
    got = one(spark, ["report.csv", "report_2023.csv", "x/y/z.tar.gz", ".hidden"], lambda c: N.safe_name(c, stamp="20240101"))
    assert got == ["report_20240101.csv", "report_2023.csv", "x/y/z.tar_20240101.gz", "hidden_20240101"]


def test_safe_name_format(spark):
    got = one(spark, ["in/a.csv"], lambda c: N.safe_name(c, "MID_{source_file}_{run}", stamp="20240101", run="r1"))
    assert got == ["in/MID_a_r1_20240101.csv"]


def test_splitext(spark):
    vals = ["a.b.c", ".bashrc", "a.", "...", "..a.b", "dir.x/file", "noext"]
    import os

    assert one(spark, vals, N.splitext_ext) == [os.path.splitext(v)[1] for v in vals]
    assert one(spark, vals, N.splitext_root) == [os.path.splitext(v)[0] for v in vals]


def test_drop_version_and_date(spark):
    assert one(spark, ["MKM_REPORT_20240131_2.txt", "a_1.b_2.txt", "x.txt"], N.drop_version) == [
        "MKM_REPORT_20240131.txt", "a_1.b.txt", "x.txt"]
    assert one(spark, ["MKM_REPORT_20240131.txt"], N.file_date) == ["20240131"]


def test_header_names(spark):
    heads = ["Invoice Number", "PO Number", "Account Segment 1 Name", "Commodity Level 3", "GL Account/Lookup", "userFullName"]
    assert one(spark, heads, N.header_name) == [
        "invoice_number", "po_number", "account_segment1_name", "commodity_level3", "gl_account/lookup", "user_full_name"]
    assert one(spark, ["GL Account/Lookup", "userFullName"], N.column_key) == ["glaccount_lookup", "userfullname"]


def test_url_file_name(spark):
    df = spark.createDataFrame(
        [
            ("http://h/a/b.csv?x=1", "http://h/a/b.csv?x=1", None, "text/csv", "m1"),
            ("http://h/a", "http://h/files/r;v=1", None, None, "m2"),
            ("http://h/a", "http://h/a", "attachment; filename=my file.xlsx", "application/zip", "m3"),
            ("http://h/a", None, None, None, "m 4"),
        ],
        "url string, final string, cd string, ct string, d string",
    )
    got = [r[0] for r in df.select(N.url_file_name("url", "final", "cd", "ct", "d")).collect()]
    assert got == ["m1", "r", "my_file.zip", "m_4"]


def test_fold_and_reserved(spark):
    assert one(spark, ["Çà ß Ñ é", "ǅ"], X.fold_accents) == ["Ca ß N e", "Dz"]
    assert one(spark, ["it’s a?b/c"], X.strip_reserved) == ["it's ab_c"]


def test_truthy(spark):
    words = ["yes", "True", "t", "1", "no", "Y", None]
    assert one(spark, words, X.truthy) == [True, True, True, True, False, False, False]
    assert one(spark, words, X.truthy_alt) == [True, True, False, True, False, True, False]


def test_parse_iso(spark):
    got = one(spark, ["2024-01-01T05:00:00Z", "2024-01-01T05:00:00+07:00", "2024-01-01", "junk"], X.parse_iso)
    assert [str(g) if g else None for g in got] == ["2024-01-01 05:00:00", "2023-12-31 22:00:00", "2024-01-01 00:00:00", None]


def test_run_window_and_stamp(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00",)], "s string").select(F.col("s").cast("timestamp_ntz").alias("t"))
    a, b = W.run_window(F.col("t"), offset_hours=-7)
    r = df.select(a, b, W.partition_stamp("t")).first()
    assert str(r[0]) == "2023-12-31 17:00:00" and str(r[1]) == "2024-01-01 17:00:00" and r[2] == "20240101"


def test_serial_dates(spark):
    df = spark.createDataFrame([(45292.0,), (45292.75,)], "v double")
    got = [str(r[0]) for r in df.select(W.serial_to_timestamp("v")).collect()]
    assert got == ["2024-01-01 00:00:00", "2024-01-01 18:00:00"]
    assert str(df.select(W.serial_to_date("v")).first()[0]) == "2024-01-01"


def test_cell_values_fixture(spark):
    rows = [
        ("order_line_description", 1, "a\nb\tc", "a b c"),
        ("order_line_quantity", 2, "2.5", "2"),
        ("order_line_quantity", 2, "3.5", "4"),
        ("order_date", 3, "45292", "2024-01-01"),
        ("created_at", 3, "45292.75", "2024-01-01T18:00:00"),
        ("invoice_month", 3, "45292", "2024-01"),
        ("invoice_year", 3, "45292", "2024"),
    ]
    df = spark.createDataFrame([r[:3] for r in rows], "header string, ctype int, raw string")
    got = [r[0] for r in df.select(cell_value(F.col("raw"), F.col("ctype"), F.col("header"), round_numbers=True)).collect()]
    assert got == [r[3] for r in rows]


def test_fold_accents_everywhere(spark):
    assert one(spark, ["ﬁancé Ångström ß", "ﬁ ② x² ½ Ａ", None], X.fold_accents) == ["fiance Angstrom ß", "fi 2 x2 1⁄2 A", None]


def test_load_schema_file(spark, tmp_dir):
    import json
    import os

    from pyspark.sql import types as T

    from postroom.operators.schema import cast_to_schema, load_schema, schema_json

    spec = [
        {"name": "a", "type": "INTEGER", "mode": "REQUIRED"},
        {"name": "b", "type": "FLOAT64"},
        {"name": "c", "type": "DATE"},
        {"name": "d", "type": "DATETIME"},
        {"name": "e", "type": "BOOLEAN"},
        {"name": "f", "type": "GEOGRAPHY", "policyTags": {"names": ["x"]}},
    ]
    path = os.path.join(tmp_dir, "schema.json")
    with open(path, "w") as fh:
        json.dump(spec, fh)
    schema, required = load_schema(path)
    assert [f.dataType for f in schema.fields] == [T.LongType(), T.DoubleType(), T.DateType(), T.TimestampNTZType(), T.BooleanType(), T.StringType()]
    assert required == ["a"]
    assert [f["type"] for f in schema_json(schema, required)] == ["INTEGER", "FLOAT", "DATE", "DATETIME", "BOOLEAN", "STRING"]
    df = spark.createDataFrame([("1", "2.5", "2024-01-31", "2024-01-31 10:00:00", "yes", "p"), ("x", "", "2024-02-30", None, "maybe", None)],
                               "a string, b string, c string, d string, e string, f string")
    good, bad = cast_to_schema(df, schema, on_error="split")
    assert good.count() == 1
    assert bad.first()["_errors"] == ["a", "c", "e"]
