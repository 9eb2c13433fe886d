"""Table loads, merges, delimited output and delivery."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from postroom.sinks import deliver as D
from postroom.sinks import tables as TB


def df_days(spark, rows):
    return spark.createDataFrame(rows, "k long, v string, d string").withColumn("d", F.col("d").cast("timestamp_ntz"))


def test_partition_replace(spark, tmp_dir):
    dest = os.path.join(tmp_dir, "t")
    TB.load_table(df_days(spark, [(1, "a", "2024-01-01"), (2, "b", "2024-01-02")]), dest, "replace", partition="d")
    TB.load_table(df_days(spark, [(3, "c", "2024-01-02")]).drop("d"), dest, "replace", partition="20240102")
    got = sorted((r.k, r.ds) for r in TB.read_table(spark, dest).collect())
    assert got == [(1, "20240101"), (3, "20240102")]
    # an empty input clears a literal partition
    TB.load_table(df_days(spark, []).drop("d"), dest, "replace", partition="20240102")
    assert sorted(r.k for r in TB.read_table(spark, dest).collect()) == [1]


def test_dynamic_replace_keeps_other_days(spark, tmp_dir):
    dest = os.path.join(tmp_dir, "t")
    TB.load_table(df_days(spark, [(1, "a", "2024-01-01"), (2, "b", "2024-01-02")]), dest, "append", partition="d")
    TB.load_table(df_days(spark, [(5, "e", "2024-01-02")]), dest, "replace", partition="d")
    assert sorted(r.k for r in TB.read_table(spark, dest).collect()) == [1, 5]


def test_regex_partition(spark, tmp_dir):
    dest = os.path.join(tmp_dir, "t")
    df = spark.createDataFrame([(1, "/in/b_20240131.csv"), (2, "/in/c_20240201.csv")], "k long, path string")
    TB.load_table(df, dest, "replace", partition=r"regex:(\d{8})", path_col="path")
    assert sorted((r.k, r.ds) for r in TB.read_table(spark, dest).collect()) == [(1, "20240131"), (2, "20240201")]


def test_append_and_replace_table(spark, tmp_dir):
    dest = os.path.join(tmp_dir, "t")
    a = spark.createDataFrame([(1,), (2,)], "k long")
    TB.load_table(a, dest)
    TB.load_table(a, dest, "append", cluster_by="k")
    assert TB.read_table(spark, dest).count() == 4
    TB.load_table(a, dest, "replace")
    assert TB.read_table(spark, dest).count() == 2


def test_merge(spark, tmp_dir):
    dest = os.path.join(tmp_dir, "m")
    TB.load_table(spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string"), dest, "merge", keys=["k"])
    src = spark.createDataFrame([(2, "B", 1), (2, "B2", 2), (3, "c", 1)], "k long, v string, seq int")
    TB.load_table(src, dest, "merge", keys=["k"], order_by="seq")
    got = sorted(tuple(r) for r in TB.read_table(spark, dest).select("k", "v").collect())
    assert got == [(1, "a"), (2, "B2"), (3, "c")]
    assert len(TB._versions(spark, dest)) == 2


def test_nonnumeric_quoting(spark, tmp_dir):
    dest = os.path.join(tmp_dir, "q")
    df = spark.createDataFrame([(1, 2.5, 'say "hi"', None)], "a long, b double, c string, d string")
    TB.write_delimited(df, dest, sep="\t", quote="nonnumeric")
    lines = [ln for p in glob.glob(dest + "/part-*") for ln in open(p).read().splitlines()]
    header = '"a"\t"b"\t"c"\t"d"'
    assert header in lines
    assert [ln for ln in lines if ln != header] == ['1\t2.5\t"say ""hi"""\t']


def test_fan_out_and_mark(spark, tmp_dir):
    df = spark.createDataFrame([("m1",), ("m2",)], "message_id string")
    st = D.fan_out(df, [{"name": "ok", "dir": os.path.join(tmp_dir, "a")}, {"name": "bad", "dir": os.path.join(tmp_dir, "b"), "format": "nope"}])
    got = sorted((r.channel, r.status, r.rows) for r in st.collect())
    assert got == [("bad", "failed", 0), ("ok", "ok", 2)]
    state = os.path.join(tmp_dir, "state")
    assert D.mark_processed(df, "j", "2024-01-01 00:00:00", state, st) is False
    ok = D.fan_out(df, [{"name": "ok", "dir": os.path.join(tmp_dir, "c")}])
    assert D.mark_processed(df, "j", "2024-01-01 00:00:00", state, ok) is True
    assert D.processed_ids(spark, state).count() == 2


def test_guard_empty(spark):
    empty = spark.createDataFrame([], "x int")
    assert D.guard_empty(empty, hour=23) == "skipped"
    with pytest.raises(D.NoFilesError):
        D.guard_empty(empty, hour=10, ignore_after=15)
    assert D.guard_empty(spark.createDataFrame([(1,)], "x int"), hour=0) == "ok"


def test_quoted_lines_hold_separators(spark, tmp_dir):
    dest = os.path.join(tmp_dir, "q2")
    df = spark.createDataFrame([(1, "a\tb"), (2, "c\nd"), (3, 'e"f')], "k long, v string")
    TB.write_delimited(df, dest, quote="nonnumeric")
    text = "".join(open(p).read() for p in sorted(glob.glob(dest + "/part-*")))
    assert "\0" not in text and '1\t"a\tb"' in text and '2\t"c\nd"' in text and '3\t"e""f"' in text


def test_merge_needs_an_order_for_repeated_keys(spark, tmp_dir):
    src = spark.createDataFrame([(1, "a"), (1, "b")], "k long, v string")
    with pytest.raises(TB.DuplicateKeyError):
        TB.load_table(src, os.path.join(tmp_dir, "m"), "merge", keys=["k"])


def test_equal_file_names(spark, tmp_dir):
    files = spark.createDataFrame([("m1", "r.csv", b"1"), ("m2", "r.csv", b"2"), ("m2", "s.csv", b"3")], "message_id string, file_name string, content binary")
    dest = os.path.join(tmp_dir, "b")
    st = D.fan_out(files, {"protocol": "blobs", "dir": dest}).first()
    assert (st.status, st.rows) == ("ok", 3)
    assert sorted(os.path.basename(p) for p in glob.glob(dest + "/*")) == ["r_m1.csv", "r_m2.csv", "s.csv"]
    st = D.fan_out(files.drop("message_id"), {"protocol": "blobs", "dir": dest + "2"}).first()
    assert st.status == "failed" and st.rows == 0 and "r.csv" in st.error


def test_partition_fallback_and_suffix(spark, tmp_dir):
    df = spark.createDataFrame([(1, "/in/b_20240131.csv"), (2, "/in/c.csv")], "k long, _path string")
    dest = os.path.join(tmp_dir, "t")
    TB.load_table(df, dest, "replace", partition=r"regex:(\d{8})", path_col="_path", run_day="20240301")
    got = TB.read_table(spark, dest)
    assert sorted(got.columns) == ["ds", "k"] and sorted((r.k, r.ds) for r in got.collect()) == [(1, "20240131"), (2, "20240301")]
    dest = os.path.join(tmp_dir, "u")
    assert D.fan_out(df.select("k"), {"protocol": "table", "dir": dest + "$20240102"}).first().status == "ok"
    assert [r.ds for r in TB.read_table(spark, dest).collect()] == ["20240102"] * 2


def test_snapshots_can_be_read_and_removed(spark, tmp_dir):
    from postroom.sinks import snapshots as SN

    dest = os.path.join(tmp_dir, "s")
    days = [(i, "a", f"2024-01-{1 + i % 9:02d}") for i in range(90)]
    assert TB.load_table(df_days(spark, days), dest, "replace", partition="d", file_rows=20) == (1, 90)
    assert TB.load_table(df_days(spark, [(500, "b", "2024-01-03"), (501, "c", None)]), dest, "replace", partition="d") == (2, 2)
    assert TB.load_table(df_days(spark, [(502, "d", None)]), dest, "replace", partition="d").rows == 1
    old = {r.k for r in TB.read_table(spark, dest, version=1).collect()}
    new = {(r.k, r.ds) for r in TB.read_table(spark, dest).collect()}
    assert old == set(range(90))
    assert new == {(i, f"202401{1 + i % 9:02d}") for i in range(90) if i % 9 != 2} | {(500, "20240103"), (502, None)}
    # files that hold no such day go on; only some are read for a range of days
    first, last = (SN.manifest(spark, dest, v) for v in (1, 3))
    assert first.join(last, "path", "left_semi").count() >= 2
    ranges = {"ds": ("20240109", "20240109")}
    assert SN.overlapping(last, ranges).count() < last.count()
    assert {r.k for r in TB.read_table(spark, dest, ranges=ranges).where("ds = '20240109'").collect()} == {i for i in range(90) if i % 9 == 8}
    assert SN.expire(spark, dest) > 0 and SN.versions(spark, dest) == [3]
    assert {(r.k, r.ds) for r in TB.read_table(spark, dest).collect()} == new


def test_a_failed_load_leaves_nothing_visible(spark, tmp_dir):
    dest = os.path.join(tmp_dir, "s")
    TB.load_table(spark.createDataFrame([(1, "a")], "k long, v string"), dest)
    bad = spark.createDataFrame([(2, "x")], "k long, v string").withColumn("v", F.raise_error(F.col("v")).cast("string"))
    with pytest.raises(Exception):
        TB.load_table(bad, dest, "replace")
    with pytest.raises(ValueError, match="replase"):
        TB.load_table(bad, dest, "replase")
    assert [tuple(r) for r in TB.read_table(spark, dest).collect()] == [(1, "a")]
    other = os.path.join(tmp_dir, "plain")
    spark.range(3).write.parquet(other)
    assert TB.read_table(spark, other).count() == 3
    with pytest.raises(ValueError, match="no snapshot"):
        TB.load_table(spark.range(1).toDF("id"), other)


def test_merge_with_null_keys_and_untold_files(spark, tmp_dir):
    dest = os.path.join(tmp_dir, "m")
    rows = spark.createDataFrame([(None, "a"), (1, "b")], "k long, v string")
    TB.load_table(rows, dest)  # told by no column: the merge must read it
    for _ in range(2):
        assert TB.load_table(rows.withColumn("v", F.upper("v")), dest, "merge", keys=["k"]).rows == 2
    assert sorted(map(tuple, TB.read_table(spark, dest).collect()), key=str) == [(1, "B"), (None, "A")]


def test_names_from_mails_stay_in_their_folder(spark, tmp_dir):
    dest = os.path.join(tmp_dir, "in")
    files = spark.createDataFrame([("1", "../esc.txt", b"a"), ("2", "sub/dir.txt", b"b"), ("3", None, b"c"), ("4", "x\\..", b"d"), ("5", "a\x00b", b"e")], "message_id string, file_name string, content binary")
    status = sorted(((r.file_name, r.size, r.error is None) for r in TB.write_blobs(files, dest).collect()), key=str)
    assert status == [("ab", 1, True), ("dir.txt", 1, True), ("esc.txt", 1, True), (None, None, False), (None, None, False)]
    assert sorted(os.listdir(tmp_dir)) == ["in"] and sorted(p for p in os.listdir(dest) if not p.startswith(".")) == ["ab", "dir.txt", "esc.txt"]


def test_quotes_nulls_and_empty_values_come_back(spark, tmp_dir):
    from postroom.operators.schema import load_schema
    from postroom.sources.records import read_delimited

    dest = os.path.join(tmp_dir, "q")
    rows = [(1, 'a"b'), (2, "t\tb\\"), (3, ""), (4, None), (5, '"'), (6, "l\nm")]
    TB.write_delimited(spark.createDataFrame(rows, "k long, v string"), dest, null_value="\\N")
    schema = load_schema([{"name": "k", "type": "INTEGER"}, {"name": "v", "type": "STRING"}])[0]
    got = read_delimited(spark, dest, schema, field_delimiter="tab", skip_leading_rows=1, quote_character='"', allow_quoted_newlines=True, null_marker="\\N", on_error="fail")
    assert sorted(map(tuple, got.collect())) == rows
