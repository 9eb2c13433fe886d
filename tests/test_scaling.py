"""Work that is dealt by rows or bytes, so that no task's share grows with the table."""

import os

import pyarrow as pa
import pytest

from postroom.operators.paths import path_matches, paths_matches
from postroom.operators.schema import load_schema
from postroom.plans import coverage as C
from postroom.plans import standins as SI
from postroom.sources import html as H
from postroom.sources import records as REC


def test_files_have_a_bounded_size(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(C, "FILE_BYTES", 4000)
    docs = spark.range(200).selectExpr("id doc_id", "concat('say \"{[', repeat('x\n', 40)) text", "CAST(NULL AS STRING) lang").unionAll(
        spark.sql("SELECT 0L, 'again', 'de' UNION ALL SELECT NULL, NULL, NULL"))
    rows, size = C._file_of_rows(docs)
    assert rows.rdd.getNumPartitions() == 6 and size == C.SPLIT_BYTES
    assert C._file_of_rows(docs.limit(3))[0].rdd.getNumPartitions() == 1 and C._file_of_rows(docs.where("false"))[0].rdd.getNumPartitions() == 1
    dest = f"{tmp_dir}/arrays"
    C._as_arrays(rows.selectExpr("to_json(struct(*)) AS value")).write.text(dest)
    assert len([f for f in os.listdir(dest) if f.endswith(".txt")]) == 6
    got = REC.read_json_records(spark, dest, load_schema(C.TEXT_SCHEMA)[0])
    assert sorted(map(str, got.collect())) == sorted(map(str, docs.collect()))


def test_rows_are_dealt_by_their_number(spark):
    rows = spark.range(0, 5001, 1, 1)
    assert SI.dealt(rows, 1000).rdd.getNumPartitions() == 6
    assert SI.dealt(rows, 1000).count() == 5001 and SI.dealt(rows.where("false")).count() == 0


def test_documents_are_parsed_in_bounded_parts(monkeypatch):
    monkeypatch.setattr(H, "CHUNK_SIGNS", 100)
    html = ["<p>a</p>", None, "<p>" + "b" * 300 + "</p>", *["<i>c</i>"] * 20, ""]
    batch = pa.RecordBatch.from_pydict({"id": list(range(len(html))), "html": html})
    parts = list(H._chunks(batch, "html"))
    assert [i for ids, _ in parts for i in ids.column(0).to_pylist()] == list(range(len(html)))
    assert [x for _, parsed in parts for x in parsed] == [H.parse_document(h) for h in html]
    assert len(parts) == 4 and list(H._chunks(batch.slice(0, 0), "html")) == []
    monkeypatch.setattr(H, "CHUNK_DOCS", 2)
    assert max(ids.num_rows for ids, _ in H._chunks(batch, "html")) == 2


def test_elements_of_odd_documents(spark):
    df = spark.createDataFrame([(None, "<p>a<b x>c</b></p>"), (7, None), (7, "no element")], "doc_id int, html string")
    assert [(r.doc_id, r.tag, r.text, r.attrs) for r in H.html_elements(df).orderBy("ord").collect()] == [(None, "p", "a", {}), (None, "b", "c", {"x": ""})]
    got = H.html_matches(df, "//p/b").orderBy("doc_id", "status").collect()
    assert [(r.doc_id, r.status, [m.text for m in r.matches]) for r in got] == [(None, "ok", ["c"]), (7, "failed", []), (7, "ok", [])]


def test_several_paths_of_one_parse(spark):
    paths = ["//p/b", "//p[text()='a']/b[1]", "/p//*"]
    df = spark.createDataFrame([(1, "<p>a<b>c</b><b>d<i>e</i></b></p>"), (2, None)], "doc_id long, html string")
    got = {(r.doc_id, r.path): (r.status, r.matches) for r in paths_matches(df, paths).collect()}
    assert len(got) == 6
    for path in paths:
        for r in path_matches(df, path).collect():
            status, found = got[r.doc_id, path]
            assert status == r.status and [m.ord for m in found] == [m.ord for m in r.matches] and [m.text for m in found] == [m.text for m in r.matches]


def test_paths_are_checked_first(spark):
    with pytest.raises(ValueError):
        paths_matches(spark.createDataFrame([(1, "")], "doc_id long, html string"), ["//a", "a"])


def test_a_row_is_parsed_once(spark, tmp_dir):
    spark.createDataFrame([('1,"a\nb",2.5',), ('2,"c",',)], "value string").coalesce(1).write.mode("overwrite").text(tmp_dir)
    schema = load_schema([{"name": "k", "type": "INTEGER"}, {"name": "t", "type": "STRING"}, {"name": "v", "type": "FLOAT"}])[0]
    good = REC.read_delimited(spark, tmp_dir, schema, allow_quoted_newlines=True, allow_jagged_rows=True, on_error="fail")
    assert sorted(map(tuple, good.collect())) == [(1, "a\nb", 2.5), (2, "c", None)]
    # but for rows of a wrong length, which are read again with one more column
    plan = good._jdf.queryExecution().optimizedPlan().toString()
    assert len([line for line in plan.splitlines() if "from_csv" in line and "_extra" not in line]) == 1
    with pytest.raises(REC.LoadError, match="too few fields"):
        REC.read_delimited(spark, tmp_dir, load_schema([*[{"name": c, "type": "STRING"} for c in "abcd"]])[0], allow_quoted_newlines=True, on_error="fail")


def test_cells_of_odd_workbooks(spark):
    from postroom.sources.workbooks import build_xlsx, workbook_cells

    book = bytearray(build_xlsx([("S", [["a", "b"], [1, None], ["x", ("date", 2.5)]])]))
    df = spark.createDataFrame([(None, book), ("empty", bytearray(build_xlsx([("S", [])]))), ("none", None), ("junk", bytearray(b"junk"))], "file_name string, content binary")
    got = workbook_cells(df).collect()
    assert [(r.row, r.col, r.ctype, r.raw, r.header_raw) for r in got if r.file_name is None] == [
        (0, 0, 1, "a", "a"), (0, 1, 1, "b", "b"), (1, 0, 2, "1", "a"), (2, 0, 1, "x", "a"), (2, 1, 3, "2.5", "b")]
    assert [(r.file_name, r.error.split(":")[0]) for r in got if r.error] == [("none", "TypeError"), ("junk", "BadZipFile")]
    assert all(r.file_name != "empty" for r in got)
