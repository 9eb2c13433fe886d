"""Archives and workbooks held as file rows."""

import io
import zipfile

from pyspark.sql import functions as F

from postroom.operators import transforms as TR
from postroom.sources.files import build_zip, expand_archives, read_files
from postroom.sources.workbooks import build_xlsx, workbook_cells


def files_df(spark, items):
    return spark.createDataFrame(items, "file_name string, content binary")


def test_expand_archives(spark):
    z = build_zip([("dir/a.csv", b"1"), ("b.txt", b"2"), ("README", b"x"), (".hidden.txt", b"h"),
                   ("inner.zip", build_zip([("c.txt", b"3")])), ("other/a.csv", b"last")])
    df = files_df(spark, [("good.zip", z), ("bad.zip", b"not a zip")])
    out = expand_archives(df).collect()
    ok = sorted((r.member_name, bytes(r.content)) for r in out if r.error is None)
    assert ok == [("a.csv", b"last"), ("b.txt", b"2")]
    bad = [r for r in out if r.error is not None]
    assert [r.file_name for r in bad] == ["bad.zip"] and bad[0].member_name is None
    keep = expand_archives(df, drop_nested=False).where(F.col("error").isNull())
    assert "inner.zip" in {r.member_name for r in keep.collect()}


def test_unzip_transform_keeps_failed(spark):
    z = build_zip([("x/report.csv", b"a")])
    df = files_df(spark, [("ok.zip", z), ("broken.zip", b"zz")])
    out = TR.apply_transform(df, "unzip", filename_format="R_{source_file}", stamp="20240101")
    got = sorted((r.file_name, r.status, bytes(r.content)) for r in out.collect())
    assert got == [("R_broken_20240101.zip", "kept", b"zz"), ("R_report_20240101.csv", "ok", b"a")]


def test_workbook_cells(spark):
    book = build_xlsx([("Data", [["Order Date", "Qty", "Name"], [("date", 45292.75), 2.5, "a\tb"]]), ("Two", [["x"]])])
    df = files_df(spark, [("b.xlsx", book), ("junk.xlsx", b"junk")])
    cells = workbook_cells(df).collect()
    good = sorted((r.sheet, r.row, r.col, r.ctype, r.raw) for r in cells if r.error is None)
    assert good == [("Data", 0, 0, 1, "Order Date"), ("Data", 0, 1, 1, "Qty"), ("Data", 0, 2, 1, "Name"),
                    ("Data", 1, 0, 3, "45292.75"), ("Data", 1, 1, 2, "2.5"), ("Data", 1, 2, 1, "a\tb")]
    assert [r.file_name for r in cells if r.error is not None] == ["junk.xlsx"]
    multi = workbook_cells(df, multi=True).where(F.col("error").isNull())
    assert sorted({r.sheet for r in multi.collect()}) == ["Data", "Two"]


def test_xlsx2csv_transform(spark, tmp_dir):
    book = build_xlsx([("Data", [["Order Date", "Order Line Quantity", "Invoice Month"], [("date", 45292.75), 2.5, ("date", 45292)]])])
    out = TR.apply_transform(files_df(spark, [("PO.xlsx", book)]), "xlsx2csv", delimiter="\t", round_numbers=True)
    got = sorted((r.file, r.header, r.value) for r in out.collect())
    assert got == [("PO_Data.csv", "invoice_month", "2024-01"), ("PO_Data.csv", "order_date", "2024-01-01T18:00:00"),
                   ("PO_Data.csv", "order_line_quantity", "2")]


def test_read_files(spark, tmp_dir):
    import os

    with open(os.path.join(tmp_dir, "a.zip"), "wb") as fh:
        fh.write(build_zip([("m.txt", b"m")]))
    df = read_files(spark, tmp_dir, "*.zip")
    assert [r.file_name for r in df.collect()] == ["a.zip"]
    assert zipfile.ZipFile(io.BytesIO(df.first().content)).namelist() == ["m.txt"]


def test_rpt_cleaner_and_version(spark):
    df = files_df(spark, [("RPT_HASIL_1.txt", b"BANK REPORT\n------\n000123\tA\t10.5\n12345 short\n654321 last")])
    out = TR.apply_transform(df, "rpt_cleaner", stamp="20240101").first()
    assert out.file_name == "RPT_HASIL_1_20240101.tsv"
    assert bytes(out.content) == b"000123\tA\t10.5\n654321 last"
    v = TR.apply_transform(files_df(spark, [("MKM_REPORT_20240131_2.txt", b"")]), "mkm_remove_version").first()
    assert v.file_name == "MKM_REPORT_20240131.txt" and v.file_date == "20240131"


def test_encrypted_archive_password_per_message(spark):
    from postroom.operators.html_select import attach_password, extract_last

    from tests.zipcrypto import encrypted_zip

    z1 = encrypted_zip([("r1.csv", b"one")], "s3cret")
    z2 = encrypted_zip([("r2.csv", b"two")], "other")
    bodies = spark.createDataFrame([("m1", "<p><b>s3cret</b></p>"), ("m2", "<p><b>other</b></p>")], "message_id string, html string")
    pw = extract_last(bodies, "//p/b", "text()", id_col="message_id")
    files = spark.createDataFrame([("m1", "a.zip", z1), ("m2", "b.zip", z2), ("m2", "c.zip", z1)], "message_id string, file_name string, content binary")
    out = TR.apply_transform(attach_password(files, pw), "unzip", stamp="20240101")
    got = sorted((r.message_id, r.file_name, r.status, bytes(r.content) if r.status == "ok" else None) for r in out.collect())
    assert got == [("m1", "r1_20240101.csv", "ok", b"one"), ("m2", "c_20240101.zip", "kept", None), ("m2", "r2_20240101.csv", "ok", b"two")]
