"""Named transforms over file tables.

A file table has ``file_name`` and ``content`` (bytes) plus any carried
columns (``message_id``, ``zip_password``, ...). ``apply_transform`` looks
the name up in a registry; every transform takes the table and keyword
parameters and ignores parameters it does not use (jobs pass all their
transform keys). Failures are rows, not exceptions: with ``on_error``
``keep`` a file that cannot be transformed is passed on unchanged (T3).

``xlsx2csv`` / ``excel_split_sheet`` return cell rows rather than file
blobs: a sheet as one value would put a whole sheet through one task, so
the delimited files are written by the sink (``write_sheets``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postroom.functions import names as N
from postroom.operators import cells as C
from postroom.operators.discrepancies import parse_discrepancies
from postroom.sinks.tables import write_delimited
from postroom.sources.files import expand_archives
from postroom.sources.workbooks import workbook_cells

TRANSFORMS: dict[str, Callable[..., DataFrame]] = {}


def register(*names: str):
    def deco(fn):
        for n in names:
            TRANSFORMS[n.lower()] = fn
        return fn

    return deco


def rename_files(files: DataFrame, filename_format: str = "{source_file}", stamp: str | None = None, **params) -> DataFrame:
    """Rename every file by the template (per row, so no file takes
    another's name); ``stamp`` is the run's ``YYYYMMDD`` (default: today)."""
    st = F.lit(stamp) if stamp else F.date_format(F.current_date(), "yyyyMMdd")
    return files.withColumn("file_name", N.safe_name(F.col("file_name"), filename_format, stamp=st, **params))


@register("unzip")
def unzip(files: DataFrame, zip_password: str | None = None, password_col: str = "zip_password", on_error: str = "keep", **_) -> DataFrame:
    """T5 ``unzip`` (S9): archive members become files; the password comes
    from the file's own message (X5) or the job's ``zip_password``."""
    src = files
    if password_col not in src.columns:
        src = src.withColumn(password_col, F.lit(zip_password).cast("string"))
    elif zip_password:
        src = src.withColumn(password_col, F.coalesce(F.col(password_col), F.lit(zip_password)))
    out = expand_archives(src, password_col=password_col, keep_failed=(on_error == "keep"))
    if on_error == "drop":
        out = out.where(F.col("error").isNull())
    elif on_error == "fail":
        out = out.withColumn("error", F.when(F.col("error").isNotNull(), F.raise_error(F.concat(F.lit("unzip failed: "), F.col("error")))))
    return out.withColumn("file_name", F.coalesce("member_name", "file_name")).drop("member_name", "size").withColumn(
        "status", F.when(F.col("error").isNull(), F.lit("ok")).otherwise(F.lit("kept"))
    )


@register("rpt_cleaner")
def rpt_cleaner(files: DataFrame, **_) -> DataFrame:
    """T5 ``rpt_cleaner`` (S8, F12): keep the lines that start with six
    digits, line ends kept; the file becomes ``<stem>.tsv``. Row-local."""
    text = F.decode("content", "UTF-8")
    kept = F.array_join(F.regexp_extract_all(text, F.lit(r"(?m)^\p{Nd}{6}[^\n]*\n?"), 0), "")
    return files.withColumn("content", F.encode(kept, "UTF-8")).withColumn(
        "file_name", F.concat(N.splitext_root("file_name"), F.lit(".tsv"))
    ).withColumn("status", F.lit("ok"))


@register("mkm_remove_version")
def mkm_remove_version(files: DataFrame, **_) -> DataFrame:
    """T5 (E10): drop the version from the name; ``file_date`` from it."""
    out = files.withColumn("file_name", N.drop_version("file_name"))
    return out.withColumn("file_date", N.file_date("file_name")).withColumn("status", F.lit("ok"))


@register("xlsx2csv", "excel_split_sheet")
def xlsx2csv(files: DataFrame, multi=False, round_numbers: bool = False, on_error: str = "keep", **_) -> DataFrame:
    """T5 (S10, E11): workbook files to normalised cells, named
    ``<stem>_<sheet>.csv``; ``multi`` reads every sheet. A file that is no
    workbook is one row with its ``error`` (T3), or fails the run with
    ``on_error='fail'``. Numbers keep their decimals unless
    ``round_numbers``."""
    multi = str(multi).lower() in ("yes", "true", "1")
    cells = workbook_cells(files, multi=multi)
    if on_error == "fail":
        cells = cells.withColumn("error", F.when(F.col("error").isNotNull(), F.raise_error(F.concat(F.lit("xlsx2csv failed: "), F.col("error")))))
    cells = cells.withColumn("file", F.concat(N.splitext_root("file_name"), F.lit("_"), F.col("sheet"), F.lit(".csv")))
    return C.normalize_cells(cells, round_numbers)


@register("parse_email_body")
def parse_email_body(files: DataFrame, run_date: str | None = None, key: str = "file_name", **_) -> DataFrame:
    """T5 (X7): discrepancy records of HTML bodies; a body that gives none
    is a row with its ``error`` (T3)."""
    docs = files.select(key, F.decode("content", "UTF-8").alias("html"))
    records, errors = parse_discrepancies(docs, run_date or "", id_col=key)
    return records.withColumn("error", F.lit(None).cast("string")).unionByName(
        errors.withColumnRenamed("reason", "error"), allowMissingColumns=True
    )


def apply_transform(files: DataFrame, name: str | None, stamp: str | None = None, **params) -> DataFrame:
    """The named transform, then the per-row rename by
    ``filename_format`` for file outputs; no transform but a format:
    rename only; neither: pass through."""
    fmt = params.pop("filename_format", None)
    fn = TRANSFORMS.get((name or "").lower())
    if fn is None:
        if name:
            raise KeyError(f"unknown transform {name!r}")
        return rename_files(files, fmt, stamp) if fmt else files
    out = fn(files, **params)
    if "content" in out.columns and "file_name" in out.columns:
        out = rename_files(out, fmt or "{source_file}", stamp)
    return out


def write_sheets(cells: DataFrame, dest: str, columns: list[str], sep: str = "\t") -> str:
    """Delimited files of transformed sheets, one folder per sheet file,
    non-numeric values quoted (K12)."""
    rows = C.cells_to_rows(cells, columns, key=("file", "sheet_no", "row"))
    return write_delimited(rows.drop("sheet_no", "row"), dest, sep=sep, quote="nonnumeric")
