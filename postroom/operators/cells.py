"""Spreadsheet cells: normalisation and cells-to-rows (SURVEY 2.5 E11,
2.6 A5, O2).

``cells(file, sheet_no, sheet, row, col, ctype, raw)``: ctype 1 text,
2 number, 3 date (a serial day number); row 0 holds the headers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postroom.functions.names import header_name
from postroom.functions.timewin import serial_to_timestamp

# --- fixed values -----------------------------------------------------------
CELL_TEXT, CELL_NUMBER, CELL_DATE = 1, 2, 3
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"
# ----------------------------------------------------------------------------

SHEET_KEY = ["file", "sheet_no"]


def cell_value(raw: Column, ctype: Column, header: Column, round_numbers: bool = False, ts: Column | None = None) -> Column:
    """Text: newlines and tabs to spaces; number: half-even rounding to
    a whole number when ``round_numbers`` (the reference always rounds);
    date: ISO date-time, cut to the date at midnight, to ``YYYY-MM`` for
    ``*_month`` headers and ``YYYY`` for ``*_year``.

    A flat CASE with one literal format per branch; ``ts`` (the cell's
    timestamp) may be given precomputed so it is evaluated once per cell.
    """
    text = F.translate(raw, "\n\t", "  ")
    num = raw
    if round_numbers:
        num = F.bround(raw.try_cast("double"), 0).cast("decimal(38,0)").cast("string")
    if ts is None:
        ts = serial_to_timestamp(raw.try_cast("double"))
    date = (
        F.when(header.endswith("_month"), F.date_format(ts, "yyyy-MM"))
        .when(header.endswith("_year"), F.date_format(ts, "yyyy"))
        .when(ts == F.to_date(ts).cast("timestamp_ntz"), F.date_format(ts, "yyyy-MM-dd"))
        .otherwise(F.date_format(ts, ISO_SECONDS))
    )
    return F.when(ctype == CELL_TEXT, text).when(ctype == CELL_NUMBER, num).when(ctype == CELL_DATE, date).otherwise(raw)


def sheet_headers(cells: DataFrame) -> DataFrame:
    """Column names of each sheet: E4 of the row-0 cells."""
    return cells.where(F.col("row") == 0).select(*SHEET_KEY, "col", header_name(F.col("raw")).alias("header"))


def with_headers(cells: DataFrame) -> DataFrame:
    """Data cells (row > 0) with their column's ``header`` (E4 of row 0).

    Readers that emit ``header`` have done that once a column. Those that
    emit ``header_raw`` (the row-0 text, known while reading
    a sheet in order) need no join: one narrow projection. Otherwise the
    row-0 cells are joined back; that side has one row per sheet column
    (AQE broadcasts it when small, and splits the cell side of a hot
    sheet otherwise).
    """
    data = cells.where(F.col("row") > 0)
    if "error" in cells.columns:  # a file that could not be read stays as one row
        data = cells.where((F.col("row") > 0) | F.col("error").isNotNull())
    if "header" in cells.columns:
        return data
    if "header_raw" in cells.columns:
        return data.withColumn("header", header_name(F.col("header_raw"))).drop("header_raw")
    return data.join(sheet_headers(cells), SHEET_KEY + ["col"], "left")


def normalize_cells(cells: DataFrame, round_numbers: bool = False) -> DataFrame:
    """E11 over a cell table; adds ``header`` and ``value`` to data cells.
    Two projections: the date cells' timestamp first, then the value, so
    neither is evaluated twice per cell."""
    data = with_headers(cells).withColumn(
        "_ts", F.when(F.col("ctype") == CELL_DATE, serial_to_timestamp(F.col("raw").try_cast("double")))
    )
    value = cell_value(F.col("raw"), F.col("ctype"), F.coalesce("header", F.lit("")), round_numbers, ts=F.col("_ts"))
    return data.withColumn("value", value).drop("_ts")


def cells_to_rows(cells: DataFrame, columns: Sequence[str], value: str = "value", key: Sequence[str] = ("file", "sheet_no", "row")) -> DataFrame:
    """A5: one row per sheet row with a fixed column list (cell ``col`` i is
    ``columns[i]``). A pivot with given values: one partial+final hash
    aggregate on the row key, no pass to discover the columns."""
    out = cells.where(F.col("row") > 0).groupBy(*key).pivot("col", list(range(len(columns)))).agg(F.max(value))
    return out.select(*key, *[F.col(str(i)).alias(name) for i, name in enumerate(columns)])


def first_sheet(cells: DataFrame) -> DataFrame:
    """O2: only the first sheet of each workbook."""
    return cells.where(F.col("sheet_no") == 0)
