"""Run windows, partition stamps and spreadsheet serial dates
(SURVEY 2.5: E12, E15, E16; 2.3: F5, F6)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Day zero of spreadsheet serial dates (1900 date system, serial >= 60).
SERIAL_EPOCH = "1899-12-30"
# Unix epoch as a zone-free wall clock.
UNIX_EPOCH = "1970-01-01 00:00:00"
# ----------------------------------------------------------------------------


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_to_ntz(seconds) -> Column:
    """Epoch seconds to a UTC wall clock (TIMESTAMP_NTZ), zone-free."""
    return F.timestamp_add("SECOND", _col(seconds).cast("long"), F.lit(UNIX_EPOCH).cast("timestamp_ntz"))


def run_window(start, end=None, offset_hours: int = 0) -> tuple[Column, Column]:
    """The half-open load window ``[start, end)``; the default end is
    start + 1 day; both bounds moved by ``offset_hours`` (the jobs use -7 h
    to read local-time mail with UTC bounds)."""
    start = _col(start)
    end = F.timestamp_add("DAY", F.lit(1), start) if end is None else _col(end)
    if offset_hours:
        start = F.timestamp_add("HOUR", F.lit(offset_hours), start)
        end = F.timestamp_add("HOUR", F.lit(offset_hours), end)
    return start, end


def in_window(ts, after_epoch=None, before_epoch=None) -> Column:
    """``after <= ts < before``; an absent bound does not apply."""
    ts = _col(ts)
    cond = F.lit(True)
    if after_epoch is not None:
        a = _col(after_epoch) if isinstance(after_epoch, (Column, str)) else F.lit(after_epoch)
        cond = cond & (a.isNull() | (ts >= epoch_to_ntz(a)))
    if before_epoch is not None:
        b = _col(before_epoch) if isinstance(before_epoch, (Column, str)) else F.lit(before_epoch)
        cond = cond & (b.isNull() | (ts < epoch_to_ntz(b)))
    return cond


def partition_stamp(ts) -> Column:
    """``YYYYMMDD`` of a timestamp or date."""
    return F.date_format(_col(ts), "yyyyMMdd")


def serial_to_date(c) -> Column:
    """Whole-day spreadsheet serial to a DATE."""
    return F.date_add(F.lit(SERIAL_EPOCH).cast("date"), F.floor(_col(c)).cast("int"))


def serial_to_timestamp(c) -> Column:
    """Spreadsheet serial (days + fraction) to a TIMESTAMP_NTZ, rounded to
    the millisecond as spreadsheet readers do. Serials below 60 count from
    1899-12-31 (the 1900 leap-year bug)."""
    c = _col(c).cast("double")
    days = c.cast("int")
    millis = F.bround((c - days) * F.lit(86400000.0), 0).cast("long")
    base = F.when(c < 60, F.lit("1899-12-31")).otherwise(F.lit(SERIAL_EPOCH)).cast("date")
    day0 = F.date_add(base, days).cast("timestamp_ntz")
    return F.timestamp_add("MILLISECOND", millis, day0)
