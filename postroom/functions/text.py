"""Text expressions."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Truthy words, two variants used by the reference's job options.
TRUTHY_WORDS = ("yes", "true", "t", "1")
TRUTHY_WORDS_ALT = ("true", "1", "yes", "y")
# Characters kept by ``strip_reserved`` besides letters, numbers and ``_``
# (the range ``!-#`` is ``! " #``).
RESERVED_KEEP = r"\-_. \^&'@\{\}\[\],$=!-#\(\)%+~"
# ----------------------------------------------------------------------------


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _strip_marks(s: str) -> str:
    return "".join(ch for ch in unicodedata.normalize("NFKD", s) if not unicodedata.combining(ch))


def fold_accents(c) -> Column:
    """Compatibility decomposition (NFKD) without combining marks, for
    every character of Unicode; what has no decomposition (``ß``) stays.
    Spark has no such function, so this is an Arrow-batched pandas UDF."""

    @F.pandas_udf("string")
    def _fold(s: pd.Series) -> pd.Series:
        return s.map(lambda v: v if v is None or v.isascii() else _strip_marks(v))

    return _fold(_col(c))


def strip_reserved(c) -> Column:
    """Curly apostrophe to ``'``, ``?`` dropped, any other character
    outside the portable file-name set to ``_``."""
    c = F.replace(_col(c), F.lit("’"), F.lit("'"))
    c = F.replace(c, F.lit("?"), F.lit(""))
    return F.regexp_replace(c, r"[^\p{L}\p{N}_" + RESERVED_KEEP + "]", "_")


def truthy(c, words=TRUTHY_WORDS) -> Column:
    """``str(v).lower() in words``; NULL is false."""
    return F.coalesce(F.lower(_col(c).cast("string")).isin(*words), F.lit(False))


def truthy_alt(c) -> Column:
    return truthy(c, TRUTHY_WORDS_ALT)


def parse_iso(c) -> Column:
    """ISO-8601 text to a timestamp (``Z`` and offsets accepted, naive
    text read as UTC); junk gives NULL. Returned as the UTC wall clock in a
    TIMESTAMP_NTZ, whatever the session zone."""
    c = F.trim(_col(c))
    zoned = c.rlike(r"[0-9]{2}:[0-9]{2}(:[0-9]{2}([.,][0-9]+)?)?(Z|[+-][0-9]{2}(:?[0-9]{2})?)$")
    return F.when(zoned, _ntz_utc(F.try_to_timestamp(c))).otherwise(c.try_cast("timestamp_ntz"))


def _ntz_utc(ts: Column) -> Column:
    """Instant to its UTC wall clock, independent of the session zone."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(ts), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
