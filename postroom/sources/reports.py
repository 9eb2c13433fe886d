"""Text reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Detail lines of bank reports start with six (Unicode decimal) digits.
DETAIL_LINE = r"^\p{Nd}{6}"
# ----------------------------------------------------------------------------


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, with the file it came from (splittable)."""
    return spark.read.text(path).select(F.col("_metadata.file_name").alias("file_name"), F.col("value").alias("line"))


def split_lines(text) -> Column:
    """Lines of a text value, as ``posexplode`` input (``\\n`` separated)."""
    text = F.col(text) if isinstance(text, str) else text
    return F.split(text, "\n")


def is_detail_line(line) -> Column:
    """the line starts with six digits."""
    line = F.col(line) if isinstance(line, str) else line
    return F.coalesce(line.rlike(DETAIL_LINE), F.lit(False))


def clean_report(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """T5 ``rpt_cleaner``: keep the detail lines only."""
    return lines.where(is_detail_line(line_col))
