"""Discrepancy e-mails to records.

Per document: the first ``//div/p`` whose first text contains ``with
result`` gives two timestamps (text split at ``result:``, each falling back
to the run date); every ``//div/p`` containing ``NOT FOUND`` is split at
``:`` into a description (trimmed, first 15 characters dropped) and
comma-separated ids, one row per id. A document that cannot be parsed so,
or has no such paragraph, goes to the error split with the reason, and
gives no records.

Plan: narrow. A document's paragraphs are one array (X1/X2); the facts are
array functions over it; then the ids are exploded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postroom.functions.names import py_strip
from postroom.sources.html import html_matches

# --- fixed values -----------------------------------------------------------
TIMESTAMP_PATTERN = r"\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}"
RESULT_MARK = "with result"
RESULT_SPLIT = "result:"
NOT_FOUND = "NOT FOUND"
DESCRIPTION_SKIP = 15
PARAGRAPH_PATH = "//div/p"
RECORD_COLUMNS = ("checking_timestamp", "unmatched_timestamp", "discrepancy_description", "transaction_id")
# ----------------------------------------------------------------------------


def _ts_or(c: Column, run_date: Column) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(py_strip(c), TIMESTAMP_PATTERN, 0), F.lit("")), run_date)


def parse_discrepancies(docs: DataFrame, run_date, id_col: str = "doc_id", html_col: str = "html") -> tuple[DataFrame, DataFrame]:
    """Returns ``(records, errors)``: records ``(id, checking_timestamp,
    unmatched_timestamp, discrepancy_description, transaction_id)``, errors
    ``(id, reason)``. Every document is in one of the two."""
    run_date = run_date if isinstance(run_date, Column) else F.lit(run_date)
    docs = html_matches(docs.select(id_col, html_col), PARAGRAPH_PATH, id_col, html_col)
    contains = lambda c, mark: F.coalesce(c.contains(mark), F.lit(False))
    facts = docs.withColumns({
        "results": F.filter("matches", lambda p: contains(F.get(p["texts"], 0), RESULT_MARK)),
        "lines": F.filter("matches", lambda p: contains(p["text"], NOT_FOUND)),
    }).withColumn("halves", F.split(F.get("results", F.lit(0))["text"], RESULT_SPLIT))
    reason = (
        F.when(F.col("status") == "failed", F.lit("document not parsed"))
        .when(F.size("matches") == 0, F.lit("no paragraph"))
        .when(F.exists("matches", lambda p: p["text"].isNull()), F.lit("paragraph without text"))
        .when(F.size("results") == 0, F.lit("no result paragraph"))
        .when(F.col("halves").isNull(), F.lit("result paragraph without text"))
        .when(F.size("halves") != 2, F.lit("result paragraph not split in two"))
        .when(F.exists("lines", lambda p: F.size(F.split(p["text"], ":")) != 2), F.lit("NOT FOUND paragraph without exactly one ':'"))
        .when(F.size("lines") == 0, F.lit("no NOT FOUND paragraph"))
    )
    tagged = facts.withColumn("reason", reason)
    errors = tagged.where(F.col("reason").isNotNull()).select(id_col, "reason")
    halves = F.col("halves")
    lines = tagged.where(F.col("reason").isNull()).select(
        id_col,
        _ts_or(F.get(halves, 0), run_date).alias("checking_timestamp"),
        _ts_or(F.get(halves, 1), run_date).alias("unmatched_timestamp"),
        F.explode("lines").alias("line"),
    )
    kv = F.split(py_strip(F.col("line.text")), ":")
    records = lines.select(
        id_col,
        "checking_timestamp",
        "unmatched_timestamp",
        F.substring(py_strip(F.get(kv, 0)), DESCRIPTION_SKIP + 1, 1 << 30).alias("discrepancy_description"),
        F.explode(F.split(py_strip(F.get(kv, 1)), ",")).alias("transaction_id"),
    ).withColumn("transaction_id", py_strip("transaction_id"))
    return records, errors
