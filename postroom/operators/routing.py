"""Routing messages to jobs.

Jobs are job documents (tens of small dicts held by the driver). Each job's
filter is compiled into a literal Column predicate, and all jobs are
evaluated in one narrow pass: ``explode(filter(array(when(cond_i, job_i))))``.
No join and no broadcast is needed, every regex is a literal compiled once
per task, and the pass is split over messages like any projection.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postroom.functions.timewin import in_window

# Job keys understood by the filter (a subset of a job document).
FILTER_KEYS = ("from", "to", "subject", "label", "after", "before", "attachment")


# --- fixed values -----------------------------------------------------------
# Signs that keep their regex meaning in a glob: jobs anchor with the first
# two and give choices with the others.
KEPT_SIGNS = "^$|()"
# ----------------------------------------------------------------------------


def filename_regex(pattern: str) -> str:
    """the regex of a file pattern, for an unanchored search. A pattern
    is a glob if it has a star and none that stands after a dot (``.*`` is a
    regex): there a star is any text, ``KEPT_SIGNS`` are as in a regex, and
    every other sign is itself. Any other pattern is a regex as it is."""
    if "*" not in pattern or ".*" in pattern:
        return pattern
    out = []
    for sign in pattern:
        if sign == "*":
            out.append(".*")
        elif sign in KEPT_SIGNS or sign.isalnum() or sign.isspace():
            out.append(sign)
        else:
            out.append("\\" + sign)
    return "".join(out)


def _contains_ci(col: Column, needle: str) -> Column:
    return F.coalesce(F.lower(col).contains(needle.lower()), F.lit(False))


def message_filter(job: Mapping) -> Column:
    """AND of the predicates the job gives; absent ones pass."""
    cond = F.lit(True)
    if job.get("from"):
        cond = cond & _contains_ci(F.col("sender"), str(job["from"]))
    if job.get("to"):
        cond = cond & _contains_ci(F.col("recipient"), str(job["to"]))
    if job.get("subject"):
        cond = cond & _contains_ci(F.col("subject"), str(job["subject"]).strip("*"))
    if job.get("label"):
        cond = cond & F.coalesce(F.array_contains("label_ids", job["label"]), F.lit(False))
    if job.get("after") is not None or job.get("before") is not None:
        cond = cond & in_window("internal_ts", job.get("after"), job.get("before"))
    if job.get("attachment") is not None and is_true(job["attachment"]):
        cond = cond & F.coalesce(F.col("has_attachment"), F.lit(False))
    return cond


def is_true(v) -> bool:
    return str(v).lower() in ("yes", "true", "t", "1")


def route_messages(messages: DataFrame, jobs: Sequence[Mapping]) -> DataFrame:
    """One row per (message, matching job)."""
    if not jobs:
        return messages.withColumn("job", F.lit(None).cast("string")).limit(0)
    conds = [message_filter(j) for j in jobs]
    # The OR of all job filters first: plain comparisons in it (time
    # bounds shared by every job) reach the parquet scan as pushed filters.
    any_job = conds[0]
    for c in conds[1:]:
        any_job = any_job | c
    hits = F.array(*[F.when(c, F.lit(j["job"])) for c, j in zip(conds, jobs)])
    return messages.where(any_job).withColumn("job", F.explode(F.filter(hits, lambda x: x.isNotNull())))


def unprocessed(routed: DataFrame, processed: DataFrame, keys=("message_id", "job")) -> DataFrame:
    """Drop messages already processed for the job (anti join)."""
    return routed.join(processed.select(*keys), list(keys), "left_anti")


def _takes(job: Mapping) -> Column:
    """whether a part's file name matches the job's pattern, and
    its MIME type the job's, when given."""
    named = F.col("filename").rlike(filename_regex(job["file_pattern"]))
    return named & (F.col("mime_type") == F.lit(job["mime_type"])) if job.get("mime_type") else named


def attachment_jobs(parts: DataFrame, jobs: Sequence[Mapping]) -> DataFrame:
    """A row for each job that takes a top-level part. As in J1, only the
    matches are exploded. Parts that were routed already, with a column
    ``job``, are only matched with that job."""
    routed = "job" in parts.columns
    hits = [F.when(_takes(j) & (F.col("job") == F.lit(j["job"])) if routed else _takes(j), F.lit(j["job"])) for j in jobs if j.get("file_pattern")]
    if not hits:
        return parts.withColumn("job", F.lit(None).cast("string")).limit(0)
    return parts.where(F.col("depth") == 0).withColumn("job", F.explode(F.filter(F.array(*hits), lambda x: x.isNotNull())))


def match_counts(routed: DataFrame) -> DataFrame:
    """A1: matches per job, with the first and last receive time."""
    return routed.groupBy("job").agg(
        F.count(F.lit(1)).alias("n_messages"),
        F.min("internal_ts").alias("first_ts"),
        F.max("internal_ts").alias("last_ts"),
    )


def order_by_receive_time(df: DataFrame) -> DataFrame:
    """O1: receive time ascending (output only; a global sort)."""
    return df.orderBy("internal_ts", "message_id")
