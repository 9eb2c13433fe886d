"""One job run end to end, composed from the operators.

``run_job`` takes a job document (the reference's ``mail_filter``,
``file_to_extract``, ``transform``, ``load_destination`` and
``ignore_after`` keys) and the message tables, and returns the delivery
status of each destination. Links found in bodies are returned as rows to
fetch (there is no HTTP client here); attachments and bodies become file
rows that are transformed and delivered.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postroom.functions import names as N
from postroom.operators import html_select as H
from postroom.operators import routing as R
from postroom.operators.transforms import apply_transform
from postroom.session import work_path
from postroom.sinks import deliver as D
from postroom.sources import messages as M


def _epoch(ts: dt.datetime) -> int:
    if ts.tzinfo is None:
        ts = ts.replace(tzinfo=dt.timezone.utc)
    return int(ts.timestamp())


def job_filter(job: Mapping, run_start: dt.datetime, run_end: dt.datetime | None = None) -> dict:
    """The routing filter of a job document: its ``mail_filter`` keys, with
    the run window (default one day) when the job gives no bounds."""
    f = dict(job.get("mail_filter") or {})
    run_end = run_end or run_start + dt.timedelta(days=1)
    f.setdefault("after", _epoch(run_start))
    f.setdefault("before", _epoch(run_end))
    f["job"] = job["name"]
    extract = job.get("file_to_extract") or {}
    f["file_pattern"] = extract.get("file_pattern")
    f["mime_type"] = extract.get("mime_type")
    return f


def job_files(job: Mapping, routed: DataFrame, attachments: DataFrame | None) -> tuple[DataFrame | None, DataFrame | None]:
    """Files of the routed messages ``(message_id, file_name, content)``,
    or, for jobs with a link path, the links to fetch ``(message_id, kind,
    pos, href, file_name[, zip_password])``; a body whose path matches no
    link yields nothing, one that cannot be parsed is itself the file (kind
    ``body``, X6). Jobs without a link path use the body itself."""
    extract = job.get("file_to_extract") or {}
    source = extract.get("source", "attachment")
    parts = M.flatten_parts(routed)
    if source == "attachment":
        hits = R.attachment_jobs(parts.withColumn("job", F.lit(job["name"])), [job_filter(job, dt.datetime(1970, 1, 1))])
        atts = attachments if attachments is not None else routed.sparkSession.createDataFrame([], M.ATTACHMENT_SCHEMA)
        place = F.array_join(F.transform("path", lambda x: x.cast("string")), ".")
        files = M.decode_payload(hits, atts).select("message_id", place.alias("pos"), F.col("filename").alias("file_name"), "content")
        return files, None
    bodies = M.select_body(routed, parts, extract.get("mime_type") or "text/html")
    bodies = bodies.select("message_id", M.urlsafe_b64decode("data").alias("content"))
    html = bodies.select("message_id", F.decode("content", "UTF-8").alias("html"))
    links = None
    if extract.get("url_xpath"):
        links = H.links_or_body(html, extract["url_xpath"], id_col="message_id")
        default = F.concat_ws("_", F.col("message_id"), F.col("pos").cast("string"))
        none = F.lit(None).cast("string")
        name = F.when(F.col("kind") == "link", N.url_file_name(F.col("href"), none, none, none, default))
        links = links.withColumn("file_name", name.otherwise(F.concat(F.col("message_id"), F.lit("_body.html"))))
        if extract.get("password_xpath"):
            pw = H.extract_last(html, extract["password_xpath"], "text()", id_col="message_id")
            links = H.attach_password(links, pw)
        return None, links
    files = bodies.select("message_id", F.concat(F.col("message_id"), F.lit("_body.html")).alias("file_name"), "content")
    return files, None


def run_job(
    job: Mapping,
    messages: DataFrame,
    attachments: DataFrame | None,
    processed_path: str,
    run_start: dt.datetime,
    run_end: dt.datetime | None = None,
    hour: int | None = None,
    test: bool = False,
) -> tuple[DataFrame, DataFrame | None]:
    """Route, skip processed, extract, transform, deliver, mark processed.

    The messages to do are computed once, into the shared work folder: what
    is guarded, delivered and marked is one batch. In ``test`` runs processed
    messages are not skipped and none are marked.

    Returns ``(statuses, links)``; ``statuses`` has one row per destination
    (or one ``skipped`` row when nothing matched at or after the job's
    ``ignore_after`` hour); ``links`` are the body links to fetch, which is
    also what link jobs deliver.
    """
    spark = messages.sparkSession
    routed = R.route_messages(messages, [job_filter(job, run_start, run_end)])
    if not test:
        routed = R.unprocessed(routed, D.processed_ids(spark, processed_path).select("message_id", "job"))
    batch = work_path(spark, "batch")
    routed.write.parquet(batch)
    todo = spark.read.schema(routed.schema).parquet(batch)
    files, links = job_files(job, todo, attachments)
    work = files if files is not None else links
    status = D.guard_empty(work, hour if hour is not None else dt.datetime.now().hour, job.get("ignore_after", 23))
    if status == "skipped":
        return spark.createDataFrame([("all", "skipped", 0, None)], D.STATUS_SCHEMA), links
    if files is not None:
        transform = dict(job.get("transform") or {})
        name = transform.pop("transform_model", None)
        out = apply_transform(files, name, stamp=run_start.strftime("%Y%m%d"), **transform)
    else:
        out = links
    dests = job.get("load_destination") or []
    dests = [dests] if isinstance(dests, Mapping) else list(dests)
    statuses = D.fan_out(out, dests)
    if not test:
        D.mark_processed(todo.select("message_id").distinct(), job["name"], run_start.strftime("%Y-%m-%d %H:%M:%S"), processed_path, statuses)
    return statuses, links
