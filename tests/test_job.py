"""A whole job run."""

import base64
import datetime as dt
import json
import os

import pytest

from postroom.plans.job import run_job
from postroom.sinks import deliver as D
from postroom.sources.files import build_zip
from postroom.sources.messages import ATTACHMENT_SCHEMA, MESSAGE_SCHEMA


def b64(b: bytes) -> str:
    return base64.urlsafe_b64encode(b).decode()


def msg(mid, ts, sender, subject, parts, body=None):
    payload = {"mimeType": "multipart/mixed", "filename": "", "body": {"size": 0}, "parts": parts}
    if body is not None:
        payload = {"mimeType": "text/html", "filename": "", "body": {"size": len(body), "data": b64(body.encode())}}
    return (mid, dt.datetime.fromisoformat(ts), sender, "fin@x", subject, [], True, json.dumps(payload))


def test_attachment_job(spark, tmp_dir):
    att = {"mimeType": "application/zip", "filename": "NPO_Spending_1.zip", "body": {"size": 10, "attachmentId": "A1"}}
    nested = {"mimeType": "multipart/alternative", "filename": "", "body": {"size": 0}, "parts": [dict(att, filename="NPO_Spending_2.zip")]}
    messages = spark.createDataFrame(
        [msg("m1", "2024-01-01 08:00:00", "a@procure.example.com", "PO", [att]),
         msg("m2", "2024-01-03 08:00:00", "a@procure.example.com", "PO", [att]),
         msg("m3", "2024-01-01 09:00:00", "a@procure.example.com", "PO", [nested])],
        MESSAGE_SCHEMA,
    )
    attachments = spark.createDataFrame([("m1", "A1", b64(build_zip([("dir/report.csv", b"x,y")])))], ATTACHMENT_SCHEMA)
    job = {
        "name": "po",
        "mail_filter": {"from": "procure.example.com", "attachment": True},
        "file_to_extract": {"source": "attachment", "file_pattern": "NPO_Spending_*"},
        "transform": {"transform_model": "unzip"},
        "load_destination": [{"name": "files", "dir": os.path.join(tmp_dir, "out")}],
    }
    state = os.path.join(tmp_dir, "processed")
    st, _ = run_job(job, messages, attachments, state, dt.datetime(2024, 1, 1), hour=10)
    assert [(r.channel, r.status, r.rows) for r in st.collect()] == [("files", "ok", 1)]
    out = spark.read.parquet(os.path.join(tmp_dir, "out")).collect()
    assert [(r.file_name, bytes(r.content)) for r in out] == [("report_20240101.csv", b"x,y")]
    assert sorted(r.message_id for r in D.processed_ids(spark, state).collect()) == ["m1", "m3"]
    # second run: everything in the window was processed
    st2, _ = run_job(job, messages, attachments, state, dt.datetime(2024, 1, 1), hour=23)
    assert [r.status for r in st2.collect()] == ["skipped"]
    with pytest.raises(D.NoFilesError):
        run_job(dict(job, ignore_after=15), messages, attachments, state, dt.datetime(2024, 1, 1), hour=10)


def test_link_job(spark, tmp_dir):
    html = '<ul><li><a href="http://h/files/a.csv">a</a></li></ul><p><b>pw9</b></p>'
    messages = spark.createDataFrame(
        [msg("m1", "2024-01-01 08:00:00", "noreply@payments.example.net", "share", None, body=html),
         msg("m2", "2024-01-01 09:00:00", "noreply@payments.example.net", "share", None, body="<p>no links</p>")],
        MESSAGE_SCHEMA,
    )
    job = {
        "name": "share",
        "mail_filter": {"from": "payments.example.net"},
        "file_to_extract": {"source": "url_in_body", "url_xpath": "//li/a", "password_xpath": "//p/b"},
        "load_destination": {"name": "list", "dir": os.path.join(tmp_dir, "links")},
    }
    st, links = run_job(job, messages, None, os.path.join(tmp_dir, "state"), dt.datetime(2024, 1, 1), hour=10)
    assert [r.status for r in st.collect()] == ["ok"]
    got = [(r.message_id, r.href, r.file_name, r.zip_password) for r in links.collect()]
    assert got == [("m1", "http://h/files/a.csv", "m1_0", "pw9")]
    # a test run takes processed messages again and marks none
    state = os.path.join(tmp_dir, "state")
    before = D.processed_ids(spark, state).count()
    st, links = run_job(job, messages, None, state, dt.datetime(2024, 1, 1), hour=10, test=True)
    assert links.count() == 1 and D.processed_ids(spark, state).count() == before
