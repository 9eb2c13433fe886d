"""Message scan, MIME flattening, body selection, decoding, routing."""

import base64
import json

from pyspark.sql import functions as F

from postroom.operators import routing as R
from postroom.sources import messages as M


def b64(s: str) -> str:
    return base64.urlsafe_b64encode(s.encode()).decode()


def part(name, mime="text/plain", data=None, size=0, att=None, parts=None, filename=""):
    p = {"mimeType": mime, "filename": filename, "body": {"size": size}}
    if data is not None:
        p["body"]["data"] = data
        p["body"]["size"] = len(data)
    if att:
        p["body"]["attachmentId"] = att
    if parts:
        p["parts"] = parts
    p["_n"] = name
    return p


def msgs(spark, payloads):
    rows = [(mid, json.dumps(p)) for mid, p in payloads]
    return spark.createDataFrame(rows, "message_id string, payload string")


def test_level_order(spark):
    tree = part("root", parts=[part("a", parts=[part("c", parts=[part("e")]), part("d")]), part("b")])
    flat = M.flatten_parts(msgs(spark, [("m", tree)]))
    # names are carried in the mime type of this fixture
    named = flat.join(spark.createDataFrame([(1,)], "x int"), how="left").orderBy("depth", "path")
    order = [json.loads(json.dumps(r.asDict()))["path"] for r in named.collect()]
    assert order == [[0], [1], [0, 0], [0, 1], [0, 0, 0]]


def test_no_depth_is_too_deep(spark):
    tree = part("leaf")
    for _ in range(30):
        tree = part("m", parts=[tree])
    flat = M.flatten_parts(msgs(spark, [("m", part("root", parts=[tree])), ("flat", part("root", parts=[part("a")]))]))
    assert sorted(r.depth for r in flat.where("message_id = 'm'").collect()) == list(range(31))
    assert flat.where("message_id = 'flat'").count() == 1


def test_select_body(spark):
    own = part("root", mime="text/html", data=b64("<p>own</p>"))
    nested = part("root", parts=[part("x", mime="text/plain", data=b64("plain")),
                                 part("y", mime="multipart/alternative", parts=[part("h1", mime="text/html", data=b64("first"))]),
                                 part("z", mime="multipart/related", parts=[part("h2", mime="text/html", data=b64("second"))]),
                                 part("att", mime="text/html", data=b64("attached"), filename="f.html")])
    none = part("root", parts=[part("x", mime="text/plain", data=b64("plain"))])
    m = msgs(spark, [("own", own), ("nested", nested), ("none", none)])
    body = M.select_body(m, M.flatten_parts(m))
    got = {r.message_id: base64.urlsafe_b64decode(r.data).decode() for r in body.collect()}
    assert got == {"own": "<p>own</p>", "nested": "second"}


def test_decode_payload(spark):
    raw = bytes(range(256)) * 3
    enc = base64.urlsafe_b64encode(raw).decode()
    assert "-" in enc and "_" in enc
    parts = spark.createDataFrame([("m", "inline", enc, None), ("m", "byid", None, "A1")],
                                  "message_id string, filename string, data string, attachment_id string")
    atts = spark.createDataFrame([("m", "A1", enc)], "message_id string, attachment_id string, data string")
    got = {r.filename: bytes(r.content) for r in M.decode_payload(parts, atts).collect()}
    assert got == {"inline": raw, "byid": raw}


def test_route_and_attachments(spark):
    m = spark.createDataFrame(
        [("1", "2024-01-01 10:00:00", "Billing@Procure.Example.com", "fin@x", "PO Spending weekly", ["L1"], True),
         ("2", "2024-01-03 10:00:00", "noreply@payments.example.net", "fin@x", "Transaction share csv download", [], False),
         ("3", "2023-12-31 23:00:00", "noreply@payments.example.net", "fin@x", "Transaction share csv download", [], False)],
        "message_id string, ts string, sender string, recipient string, subject string, label_ids array<string>, has_attachment boolean",
    ).withColumn("internal_ts", F.col("ts").cast("timestamp_ntz"))
    jobs = [
        {"job": "po", "from": "procure.example.com", "subject": "PO Spending", "attachment": "true", "file_pattern": "NPO_Spending_*"},
        {"job": "mid", "from": "noreply@payments.example.net", "subject": "*csv download*", "after": 1704067200, "before": 1704067200 + 3 * 86400},
        {"job": "lab", "label": "L1", "file_pattern": "*.csv", "mime_type": "text/csv"},
    ]
    routed = R.route_messages(m, jobs)
    assert sorted((r.message_id, r.job) for r in routed.collect()) == [("1", "lab"), ("1", "po"), ("2", "mid")]
    parts = spark.createDataFrame(
        [("1", 0, "NPO_Spending_2024.xlsx", "application/x"), ("1", 1, "NPO_Spending_nested.xlsx", "application/x"),
         ("1", 0, "a.csv", "text/csv"), ("1", 0, "b.csv", "text/plain"), ("1", 0, "xNPO_Spending_Y", "a")],
        "message_id string, depth int, filename string, mime_type string",
    )
    hits = R.attachment_jobs(parts.join(routed.select("message_id", "job"), "message_id"), jobs)
    assert sorted((r.job, r.filename) for r in hits.collect()) == [
        ("lab", "a.csv"), ("po", "NPO_Spending_2024.xlsx"), ("po", "xNPO_Spending_Y")]
    assert R.filename_regex("*Scheduled.csv") == r".*Scheduled\.csv"
    assert R.filename_regex("^a+b*.csv$|c[1]*") == r"^a\+b.*\.csv$|c\[1\].*"
    assert R.filename_regex("a.*b") == "a.*b"


def test_unprocessed(spark):
    routed = spark.createDataFrame([("1", "a"), ("1", "b"), ("2", "a")], "message_id string, job string")
    done = spark.createDataFrame([("1", "a")], "message_id string, job string")
    assert sorted(tuple(r) for r in R.unprocessed(routed, done).collect()) == [("1", "b"), ("2", "a")]


def test_read_lines_and_clean(spark, tmp_dir):
    import os

    from postroom.sources.reports import clean_report, read_lines

    with open(os.path.join(tmp_dir, "RPT_1.txt"), "w") as fh:
        fh.write("BANK REPORT\n------\n000123\tA\t10.5\n12345 short\n")
    out = clean_report(read_lines(spark, tmp_dir))
    assert [(r.file_name, r.line) for r in out.collect()] == [("RPT_1.txt", "000123\tA\t10.5")]


def test_order_by_receive_time(spark):
    m = spark.createDataFrame([("b", "2024-01-02 00:00:00"), ("a", "2024-01-02 00:00:00"), ("c", "2024-01-01 00:00:00")],
                              "message_id string, t string").withColumn("internal_ts", F.col("t").cast("timestamp_ntz"))
    assert [r.message_id for r in R.order_by_receive_time(m).collect()] == ["c", "a", "b"]


def test_scan_messages_and_window_pushdown(spark, tmp_dir):
    import io
    import os
    from contextlib import redirect_stdout

    rows = [
        {"message_id": "1", "internal_ts": "2024-01-01T10:00:00", "sender": "a@procure.example.com", "recipient": "f@x",
         "subject": "PO Spending", "label_ids": ["L"], "has_attachment": True, "payload": "{}"},
        {"message_id": "2", "internal_ts": "2024-01-05T10:00:00", "sender": "a@procure.example.com", "recipient": "f@x",
         "subject": "PO Spending", "label_ids": [], "has_attachment": True, "payload": "{}"},
    ]
    src = os.path.join(tmp_dir, "messages.json")
    with open(src, "w") as fh:
        fh.write("\n".join(json.dumps(r) for r in rows))
    m = M.scan_messages(spark, src)
    pq = os.path.join(tmp_dir, "messages.parquet")
    m.write.parquet(pq)
    window = {"after": 1704067200, "before": 1704067200 + 86400}
    jobs = [{"job": "a", "from": "procure.example.com", **window}, {"job": "b", "subject": "PO", **window}]
    routed = R.route_messages(M.scan_messages(spark, pq, fmt="parquet"), jobs)
    assert sorted((r.message_id, r.job) for r in routed.collect()) == [("1", "a"), ("1", "b")]
    buf = io.StringIO()
    with redirect_stdout(buf):
        routed.explain("formatted")
    pushed = [ln for ln in buf.getvalue().splitlines() if ln.startswith("PushedFilters")]
    assert pushed and "internal_ts" in pushed[0]
