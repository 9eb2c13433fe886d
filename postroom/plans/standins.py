"""Views of the driver tables as the reference's inputs.

``events`` are messages, ``conversations`` message parts, ``pages`` HTML
bodies, ``documents`` payloads and text reports, ``labels`` processed ids.
Every view is a narrow projection of its table, so the work grows with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postroom.functions.names import header_name
from postroom.sources.messages import urlsafe_b64encode

# --- fixed values -----------------------------------------------------------
# Sender domains of the stand-in messages, picked by user id.
SENDER_DOMAINS = ("procure.example.com", "payments.example.net", "mail.example.com", "bank.example.org")
RECIPIENT = "finance@example.com"
# Job documents routed over ``events``. 2024-01-01 is
# epoch 1704067200; the second window is read with the jobs' -7 h offset.
JOBS = (
    {"job": "po_spending", "from": "procure.example.com", "subject": "purchase", "attachment": "true", "source": "attachment", "file_pattern": "*bolt", "mime_type": "SMALL"},
    {"job": "transaction_share", "from": "payments.example.net", "subject": "*click*", "after": 1704067200, "before": 1704931200, "source": "url_in_body", "url_xpath": "//li/a"},
    {"job": "error_digest", "label": "error", "after": 1704067200 - 25200, "before": 1704067200 + 5 * 86400 - 25200, "source": "url_in_body", "url_xpath": "//li/a"},
    {"job": "views", "subject": "view", "source": "attachment", "file_pattern": "^(red|blue) *", "mime_type": None},
    {"job": "bank", "from": "BANK.example", "to": "finance", "source": "body", "file_pattern": "hot.*(gear|gizmo)|ring$"},
)
# ----------------------------------------------------------------------------

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Rows that one task takes of a table whose rows are small, and each much work.
TASK_ROWS = 20_000


def dealt(df: DataFrame, rows: int = TASK_ROWS) -> DataFrame:
    """A table dealt to as many tasks as its rows need. Spark counts bytes,
    and gives some hundred thousand short rows to one task."""
    return df.repartition(-(-df.count() // rows) or 1)


def events_as_messages(events: DataFrame) -> DataFrame:
    domains = F.array(*[F.lit(d) for d in SENDER_DOMAINS])
    return events.select(
        F.col("event_id").cast("string").alias("message_id"),
        F.col("ts").alias("internal_ts"),
        F.concat(F.lit("user"), F.col("user_id").cast("string"), F.lit("@"), F.element_at(domains, (F.pmod("user_id", F.lit(len(SENDER_DOMAINS))) + 1).cast("int"))).alias("sender"),
        F.lit(RECIPIENT).alias("recipient"),
        F.concat(F.lit("Report "), F.col("event_type")).alias("subject"),
        F.array("event_type").alias("label_ids"),
        (F.col("value") >= 10).alias("has_attachment"),
        F.col("event_id").alias("event_id"),
    )


def conversations_as_parts(conversations: DataFrame) -> DataFrame:
    """Flat parts: a conversation is a message, a turn a top-level part, the
    role its MIME type and the text its data."""
    return conversations.select(
        F.col("conv_id").alias("message_id"),
        F.lit(0).alias("depth"),
        F.array(F.col("turn").cast("int")).alias("path"),
        F.lit("").alias("filename"),
        F.col("role").alias("mime_type"),
        F.col("text").alias("data"),
    )


def _leaf(mime, filename, size, data=None, attachment_id=None):
    return F.struct(
        mime.alias("mimeType"),
        filename.alias("filename"),
        F.struct(size.alias("size"), data.alias("data") if data is not None else F.lit(None).cast("string").alias("data"),
                 attachment_id.alias("attachmentId") if attachment_id is not None else F.lit(None).cast("string").alias("attachmentId")).alias("body"),
    )


def conversations_as_mime(conversations: DataFrame) -> DataFrame:
    """One message per conversation turn with a nested MIME payload:
    ``[alternative[text/plain, text/html], attachment]``."""
    text = F.col("text")
    html = F.concat(F.lit("<p>"), text, F.lit("</p>"))
    plain = _leaf(F.lit("text/plain"), F.lit(""), F.octet_length(text).cast("long"), urlsafe_b64encode(F.encode(text, "UTF-8")))
    rich = _leaf(F.lit("text/html"), F.lit(""), F.octet_length(html).cast("long"), urlsafe_b64encode(F.encode(html, "UTF-8")))
    att_name = F.concat(F.lit("turn_"), F.col("turn").cast("string"), F.lit("_"), F.col("role"), F.lit(".txt"))
    att_id = F.concat(F.lit("att-"), F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string"))
    alt = F.struct(
        F.lit("multipart/alternative").alias("mimeType"), F.lit("").alias("filename"),
        F.struct(F.lit(0).cast("long").alias("size")).alias("body"),
        F.array(plain, rich).alias("parts"),
    )
    att = F.struct(
        F.lit("text/plain").alias("mimeType"), att_name.alias("filename"),
        F.struct(F.octet_length(text).cast("long").alias("size"), att_id.alias("attachmentId")).alias("body"),
    )
    # the children are differently shaped objects, so the array is spliced
    payload_json = F.concat(
        F.lit('{"mimeType":"multipart/mixed","filename":"","body":{"size":0},"parts":['),
        F.to_json(alt), F.lit(","), F.to_json(att), F.lit("]}"),
    )
    return conversations.select(
        F.concat(F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string")).alias("message_id"),
        payload_json.alias("payload"),
    )


def documents_as_parts(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents as one-part messages, URL-safe base64 encoded: even ids
    carry their data inline, odd ids by attachment id."""
    enc = urlsafe_b64encode(F.encode("text", "UTF-8"))
    inline = F.col("doc_id") % 2 == 0
    att_id = F.concat(F.lit("a"), F.col("doc_id").cast("string"))
    parts = documents.select(
        F.col("doc_id").cast("string").alias("message_id"),
        F.lit(0).alias("depth"),
        F.array(F.lit(0)).alias("path"),
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("filename"),
        F.lit("text/plain").alias("mime_type"),
        F.when(inline, enc).alias("data"),
        F.when(~inline, att_id).alias("attachment_id"),
    )
    attachments = documents.where(~inline).select(
        F.col("doc_id").cast("string").alias("message_id"), att_id.alias("attachment_id"), enc.alias("data")
    )
    return parts, attachments


# --- discrepancy mail, cells, loads -------------------------------------------
# Orders are grouped into mails of at most this many consecutive order keys.
MAIL_KEYS = 64
RUN_DATE = "2024-01-02"
ORDER_STATUSES = ("F", "O", "P")


def orders_as_discrepancy_mail(orders: DataFrame) -> DataFrame:
    """One HTML mail per block of ``MAIL_KEYS`` order keys: a result
    paragraph, then per order status a ``NOT FOUND`` paragraph listing the
    keys. Every 7th mail has no unmatched time (run date used), every 50th
    a paragraph with two ``:`` (the whole mail is an error)."""
    bucket = F.floor(F.col("o_orderkey") / MAIL_KEYS).cast("long")
    per = orders.groupBy(bucket.alias("bucket")).agg(
        F.min(F.to_date("o_orderdate")).alias("day"),
        F.array_sort(F.collect_list(F.struct("o_orderkey", "o_orderstatus"))).alias("items"),
    )
    day = F.date_format("day", "yyyy-MM-dd")
    paras = []
    for st in ORDER_STATUSES:
        ids = F.transform(F.filter("items", lambda x: x["o_orderstatus"] == st), lambda x: x["o_orderkey"].cast("string"))
        paras.append(F.when(F.size(ids) > 0, F.concat(F.lit(f"<p>Transaction in status {st} NOT FOUND : "), F.array_join(ids, ", "), F.lit("</p>"))).otherwise(F.lit("")))
    unmatched = F.when(F.col("bucket") % 7 == 0, F.lit("unknown")).otherwise(F.concat(day, F.lit(" 00:00:00")))
    broken = F.when(F.col("bucket") % 50 == 0, F.lit("<p>Transaction in BQ NOT FOUND : a: b</p>")).otherwise(F.lit(""))
    html = F.concat(
        F.lit("<html><body><div><p>Checking time "), day, F.lit(" 01:02:03 with result: unmatched at "), unmatched, F.lit("</p>"),
        *paras, broken, F.lit("<p>All other transactions matched</p></div></body></html>"),
    )
    return per.select(F.concat(F.lit("disc-"), F.col("bucket").cast("string")).alias("message_id"), html.alias("html"))


def _serial_days(ts) -> "F.Column":
    return F.datediff(F.to_date(ts), F.lit("1899-12-30").cast("date"))


LINEITEM_CELL_HEADERS = ("Order Line Description", "Order Line Quantity", "Extended Price", "Ship Date", "Created At", "Invoice Month", "Invoice Year")
ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
# Rows of a generated sheet: one workbook per block of this many order keys.
SHEET_KEYS = 4096


def _melt(df: DataFrame, file_col, row_col, cells, headers) -> DataFrame:
    """Rows to ``cells(file, sheet_no, sheet, row, col, ctype, raw,
    header)`` with a header row 0 for every file, as a sheet reader emits
    them. A header is normalised once, as a literal of its column."""
    body = df.select(
        file_col.alias("file"), row_col.alias("row"),
        F.explode(F.array(*[F.struct(F.lit(i).alias("col"), F.lit(t).alias("ctype"), v.cast("string").alias("raw"), header_name(F.lit(h)).alias("header"))
                            for i, ((t, v), h) in enumerate(zip(cells, headers))])).alias("c"),
    ).select("file", F.lit(0).alias("sheet_no"), F.lit("Sheet1").alias("sheet"), "row", "c.col", "c.ctype", "c.raw", "c.header")
    heads = (
        df.select(file_col.alias("file")).distinct()
        .select("file", F.lit(0).alias("sheet_no"), F.lit("Sheet1").alias("sheet"), F.lit(0).cast("long").alias("row"),
                F.posexplode(F.array(*[F.lit(h) for h in headers])).alias("col", "raw"))
        .select("file", "sheet_no", "sheet", "row", "col", F.lit(1).alias("ctype"), "raw", F.lit(None).cast("string").alias("header"))
    )
    return body.unionByName(heads)


def lineitem_as_cells(lineitem: DataFrame) -> DataFrame:
    days = _serial_days("l_shipdate")
    cells = [
        (1, F.concat(F.col("l_returnflag"), F.lit("\n"), F.col("l_linestatus"), F.lit("\tx"))),
        (2, F.col("l_quantity") / 2),
        (2, F.col("l_extendedprice")),
        (3, days),
        (3, days + F.col("l_linenumber") / F.lit(8.0)),
        (3, days),
        (3, days),
    ]
    file_col = F.concat(F.lit("lineitem_"), F.floor(F.col("l_orderkey") / SHEET_KEYS).cast("string"), F.lit(".xlsx"))
    return _melt(lineitem, file_col, (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("long"), cells, LINEITEM_CELL_HEADERS)


def orders_as_cells(orders: DataFrame) -> DataFrame:
    cells = [
        (2, F.col("o_orderkey")), (2, F.col("o_custkey")), (1, F.col("o_orderstatus")),
        (2, F.col("o_totalprice")), (3, _serial_days("o_orderdate")), (1, F.col("o_orderpriority")),
    ]
    file_col = F.concat(F.lit("orders_"), F.floor(F.col("o_orderkey") / SHEET_KEYS).cast("string"), F.lit(".xlsx"))
    headers = ("Order Key", "Cust Key", "Order Status", "Total Price", "Order Date", "Order Priority")
    return _melt(orders, file_col, (F.col("o_orderkey") + 1).cast("long"), cells, headers)


def orders_as_text(orders: DataFrame) -> DataFrame:
    """Orders as text records with bad values: every 97th total price is
    ``n/a``, every 89th date impossible, every 83rd customer empty."""
    k = F.col("o_orderkey")
    return orders.select(
        k.cast("string").alias("o_orderkey"),
        F.when(k % 83 == 0, F.lit("")).otherwise(F.col("o_custkey").cast("string")).alias("o_custkey"),
        F.col("o_orderstatus"),
        F.when(k % 97 == 0, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice"),
        F.when(k % 89 == 0, F.lit("2024-13-45")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("o_orderdate"),
    )


# Documents per generated archive (bounded group, see ``documents_as_archives``).
ARCHIVE_DOCS = 16


def documents_as_archives(documents: DataFrame) -> DataFrame:
    """Documents packed ``ARCHIVE_DOCS`` per zip (groups bounded by the id
    range): members ``texts/doc_<id>.txt`` (folder flattened on expand),
    plus a nested ``inner.zip`` and a ``README`` without a dot that the
    expansion leaves out. Every 9th block is a broken archive."""
    import pandas as pd

    from postroom.sources.files import build_zip

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        block = int(pdf["block"].iloc[0])
        members = [(f"texts/doc_{d}.txt", t.encode("utf-8")) for d, t in zip(pdf["doc_id"], pdf["text"])]
        members += [("inner.zip", build_zip([("x.txt", b"x")])), ("README", b"readme")]
        data = build_zip(members)
        if block % 9 == 4:
            data = data[: len(data) // 2]
        return pd.DataFrame({"file_name": [f"block_{block}.zip"], "content": [data]})

    block = F.floor(F.col("doc_id") / ARCHIVE_DOCS).cast("long")
    return documents.select(block.alias("block"), "doc_id", "text").groupBy("block").applyInPandas(pack, "file_name string, content binary")


# Orders per generated workbook (bounded group).
WORKBOOK_KEYS = 256
ORDER_HEADERS = ("Order Key", "Cust Key", "Order Status", "Total Price", "Order Date", "Order Priority")


def orders_as_workbooks(orders: DataFrame) -> DataFrame:
    """Orders written as .xlsx files, ``WORKBOOK_KEYS`` order keys each:
    sheet ``Orders`` with a header row (dates as date-styled serials) and a
    second sheet ``Summary`` that single-sheet reads leave out."""
    import datetime as _dt

    import pandas as pd

    from postroom.sources.workbooks import build_xlsx

    epoch = _dt.datetime(1899, 12, 30)

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        block = int(pdf["block"].iloc[0])
        pdf = pdf.sort_values("o_orderkey")
        rows = [list(ORDER_HEADERS)]
        columns = [pdf[c].tolist() for c in cols]
        for key, cust, status, price, date, priority in zip(*columns):
            serial = (date.to_pydatetime() - epoch).total_seconds() / 86400.0
            rows.append([int(key), int(cust), status, float(price), ("date", serial), priority])
        data = build_xlsx([("Orders", rows), ("Summary", [["Rows"], [len(pdf)]])])
        return pd.DataFrame({"file_name": [f"orders_{block}.xlsx"], "content": [data]})

    block = F.floor(F.col("o_orderkey") / WORKBOOK_KEYS).cast("long")
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
    return orders.select(block.alias("block"), *cols).groupBy("block").applyInPandas(pack, "file_name string, content binary")


# Order keys per generated text report.
REPORT_KEYS = 64


def lineitem_as_reports(lineitem: DataFrame) -> DataFrame:
    """Bank-style text reports: per block of ``REPORT_KEYS`` order keys a
    file with two title lines, one detail line per lineitem row (six-digit
    key first) and a short trailer line."""
    block = F.floor(F.col("l_orderkey") / REPORT_KEYS).cast("long")
    detail = F.concat_ws("\t", F.format_string("%06d", "l_orderkey"), F.col("l_linenumber").cast("string"), F.col("l_returnflag"))
    per = lineitem.select(block.alias("block"), F.struct("l_orderkey", "l_linenumber", detail.alias("line")).alias("r")).groupBy("block").agg(
        F.array_sort(F.collect_list("r")).alias("rs")
    )
    body = F.array_join(F.transform("rs", lambda x: x["line"]), "\n")
    text = F.concat(F.lit("BANK REPORT\n------\n"), body, F.lit("\n12345 total\n"))
    return per.select(F.concat(F.lit("RPT_HASIL_"), F.col("block").cast("string"), F.lit(".txt")).alias("file_name"), F.encode(text, "UTF-8").alias("content"))
