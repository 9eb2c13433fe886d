"""Driver queries: one per operator group of SURVEY 2 (see 7.3).

Each takes ``(spark, sf_dir)`` and returns a DataFrame over the whole input
tables. Column names equal those of the matching SQL in ``oracle.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postroom.functions import names as N
from postroom.operators import html_select as H
from postroom.operators import routing as R
from postroom.functions import text as X
from postroom.functions import timewin as W
from postroom.operators import cells as C
from postroom.operators import checks as V
from postroom.operators import schema as S
from postroom.operators.discrepancies import parse_discrepancies
from postroom.plans import standins as SI
from postroom.sources import reports as RP
from postroom.plans.standins import (
    JOBS,
    conversations_as_mime,
    conversations_as_parts,
    dealt,
    documents_as_parts,
    events_as_messages,
    table,
)
from postroom.session import apply_defaults
from postroom.sources import messages as M
from postroom.sources.html import html_elements

LINK_PATH = "//li/a"


def _prep(spark: SparkSession) -> None:
    apply_defaults(spark)


# -- messages ----------------------------------------------------------------

def route_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches per job over all messages."""
    _prep(spark)
    msgs = events_as_messages(table(spark, sf_dir, "events"))
    return R.match_counts(R.route_messages(msgs, JOBS))


def unprocessed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents not yet processed (``labels`` holds processed ids)."""
    _prep(spark)
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("message_id"), "lang", "source")
    done = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("message_id"))
    return R.unprocessed(docs, done, keys=("message_id",))


def attachment_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names (``part.p_name``) against every attachment
    job's file pattern and MIME type; a part has a row for each job that
    takes it, and no others are made."""
    _prep(spark)
    part = table(spark, sf_dir, "part")
    parts = part.select(
        F.col("p_partkey").alias("message_id"),
        F.lit(0).alias("depth"),
        F.col("p_name").alias("filename"),
        F.split("p_type", " ").getItem(0).alias("mime_type"),
    )
    jobs = [j for j in JOBS if j.get("file_pattern")]
    return R.attachment_jobs(parts, jobs).select("job", "message_id", "filename")


def last_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3, A2: last ``assistant`` part per conversation."""
    _prep(spark)
    conv = table(spark, sf_dir, "conversations")
    parts = conversations_as_parts(conv)
    msgs = conv.select(F.col("conv_id").alias("message_id"), F.lit(None).cast("string").alias("payload")).distinct()
    return M.select_body(msgs, parts, mime_type="assistant").withColumnRenamed("data", "body")


def flatten_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested MIME payloads flattened in level order, inline
    data decoded."""
    _prep(spark)
    msgs = conversations_as_mime(table(spark, sf_dir, "conversations"))
    parts = M.flatten_parts(msgs)
    return parts.select(
        "message_id",
        "depth",
        F.array_join(F.transform("path", lambda x: x.cast("string")), ".").alias("part_path"),
        "filename",
        "mime_type",
        "size",
        F.decode(M.urlsafe_b64decode("data"), "UTF-8").alias("text"),
        "attachment_id",
    )


def decode_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URL-safe base64 payloads, inline or by attachment id."""
    _prep(spark)
    parts, atts = documents_as_parts(table(spark, sf_dir, "documents"))
    out = M.decode_payload(parts, atts)
    return out.select(F.col("message_id").cast("long").alias("doc_id"), F.decode("content", "UTF-8").alias("text"))


# -- HTML --------------------------------------------------------------------

def _pages(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(F.col("page_id").alias("doc_id"), "html")


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``//li/a`` targets of every page in document order."""
    _prep(spark)
    return H.extract_links(_pages(spark, sf_dir), LINK_PATH).withColumnRenamed("doc_id", "page_id")


def last_link_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text of the last ``//li/a`` of every page (NULL when none)."""
    _prep(spark)
    return H.extract_last(_pages(spark, sf_dir), LINK_PATH, attr="text()").withColumnRenamed("doc_id", "page_id").withColumnRenamed("value", "link_text")


def links_or_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even pages belong to a job with a link path, odd ones to a job
    without: links for the first, the body itself for the second."""
    _prep(spark)
    return H.links_or_body(_pages(spark, sf_dir), LINK_PATH, with_path=F.col("doc_id") % 2 == 0).withColumnRenamed("doc_id", "page_id")


def elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elements per page and tag, all tags."""
    _prep(spark)
    els = html_elements(_pages(spark, sf_dir))
    return (
        els.groupBy(F.col("doc_id").alias("page_id"), "tag")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def route_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The minimum slice: messages routed to link jobs, minus
    processed ones, joined to their HTML body, links extracted and named."""
    _prep(spark)
    msgs = events_as_messages(table(spark, sf_dir, "events"))
    link_jobs = [j for j in JOBS if j.get("source") == "url_in_body"]
    routed = R.route_messages(msgs, link_jobs)
    done = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("message_id"))
    todo = R.unprocessed(routed, done, keys=("message_id",))
    pages = _pages(spark, sf_dir)
    n_pages = pages.select(F.count(F.lit(1))).scalar()
    lk = H.extract_links(pages, LINK_PATH).withColumnRenamed("doc_id", "page_id")
    joined = todo.withColumn("page_id", F.pmod(F.col("event_id"), n_pages)).join(lk, "page_id")
    stem = F.concat_ws("_", F.col("message_id"), F.col("pos").cast("string"), N.basename(N.url_path("href")))
    return joined.select(
        "job",
        "message_id",
        "pos",
        "href",
        N.safe_name(F.concat(stem, F.lit(".html")), stamp=F.date_format("internal_ts", "yyyyMMdd")).alias("file_name"),
    )


# -- reports -----------------------------------------------------------------

def discrepancies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Discrepancy mails built from orders, parsed back."""
    _prep(spark)
    mails = SI.orders_as_discrepancy_mail(table(spark, sf_dir, "orders"))
    records, _errors = parse_discrepancies(mails, SI.RUN_DATE, id_col="message_id")
    return records


def report_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detail lines of text reports (document lines, plus lines
    made from lineitem, half of them detail lines)."""
    _prep(spark)
    docs = table(spark, sf_dir, "documents").select(
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("report_id"),
        F.posexplode(RP.split_lines("text")).alias("line_no", "line"),
    )
    li = table(spark, sf_dir, "lineitem")
    detail = F.concat_ws("\t", F.format_string("%06d", "l_orderkey"), F.col("l_linenumber").cast("string"), F.col("l_returnflag"))
    short = F.concat(F.format_string("%05d", "l_linenumber"), F.lit(" short "), F.col("l_orderkey").cast("string"))
    lines = li.select(
        F.concat(F.lit("li-"), F.col("l_orderkey").cast("string")).alias("report_id"),
        F.col("l_linenumber").alias("line_no"),
        F.when(F.col("l_linenumber") % 2 == 0, detail).otherwise(short).alias("line"),
    )
    return RP.clean_report(docs.unionByName(lines))


# -- names ---------------------------------------------------------------------

def secure_filename(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1 over page URLs."""
    _prep(spark)
    return table(spark, sf_dir, "pages").select("page_id", "url", N.secure_filename("url").alias("file_name"))


def safe_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E2, E3 over part names as export paths."""
    _prep(spark)
    part = table(spark, sf_dir, "part")
    path = F.concat(F.lit("exports/"), F.col("p_name"), F.when(F.col("p_partkey") % 3 == 0, F.lit(" 2023")).otherwise(F.lit("")), F.lit(".csv"))
    return part.select("p_partkey", path.alias("path")).select("p_partkey", "path", N.safe_name("path", stamp="20240101").alias("file_name"))


def fetch_log(pages: DataFrame) -> DataFrame:
    """Pages as download records: every third redirected, every third with
    a Content-Disposition name, every fourth a zip."""
    pid = F.col("page_id")
    final = F.when(pid % 3 == 1, F.concat(F.regexp_replace("url", r"[?#].*$", ""), F.lit("/file_"), pid.cast("string"), F.lit(".csv"))).otherwise(F.col("url"))
    cd = F.when(pid % 3 == 2, F.concat(F.lit("attachment; filename=export "), pid.cast("string"), F.lit(".xlsx")))
    ctype = F.when(pid % 4 == 0, F.lit("application/zip")).otherwise(F.lit("text/csv"))
    return pages.select("page_id", "url", final.alias("final_url"), cd.alias("content_disposition"), ctype.alias("content_type"),
                        F.concat(F.lit("msg"), pid.cast("string")).alias("default_name"))


def url_file_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E9, E3 over a fetch log made from pages."""
    _prep(spark)
    log = fetch_log(table(spark, sf_dir, "pages"))
    return log.select("page_id", N.url_file_name("url", "final_url", "content_disposition", "content_type", "default_name").alias("file_name"))


def drop_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E10 over versioned report names made from orders."""
    _prep(spark)
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    ver = F.when(k % 3 == 0, F.lit("")).when(k % 3 == 1, F.concat(F.lit("_"), (k % 10).cast("string"))).otherwise(F.concat(F.lit("_"), (k % 10).cast("string"), F.lit("_v")))
    name = F.concat(F.lit("MKM_REPORT_"), F.date_format("o_orderdate", "yyyyMMdd"), ver, F.lit(".txt"))
    out = o.select("o_orderkey", name.alias("file_name")).withColumn("renamed", N.drop_version("file_name"))
    return out.withColumn("file_date", N.file_date("renamed"))


# --- fixed values -------------------------------------------------------------
# Spreadsheet headers of the reference's jobs (see FIXTURES 6).
HEADERS = ("Invoice Number", "PO Number", "Account Segment 1 Name", "Commodity Level 3", "GL Account/Lookup", "userFullName")
# ------------------------------------------------------------------------------


def header_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job headers combined with every part type and size."""
    _prep(spark)
    part = dealt(table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size"))
    h = part.select("p_partkey", F.posexplode(F.array(*[F.lit(x) for x in HEADERS])).alias("header_no", "h"), "p_type", "p_size")
    h = h.select("p_partkey", "header_no", F.concat_ws(" ", "h", "p_type", F.col("p_size").cast("string")).alias("header"))
    return h.select("p_partkey", "header_no", "header", N.header_name("header").alias("header_name"),
                    N.header_name_alt("header").alias("header_name_alt"), N.column_key("header").alias("column_key"))


def fold_accents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E7 over all documents."""
    _prep(spark)
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", X.fold_accents("text").alias("folded"))


def strip_reserved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E8 over all documents."""
    _prep(spark)
    return table(spark, sf_dir, "documents").select("doc_id", X.strip_reserved("text").alias("stripped"))


# -- cells ---------------------------------------------------------------------

def normalize_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitem as workbook cells, normalised as the reference
    writes them (numbers rounded half-even)."""
    _prep(spark)
    cells = SI.lineitem_as_cells(table(spark, sf_dir, "lineitem"))
    return C.normalize_cells(cells, round_numbers=True).select("file", "row", "col", "header", "value")


ORDER_SCHEMA = S.load_schema([
    {"name": "o_orderkey", "type": "INTEGER", "mode": "REQUIRED"},
    {"name": "o_custkey", "type": "INTEGER", "mode": "REQUIRED"},
    {"name": "o_orderstatus", "type": "STRING"},
    {"name": "o_totalprice", "type": "FLOAT"},
    {"name": "o_orderdate", "type": "DATE"},
])


def cells_to_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as cells, pivoted back to rows and typed."""
    _prep(spark)
    cells = C.first_sheet(SI.orders_as_cells(table(spark, sf_dir, "orders")))
    rows = C.cells_to_rows(C.normalize_cells(cells), SI.ORDER_COLUMNS)
    return rows.select(
        F.col("o_orderkey").cast("long").alias("o_orderkey"),
        F.col("o_custkey").cast("long").alias("o_custkey"),
        "o_orderstatus",
        F.col("o_totalprice").cast("double").alias("o_totalprice"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("o_orderdate"),
        "o_orderpriority",
    )


# -- windows, flags, schemas, checks --------------------------------------------

def run_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event's day as an ISO run start, its -7 h
    load window, partition stamp and whether the event falls in it."""
    _prep(spark)
    ev = table(spark, sf_dir, "events")
    start = X.parse_iso(F.date_format("ts", "yyyy-MM-dd'T'00:00:00'Z'"))
    ws, we = W.run_window(start, offset_hours=-7)
    return ev.select(
        "event_id",
        W.partition_stamp(start).alias("partition"),
        ws.alias("window_start"),
        we.alias("window_end"),
        ((F.col("ts") >= ws) & (F.col("ts") < we)).alias("in_window"),
    )


TRUTHY_SAMPLES = ("yes", "True", "t", "1", "no", "Y", "0", "false")


def truthy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event ``props.k`` mapped to flag words, parsed both ways."""
    _prep(spark)
    ev = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").try_cast("long")
    word = F.element_at(F.array(*[F.lit(w) for w in TRUTHY_SAMPLES]), (F.pmod(k, F.lit(8)) + 1).cast("int"))
    return ev.select("event_id", word.alias("word")).select("event_id", "word", X.truthy("word").alias("truthy"), X.truthy_alt("word").alias("truthy_alt"))


def cast_to_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as text with bad values, cast to the declared schema."""
    _prep(spark)
    schema, _required = ORDER_SCHEMA
    out = S.cast_to_schema(SI.orders_as_text(table(spark, sf_dir, "orders")), schema, on_error="null")
    return out.withColumn("errors", F.array_join("_errors", ",")).drop("_errors")


def check_required(spark: SparkSession, sf_dir: str) -> DataFrame:
    """REQUIRED columns of the declared schema that are NULL."""
    _prep(spark)
    schema, required = ORDER_SCHEMA
    typed = S.cast_to_schema(SI.orders_as_text(table(spark, sf_dir, "orders")), schema, on_error="null")
    out = S.check_required(typed, required)
    return out.select("o_orderkey", "o_custkey", F.array_join("_missing", ",").alias("missing"))


CUSTOMER_RULES = {
    "c_custkey": {"required": True, "type": "integer"},
    "c_name": {"required": True, "type": "string", "dependencies": ["c_custkey"]},
    "c_nationkey": {"type": ["integer", "string"], "oneof": [{"max": 10}, {"min": 5}]},
    "c_acctbal": {"type": "float", "nullable": False, "min": 0},
    "c_mktsegment": {"allowed": ["AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY"], "dependencies": {"c_nationkey": list(range(0, 20))}},
}


def check_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1-V7: customer rows against a rule set."""
    _prep(spark)
    cust = table(spark, sf_dir, "customer")
    out = V.check_records(cust, CUSTOMER_RULES)
    return out.select("c_custkey", F.array_join("violations", ";").alias("violations"))


def check_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: valid, invalid and total customer rows."""
    _prep(spark)
    return V.check_counts(V.check_records(table(spark, sf_dir, "customer"), CUSTOMER_RULES))


NO_ORACLE: tuple[str, ...] = ()


# -- loads, sinks, streams --------------------------------------------------------

from postroom.session import work_path  # noqa: E402
from postroom.sinks import deliver as D  # noqa: E402
from postroom.sinks import tables as TB  # noqa: E402
from postroom.sources import records as REC  # noqa: E402
from postroom.streaming.incremental import incremental_load as _incremental, read_sink  # noqa: E402

ORDER_FULL_SCHEMA = S.load_schema([
    {"name": "o_orderkey", "type": "INTEGER", "mode": "REQUIRED"},
    {"name": "o_custkey", "type": "INTEGER"},
    {"name": "o_orderstatus", "type": "STRING"},
    {"name": "o_totalprice", "type": "FLOAT"},
    {"name": "o_orderdate", "type": "DATETIME"},
    {"name": "o_orderpriority", "type": "STRING"},
])[0]


def read_delimited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K11, S5 (tab, one header row, null marker, quote), S7, U1: orders
    delivered as tab-separated files and loaded back against the schema."""
    _prep(spark)
    dest = work_path(spark, "orders-tsv")
    TB.write_delimited(table(spark, sf_dir, "orders"), dest, sep="\t", header=True, null_value="\\N")
    good, _bad = REC.read_records(spark, dest, "csv", ORDER_FULL_SCHEMA, field_delimiter="tab", skip_leading_rows=1,
                                  null_marker="\\N", quote_character='"')
    return good


def read_json_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders delivered as JSON lines and loaded back."""
    _prep(spark)
    dest = work_path(spark, "orders-json")
    TB.write_files(table(spark, sf_dir, "orders"), dest, "json")
    return REC.read_records(spark, dest + "/*.json", "json", ORDER_FULL_SCHEMA, array=False)


REPLACE_DAY = "19970315"


def replace_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders loaded by day of ``o_orderdate``,
    then one day replaced by its re-priced rows."""
    _prep(spark)
    dest = work_path(spark, "orders-by-day")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    TB.load_table(orders, dest, "replace", partition="o_orderdate")
    day = F.date_format("o_orderdate", "yyyyMMdd") == REPLACE_DAY
    changed = orders.where(day).withColumn("o_totalprice", F.col("o_totalprice") * 2)
    TB.load_table(changed, dest, "replace", partition=REPLACE_DAY)
    schema = S.T.StructType([*orders.schema.fields, S.T.StructField("ds", S.T.StringType())])
    return TB.read_table(spark, dest, schema).select("o_orderkey", "o_totalprice", "o_orderdate", F.col("ds").alias("partition"))


def merge_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: keyed upsert of changed and new orders into the orders table."""
    _prep(spark)
    dest = work_path(spark, "orders-merge")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    TB.load_table(orders, dest, "merge", keys=["o_orderkey"])
    k = F.col("o_orderkey")
    changed = orders.where(k % 10 == 0).withColumn("o_orderstatus", F.lit("M"))
    new = orders.where(k % 25 == 0).withColumn("o_orderkey", k + 1000000000).withColumn("o_orderstatus", F.lit("N"))
    TB.load_table(changed.unionByName(new), dest, "merge", keys=["o_orderkey"])
    return TB.read_table(spark, dest)


def fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events delivered to four channels, one of them broken."""
    _prep(spark)
    ev = table(spark, sf_dir, "events")
    base = work_path(spark, "fan-out")
    channels = [
        {"name": "parquet", "protocol": "files", "dir": f"{base}/parquet", "format": "parquet"},
        {"name": "json", "protocol": "files", "dir": f"{base}/json", "format": "json"},
        {"name": "tsv", "protocol": "delimited", "dir": f"{base}/tsv", "quote": "nonnumeric"},
        {"name": "broken", "protocol": "files", "dir": f"{base}/broken", "format": "no-such-format"},
    ]
    return D.fan_out(ev, channels).select("channel", "status", "rows")


def mark_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages delivered to two good channels, then marked
    processed; a second run with a broken channel marks nothing."""
    _prep(spark)
    msgs = events_as_messages(table(spark, sf_dir, "events")).select("message_id", "internal_ts")
    base = work_path(spark, "mark")
    state = f"{base}/processed"
    D.guard_empty(msgs, hour=0)
    ok = D.fan_out(msgs, [{"name": "a", "dir": f"{base}/a"}, {"name": "b", "dir": f"{base}/b"}])
    D.mark_processed(msgs, "events_job", "2024-01-02 00:00:00", state, ok)
    bad = D.fan_out(msgs, [{"name": "c", "dir": f"{base}/c", "format": "no-such-format"}])
    D.mark_processed(msgs, "events_job_2", "2024-01-03 00:00:00", state, bad)
    return D.processed_ids(spark, state).select("message_id", "job")


def incremental_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events arrive as files; a stream routes each new
    file's messages once; a second run finds nothing new."""
    _prep(spark)
    base = work_path(spark, "incremental")
    src, sink, ckpt = f"{base}/in", f"{base}/out", f"{base}/checkpoint"
    ev = table(spark, sf_dir, "events")
    ev.repartition(8, "event_id").write.parquet(src)
    fn = lambda df: R.route_messages(events_as_messages(df), JOBS).select("message_id", "job")
    _incremental(spark, src, ev.schema, ckpt, sink, fn, max_files_per_trigger=2)
    _incremental(spark, src, ev.schema, ckpt, sink, fn, max_files_per_trigger=2)
    return read_sink(spark, sink).select("message_id", "job")


# -- files ------------------------------------------------------------------------

from postroom.sources import files as FL  # noqa: E402


def expand_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents packed into zip archives, expanded again;
    broken archives give a row with their error."""
    _prep(spark)
    zips = SI.documents_as_archives(table(spark, sf_dir, "documents"))
    members = FL.expand_archives(zips)
    doc_id = F.nullif(F.regexp_extract("member_name", r"^doc_(\d+)\.txt$", 1), F.lit("")).cast("long")
    broken = F.when(F.col("error").isNotNull(), F.col("file_name"))
    return members.select(doc_id.alias("doc_id"), F.decode("content", "UTF-8").alias("text"), broken.alias("broken"))


from postroom.sources import workbooks as WB  # noqa: E402


def workbook_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S10, E11, A5, O2, T5 (``xlsx2csv``): orders as .xlsx workbooks, read
    to cells (first sheet), normalised and pivoted back to typed rows."""
    _prep(spark)
    books = SI.orders_as_workbooks(table(spark, sf_dir, "orders"))
    cells = WB.workbook_cells(books).where(F.col("error").isNull()).withColumnRenamed("file_name", "file")
    rows = C.cells_to_rows(C.normalize_cells(cells), SI.ORDER_COLUMNS)
    return rows.select(
        F.col("o_orderkey").cast("long").alias("o_orderkey"),
        F.col("o_custkey").cast("long").alias("o_custkey"),
        "o_orderstatus",
        F.col("o_totalprice").cast("double").alias("o_totalprice"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("o_orderdate"),
        "o_orderpriority",
    )


from postroom.operators import transforms as TR  # noqa: E402


def apply_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1, T5 ``rpt_cleaner``: text reports built from lineitem, cleaned to
    their detail lines."""
    _prep(spark)
    files = SI.lineitem_as_reports(table(spark, sf_dir, "lineitem"))
    out = TR.apply_transform(files, "rpt_cleaner", filename_format="{source_file}", stamp="20240101")
    lines = out.select("file_name", F.explode(F.split(F.decode("content", "UTF-8"), "\n")).alias("line"))
    return lines.where(F.col("line") != "")


def transform_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1, T3, T4, T5 ``unzip``: archives unzipped, members renamed by
    the job format; broken archives kept as they are and renamed too."""
    _prep(spark)
    zips = SI.documents_as_archives(table(spark, sf_dir, "documents"))
    out = TR.apply_transform(zips, "unzip", filename_format="DOC_{source_file}", stamp="20240101", on_error="keep", transform_model="unzip")
    return out.select("file_name", "status")


def load_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5d, S5e, E17: orders written as tab-separated lines where every
    101st row has an extra field, every 103rd lacks its last one and every
    107th has a bad price; loaded against the schema, every row is ``ok``
    or rejected with its reason."""
    _prep(spark)
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    head = [k.cast("string"), F.col("o_custkey").cast("string"), F.col("o_orderstatus")]
    price = F.when(k % 107 == 0, F.lit("x")).otherwise(F.col("o_totalprice").cast("string"))
    date = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    full = F.concat_ws("\t", *head, price, date, F.col("o_orderpriority"))
    line = (
        F.when(k % 101 == 0, F.concat(full, F.lit("\textra")))
        .when(k % 103 == 0, F.concat_ws("\t", *head, price, date))
        .otherwise(full)
    )
    dest = work_path(spark, "orders-rejects")
    o.select(line.alias("value")).write.text(dest)
    rows = REC.read_delimited(spark, dest, ORDER_FULL_SCHEMA, field_delimiter="tab", on_error="tag")
    key = F.coalesce(F.col("o_orderkey"), F.split("_raw", "\t").getItem(0).try_cast("long"))
    return rows.select(key.alias("o_orderkey"), F.coalesce("_reason", F.lit("ok")).alias("status"))


def discrepancy_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Discrepancy mails that cannot be parsed, with the reason."""
    _prep(spark)
    mails = SI.orders_as_discrepancy_mail(table(spark, sf_dir, "orders"))
    _records, errors = parse_discrepancies(mails, SI.RUN_DATE, id_col="message_id")
    return errors
