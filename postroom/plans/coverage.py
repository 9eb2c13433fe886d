"""Driver queries of single operators and options that the queries of
``queries.py`` do not exercise, with their SQL. Each reads whole tables.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postroom.functions import timewin as W
from postroom.operators import checks as V
from postroom.operators import html_select as H
from postroom.operators import job_index as JI
from postroom.operators import paths as P
from postroom.operators import routing as R
from postroom.operators import schema as S
from postroom.operators import transforms as TR
from postroom.plans import queries as _q
from postroom.plans import standins as SI
from postroom.plans.oracle import MESSAGES, ORDERS_ALL, _secure
from postroom.plans.standins import table
from postroom.session import apply_defaults, work_path
from postroom.streaming import incremental as INC
from postroom.sinks import deliver as D
from postroom.sinks import snapshots as SN
from postroom.sinks import tables as TB
from postroom.sources import messages as M
from postroom.sources import records as REC
from postroom.sources import reports as RP
from postroom.sources.html import html_elements

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str):
    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_defaults(spark)
            return fn(spark, sf_dir)

        run.__doc__ = fn.__doc__
        QUERIES[fn.__name__], ORACLE[fn.__name__] = run, sql
        return fn

    return add


DEEP = 12
_BUCKET = "CAST(floor({} / {}) AS BIGINT)"


def bucket(column: str, size: int):
    return F.floor(F.col(column) / size).cast("long")


# -- messages ------------------------------------------------------------------

@query(f"""
WITH m AS (SELECT CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS message_id, text FROM conversations)
SELECT message_id, CAST(d AS INTEGER) AS depth, 'multipart/mixed' AS mime_type, CAST(NULL AS VARCHAR) AS text FROM m, range({DEEP}) r(d)
UNION ALL SELECT message_id, {DEEP}, 'text/html', text FROM m
UNION ALL SELECT message_id, -1, 'body', text FROM m
""")
def flatten_deep_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each turn under twelve multiparts: all parts, and the
    body that is selected (depth -1)."""
    open_part = '{"mimeType":"multipart/mixed","filename":"","body":{"size":0},"parts":['
    leaf = F.struct(
        F.lit("text/html").alias("mimeType"), F.lit("").alias("filename"),
        F.struct(F.octet_length("text").cast("long").alias("size"), M.urlsafe_b64encode(F.encode("text", "UTF-8")).alias("data")).alias("body"),
    )
    conv = table(spark, sf_dir, "conversations")
    msgs = conv.select(
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("message_id"),
        F.concat(F.lit(open_part * (DEEP + 1)), F.to_json(leaf), F.lit("]}" * (DEEP + 1))).alias("payload"),
    )
    parts = M.flatten_parts(msgs)
    text = F.decode(M.urlsafe_b64decode("data"), "UTF-8").alias("text")
    body = M.select_body(msgs, parts).select("message_id", F.lit(-1).alias("depth"), F.lit("body").alias("mime_type"), text)
    return parts.select("message_id", "depth", "mime_type", text).unionByName(body)


@query(f"WITH {MESSAGES} SELECT message_id, sender, subject, internal_ts, has_attachment FROM messages")
def scan_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A message export written as JSON lines, scanned back."""
    dest = work_path(spark, "messages")
    SI.events_as_messages(table(spark, sf_dir, "events")).drop("event_id").write.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(dest)
    return M.scan_messages(spark, dest).select("message_id", "sender", "subject", "internal_ts", "has_attachment")


@query("SELECT count(*) AS n, CAST(0 AS BIGINT) AS n_out_of_order FROM events")
def receive_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1: messages sorted by receive time; rows before which a later one
    stands, within the sorted partitions and between them."""
    msgs = SI.events_as_messages(table(spark, sf_dir, "events")).select("message_id", "internal_ts")
    done = R.order_by_receive_time(msgs).select("internal_ts", F.spark_partition_id().alias("p"), F.monotonically_increasing_id().alias("i"))
    each = done.groupBy("p", bucket("i", 1000).alias("b")).agg(
        F.count("*").alias("n"), F.array_sort(F.collect_list(F.struct("i", "internal_ts"))).alias("rows")
    )
    ts = F.transform("rows", lambda r: r["internal_ts"])
    bad = F.when(ts != F.array_sort(ts), F.lit(1).cast("long")).otherwise(F.lit(0).cast("long"))
    return each.agg(F.sum("n").alias("n"), F.sum(bad).alias("n_out_of_order"))


@query("""
SELECT DISTINCT job, hour, CASE WHEN job = 'events' THEN 'ok' WHEN hour >= 15 THEN 'skipped' ELSE 'error' END AS status
FROM (SELECT unnest(['events', 'none']) AS job), (SELECT unnest([9, 15, 23]) AS hour), events
""")
def empty_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches with and without messages at three hours."""
    msgs = SI.events_as_messages(table(spark, sf_dir, "events"))
    out = []
    for job, df in (("events", msgs), ("none", msgs.where(F.col("subject") == "no such subject"))):
        for hour in (9, 15, 23):
            try:
                out.append((job, hour, D.guard_empty(df, hour, ignore_after=15)))
            except D.NoFilesError:
                out.append((job, hour, "error"))
    return spark.createDataFrame(out, "job string, hour int, status string")


# -- files and deliveries --------------------------------------------------------

def _orders_lines(spark: SparkSession, sf_dir: str, size: int = 4096) -> DataFrame:
    """Files of at most ``size`` order keys: two title lines, then rows."""
    o = table(spark, sf_dir, "orders").select(bucket("o_orderkey", size).alias("b"), "o_orderkey", "o_custkey", "o_orderstatus")
    line = F.concat_ws("\t", F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"), "o_orderstatus")
    per = o.groupBy("b").agg(F.array_sort(F.collect_list(line)).alias("lines"))
    text = F.concat(F.lit("REPORT\nkey\tcust\tstatus\n"), F.array_join("lines", "\n"), F.lit("\n"))
    return per.select("b", F.encode(text, "UTF-8").alias("content"))


LINE_SCHEMA = [{"name": "o_orderkey", "type": "INTEGER"}, {"name": "o_custkey", "type": "INTEGER"}, {"name": "o_orderstatus", "type": "STRING"}]


@query(f"""
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(20000000 + {_BUCKET.format("o_orderkey", 4096)} AS VARCHAR) AS partition FROM orders
""")
def load_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7, S5b (two leading rows), K13: files delivered to a table whose
    partition is in their name; only the declared columns are loaded."""
    name = F.concat(F.lit("orders_"), (F.col("b") + 20_000_000).cast("string"), F.lit(".tsv"))
    files = _orders_lines(spark, sf_dir).select(F.col("b").cast("string").alias("message_id"), name.alias("file_name"), "content")
    dest = work_path(spark, "from-files")
    channel = {"protocol": "records", "dir": dest, "schema": LINE_SCHEMA, "field_delimiter": "tab", "skip_leading_rows": 2,
               "partition": r"regex:orders_(\d{8})", "load_method": "replace"}
    status = D.fan_out(files, [channel]).first()
    if status["status"] != "ok":
        raise OSError(status["error"])
    return TB.read_table(spark, dest).withColumnRenamed("ds", "partition")


@query("SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def same_name_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message has a file of the same name; all arrive."""
    files = _orders_lines(spark, sf_dir, 1024).select(F.col("b").cast("string").alias("message_id"), F.lit("daily.tsv").alias("file_name"), "content")
    base = work_path(spark, "same-name")
    done = {r["channel"]: r for r in D.fan_out(files, [{"name": "blobs", "protocol": "blobs", "dir": f"{base}/blobs"}, {
        "name": "records", "protocol": "records", "dir": f"{base}/table", "schema": LINE_SCHEMA, "field_delimiter": "tab", "skip_leading_rows": 2}]).collect()}
    if any(r["status"] != "ok" for r in done.values()):
        raise OSError(str(done))
    blobs = REC.read_delimited(spark, f"{base}/blobs", S.load_schema(LINE_SCHEMA)[0], field_delimiter="tab", skip_leading_rows=2, on_error="fail")
    # the delivered files and the loaded table hold the same rows, each once
    return blobs.unionAll(TB.read_table(spark, f"{base}/table").select(*blobs.columns)).groupBy(*blobs.columns).agg(F.count("*").alias("n")).where("n = 2").drop("n")


@query("SELECT doc_id, nullif(text, '') AS text, lang FROM documents")
def deliver_delimited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K12, S5c, S5g: texts with line ends, tabs and quotes delivered as
    delimited text with quoted values, and read back."""
    dest = work_path(spark, "quoted")
    TB.write_delimited(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), dest, sep="\t", quote="nonnumeric")
    schema = S.load_schema([{"name": "doc_id", "type": "INTEGER"}, {"name": "text", "type": "STRING"}, {"name": "lang", "type": "STRING"}])[0]
    return REC.read_delimited(spark, dest, schema, field_delimiter="tab", skip_leading_rows=1, allow_quoted_newlines=True, quote_character='"', on_error="fail")


@query(ORDERS_ALL)
def inferred_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delimited files without a schema."""
    dest = work_path(spark, "inferred")
    TB.write_delimited(table(spark, sf_dir, "orders"), dest, sep=",")
    df = REC.read_records(spark, dest, "csv", None, skip_leading_rows=1, on_error="drop")
    return df.withColumns({"o_orderkey": F.col("o_orderkey").cast("long"), "o_custkey": F.col("o_custkey").cast("long"), "o_orderdate": F.col("o_orderdate").cast("timestamp_ntz")})


@query("""
WITH o AS (SELECT *, o_orderkey = (SELECT max(o_orderkey) FROM orders) AS last FROM orders),
p AS (SELECT *, o_orderkey % 2 = 1 AND NOT last AS other FROM o)
SELECT o_orderkey AS key, CASE WHEN NOT other THEN o_custkey END AS cust, CASE WHEN other THEN o_orderstatus END AS extra, o_totalprice AS price,
  CASE WHEN last THEN 0.5 ELSE CAST(o_orderkey % 7 AS DOUBLE) END AS mixed,
  CASE WHEN last THEN date_trunc('day', o_orderdate) + INTERVAL 1 HOUR ELSE CAST(date_trunc('day', o_orderdate) AS TIMESTAMP) END AS day,
  CASE WHEN last THEN 'A1' ELSE CAST(o_custkey AS VARCHAR) END AS code,
  'code:string key:bigint cust:bigint day:timestamp_ntz extra:string price:double mixed:double' AS types
FROM p
""")
def inferred_ragged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files whose headers differ; one row, in a file of its own, decides
    three of the types."""
    o = table(spark, sf_dir, "orders")
    most = o.agg(F.max("o_orderkey").alias("most"))
    o = o.join(F.broadcast(most), F.col("o_orderkey") == F.col("most"), "left").withColumn("last", F.col("most").isNotNull())
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    named = o.select(
        "last", F.col("o_orderkey").alias("key"), F.col("o_custkey").alias("cust"), F.col("o_orderstatus").alias("extra"), F.col("o_totalprice").alias("price"),
        F.when(F.col("last"), "0.5").otherwise((F.col("o_orderkey") % 7).cast("string")).alias("mixed"),
        F.when(F.col("last"), F.concat(day, F.lit(" 01:00:00"))).otherwise(day).alias("day"),
        F.when(F.col("last"), "A1").otherwise(F.col("o_custkey").cast("string")).alias("code"),
    )
    other = (F.col("key") % 2 == 1) & ~F.col("last")
    dest = work_path(spark, "ragged")
    few = ["key", "cust", "price", "mixed", "day", "code"]
    TB.write_delimited(named.where(~other & ~F.col("last")).select(few), f"{dest}/a", sep=",")
    TB.write_delimited(named.where(other).select("code", "day", "extra", "mixed", "price", "key"), f"{dest}/b", sep=",")
    TB.write_delimited(named.where("last").select(few), f"{dest}/z", sep=",")
    df = REC.read_records(spark, f"{dest}/*", "csv", None, skip_leading_rows=1, on_error="drop", detect=True)
    return df.withColumn("types", F.lit(" ".join(f"{f.name}:{f.dataType.simpleString()}" for f in df.schema.fields)))


@query("SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def json_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that are one JSON array each."""
    o = table(spark, sf_dir, "orders")
    per = o.groupBy(bucket("o_orderkey", 1024).alias("b")).agg(F.to_json(F.collect_list(F.struct("o_orderkey", "o_custkey", "o_orderstatus"))).alias("j"))
    files = per.select(F.concat(F.lit("a"), F.col("b").cast("string"), F.lit(".json")).alias("file_name"), F.encode("j", "UTF-8").alias("content"))
    dest = work_path(spark, "json-arrays")
    D._write_all(files, dest)
    return REC.read_records(spark, dest, "json", S.load_schema(LINE_SCHEMA)[0])


@query("""
SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 103 = 0 AND o_orderkey % 101 <> 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus FROM orders
""")
def lenient_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5d, S5e with both flags: rows with extra and missing fields load."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    two = F.concat_ws("\t", k.cast("string"), F.col("o_custkey").cast("string"))
    three = F.concat_ws("\t", two, "o_orderstatus")
    dest = work_path(spark, "lenient")
    o.select(F.when(k % 101 == 0, F.concat(three, F.lit("\textra"))).when(k % 103 == 0, two).otherwise(three).alias("value")).write.text(dest)
    return REC.read_delimited(spark, dest, S.load_schema(LINE_SCHEMA)[0], field_delimiter="tab", ignore_unknown_values=True, allow_jagged_rows=True, on_error="fail")


@query("SELECT report, line_no, line FROM (SELECT CAST(doc_id AS VARCHAR) AS report, unnest(string_split(text, chr(10))) AS line, CAST(unnest(generate_series(1, len(string_split(text, chr(10))))) AS BIGINT) AS line_no FROM documents) WHERE line <> ''")
def read_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text reports scanned as lines, one row per line, by file."""
    docs = table(spark, sf_dir, "documents")
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("i", "line")).where("line <> ''")
    dest = work_path(spark, "reports")
    lines.select(F.concat_ws("\t", F.col("doc_id").cast("string"), (F.col("i") + 1).cast("string"), "line").alias("value")).write.text(dest)
    cut = F.split("line", "\t", 3)
    return RP.read_lines(spark, dest).select(cut[0].alias("report"), cut[1].cast("long").alias("line_no"), cut[2].alias("line"))


@query("SELECT c_custkey, c_name, c_nationkey FROM customer WHERE c_nationkey < 10")
def replace_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2, K3, K9: a table appended to twice, then replaced, clustered."""
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    dest = work_path(spark, "customers")
    TB.load_table(cust, dest)
    TB.load_table(cust, dest, "append", cluster_by="c_nationkey")
    TB.load_table(cust.where("c_nationkey < 10"), dest, "replace", cluster_by="c_nationkey, c_custkey")
    return TB.read_table(spark, dest)


@query("""
SELECT o_orderkey, strftime(o_orderdate, '%Y%m') AS partition FROM orders
""")
def monthly_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K8 by a channel's ``time_partitioning_field`` and ``_type``."""
    dest = work_path(spark, "monthly")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    status = D.fan_out(orders, [{"protocol": "table", "dir": dest, "load_method": "replace", "time_partitioning_field": "o_orderdate", "time_partitioning_type": "MONTH"}]).first()
    if status["status"] != "ok":
        raise OSError(status["error"])
    return TB.read_table(spark, dest).select("o_orderkey", F.col("ds").alias("partition"))


@query(f"""
SELECT p_partkey, {_secure("CASE WHEN regexp_matches('REN_' || p_name, '[0-9]{4}') THEN 'REN_' || p_name ELSE 'REN_' || p_name || '_20240101' END || '.csv'")} AS file_name FROM part
""")
def rename_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No transform but a name format."""
    files = table(spark, sf_dir, "part").select("p_partkey", F.concat("p_name", F.lit(".csv")).alias("file_name"))
    return TR.apply_transform(files, None, stamp="20240101", filename_format="REN_{source_file}")


@query("""
SELECT o_orderkey, 'MKM_REPORT_' || strftime(o_orderdate, '%Y%m%d') || '.txt' AS file_name, strftime(o_orderdate, '%Y%m%d') AS file_date, 'ok' AS status FROM orders
""")
def remove_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5 ``mkm_remove_version``, E10: versions dropped, the date kept."""
    o = table(spark, sf_dir, "orders")
    name = F.concat(F.lit("MKM_REPORT_"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit("_"), (F.col("o_orderkey") % 10).cast("string"), F.lit(".txt"))
    return TR.apply_transform(o.select("o_orderkey", name.alias("file_name")), "mkm_remove_version")


@query(ORDERS_ALL + " WHERE floor(o_orderkey / 256) IS NOT NULL")
def load_workbooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S10, T5 ``xlsx2csv``, K13: workbooks transformed and delivered to a
    table, decimals kept."""
    books = SI.orders_as_workbooks(table(spark, sf_dir, "orders"))
    cells = TR.apply_transform(books, "xlsx2csv", filename_format="{source_file}")
    types = ("INTEGER", "INTEGER", "STRING", "FLOAT", "DATETIME", "STRING")
    dest = work_path(spark, "workbooks")
    status = D.fan_out(cells, {"protocol": "records", "dir": dest, "schema": [{"name": n, "type": t} for n, t in zip(SI.ORDER_COLUMNS, types)]}).first()
    if status["status"] != "ok":
        raise OSError(status["error"])
    return TB.read_table(spark, dest)


# -- HTML --------------------------------------------------------------------------

_TEXTS = """list_transform(regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a>', 1), lambda x:
    replace(replace(replace(replace(x, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&'))"""


@query(f"""
WITH t AS (SELECT page_id, {_TEXTS} AS texts FROM pages)
SELECT page_id, CAST(len(list_filter(texts, lambda x: contains(x, 'a'))) AS BIGINT) AS n_with, CAST(len(texts) AS BIGINT) AS n_all FROM t
""")
def path_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links by ``contains(text(), ...)``, and all of them."""
    pages = table(spark, sf_dir, "pages").select("page_id", "html")
    count = lambda path: H.html_matches(pages, path, "page_id")
    some = count("//li/a[contains(text(),'a')]").select("page_id", F.size("matches").cast("long").alias("n_with"))
    every = H.select_elements(html_elements(pages, "page_id"), "//li/a").groupBy("page_id").agg(F.count("*").alias("n_all"))
    return some.join(every, "page_id", "left").withColumn("n_all", F.coalesce("n_all", F.lit(0).cast("long")))


@query(f"""
SELECT CAST(doc_id AS VARCHAR) AS message_id, CAST(doc_id AS VARCHAR) || '_' || i || '.zip' AS file_name,
  CASE WHEN doc_id % 3 <> 0 THEN 'pw' || CAST(doc_id AS VARCHAR) END AS zip_password
FROM documents, (SELECT unnest(['a', 'b']) AS i)
""")
def archive_passwords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X4, X5, J5, ``text()=``: each message's last bold text is the password
    of that message's files; a message without one has none."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("message_id"), "doc_id")
    html = F.concat(F.lit("<div><p>Dear user,<b> first </b></p><p>"), F.when(F.col("doc_id") % 3 == 0, "none").otherwise(F.concat(F.lit("<i>key</i><em>"), F.lit("pw"), "message_id", F.lit("</em>"))), F.lit("</p></div>"))
    passwords = H.extract_last(docs.select("message_id", html.alias("html")), "//p/em", "text()", id_col="message_id")
    files = docs.select("message_id", F.explode(F.array(F.lit("a"), F.lit("b"))).alias("i")).select("message_id", F.concat_ws("", "message_id", F.lit("_"), "i", F.lit(".zip")).alias("file_name"))
    return H.attach_password(files, passwords)


@query("""
SELECT 'mail-' || CAST(o_orderkey AS VARCHAR) AS file_name,
  CASE WHEN o_orderkey % 3 = 1 THEN CAST(o_orderkey AS VARCHAR) END AS transaction_id,
  CASE o_orderkey % 3 WHEN 0 THEN 'no paragraph' WHEN 2 THEN 'no NOT FOUND paragraph' END AS error
FROM orders
""")
def email_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X7, T5 ``parse_email_body``: every body gives records or its error,
    also one without any paragraph."""
    k = F.col("o_orderkey")
    found = F.concat(F.lit("<p>Transaction in BQ NOT FOUND : "), k.cast("string"), F.lit("</p>"))
    body = F.when(k % 3 == 0, F.lit("<ul><li>nothing</li></ul>")).otherwise(F.concat(
        F.lit("<div><p>x with result: y</p>"), F.when(k % 3 == 1, found).otherwise(F.lit("<p>all is well</p>")), F.lit("</div>")))
    files = table(spark, sf_dir, "orders").select(F.concat(F.lit("mail-"), k.cast("string")).alias("file_name"), F.encode(body, "UTF-8").alias("content"))
    return TR.apply_transform(files, "parse_email_body", run_date="2024-01-02").select("file_name", "transaction_id", "error")


# -- cells and checks -----------------------------------------------------------------

@query("""
SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS ship_date FROM lineitem
""")
def serial_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spreadsheet serials to dates."""
    li = table(spark, sf_dir, "lineitem")
    serial = F.date_diff(F.to_date("l_shipdate"), F.lit("1899-12-30").cast("date")) + 0.75
    return li.select("l_orderkey", "l_linenumber", W.serial_to_date(serial).alias("ship_date"))


STRICT_RULES = {
    "c_custkey": {"required": True, "type": "integer"},
    "c_name": {"required": True, "type": "string"},
    "c_phone": {"type": "string"},
    "c_acctbal": {"nullable": False, "type": ["float", "integer"]},
    "c_address": {"schema": {"nation": {"required": True, "max": 20}, "tags": {"schema": {"items": {"allowed": ["a", "b"]}}}}},
    "name": {"match_filename": True},
}


@query("""
WITH c AS (
  SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_name END AS c_name, CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal,
    c_nationkey, 'cust' || CAST(c_custkey % 5 AS VARCHAR) AS name FROM customer
)
SELECT c_custkey, concat_ws(';',
  CASE WHEN c_name IS NULL THEN 'c_name: required' END, 'c_phone: type', CASE WHEN c_acctbal IS NULL THEN 'c_acctbal: nullable' END,
  CASE WHEN c_nationkey > 20 THEN 'c_address: nation: max' END, CASE WHEN c_custkey % 13 = 0 THEN 'c_address: tags: items' END,
  CASE WHEN c_custkey % 5 <> 3 THEN 'name: match_filename' END, CASE WHEN c_custkey % 2 = 0 THEN 'extra: unknown field' END
) AS violations FROM c
""")
def strict_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1, V2 (a number is no string), V4, V7, V8, and rules for the keys of
    a struct and the items of a list, all of which fire."""
    k = F.col("c_custkey")
    tags = F.when(k % 13 == 0, F.array(F.lit("a"), F.lit("z"))).otherwise(F.array(F.lit("a")))
    cust = table(spark, sf_dir, "customer").select(
        "c_custkey", F.when(k % 7 != 0, F.col("c_name")).alias("c_name"), F.col("c_nationkey").alias("c_phone"),
        F.when(k % 11 != 0, F.col("c_acctbal")).alias("c_acctbal"),
        F.struct(F.col("c_nationkey").alias("nation"), tags.alias("tags")).alias("c_address"),
        F.concat(F.lit("cust"), (k % 5).cast("string")).alias("name"), F.when(k % 2 == 0, F.lit("x")).alias("extra"),
        F.lit("/in/cust3.yaml").alias("_file"),
    )
    return V.check_records(cust, STRICT_RULES, file_col="_file").select("c_custkey", F.array_join("violations", ";").alias("violations"))


# -- a whole job ------------------------------------------------------------------------

@query(f"""
WITH {MESSAGES}, links AS (
  SELECT page_id, unnest(m) AS href, CAST(unnest(generate_series(1, len(m))) - 1 AS INTEGER) AS pos
  FROM (SELECT page_id, regexp_extract_all(html, '<li><a href="([^"]*)"', 1) AS m FROM pages))
SELECT m.message_id, k.pos, k.href, CAST(1 AS BIGINT) AS n_processed, 'skipped' AS second_run
FROM messages m JOIN links k ON k.page_id = m.event_id % (SELECT count(*) FROM pages)
WHERE list_contains(label_ids, 'error') AND internal_ts >= TIMESTAMP '2024-01-01' AND internal_ts < TIMESTAMP '2024-01-06'
""")
def run_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entry A of SURVEY 3: error mails with page bodies, their links
    delivered once and marked; a second run has nothing to do."""
    import datetime as dt

    from postroom.plans.job import run_job as run

    pages = table(spark, sf_dir, "pages")
    n = pages.count()
    body = F.struct(F.octet_length("html").cast("long").alias("size"), M.urlsafe_b64encode(F.encode("html", "UTF-8")).alias("data"))
    html = pages.select("page_id", F.to_json(F.struct(F.lit("text/html").alias("mimeType"), F.lit("").alias("filename"), body.alias("body"))).alias("payload"))
    events = SI.events_as_messages(table(spark, sf_dir, "events")).withColumn("page_id", F.pmod("event_id", F.lit(n)))
    msgs = events.join(html, "page_id").drop("page_id", "event_id")
    base = work_path(spark, "job")
    job = {"name": "error_digest", "mail_filter": {"label": "error"}, "file_to_extract": {"source": "url_in_body", "url_xpath": "//li/a"},
           "load_destination": {"name": "links", "dir": f"{base}/links"}}
    first, end = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 6)
    run(job, msgs, None, f"{base}/state", first, end, hour=1)
    again, _ = run(job, msgs, None, f"{base}/state", first, end, hour=23)
    second = again.first()["status"]
    done = D.processed_ids(spark, f"{base}/state").groupBy("message_id").agg(F.count("*").alias("n_processed"))
    links = spark.read.parquet(f"{base}/links").where("kind = 'link'").select("message_id", "pos", "href")
    return links.join(done, "message_id").withColumn("second_run", F.lit(second))


# -- records over blocks -----------------------------------------------------------------

def _in_splits(spark: SparkSession, size: int, read) -> DataFrame:
    """What ``read`` gives when files are split every ``size`` bytes, with
    the task that gave each row."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    dest = work_path(spark, "in-splits")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    try:
        read().withColumn("task", F.spark_partition_id()).write.parquet(dest)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    return spark.read.parquet(dest)


def _spread(df: DataFrame) -> DataFrame:
    """Whether more than one task gave the rows, beside each of them."""
    tasks = df.agg((F.count_distinct("task") > 1).alias("spread"))
    return df.drop("task").join(F.broadcast(tasks))


_ODD_TEXT = """CASE doc_id % 4 WHEN 1 THEN '' WHEN 2 THEN NULL WHEN 3 THEN 'say "' || text || '"' || chr(9) || 'back \\ slash' ELSE text END"""


def _odd_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id") % 4
    odd = F.when(k == 1, "").when(k == 3, F.concat(F.lit('say "'), "text", F.lit('"\tback \\ slash'))).when(k == 0, F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", odd.alias("text"), "lang")


TEXT_SCHEMA = [{"name": "doc_id", "type": "INTEGER"}, {"name": "text", "type": "STRING"}, {"name": "lang", "type": "STRING"}]


@query(f"SELECT doc_id, {_ODD_TEXT} AS text, lang FROM documents")
def quoted_tsv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with quotes, tabs, backslashes and line ends, nulls and
    empty texts, written and read back."""
    dest = work_path(spark, "quoted-tsv")
    TB.write_delimited(_odd_texts(spark, sf_dir), dest, null_value="\\N")
    return REC.read_delimited(spark, dest, S.load_schema(TEXT_SCHEMA)[0], field_delimiter="tab", skip_leading_rows=1, allow_quoted_newlines=True,
                              quote_character='"', null_marker="\\N", on_error="fail")


#: Bytes of text that one task writes as one file, and the most splits in which
#: all files are read (below that many, splits have ``SPLIT_BYTES``).
FILE_BYTES, SPLIT_BYTES, MOST_SPLITS = 64 << 20, 1 << 17, 4096


def _file_of_rows(df: DataFrame) -> tuple[DataFrame, int]:
    """The rows dealt to as many tasks as files of ``FILE_BYTES`` take (one
    for a small table), and the size of the splits to read them in."""
    size = df.agg(F.sum(F.lit(16) + sum(F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in df.columns))).first()[0] or 0
    return df.repartition(-(-size // FILE_BYTES) or 1), max(SPLIT_BYTES, size // MOST_SPLITS)


@query(f"SELECT doc_id, {_ODD_TEXT} AS text, lang, true AS spread FROM documents")
def split_quoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of quoted values with line ends (one file, if the table is
    small), each read by many tasks."""
    dest = work_path(spark, "one-file")
    rows, size = _file_of_rows(_odd_texts(spark, sf_dir))
    TB.write_delimited(rows, dest, null_value="\\N")
    load = lambda: REC.read_delimited(spark, dest, S.load_schema(TEXT_SCHEMA)[0], field_delimiter="tab", skip_leading_rows=1, allow_quoted_newlines=True,
                                      quote_character='"', null_marker="\\N", on_error="fail")
    return _spread(_in_splits(spark, size, load))


def _as_arrays(objects: DataFrame) -> DataFrame:
    """Lines that make each task's JSON objects one array; no rows, no array."""

    def run(batches):
        sign = "["
        for batch in batches:
            signed = []
            for value in batch.columns[0].to_pylist():
                signed.append(sign + value)
                sign = ","
            yield pa.RecordBatch.from_pydict({"value": signed})
        if sign == ",":
            yield pa.RecordBatch.from_pydict({"value": ["]"]})

    return objects.mapInArrow(run, "value string")


@query("SELECT doc_id, text, lang, true AS spread FROM documents")
def split_json_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that are one JSON array each (one file, if the table is
    small), each read by many tasks."""
    rows, size = _file_of_rows(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    dest = work_path(spark, "one-array")
    _as_arrays(rows.select(F.to_json(F.struct("doc_id", "text", "lang")).alias("value"))).write.text(dest)
    return _spread(_in_splits(spark, size, lambda: REC.read_json_records(spark, dest, S.load_schema(TEXT_SCHEMA)[0])))


@query("SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def long_title_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two leading rows, the first longer than the blocks that the file
    is read in."""
    o = table(spark, sf_dir, "orders")
    line = F.concat_ws("\t", F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"), "o_orderstatus")
    title = spark.range(1).select(F.concat(F.repeat(F.lit("title "), 20_000), F.lit("\nkey\tcust\tstatus")).alias("value"))
    dest = work_path(spark, "long-title")
    title.unionAll(o.select(line.alias("value"))).coalesce(1).write.text(dest)
    load = lambda: REC.read_delimited(spark, dest, S.load_schema(LINE_SCHEMA)[0], field_delimiter="tab", skip_leading_rows=2, on_error="fail")
    return _in_splits(spark, 1 << 15, load).drop("task")


# -- names and snapshots -------------------------------------------------------------------

#: Small files that one task reads.
TASK_FILES = 2048


@query("""
SELECT 'in/' || CASE p_partkey % 5 WHEN 0 THEN 'esc_' || p_partkey || '.txt' WHEN 1 THEN 'dir_' || p_partkey || '.txt' WHEN 2 THEN 'back_' || p_partkey || '.txt'
  ELSE 'same_' || p_partkey || '.txt' END AS path, p_name AS text FROM part WHERE p_partkey % 5 <> 4
UNION ALL SELECT NULL, CAST(count(*) AS VARCHAR) FROM part WHERE p_partkey % 5 = 4
""")
def hostile_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: file names with paths in them, equal and missing ones; all that is
    below the folder's parent, and the number of errors."""
    k = F.col("p_partkey")
    end = F.concat(k.cast("string"), F.lit(".txt"))
    name = F.when(k % 5 == 0, F.concat(F.lit("../esc_"), end)).when(k % 5 == 1, F.concat(F.lit("/a/sub/dir_"), end))
    name = name.when(k % 5 == 2, F.concat(F.lit("c:\\x\\back_"), end)).when(k % 5 == 3, "same.txt").when(k % 10 == 4, "..")
    part = SI.dealt(table(spark, sf_dir, "part").select("p_partkey", "p_name"))
    files = part.select(k.cast("string").alias("message_id"), name.alias("file_name"), F.encode("p_name", "UTF-8").alias("content"))
    base = work_path(spark, "hostile")
    n, errors = TB.write_blobs(files, f"{base}/in").agg(F.count("*"), F.count_if(F.col("error").isNotNull())).first()
    # Spark takes a file for 4 MB at least, so 32 small ones would be a task
    held = spark.read.option("recursiveFileLookup", "true").format("binaryFile").load(base).coalesce(-(-n // TASK_FILES) or 1)
    found = held.select(F.regexp_extract("path", "hostile-[0-9a-f]+/(.*)$", 1).alias("path"), F.decode("content", "UTF-8").alias("text"))
    return found.unionAll(spark.range(1).select(F.lit(None).cast("string"), F.lit(str(errors))))


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE o_custkey END AS o_custkey, CASE WHEN o_orderkey % 10 = 0 THEN 'M' ELSE o_orderstatus END AS o_orderstatus FROM orders
""")
def merge_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: keys of two fields, one of which may be null; rows merged twice
    stay one."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 50 != 0, F.col("o_custkey")).alias("o_custkey"), "o_orderstatus")
    dest, keys = work_path(spark, "null-keys"), ["o_custkey", "o_orderkey"]
    TB.load_table(orders, dest, "merge", keys=keys)
    for _ in range(2):
        TB.load_table(orders.where("o_orderkey % 10 = 0").withColumn("o_orderstatus", F.lit("M")), dest, "merge", keys=keys)
    return TB.read_table(spark, dest)


@query("""
WITH m AS (SELECT min(o_orderkey) AS a, max(o_orderkey) - min(o_orderkey) AS w FROM orders)
SELECT o_orderkey, CASE WHEN o_orderkey BETWEEN a + w // 2 AND a + w // 2 + w // 100 THEN 'M' ELSE o_orderstatus END AS o_orderstatus, true AS few FROM orders, m
""")
def merge_touches_few(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: a merge of a hundredth of the keys; whether the manifest shows
    that it wrote under a twentieth of the bytes."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    m = orders.agg(F.min("o_orderkey").alias("a"), F.max("o_orderkey").alias("b"), F.count("*").alias("n")).first()
    dest, w = work_path(spark, "clustered-merge"), m["b"] - m["a"]
    size = -(-m["n"] // 100)
    TB.load_table(orders, dest, "merge", keys=["o_orderkey"], file_rows=size)
    low = m["a"] + w // 2
    some = orders.where(F.col("o_orderkey").between(low, low + w // 100)).withColumn("o_orderstatus", F.lit("M"))
    TB.load_table(some, dest, "merge", keys=["o_orderkey"], file_rows=size)
    before, after = SN.manifest(spark, dest, 1), SN.manifest(spark, dest, 2)
    new = after.join(before.select("path"), "path", "left_anti").agg(F.sum("bytes").alias("new"))
    few = new.join(after.agg(F.sum("bytes").alias("all"))).select((20 * F.col("new") < F.col("all")).alias("few"))
    return TB.read_table(spark, dest).join(F.broadcast(few))


@query(f"""
WITH o AS (SELECT o_orderkey, o_totalprice, strftime(o_orderdate, '%Y%m%d') AS partition FROM orders)
SELECT CAST(1 AS INTEGER) AS version, *, true AS few_files FROM o
UNION ALL SELECT 2, o_orderkey, CASE WHEN partition = '{_q.REPLACE_DAY}' THEN o_totalprice * 2 ELSE o_totalprice END, partition, true FROM o
""")
def snapshot_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4, K8: both snapshots of a table by day, before and after one day was
    replaced; days share files."""
    dest = work_path(spark, "history")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    TB.load_table(orders, dest, "replace", partition="o_orderdate")
    changed = orders.where(F.date_format("o_orderdate", "yyyyMMdd") == _q.REPLACE_DAY).withColumn("o_totalprice", F.col("o_totalprice") * 2)
    TB.load_table(changed, dest, "replace", partition=_q.REPLACE_DAY)
    few = SN.manifest(spark, dest).count() < 100
    each = [TB.read_table(spark, dest, version=v).select(F.lit(v).alias("version"), "o_orderkey", "o_totalprice", F.col("ds").alias("partition")) for v in (1, 2)]
    return each[0].unionAll(each[1]).withColumn("few_files", F.lit(few))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, true AS few FROM lineitem WHERE l_suppkey = 3")
def clustered_skipping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K9: clustered on two fields; a filter on the second reads under a
    quarter of the files."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    dest, ranges = work_path(spark, "clustered"), {"l_suppkey": (3, 3)}
    TB.load_table(rows, dest, "append", cluster_by="l_partkey, l_suppkey", file_rows=-(-rows.count() // 256))
    files = SN.manifest(spark, dest)
    few = 4 * SN.overlapping(files, ranges).count() < files.count()
    return TB.read_table(spark, dest, ranges=ranges).where("l_suppkey = 3").withColumn("few", F.lit(few))


# -- deep mails, attachment jobs, nested rules ------------------------------------------------

DEEPEST = 200


@query(f"""
WITH m AS (SELECT CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS message_id, text, conv_id, turn FROM conversations),
d AS (SELECT message_id, text FROM m WHERE conv_id = (SELECT min(conv_id) FROM m) AND turn = (SELECT min(turn) FROM m))
SELECT message_id, 0 AS depth, 'text/html' AS mime_type, text FROM m WHERE message_id NOT IN (SELECT message_id FROM d)
UNION ALL SELECT message_id, CAST(r.i AS INTEGER), 'multipart/mixed', NULL FROM d, range({DEEPEST}) r(i)
UNION ALL SELECT message_id, {DEEPEST}, 'text/html', text FROM d
""")
def deep_mail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One mail 200 parts deep among flat ones."""
    conv = table(spark, sf_dir, "conversations")
    least = conv.agg(F.min("conv_id").alias("c"), F.min("turn").alias("t")).first()
    leaf = F.to_json(F.struct(
        F.lit("text/html").alias("mimeType"), F.lit("").alias("filename"),
        F.struct(F.octet_length("text").cast("long").alias("size"), M.urlsafe_b64encode(F.encode("text", "UTF-8")).alias("data")).alias("body"),
    ))
    deep = (F.col("conv_id") == least["c"]) & (F.col("turn") == least["t"])
    open_part = '{"mimeType":"multipart/mixed","filename":"","body":{"size":0},"parts":['
    n = F.when(deep, DEEPEST + 1).otherwise(1)
    payload = F.concat(F.repeat(F.lit(open_part), n), leaf, F.repeat(F.lit("]}"), n))
    msgs = conv.select(F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("message_id"), payload.alias("payload"))
    return M.flatten_parts(msgs).select("message_id", "depth", "mime_type", F.decode(M.urlsafe_b64decode("data"), "UTF-8").alias("text"))


@query("SELECT o_orderkey, o_custkey, o_orderstatus, CAST(1 AS BIGINT) AS n_files FROM orders")
def run_attachments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J3 in a whole job (entry A of SURVEY 3): attachments that match the
    job's pattern, renamed and delivered as files and into a table; others
    are left."""
    import datetime as dt

    from postroom.plans.job import run_job as run

    files = _orders_lines(spark, sf_dir, 1024)
    part = lambda name, content: F.struct(name.alias("filename"), F.lit("text/tab-separated-values").alias("mimeType"), F.struct(F.octet_length(content).cast("long").alias("size"), M.urlsafe_b64encode(content).alias("data")).alias("body"))
    parts = F.array(part(F.concat(F.lit("orders_"), F.col("b").cast("string"), F.lit(".tsv")), F.col("content")), part(F.lit("note.txt"), F.encode(F.lit("no rows"), "UTF-8")))
    msgs = files.select(
        F.col("b").cast("string").alias("message_id"), F.lit("2024-01-01 10:00:00").cast("timestamp_ntz").alias("internal_ts"), F.lit("x@y.example").alias("sender"),
        F.lit("z@y.example").alias("recipient"), F.lit("Orders").alias("subject"), F.array(F.lit("in")).alias("label_ids"), F.lit(True).alias("has_attachment"),
        F.to_json(F.struct(F.lit("multipart/mixed").alias("mimeType"), F.lit("").alias("filename"), F.struct(F.lit(0).alias("size")).alias("body"), parts.alias("parts"))).alias("payload"),
    )
    base = work_path(spark, "attachments")
    job = {"name": "orders", "mail_filter": {"subject": "orders"}, "file_to_extract": {"source": "attachment", "file_pattern": "orders_*.tsv"}, "transform": {"filename_format": "{source_file}"},
           "load_destination": [{"name": "files", "protocol": "blobs", "dir": f"{base}/files"}, {
               "name": "table", "protocol": "records", "dir": f"{base}/table", "schema": LINE_SCHEMA, "field_delimiter": "tab", "skip_leading_rows": 2}]}
    statuses, _ = run(job, msgs, None, f"{base}/state", dt.datetime(2024, 1, 1), hour=1)
    bad = statuses.where("status <> 'ok'").limit(1).collect()
    if bad:
        raise OSError(str(bad[0]))
    held = REC.read_delimited(spark, f"{base}/files", S.load_schema(LINE_SCHEMA)[0], field_delimiter="tab", skip_leading_rows=2, on_error="fail")
    n = held.groupBy("o_orderkey").agg(F.count("*").alias("n_files"))
    return TB.read_table(spark, f"{base}/table").join(n, "o_orderkey")


DESTINATION = {
    "protocol": {"required": True, "allowed": ["store", "table", "host"]},
    "bucket": {"type": "string", "dependencies": {"protocol": ["store"]}},
    "table_id": {"type": "string", "dependencies": {"protocol": ["table"]}},
    "skip": {"type": "integer", "dependencies": "table_id"},
}
NESTED_RULES = {"c_custkey": {"type": "integer"}, "dest": {"schema": DESTINATION}, "dests": {"schema": {"items": {"schema": DESTINATION}}}}


@query("""
WITH d AS (SELECT c_custkey AS k, ['store', 'table', 'host', 'ftp', NULL][c_custkey % 5 + 1] AS protocol, CASE WHEN c_custkey % 3 = 0 THEN 'b' END AS bucket,
  CASE WHEN c_custkey % 2 = 0 THEN 't' END AS table_id, CASE WHEN c_custkey % 7 < 2 THEN 1 END AS skip, CASE WHEN c_custkey % 11 = 0 THEN 'x' END AS other FROM customer),
v AS (SELECT k, [CASE WHEN protocol IS NULL THEN 'protocol: required' END, CASE WHEN protocol = 'ftp' THEN 'protocol: allowed' END,
  CASE WHEN bucket IS NOT NULL AND coalesce(protocol, '') <> 'store' THEN 'bucket: dependencies' END,
  CASE WHEN table_id IS NOT NULL AND coalesce(protocol, '') <> 'table' THEN 'table_id: dependencies' END,
  CASE WHEN skip IS NOT NULL AND table_id IS NULL THEN 'skip: dependencies' END, CASE WHEN other IS NOT NULL THEN 'other: unknown field' END] AS found FROM d)
SELECT k AS c_custkey, array_to_string(list_transform(list_filter(found, lambda x: x IS NOT NULL), lambda x: 'dest: ' || x), ';')
  || CASE WHEN len(list_filter(found, lambda x: x IS NOT NULL)) > 0 THEN ';dests: items' ELSE '' END AS violations FROM v
""")
def nested_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V5, V7: siblings that a key depends on, and unknown keys, in a dict
    and in the dicts of a list."""
    k = F.col("c_custkey")
    protocol = F.get(F.array(F.lit("store"), F.lit("table"), F.lit("host"), F.lit("ftp"), F.lit(None)), (k % 5).cast("int"))
    dest = F.struct(
        protocol.alias("protocol"), F.when(k % 3 == 0, "b").alias("bucket"), F.when(k % 2 == 0, "t").alias("table_id"),
        F.when(k % 7 < 2, 1).alias("skip"), F.when(k % 11 == 0, "x").alias("other"),
    )
    fine = F.struct(F.lit("store").alias("protocol"), F.lit("b").alias("bucket"), F.lit(None).cast("string").alias("table_id"), F.lit(None).cast("int").alias("skip"), F.lit(None).cast("string").alias("other"))
    cust = table(spark, sf_dir, "customer").select("c_custkey", dest.alias("dest"), F.array(fine, dest).alias("dests"))
    return V.check_records(cust, NESTED_RULES).select("c_custkey", F.array_join("violations", ";").alias("violations"))


# -- late mail -----------------------------------------------------------------

LATENESS_DAYS = 10


@query(f"""
WITH e AS (SELECT event_id, ts, event_id % 10 = 0 AS held_back, ts - min(ts) OVER () AS t, max(ts) OVER () - min(ts) OVER () AS span FROM events),
r AS (
  SELECT 1 AS run, * FROM e WHERE NOT held_back AND t * 2 < span
  UNION ALL SELECT 2, * FROM e WHERE NOT held_back AND t * 4 >= span AND t * 4 < span * 3
  UNION ALL SELECT 3, * FROM e WHERE held_back OR t * 4 >= span),
mark AS (SELECT run, max(max(epoch_ms(ts))) OVER (ORDER BY run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {LATENESS_DAYS} * 86400000 AS ms FROM r GROUP BY run),
j AS (SELECT r.*, coalesce(epoch_us(ts) <= ms * 1000, false) AS late FROM r JOIN mark USING (run)),
n AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY run) AS seen FROM j WHERE NOT late)
SELECT CAST(event_id AS VARCHAR) AS message_id, run, (SELECT count(*) FROM n WHERE seen > 1) AS n_repeated, (SELECT count(*) FROM j WHERE late) AS n_late
FROM n WHERE seen = 1
""")
def late_mail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exports of overlapping windows arrive one after the other, the
    last with mail held back; each run goes on from the checkpoint. Every
    message is taken once, those later than the watermark are counted."""
    ev = table(spark, sf_dir, "events")
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    lo, hi = ev.agg(F.min(at), F.max(at)).first()
    timed = ev.withColumn("t", at - F.lit(lo)).withColumn("span", F.lit(hi) - F.lit(lo))
    held_back = F.col("event_id") % 10 == 0
    exports = [
        ~held_back & (F.col("t") * 2 < F.col("span")),
        ~held_back & (F.col("t") * 4 >= F.col("span")) & (F.col("t") * 4 < F.col("span") * 3),
        held_back | (F.col("t") * 4 >= F.col("span")),
    ]
    base = work_path(spark, "late-mail")
    src, sink, ckpt = f"{base}/in", f"{base}/out", f"{base}/checkpoint"
    msgs = SI.events_as_messages(timed.where("false").select(ev.columns)).select("message_id", "internal_ts")
    done = []
    for run, export in enumerate(exports, 1):
        SI.events_as_messages(timed.where(export).select(ev.columns)).select("message_id", "internal_ts").write.mode("append").parquet(src)
        mark = lambda df, run=run: df.select("message_id", F.lit(run).alias("run"))
        done.append(INC.load_once(spark, src, msgs.schema, ckpt, sink, ["message_id"], "internal_ts", f"{LATENESS_DAYS} days", mark))
    total = lambda f: F.lit(sum(getattr(d, f) for d in done)).cast("long")
    return INC.read_sink(spark, sink).select("message_id", "run", total("repeated").alias("n_repeated"), total("late").alias("n_late"))


# -- paths of any depth --------------------------------------------------------

#: Documents' bodies by doc_id % 3: (tag, children...); the text of a is the id.
TREES = (
    ("body", ("table", ("tr", ("td", ("a",), ("b", ("a",))), ("td", ("a",)))), ("a",), ("div", ("p", ("b",)), ("span", ("b",)))),
    ("body", ("div", ("div", ("span", ("a",), ("a",), ("b",), ("a",)), ("p", ("i", ("b",)), ("b",))), ("a",), ("a",))),
    ("body", ("span", ("table", ("tr", ("td", ("table", ("tr", ("td", ("a",))))))), ("a",)), ("p", ("b",), ("b",)), ("div", ("p",), ("p", ("b",), ("b",)))),
)


def _markup(tree: tuple) -> list[str]:
    """A tree's HTML, cut where the text of an a stands."""
    tag, *children = tree
    if tag == "a":
        return ['<a href="/x">', "</a>"]
    parts = [f"<{tag}>"]
    for child in children:
        head, *rest = _markup(child)
        parts[-1] += head
        parts += rest
    parts[-1] += f"</{tag}>"
    return parts


def _intervals(tree: tuple, kind: int, rows: list, parent: int = -1, depth: int = 0) -> int:
    """Appends (kind, ord, last, depth, parent, tag) of every element; last is
    the greatest ord below it."""
    at = len([r for r in rows if r[0] == kind])
    rows.append([kind, at, at, depth, parent, tree[0]])
    row = rows[-1]
    for child in tree[1:]:
        row[2] = _intervals(child, kind, rows, at, depth + 1)
    return row[2]


def _interval_sql() -> str:
    rows: list = []
    for kind, tree in enumerate(TREES):
        _intervals(tree, kind, rows)
    return ", ".join(f"({k}, {o}, {e}, {d}, {p}, '{t}')" for k, o, e, d, p, t in rows)


PATHS = ("//table//a", "//div/p/b", "/body/*//a[2]", "//tr//b/a", "//table//table//a", "//span/a[contains(text(),'7')]")


@query(f"""
WITH e(kind, ord, last, depth, parent, tag) AS (VALUES {_interval_sql()}),
x AS (SELECT *, row_number() OVER (PARTITION BY kind, parent, tag ORDER BY ord) AS place FROM e),
m AS (
  SELECT DISTINCT '//table//a' AS path, a.kind, a.ord FROM x t JOIN x a ON t.kind = a.kind AND a.ord > t.ord AND a.ord <= t.last WHERE t.tag = 'table' AND a.tag = 'a'
  UNION ALL SELECT DISTINCT '//div/p/b', b.kind, b.ord FROM x d JOIN x p ON d.kind = p.kind AND p.parent = d.ord JOIN x b ON p.kind = b.kind AND b.parent = p.ord WHERE d.tag = 'div' AND p.tag = 'p' AND b.tag = 'b'
  UNION ALL SELECT DISTINCT '/body/*//a[2]', a.kind, a.ord FROM x r JOIN x c ON r.kind = c.kind AND c.parent = r.ord JOIN x a ON c.kind = a.kind AND a.ord > c.ord AND a.ord <= c.last WHERE r.depth = 0 AND r.tag = 'body' AND a.tag = 'a' AND a.place = 2
  UNION ALL SELECT DISTINCT '//tr//b/a', a.kind, a.ord FROM x t JOIN x b ON t.kind = b.kind AND b.ord > t.ord AND b.ord <= t.last JOIN x a ON a.kind = b.kind AND a.parent = b.ord WHERE t.tag = 'tr' AND b.tag = 'b' AND a.tag = 'a'
  UNION ALL SELECT DISTINCT '//table//table//a', a.kind, a.ord FROM x s JOIN x t ON s.kind = t.kind AND t.ord > s.ord AND t.ord <= s.last JOIN x a ON t.kind = a.kind AND a.ord > t.ord AND a.ord <= t.last WHERE s.tag = 'table' AND t.tag = 'table' AND a.tag = 'a'
  UNION ALL SELECT '//span/a', a.kind, a.ord FROM x s JOIN x a ON s.kind = a.kind AND a.parent = s.ord WHERE s.tag = 'span' AND a.tag = 'a')
SELECT doc_id, CASE path WHEN '//span/a' THEN '{PATHS[-1].replace("'", "''")}' ELSE path END AS path, CAST(ord AS INTEGER) AS ord
FROM documents JOIN m ON kind = doc_id % {len(TREES)} WHERE path <> '//span/a' OR contains(CAST(doc_id AS VARCHAR), '7')
""")
def deep_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths of several steps over bodies built from the ids; the SQL
    joins intervals of elements."""
    docs = SI.dealt(table(spark, sf_dir, "documents").select("doc_id"))
    body = F.when(F.lit(False), "")
    for kind, tree in enumerate(TREES):
        head, *rest = _markup(tree)
        text = F.concat(F.lit(head), *[x for part in rest for x in (F.col("doc_id").cast("string"), F.lit(part))])
        body = body.when(F.col("doc_id") % len(TREES) == kind, text)
    return P.paths_matches(docs.withColumn("html", body), PATHS).select("doc_id", "path", F.explode("matches.ord").alias("ord"))


# -- many jobs -----------------------------------------------------------------

MANY_JOBS = 2000
_HOUR, _START = 3600, 1704067200
_KINDS = ("click", "view", "error", "purchase")


def _many_jobs() -> list[dict]:
    """Jobs of four kinds in turn: a sender; a label within hours; a window
    alone; a subject, with attachment, until a time."""
    out = []
    for i in range(MANY_JOBS):
        job, kind = {"job": f"j{i}"}, _KINDS[i // 4 % 4]
        if i % 4 == 0:
            job |= {"from": f"User{i // 4}@"}
        elif i % 4 == 1:
            job |= {"label": kind, "after": _START + i * _HOUR // 4, "before": _START + i * _HOUR // 4 + 7 * _HOUR}
        elif i % 4 == 2:
            job |= {"after": _START + i * _HOUR // 4 + 17, "before": _START + i * _HOUR // 4 + _HOUR // 2}
        else:
            job |= {"subject": f"*{kind}*", "from": f"{i // 4}@pay", "attachment": "true", "before": _START + i * _HOUR}
        out.append(job)
    return out


@query(f"""
WITH {MESSAGES}, m AS (SELECT *, epoch(internal_ts) AS s FROM messages),
j AS (SELECT i, 'j' || i AS job, (['click', 'view', 'error', 'purchase'])[i // 4 % 4 + 1] AS kind, {_START} + i * {_HOUR} // 4 AS t FROM range({MANY_JOBS}) r(i))
SELECT job, count(*) AS n_messages, min(internal_ts) AS first_ts, max(internal_ts) AS last_ts FROM (
  SELECT job, internal_ts FROM m JOIN j ON i % 4 = 0 AND contains(lower(sender), 'user' || (i // 4) || '@')
  UNION ALL SELECT job, internal_ts FROM m JOIN j ON i % 4 = 1 AND list_contains(label_ids, kind) AND s >= t AND s < t + {7 * _HOUR}
  UNION ALL SELECT job, internal_ts FROM m JOIN j ON i % 4 = 2 AND s >= t + 17 AND s < t + {_HOUR // 2}
  UNION ALL SELECT job, internal_ts FROM m JOIN j ON i % 4 = 3 AND contains(lower(subject), kind) AND contains(lower(sender), (i // 4) || '@pay')
    AND has_attachment AND s < {_START} + i * {_HOUR}
) GROUP BY job
""")
def route_many_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches of two thousand jobs, found by an index."""
    return R.match_counts(JI.route_many(SI.events_as_messages(table(spark, sf_dir, "events")), _many_jobs()))
