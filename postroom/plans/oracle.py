"""DuckDB SQL for each driver query (same column names and types).

Written independently of the Spark code: plain SQL over the driver's
tables, used by the driver's correctness gate and by ``tests/``.
"""

from __future__ import annotations

from postroom.plans.standins import JOBS, RECIPIENT, SENDER_DOMAINS

EPOCH = "TIMESTAMP '1970-01-01 00:00:00'"

MESSAGES = f"""messages AS (
  SELECT CAST(event_id AS VARCHAR) AS message_id, ts AS internal_ts,
         'user' || CAST(user_id AS VARCHAR) || '@' || ({list(SENDER_DOMAINS)})[((user_id % 4) + 4) % 4 + 1] AS sender,
         '{RECIPIENT}' AS recipient, 'Report ' || event_type AS subject, [event_type] AS label_ids,
         value >= 10 AS has_attachment, event_id
  FROM events)"""


def _job_where(j) -> str:
    conds = []
    if j.get("from"):
        conds.append(f"contains(lower(sender), '{j['from'].lower()}')")
    if j.get("to"):
        conds.append(f"contains(lower(recipient), '{j['to'].lower()}')")
    if j.get("subject"):
        conds.append(f"contains(lower(subject), '{j['subject'].strip('*').lower()}')")
    if j.get("label"):
        conds.append(f"list_contains(label_ids, '{j['label']}')")
    if j.get("after") is not None:
        conds.append(f"internal_ts >= {EPOCH} + to_seconds({int(j['after'])})")
    if j.get("before") is not None:
        conds.append(f"internal_ts < {EPOCH} + to_seconds({int(j['before'])})")
    if str(j.get("attachment")).lower() in ("yes", "true", "t", "1"):
        conds.append("has_attachment")
    return " AND ".join(conds) or "TRUE"


def _routed(jobs) -> str:
    return "\n  UNION ALL ".join(f"SELECT '{j['job']}' AS job, * FROM messages WHERE {_job_where(j)}" for j in jobs)


ROUTE_MESSAGES = f"""
WITH {MESSAGES}
SELECT job, count(*) AS n_messages, min(internal_ts) AS first_ts, max(internal_ts) AS last_ts
FROM ({_routed(JOBS)}) GROUP BY job
"""

UNPROCESSED = """
SELECT d.doc_id AS message_id, d.lang, d.source FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
"""

ATTACHMENT_MATCH = """
SELECT 'po_spending' AS job, p_partkey AS message_id, p_name AS filename FROM part
  WHERE regexp_matches(p_name, '.*bolt') AND split_part(p_type, ' ', 1) = 'SMALL'
UNION ALL SELECT 'views', p_partkey, p_name FROM part WHERE regexp_matches(p_name, '^(red|blue) .*')
UNION ALL SELECT 'bank', p_partkey, p_name FROM part WHERE regexp_matches(p_name, 'hot.*(gear|gizmo)|ring$')
"""

LAST_BODY = """
SELECT conv_id AS message_id, max_by(text, turn) AS body FROM conversations
WHERE role = 'assistant' GROUP BY conv_id
"""

FLATTEN_PARTS = """
WITH c AS (SELECT CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS message_id, conv_id, turn, role, text,
                  '<p>' || text || '</p>' AS html FROM conversations)
SELECT message_id, 0 AS depth, '0' AS part_path, '' AS filename, 'multipart/alternative' AS mime_type,
       CAST(0 AS BIGINT) AS size, CAST(NULL AS VARCHAR) AS text, CAST(NULL AS VARCHAR) AS attachment_id FROM c
UNION ALL SELECT message_id, 0, '1', 'turn_' || CAST(turn AS VARCHAR) || '_' || role || '.txt', 'text/plain',
       CAST(strlen(text) AS BIGINT), NULL, 'att-' || CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) FROM c
UNION ALL SELECT message_id, 1, '0.0', '', 'text/plain', CAST(strlen(text) AS BIGINT), text, NULL FROM c
UNION ALL SELECT message_id, 1, '0.1', '', 'text/html', CAST(strlen(html) AS BIGINT), html, NULL FROM c
"""

DECODE_PAYLOAD = "SELECT doc_id, text FROM documents"

_LINKS = """links AS (
  SELECT page_id, CAST(i - 1 AS INTEGER) AS pos, href FROM (
    SELECT page_id, unnest(m) AS href, unnest(generate_series(1, len(m))) AS i
    FROM (SELECT page_id, regexp_extract_all(html, '<li><a href="([^"]*)"', 1) AS m FROM pages)))"""

LINKS = f"WITH {_LINKS} SELECT page_id, pos, href FROM links"

LAST_LINK_TEXT = r"""
SELECT page_id,
       regexp_replace(replace(replace(replace(replace(
         regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a>', 1)[-1],
         '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&'), '^\s+|\s+$', '', 'g') AS link_text
FROM pages
"""

LINKS_OR_BODY = f"""
WITH {_LINKS}
SELECT page_id, 'link' AS kind, pos, href FROM links WHERE page_id % 2 = 0
UNION ALL SELECT page_id, 'body', CAST(NULL AS INTEGER), CAST(NULL AS VARCHAR) FROM pages WHERE page_id % 2 <> 0
"""

ELEMENTS = r"""
SELECT page_id, lower(t) AS tag, count(*) AS n
FROM (SELECT page_id, unnest(regexp_extract_all(html, '<([a-zA-Z][a-zA-Z0-9]*)[\s>/]', 1)) AS t FROM pages)
GROUP BY ALL
"""


def _secure(x: str) -> str:
    return (
        "regexp_replace(regexp_replace(regexp_replace(regexp_replace("
        f"replace({x}, '/', ' '), '^\\s+|\\s+$', '', 'g'), '\\s+', '_', 'g'), '[^A-Za-z0-9_.-]', '', 'g'), '^[._]+|[._]+$', '', 'g')"
    )


_LINK_JOBS = [j for j in JOBS if j.get("source") == "url_in_body"]
ROUTE_LINKS = f"""
WITH {MESSAGES}, {_LINKS},
routed AS ({_routed(_LINK_JOBS)}),
todo AS (SELECT * FROM routed r WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE CAST(l.doc_id AS VARCHAR) = r.message_id)),
j AS (SELECT t.job, t.message_id, t.internal_ts, k.pos, k.href,
             t.message_id || '_' || CAST(k.pos AS VARCHAR) || '_' ||
             regexp_extract(regexp_replace(regexp_extract(k.href, '^(?:[A-Za-z][A-Za-z0-9+.\\-]*:)?(?://[^/?#]*)?([^?#]*)', 1), ';[^/]*$', ''), '([^/]*)$', 1) AS stem
      FROM todo t JOIN links k ON k.page_id = t.event_id % (SELECT count(*) FROM pages))
SELECT job, message_id, pos, href,
       {_secure("CASE WHEN regexp_matches(stem, '[0-9]{4}') THEN stem ELSE stem || '_' || strftime(internal_ts, '%Y%m%d') END || '.html'")} AS file_name
FROM j
"""

DISCREPANCIES = """
WITH b AS (SELECT o_orderkey, o_orderstatus, CAST(floor(o_orderkey / 64) AS BIGINT) AS bucket,
                  min(CAST(o_orderdate AS DATE)) OVER (PARTITION BY CAST(floor(o_orderkey / 64) AS BIGINT)) AS day
           FROM orders)
SELECT 'disc-' || CAST(bucket AS VARCHAR) AS message_id,
       strftime(day, '%Y-%m-%d') || ' 01:02:03' AS checking_timestamp,
       CASE WHEN bucket % 7 = 0 THEN '2024-01-02' ELSE strftime(day, '%Y-%m-%d') || ' 00:00:00' END AS unmatched_timestamp,
       'status ' || o_orderstatus || ' NOT FOUND' AS discrepancy_description,
       CAST(o_orderkey AS VARCHAR) AS transaction_id
FROM b WHERE bucket % 50 <> 0
"""

REPORT_LINES = """
SELECT report_id, line_no, line FROM (
  SELECT 'doc-' || CAST(doc_id AS VARCHAR) AS report_id, CAST(i - 1 AS INTEGER) AS line_no, line FROM (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
           unnest(generate_series(1, len(string_split(text, chr(10))))) AS i FROM documents)
  UNION ALL
  SELECT 'li-' || CAST(l_orderkey AS VARCHAR), l_linenumber,
         CASE WHEN l_linenumber % 2 = 0
              THEN printf('%06d', l_orderkey) || chr(9) || CAST(l_linenumber AS VARCHAR) || chr(9) || l_returnflag
              ELSE printf('%05d', l_linenumber) || ' short ' || CAST(l_orderkey AS VARCHAR) END
  FROM lineitem)
WHERE regexp_matches(line, '^[0-9]{6}')
"""

SECURE_FILENAME = f"SELECT page_id, url, {_secure('url')} AS file_name FROM pages"

SAFE_NAME = f"""
SELECT p_partkey, path,
       'exports/' || {_secure("CASE WHEN regexp_matches(stem, '[0-9]{4}') THEN stem ELSE stem || '_20240101' END || '.csv'")} AS file_name
FROM (SELECT p_partkey, p_name || CASE WHEN p_partkey % 3 = 0 THEN ' 2023' ELSE '' END AS stem,
             'exports/' || p_name || CASE WHEN p_partkey % 3 = 0 THEN ' 2023' ELSE '' END || '.csv' AS path FROM part)
"""

URL_FILE_NAME = f"""
WITH log AS (
  SELECT page_id, url,
         CASE WHEN page_id % 3 = 1 THEN regexp_replace(url, '[?#].*$', '') || '/file_' || CAST(page_id AS VARCHAR) || '.csv' ELSE url END AS final_url,
         CASE WHEN page_id % 3 = 2 THEN 'attachment; filename=export ' || CAST(page_id AS VARCHAR) || '.xlsx' END AS cd,
         CASE WHEN page_id % 4 = 0 THEN 'application/zip' ELSE 'text/csv' END AS ctype,
         'msg' || CAST(page_id AS VARCHAR) AS default_name
  FROM pages),
n0 AS (
  SELECT page_id, ctype, CASE
    WHEN cd IS NOT NULL AND regexp_extract(cd, 'filename=(.+)', 1) <> '' THEN regexp_extract(cd, 'filename=(.+)', 1)
    WHEN final_url <> url THEN regexp_extract(regexp_replace(regexp_extract(final_url,
         '^(?:[A-Za-z][A-Za-z0-9+.\\-]*:)?(?://[^/?#]*)?([^?#]*)', 1), ';[^/]*$', ''), '([^/]*)$', 1)
    ELSE default_name END AS name
  FROM log),
n1 AS (
  SELECT page_id, CASE WHEN ctype = 'application/zip'
    THEN left(name, length(name) - length(regexp_extract(regexp_extract(name, '([^/]*)$', 1), '^\\.*[^.].*?(\\.[^.]*)$', 1))) || '.zip'
    ELSE name END AS name
  FROM n0)
SELECT page_id, {_secure('name')} AS file_name FROM n1
"""

DROP_VERSION = """
SELECT o_orderkey, file_name, renamed, substring(renamed, 12, 8) AS file_date FROM (
  SELECT o_orderkey, file_name, regexp_replace(file_name, '^(.*)_[0-9]\\.', '\\1.') AS renamed FROM (
    SELECT o_orderkey, 'MKM_REPORT_' || strftime(o_orderdate, '%Y%m%d') ||
           CASE o_orderkey % 3 WHEN 0 THEN '' WHEN 1 THEN '_' || CAST(o_orderkey % 10 AS VARCHAR)
                ELSE '_' || CAST(o_orderkey % 10 AS VARCHAR) || '_v' END || '.txt' AS file_name
    FROM orders))
"""

HEADER_NAMES = r"""
WITH h AS (
  SELECT p_partkey, CAST(i - 1 AS INTEGER) AS header_no, x || ' ' || p_type || ' ' || CAST(p_size AS VARCHAR) AS header FROM (
    SELECT p_partkey, p_type, p_size,
           unnest(['Invoice Number', 'PO Number', 'Account Segment 1 Name', 'Commodity Level 3', 'GL Account/Lookup', 'userFullName']) AS x,
           unnest(generate_series(1, 6)) AS i
    FROM part))
SELECT p_partkey, header_no, header,
  replace(replace(lower(regexp_replace(regexp_replace(header, '(.)([A-Z][a-z]+)', '\1_\2', 'g'), '([a-z0-9])([A-Z])', '\1_\2', 'g')), ' ', ''), '/_', '/') AS header_name,
  replace(replace(lower(regexp_replace(regexp_replace(trim(replace(header, ' ', '')), '(.)([A-Z][a-z]+)', '\1_\2', 'g'), '([a-z0-9])([A-Z])', '\1_\2', 'g')), ' _', '_'), '/_', '/') AS header_name_alt,
  regexp_replace(trim(lower(replace(header, ' ', ''))), '[^\pL\pN_]', '_', 'g') AS column_key
FROM h
"""

FOLD_ACCENTS = "SELECT doc_id, strip_accents(text) AS folded FROM documents"

STRIP_RESERVED = r"""
SELECT doc_id, regexp_replace(replace(replace(text, '’', ''''), '?', ''), '[^\pL\pN_\-_. \^&''@\{\}\[\],$=!-#\(\)%+~]', '_', 'g') AS stripped
FROM documents
"""

NORMALIZE_CELLS = """
WITH li AS (
  SELECT l_linenumber, l_returnflag, l_linestatus, l_quantity, l_extendedprice,
         date_diff('day', DATE '1899-12-30', CAST(l_shipdate AS DATE)) AS days,
         'lineitem_' || CAST(CAST(floor(l_orderkey / 4096) AS BIGINT) AS VARCHAR) || '.xlsx' AS file,
         l_orderkey * 8 + l_linenumber AS row
  FROM lineitem),
t AS (SELECT *, TIMESTAMP '1899-12-30 00:00:00' + to_days(CAST(days AS INTEGER)) + to_hours(CAST(l_linenumber * 3 AS BIGINT)) AS created FROM li)
SELECT file, row, 0 AS col, 'order_line_description' AS header,
       replace(replace(l_returnflag || chr(10) || l_linestatus || chr(9) || 'x', chr(10), ' '), chr(9), ' ') AS value FROM t
UNION ALL SELECT file, row, 1, 'order_line_quantity', CAST(CAST(round_even(l_quantity / 2, 0) AS DECIMAL(38,0)) AS VARCHAR) FROM t
UNION ALL SELECT file, row, 2, 'extended_price', CAST(CAST(round_even(l_extendedprice, 0) AS DECIMAL(38,0)) AS VARCHAR) FROM t
UNION ALL SELECT file, row, 3, 'ship_date', strftime(DATE '1899-12-30' + CAST(days AS INTEGER), '%Y-%m-%d') FROM t
UNION ALL SELECT file, row, 4, 'created_at',
       CASE WHEN strftime(created, '%H:%M:%S') = '00:00:00' THEN strftime(created, '%Y-%m-%d') ELSE strftime(created, '%Y-%m-%dT%H:%M:%S') END FROM t
UNION ALL SELECT file, row, 5, 'invoice_month', strftime(DATE '1899-12-30' + CAST(days AS INTEGER), '%Y-%m') FROM t
UNION ALL SELECT file, row, 6, 'invoice_year', strftime(DATE '1899-12-30' + CAST(days AS INTEGER), '%Y') FROM t
"""

CELLS_TO_ROWS = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS o_orderdate, o_orderpriority
FROM orders
"""

RUN_WINDOW = """
SELECT event_id, strftime(d, '%Y%m%d') AS partition, d - INTERVAL 7 HOUR AS window_start, d + INTERVAL 17 HOUR AS window_end,
       ts >= d - INTERVAL 7 HOUR AND ts < d + INTERVAL 17 HOUR AS in_window
FROM (SELECT event_id, ts, CAST(date_trunc('day', ts) AS TIMESTAMP) AS d FROM events)
"""

TRUTHY = """
SELECT event_id, word, coalesce(lower(word) IN ('yes', 'true', 't', '1'), false) AS truthy,
       coalesce(lower(word) IN ('true', '1', 'yes', 'y'), false) AS truthy_alt
FROM (SELECT event_id, (['yes', 'True', 't', '1', 'no', 'Y', '0', 'false'])[(((CAST(json_extract_string(props, '$.k') AS BIGINT) % 8) + 8) % 8) + 1] AS word
      FROM events)
"""

CAST_TO_SCHEMA = """
SELECT o_orderkey, CASE WHEN o_orderkey % 83 = 0 THEN NULL ELSE o_custkey END AS o_custkey, o_orderstatus,
       CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice,
       CASE WHEN o_orderkey % 89 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS o_orderdate,
       concat_ws(',', CASE WHEN o_orderkey % 97 = 0 THEN 'o_totalprice' END, CASE WHEN o_orderkey % 89 = 0 THEN 'o_orderdate' END) AS errors
FROM orders
"""

CHECK_REQUIRED = """
SELECT o_orderkey, CASE WHEN o_orderkey % 83 = 0 THEN NULL ELSE o_custkey END AS o_custkey,
       CASE WHEN o_orderkey % 83 = 0 THEN 'o_custkey' ELSE '' END AS missing
FROM orders
"""

CHECK_RECORDS = """
SELECT c_custkey, concat_ws(';',
  CASE WHEN c_custkey IS NULL THEN 'c_custkey: required' END,
  CASE WHEN c_custkey IS NOT NULL AND TRY_CAST(CAST(c_custkey AS VARCHAR) AS BIGINT) IS NULL THEN 'c_custkey: type' END,
  CASE WHEN c_name IS NULL THEN 'c_name: required' END,
  CASE WHEN c_name IS NOT NULL AND c_custkey IS NULL THEN 'c_name: dependencies' END,
  CASE WHEN (CAST(c_nationkey IS NULL OR c_nationkey <= 10 AS INTEGER) + CAST(c_nationkey IS NULL OR c_nationkey >= 5 AS INTEGER)) <> 1
       THEN 'c_nationkey: oneof' END,
  CASE WHEN c_acctbal IS NULL THEN 'c_acctbal: nullable' END,
  CASE WHEN c_acctbal < 0 THEN 'c_acctbal: min' END,
  CASE WHEN c_mktsegment IS NOT NULL AND c_mktsegment NOT IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'MACHINERY') THEN 'c_mktsegment: allowed' END,
  CASE WHEN c_mktsegment IS NOT NULL AND NOT coalesce(c_nationkey BETWEEN 0 AND 19, false) THEN 'c_mktsegment: dependencies' END
) AS violations
FROM customer
"""

CHECK_COUNTS = f"""
SELECT count(*) AS n_total, count(*) FILTER (WHERE violations = '') AS n_valid, count(*) FILTER (WHERE violations <> '') AS n_invalid
FROM ({CHECK_RECORDS})
"""


ORACLE = {
    "route_messages": ROUTE_MESSAGES,
    "unprocessed": UNPROCESSED,
    "attachment_match": ATTACHMENT_MATCH,
    "last_body": LAST_BODY,
    "flatten_parts": FLATTEN_PARTS,
    "decode_payload": DECODE_PAYLOAD,
    "links": LINKS,
    "last_link_text": LAST_LINK_TEXT,
    "links_or_body": LINKS_OR_BODY,
    "elements": ELEMENTS,
    "route_links": ROUTE_LINKS,
    "discrepancies": DISCREPANCIES,
    "report_lines": REPORT_LINES,
    "secure_filename": SECURE_FILENAME,
    "safe_name": SAFE_NAME,
    "url_file_name": URL_FILE_NAME,
    "drop_version": DROP_VERSION,
    "header_names": HEADER_NAMES,
    "fold_accents": FOLD_ACCENTS,
    "strip_reserved": STRIP_RESERVED,
    "normalize_cells": NORMALIZE_CELLS,
    "cells_to_rows": CELLS_TO_ROWS,
    "run_window": RUN_WINDOW,
    "truthy": TRUTHY,
    "cast_to_schema": CAST_TO_SCHEMA,
    "check_required": CHECK_REQUIRED,
    "check_records": CHECK_RECORDS,
    "check_counts": CHECK_COUNTS,
}

ORDERS_ALL = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders"

REPLACE_PARTITION = """
SELECT o_orderkey, CASE WHEN strftime(o_orderdate, '%Y%m%d') = '19970315' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice,
       o_orderdate, strftime(o_orderdate, '%Y%m%d') AS partition
FROM orders
"""

MERGE_TABLE = """
SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 10 = 0 THEN 'M' ELSE o_orderstatus END AS o_orderstatus, o_totalprice FROM orders
UNION ALL
SELECT o_orderkey + 1000000000, o_custkey, 'N', o_totalprice FROM orders WHERE o_orderkey % 25 = 0
"""

FAN_OUT = """
SELECT c.channel, c.status, CASE WHEN c.status = 'ok' THEN (SELECT count(*) FROM events) ELSE 0 END AS rows
FROM (VALUES ('parquet', 'ok'), ('json', 'ok'), ('tsv', 'ok'), ('broken', 'failed')) c(channel, status)
"""

MARK_PROCESSED = "SELECT CAST(event_id AS VARCHAR) AS message_id, 'events_job' AS job FROM events"

INCREMENTAL_LOAD = f"""
WITH {MESSAGES}
SELECT message_id, job FROM ({_routed(JOBS)})
"""

ORACLE.update({
    "read_delimited": ORDERS_ALL,
    "read_json_records": ORDERS_ALL,
    "replace_partition": REPLACE_PARTITION,
    "merge_table": MERGE_TABLE,
    "fan_out": FAN_OUT,
    "mark_processed": MARK_PROCESSED,
    "incremental_load": INCREMENTAL_LOAD,
})

ORACLE["expand_archives"] = """
SELECT doc_id, text, CAST(NULL AS VARCHAR) AS broken FROM documents WHERE CAST(floor(doc_id / 16) AS BIGINT) % 9 <> 4
UNION ALL SELECT DISTINCT CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), 'block_' || CAST(CAST(floor(doc_id / 16) AS BIGINT) AS VARCHAR) || '.zip'
FROM documents WHERE CAST(floor(doc_id / 16) AS BIGINT) % 9 = 4
"""
ORACLE["workbook_cells"] = ORDERS_ALL

ORACLE["apply_transform"] = """
SELECT CASE WHEN regexp_matches(stem, '[0-9]{4}') THEN stem ELSE stem || '_20240101' END || '.tsv' AS file_name, line
FROM (SELECT 'RPT_HASIL_' || CAST(CAST(floor(l_orderkey / 64) AS BIGINT) AS VARCHAR) AS stem,
             printf('%06d', l_orderkey) || chr(9) || CAST(l_linenumber AS VARCHAR) || chr(9) || l_returnflag AS line
      FROM lineitem)
"""

ORACLE["transform_chain"] = """
WITH d AS (SELECT doc_id, CAST(floor(doc_id / 16) AS BIGINT) AS block FROM documents)
SELECT CASE WHEN regexp_matches('DOC_doc_' || CAST(doc_id AS VARCHAR), '[0-9]{4}') THEN 'DOC_doc_' || CAST(doc_id AS VARCHAR)
            ELSE 'DOC_doc_' || CAST(doc_id AS VARCHAR) || '_20240101' END || '.txt' AS file_name, 'ok' AS status
FROM d WHERE block % 9 <> 4
UNION ALL
SELECT DISTINCT CASE WHEN regexp_matches('DOC_block_' || CAST(block AS VARCHAR), '[0-9]{4}') THEN 'DOC_block_' || CAST(block AS VARCHAR)
            ELSE 'DOC_block_' || CAST(block AS VARCHAR) || '_20240101' END || '.zip', 'kept'
FROM d WHERE block % 9 = 4
"""

ORACLE["load_rejects"] = """
SELECT o_orderkey, CASE WHEN o_orderkey % 101 = 0 THEN 'too many fields'
                        WHEN o_orderkey % 103 = 0 THEN 'too few fields'
                        WHEN o_orderkey % 107 = 0 THEN 'bad value: o_totalprice'
                        ELSE 'ok' END AS status
FROM orders
"""

ORACLE["discrepancy_errors"] = """
SELECT DISTINCT 'disc-' || CAST(CAST(floor(o_orderkey / 64) AS BIGINT) AS VARCHAR) AS message_id,
       'NOT FOUND paragraph without exactly one '':''' AS reason
FROM orders WHERE CAST(floor(o_orderkey / 64) AS BIGINT) % 50 = 0
"""
