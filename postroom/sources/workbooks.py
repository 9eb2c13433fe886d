"""Spreadsheet workbooks (.xlsx) to cell rows.

This Spark has no Excel source, so each workbook file (one row) is decoded
in ``mapInArrow`` with ``zipfile`` and ``xml.etree``: shared strings,
inline strings, numbers, booleans, errors, and dates recognised from the
cell style's number format. Output is the cell table
``(file_name, sheet_no, sheet, row, col, ctype, raw)`` with ctype
1 text, 2 number, 3 date, 4 boolean, 5 error; rows and columns from 0.
"""

from __future__ import annotations

import io
import re
import zipfile
import xml.etree.ElementTree as ET

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
NS_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
NS_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
NS_PKG_REL = "http://schemas.openxmlformats.org/package/2006/relationships"
# Built-in number formats that show dates or times.
BUILTIN_DATE_FORMATS = frozenset(list(range(14, 23)) + list(range(45, 48)) + list(range(27, 37)) + list(range(50, 59)))
CTYPE_TEXT, CTYPE_NUMBER, CTYPE_DATE, CTYPE_BOOL, CTYPE_ERROR = 1, 2, 3, 4, 5
# ----------------------------------------------------------------------------

CELL_SCHEMA = T.StructType(
    [
        T.StructField("sheet_no", T.IntegerType()),
        T.StructField("sheet", T.StringType()),
        T.StructField("row", T.LongType()),
        T.StructField("col", T.IntegerType()),
        T.StructField("ctype", T.IntegerType()),
        T.StructField("raw", T.StringType()),
        T.StructField("header_raw", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)

_REF = re.compile(r"^([A-Z]+)([0-9]+)$")
_QUOTED = re.compile(r'"[^"]*"|\[[^\]]*\]|\\.')


def _q(tag: str) -> str:
    return f"{{{NS_MAIN}}}{tag}"


def _col_index(letters: str) -> int:
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def _is_date_format(code: str) -> bool:
    body = _QUOTED.sub("", code).lower()
    return any(ch in body for ch in "dmyhs") and "general" not in body


def _text(el) -> str:
    """Text of a string item: ``<t>`` or the runs ``<r><t>``."""
    return "".join(t.text or "" for t in el.iter(_q("t")))


def _date_styles(zf: zipfile.ZipFile) -> set[int]:
    try:
        root = ET.fromstring(zf.read("xl/styles.xml"))
    except KeyError:
        return set()
    custom = {}
    fmts = root.find(_q("numFmts"))
    if fmts is not None:
        for f in fmts.findall(_q("numFmt")):
            custom[int(f.get("numFmtId"))] = f.get("formatCode", "")
    xfs = root.find(_q("cellXfs"))
    out = set()
    if xfs is not None:
        for i, xf in enumerate(xfs.findall(_q("xf"))):
            fid = int(xf.get("numFmtId", "0"))
            if fid in BUILTIN_DATE_FORMATS or (fid in custom and _is_date_format(custom[fid])):
                out.add(i)
    return out


def _sheets(zf: zipfile.ZipFile):
    wb = ET.fromstring(zf.read("xl/workbook.xml"))
    rels = ET.fromstring(zf.read("xl/_rels/workbook.xml.rels"))
    target = {r.get("Id"): r.get("Target") for r in rels.iter(f"{{{NS_PKG_REL}}}Relationship")}
    out = []
    for s in wb.iter(_q("sheet")):
        t = target.get(s.get(f"{{{NS_REL}}}id"), "")
        t = t.lstrip("/")
        path = t if t.startswith("xl/") else f"xl/{t}"
        out.append((s.get("name"), path))
    return out


def workbook_cells_of(content: bytes, multi: bool = False):
    """Cell tuples ``(sheet_no, sheet, row, col, ctype, raw, header_raw,
    None)`` of one workbook; only the first sheet unless ``multi``.
    ``header_raw`` is the row-0 text of the cell's column (cells come in
    row order), so later steps need no header join."""
    rows = []
    with zipfile.ZipFile(io.BytesIO(content)) as zf:
        try:
            shared = [_text(si) for si in ET.fromstring(zf.read("xl/sharedStrings.xml")).iter(_q("si"))]
        except KeyError:
            shared = []
        dates = _date_styles(zf)
        sheets = _sheets(zf)
        for sheet_no, (name, path) in enumerate(sheets if multi else sheets[:1]):
            heads: dict[int, str] = {}
            for _, el in ET.iterparse(io.BytesIO(zf.read(path))):
                if el.tag != _q("c"):
                    continue
                m = _REF.match(el.get("r", ""))
                if not m:
                    continue
                col, row = _col_index(m.group(1)), int(m.group(2)) - 1
                t = el.get("t", "n")
                v = el.find(_q("v"))
                val = v.text if v is not None else None
                if t == "s":
                    ctype, raw = CTYPE_TEXT, shared[int(val)] if val is not None else None
                elif t == "inlineStr":
                    is_ = el.find(_q("is"))
                    ctype, raw = CTYPE_TEXT, _text(is_) if is_ is not None else ""
                elif t == "str":
                    ctype, raw = CTYPE_TEXT, val
                elif t == "b":
                    ctype, raw = CTYPE_BOOL, val
                elif t == "e":
                    ctype, raw = CTYPE_ERROR, val
                else:
                    if val is None:
                        el.clear()
                        continue
                    ctype = CTYPE_DATE if int(el.get("s", "0")) in dates else CTYPE_NUMBER
                    raw = val
                if row == 0:
                    heads[col] = raw
                rows.append((sheet_no, name, row, col, ctype, raw, heads.get(col), None))
                el.clear()
    return rows


def workbook_cells(files: DataFrame, content_col: str = "content", multi: bool = False) -> DataFrame:
    """The cells of every workbook file (first sheet, or all sheets
    with ``multi``); a file that cannot be read gives one row with
    ``error`` set."""
    keep = [c for c in files.columns if c != content_col]
    schema = T.StructType([files.schema[c] for c in keep] + list(CELL_SCHEMA.fields))
    names = [f.name for f in schema.fields]
    kinds = [{"int": pa.int32(), "bigint": pa.int64()}.get(f.dataType.simpleString(), pa.string()) for f in CELL_SCHEMA.fields]

    def run(batches):
        # cells leave workbook by workbook: a task holds one workbook's cells
        for batch in batches:
            rest, contents = batch.drop_columns([content_col]), batch.column(content_col)
            for i in range(batch.num_rows):
                try:
                    cells = workbook_cells_of(bytes(contents[i].as_py()), multi)
                except Exception as e:
                    cells = [(None, None, None, None, None, None, None, f"{type(e).__name__}: {e}")]
                columns = zip(*cells) if cells else [()] * len(kinds)
                of = pa.array([i] * len(cells), pa.int32())
                yield pa.RecordBatch.from_arrays([*(c.take(of) for c in rest.columns), *map(pa.array, columns, kinds)], names)

    return files.select(*keep, content_col).mapInArrow(run, schema)


# -- writing (for fixtures and exports) ---------------------------------------------

def _esc(s: str) -> str:
    return s.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;").replace('"', "&quot;")


def _ref(row: int, col: int) -> str:
    letters = ""
    col += 1
    while col:
        col, r = divmod(col - 1, 26)
        letters = chr(65 + r) + letters
    return f"{letters}{row + 1}"


def build_xlsx(sheets) -> bytes:
    """A minimal workbook: ``sheets`` is a list of ``(name, rows)``; a cell
    is ``None``, ``str`` (inline string), a number, or ``("date", serial)``."""
    ct = [
        '<?xml version="1.0" encoding="UTF-8"?>',
        '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">',
        '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>',
        '<Default Extension="xml" ContentType="application/xml"/>',
        '<Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>',
        '<Override PartName="/xl/styles.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.styles+xml"/>',
    ]
    wb = [f'<?xml version="1.0" encoding="UTF-8"?><workbook xmlns="{NS_MAIN}" xmlns:r="{NS_REL}"><sheets>']
    rels = [f'<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="{NS_PKG_REL}">']
    parts = {}
    for i, (name, rows) in enumerate(sheets, start=1):
        ct.append(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>')
        wb.append(f'<sheet name="{_esc(name)}" sheetId="{i}" r:id="rId{i}"/>')
        rels.append(f'<Relationship Id="rId{i}" Type="{NS_REL}/worksheet" Target="worksheets/sheet{i}.xml"/>')
        body = [f'<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="{NS_MAIN}"><sheetData>']
        for r, cells in enumerate(rows):
            body.append(f'<row r="{r + 1}">')
            for c, v in enumerate(cells):
                if v is None:
                    continue
                ref = _ref(r, c)
                if isinstance(v, tuple) and v[0] == "date":
                    body.append(f'<c r="{ref}" s="1"><v>{v[1]!r}</v></c>')
                elif isinstance(v, str):
                    body.append(f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{_esc(v)}</t></is></c>')
                else:
                    body.append(f'<c r="{ref}"><v>{v!r}</v></c>')
            body.append("</row>")
        body.append("</sheetData></worksheet>")
        parts[f"xl/worksheets/sheet{i}.xml"] = "".join(body)
    n = len(sheets)
    rels.append(f'<Relationship Id="rId{n + 1}" Type="{NS_REL}/styles" Target="styles.xml"/></Relationships>')
    wb.append("</sheets></workbook>")
    ct.append("</Types>")
    styles = (
        f'<?xml version="1.0" encoding="UTF-8"?><styleSheet xmlns="{NS_MAIN}">'
        '<cellXfs count="2"><xf numFmtId="0"/><xf numFmtId="14" applyNumberFormat="1"/></cellXfs></styleSheet>'
    )
    root_rels = (
        f'<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="{NS_PKG_REL}">'
        f'<Relationship Id="rId1" Type="{NS_REL}/officeDocument" Target="xl/workbook.xml"/></Relationships>'
    )
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        zf.writestr("[Content_Types].xml", "".join(ct))
        zf.writestr("_rels/.rels", root_rels)
        zf.writestr("xl/workbook.xml", "".join(wb))
        zf.writestr("xl/_rels/workbook.xml.rels", "".join(rels))
        zf.writestr("xl/styles.xml", styles)
        for k, v in parts.items():
            zf.writestr(k, v)
    return buf.getvalue()
