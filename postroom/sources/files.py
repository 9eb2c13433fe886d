"""Files held as rows: archives and workbooks (SURVEY 2.1 S9, S10; 2.3 F14;
2.6 G4).

Input is a table of files ``(file_name, content binary, ...)``, e.g. from
the ``binaryFile`` source or from decoded attachments. Each file is one
row, so one file is the memory unit of a task; the work splits over
files (``repartition`` spreads them when a source holds few large ones).
Decoding runs in ``mapInPandas`` with the standard library's ``zipfile``
and ``xml.etree``. Rows are whole files, so sessions that decode large
files should lower ``spark.sql.execution.arrow.maxRecordsPerBatch``.
"""

from __future__ import annotations

import io
import posixpath
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MEMBER_SCHEMA = T.StructType(
    [
        T.StructField("member_name", T.StringType()),
        T.StructField("content", T.BinaryType()),
        T.StructField("size", T.LongType()),
        T.StructField("error", T.StringType()),
    ]
)


def read_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Files of a folder as ``(file_path, file_name, content)`` rows."""
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    df = reader.load(path)
    return df.select(F.col("path").alias("file_path"), F.regexp_extract("path", r"([^/]*)$", 1).alias("file_name"), "content")


def _members(content: bytes, password: str | None, drop_nested: bool):
    """Member rows of one archive: paths flattened (the last member of a
    name wins), only names with a dot that do not start with one, nested
    ``.zip`` members dropped when asked."""
    out = {}
    with zipfile.ZipFile(io.BytesIO(content)) as zf:
        pwd = password.encode() if password else None
        for info in zf.infolist():
            if info.is_dir():
                continue
            name = posixpath.basename(info.filename.replace("\\", "/"))
            if not name or name.startswith(".") or "." not in name:
                continue
            if drop_nested and name.lower().endswith(".zip"):
                continue
            out[name] = zf.read(info, pwd=pwd)
    return [(n, data, len(data), None) for n, data in out.items()]


def expand_archives(files: DataFrame, content_col: str = "content", password_col: str | None = None, drop_nested: bool = True, keep_failed: bool = False) -> DataFrame:
    """One row per archive member: the file's columns plus
    ``member_name, content, size, error``. A bad or encrypted-but-no-password
    archive gives one row with ``error`` set and no member;
    with ``keep_failed`` that row carries the archive's own bytes (T3)."""
    import pandas as pd

    keep = [c for c in files.columns if c != content_col]
    in_cols = keep + [content_col] + ([password_col] if password_col and password_col not in keep else [])
    schema = T.StructType([files.schema[c] for c in keep] + list(MEMBER_SCHEMA.fields))
    names = [f.name for f in schema.fields]

    def run(batches):
        # rows leave archive by archive: a task holds one archive's members
        for pdf in batches:
            for rec in pdf.to_dict("records"):
                rows = []
                base = [rec[c] for c in keep]
                data = rec[content_col]
                pw = rec.get(password_col) if password_col else None
                if data is None:
                    yield pd.DataFrame([base + [None, None, None, "no content"]], columns=names)
                    continue
                kept = bytes(data) if keep_failed else None
                try:
                    for m in _members(bytes(data), pw, drop_nested):
                        rows.append(base + list(m))
                except Exception as e:  # bad archive, wrong password, unsupported method
                    rows.append(base + [None, kept, len(data), f"{type(e).__name__}: {e}"])
                yield pd.DataFrame(rows, columns=names)

    return files.select(*in_cols).mapInPandas(run, schema)


def build_zip(members) -> bytes:
    """An archive from ``(name, bytes)`` pairs (deflated)."""
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        for name, data in members:
            zf.writestr(name, data)
    return buf.getvalue()
