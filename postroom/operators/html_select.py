"""Selecting and extracting from HTML element rows.

The path family the jobs use is ``//tag`` or ``//parent/tag`` with an
optional ``[text()='v']`` or ``[contains(text(),'v')]``; it becomes a
Column predicate over ``(tag, parent_tag, texts)``. Links and last matches
take longer paths too (``operators.paths``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postroom.functions.names import py_strip
from postroom.operators.paths import parse_steps, path_matches
from postroom.sources.html import html_matches, parse_path  # noqa: F401


def path_predicate(path: str) -> Column:
    """The predicate of a path over element rows. Unsupported paths raise."""
    p = parse_path(path)
    cond = F.lit(True)
    if p.tag != "*":
        cond = cond & (F.col("tag") == p.tag)
    if p.parent:
        cond = cond & (F.col("parent_tag").isNotNull() if p.parent == "*" else F.col("parent_tag") == p.parent)
    if p.test == "eq":
        cond = cond & F.coalesce(F.array_contains("texts", p.value), F.lit(False))
    elif p.test == "contains":
        cond = cond & F.coalesce(F.get(F.col("texts"), 0).contains(p.value), F.lit(False))
    return cond


def select_elements(elements: DataFrame, path: str) -> DataFrame:
    """Elements matching a path."""
    return elements.where(path_predicate(path))


def _matches(docs: DataFrame, path: str, id_col: str, html_col: str) -> DataFrame:
    """A path of one tag, or of parent and child with a test of the child's
    text, is tested as the document is parsed; any other over its tree."""
    try:
        *before, last = parse_steps(path)
    except ValueError:  # the short form takes values with its own quotes in them
        return html_matches(docs, path, id_col, html_col)
    plain = all(not s.child and not s.place and not s.tests for s in before) and not last.place
    short = len(before) == int(last.child) and len(last.tests) <= 1 and all(t[0] != "attribute" for t in last.tests)
    return html_matches(docs, path, id_col, html_col) if plain and short else path_matches(docs, path, html_col)


def _hrefs() -> Column:
    return F.filter(F.transform("matches", lambda m: m["href"]), lambda h: h.isNotNull())


def extract_links(docs: DataFrame, path: str, id_col: str = "doc_id", html_col: str = "html") -> DataFrame:
    """Link targets of the matching elements in document order:
    ``(id, pos, href)``, ``pos`` from 0. Narrow: no shuffle."""
    found = _matches(docs.select(id_col, html_col), path, id_col, html_col)
    return found.select(id_col, F.posexplode(_hrefs()).alias("pos", "href"))


def extract_last(docs: DataFrame, path: str, attr: str = "href", id_col: str = "doc_id", html_col: str = "html") -> DataFrame:
    """Per document, the attribute (or ``text()``) of the last match,
    trimmed; NULL when nothing matches. Narrow: every document is a row."""
    found = _matches(docs.select(id_col, html_col), path, id_col, html_col)
    last = F.try_element_at("matches", F.lit(-1))
    return found.select(id_col, py_strip(last["text"] if "()" in attr else last["attrs"][attr]).alias("value"))


def attach_password(files: DataFrame, passwords: DataFrame, key: str = "message_id") -> DataFrame:
    """The archive password found in a message's body, joined to
    that message's files (one password per message, not one per run)."""
    return files.join(passwords.select(key, F.col("value").alias("zip_password")), key, "left")


def links_or_body(docs: DataFrame, path: str | None, id_col: str = "doc_id", html_col: str = "html", with_path: Column | None = None) -> DataFrame:
    """``(id, kind, pos, href)``: the links of a body; the body itself
    when its job has no path (``path`` or ``with_path`` says so) or it could
    not be parsed. A body whose path matches no link yields nothing."""
    body = F.struct(F.lit("body").alias("kind"), F.lit(None).cast("int").alias("pos"), F.lit(None).cast("string").alias("href"))
    if path is None:
        return docs.select(id_col, F.inline(F.array(body)))
    wanted = F.lit(True) if with_path is None else F.coalesce(with_path, F.lit(False))
    found = _matches(docs.select(id_col, html_col, wanted.alias("_wanted")), path, id_col, html_col)
    links = F.transform(_hrefs(), lambda h, i: F.struct(F.lit("link").alias("kind"), i.cast("int").alias("pos"), h.alias("href")))
    return found.select(id_col, F.inline(F.when(F.col("_wanted") & (F.col("status") != "failed"), links).otherwise(F.array(body))))
