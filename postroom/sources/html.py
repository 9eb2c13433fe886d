"""HTML bodies to element rows.

Spark's ``xpath()`` needs well-formed XML and fails on ordinary HTML, so
each document is parsed inside ``mapInArrow`` with the standard library's
``html.parser``: Arrow batches in, one row per element out. A document is
the memory unit of a task; the work splits over documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
# Elements without content or end tag.
VOID_TAGS = frozenset(
    "area base br col embed hr img input link meta param source track wbr keygen command basefont frame isindex".split()
)
# Start tags that close an open <p> (HTML block content).
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section summary table ul dd dt".split()
)
# Elements that bound the search for an open element to close implicitly.
SCOPE_TAGS = frozenset("applet caption html table td th marquee object template button".split())
# Implied end tags: a start tag closes the nearest open element of these
# kinds, unless one of the boundary elements comes first.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol"} | SCOPE_TAGS),
    "dt": ({"dt", "dd"}, {"dl"} | SCOPE_TAGS),
    "dd": ({"dt", "dd"}, {"dl"} | SCOPE_TAGS),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr"}, {"table", "tbody", "thead", "tfoot"}),
    "option": ({"option"}, {"select", "datalist"}),
}
# ----------------------------------------------------------------------------

ELEMENT_FIELDS = [
    T.StructField("ord", T.IntegerType()),
    T.StructField("depth", T.IntegerType()),
    T.StructField("tag", T.StringType()),
    T.StructField("parent_tag", T.StringType()),
    T.StructField("attrs", T.MapType(T.StringType(), T.StringType())),
    T.StructField("texts", T.ArrayType(T.StringType())),
    T.StructField("text", T.StringType()),
    T.StructField("href", T.StringType()),
]


class _Open:
    __slots__ = ("tag", "ord", "depth", "parent", "attrs", "texts", "text", "pending", "has_child")

    def __init__(self, tag, ord_, depth, parent, attrs):
        self.tag, self.ord, self.depth, self.parent, self.attrs = tag, ord_, depth, parent, attrs
        self.texts, self.text, self.pending, self.has_child = [], None, [], False

    def flush(self, before_child: bool):
        if self.pending:
            s = "".join(self.pending)
            self.pending = []
            self.texts.append(s)
            if not self.has_child and self.text is None:
                self.text = s
        if before_child:
            self.has_child = True


class ElementParser(HTMLParser):
    """Tree builder with explicit repair rules: void elements, implied end
    tags (``p``, ``li``, ``td``/``th``, ``tr``, ...), stray end tags ignored,
    an end tag closes everything opened after its element."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows = []
        self.stack: list[_Open] = []
        self.n = 0

    # -- helpers -------------------------------------------------------------
    def _emit(self, el: _Open):
        el.flush(False)
        self.rows.append((el.ord, el.depth, el.tag, el.parent, el.attrs, el.texts, el.text, el.attrs.get("href")))

    def _pop_to(self, idx: int):
        while len(self.stack) > idx:
            self._emit(self.stack.pop())

    def _find(self, tags, bounds):
        for i in range(len(self.stack) - 1, -1, -1):
            t = self.stack[i].tag
            if t in tags:
                return i
            if t in bounds:
                return -1
        return -1

    def _open(self, tag, attrs, void):
        parent = self.stack[-1] if self.stack else None
        if parent is not None:
            parent.flush(True)
        el = _Open(tag, self.n, len(self.stack), parent.tag if parent else None,
                   {k: ("" if v is None else v) for k, v in attrs})
        self.n += 1
        if void:
            self._emit(el)
        else:
            self.stack.append(el)

    # -- parser callbacks ----------------------------------------------------
    def handle_starttag(self, tag, attrs):
        if tag in CLOSES_P:
            i = self._find({"p"}, SCOPE_TAGS)
            if i >= 0:
                self._pop_to(i)
        rule = IMPLIED.get(tag)
        if rule:
            i = self._find(*rule)
            if i >= 0:
                self._pop_to(i)
        self._open(tag, attrs, tag in VOID_TAGS)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS and self.stack and self.stack[-1].tag == tag:
            self._emit(self.stack.pop())

    def handle_endtag(self, tag):
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i].tag == tag:
                self._pop_to(i)
                return

    def handle_data(self, data):
        if self.stack:
            self.stack[-1].pending.append(data)

    def finish(self):
        self.close()
        self._pop_to(0)
        self.rows.sort(key=lambda r: r[0])
        return self.rows


def parse_document(html: str | None) -> tuple[str, list]:
    """``ok`` or ``failed`` (no document, or a parser error) and the element
    tuples of one document."""
    if html is None:
        return "failed", []
    p = ElementParser()
    try:
        p.feed(html)
        return "ok", p.finish()
    except Exception:
        return "failed", []


def parse_elements(html: str | None) -> list:
    """Element tuples of one document; see :func:`parse_document`."""
    return parse_document(html)[1]


_PATH = re.compile(r"^//(?:(?P<parent>[A-Za-z][\w-]*|\*)/)?(?P<tag>[A-Za-z][\w-]*|\*)(?:\[(?P<pred>.*)\])?$")
_EQ = re.compile(r"""^\s*text\(\)\s*=\s*(?P<q>['"])(?P<v>.*)(?P=q)\s*$""")
_CONTAINS = re.compile(r"""^\s*contains\(\s*text\(\)\s*,\s*(?P<q>['"])(?P<v>.*)(?P=q)\s*\)\s*$""")


class Path(NamedTuple):
    """``//tag`` or ``//parent/tag`` (``*`` is any), with an optional test
    of the text: ``eq`` any direct text node, ``contains`` the first."""

    tag: str
    parent: str | None
    test: str | None
    value: str | None

    def matches(self, tag: str, parent: str | None, texts: list) -> bool:
        if self.tag not in ("*", tag) or (self.parent and (parent is None or self.parent not in ("*", parent))):
            return False
        if self.test == "eq":
            return self.value in texts
        return self.test is None or bool(texts) and self.value in texts[0]


def parse_path(path: str) -> Path:
    """Unsupported paths raise."""
    m = _PATH.match(path.strip())
    if not m:
        raise ValueError(f"unsupported path: {path}")
    test = value = None
    if m["pred"]:
        eq, contains = _EQ.match(m["pred"]), _CONTAINS.match(m["pred"])
        if not (eq or contains):
            raise ValueError(f"unsupported predicate: {m['pred']}")
        test, value = ("eq", eq["v"]) if eq else ("contains", contains["v"])
    return Path(m["tag"].lower(), m["parent"] and m["parent"].lower(), test, value)


MATCH = T.StructType(
    [
        T.StructField("attrs", T.MapType(T.StringType(), T.StringType())),
        T.StructField("texts", T.ArrayType(T.StringType())),
        T.StructField("text", T.StringType()),
        T.StructField("href", T.StringType()),
    ]
)


#: The most documents, and signs of HTML (or one document), parsed at a time:
#: what a worker holds doesn't grow with Arrow's batches.
CHUNK_DOCS, CHUNK_SIGNS = 256, 1 << 20


def _chunks(batch: pa.RecordBatch, html_col: str) -> Iterator[tuple[pa.RecordBatch, list[tuple[str, list]]]]:
    """Parts of a batch without the HTML, with each document's status and elements."""
    at, size, html = 0, 0, batch.column(html_col)
    rest = batch.drop_columns([html_col])
    signs = pc.fill_null(pc.binary_length(html), 0).to_pylist()
    for i, n in enumerate([*signs, CHUNK_SIGNS]):
        if i > at and (size + n > CHUNK_SIGNS or i - at == CHUNK_DOCS or i == len(signs)):
            yield rest.slice(at, i - at), [parse_document(h) for h in html.slice(at, i - at).to_pylist()]
            at, size = i, 0
        size += n


_KINDS = {"ord": pa.int32(), "depth": pa.int32(), "attrs": pa.map_(pa.string(), pa.string()), "texts": pa.list_(pa.string())}
_PLACES = {f.name: i for i, f in enumerate(ELEMENT_FIELDS)}


def _columns(rows: list[tuple], names: list[str]) -> list[pa.Array]:
    out = []
    for name in names:
        values = [r[_PLACES[name]] for r in rows]
        if name == "attrs":
            values = [None if a is None else list(a.items()) for a in values]
        out.append(pa.array(values, _KINDS.get(name, pa.string())))
    return out


def _with_lists(docs: pa.RecordBatch, status: list[str], name: str, found: list[list[tuple]], names: list[str]) -> pa.RecordBatch:
    """The documents with their status and, as one array each, elements."""
    ends = pa.array([0, *accumulate(len(rows) for rows in found)], pa.int32())
    elements = pa.StructArray.from_arrays(_columns([r for rows in found for r in rows], names), names)
    columns = [*docs.columns, pa.array(status, pa.string()), pa.ListArray.from_arrays(ends, elements)]
    return pa.RecordBatch.from_arrays(columns, [*docs.schema.names, "status", name])


def html_matches(docs: DataFrame, path: str, id_col: str = "doc_id", html_col: str = "html") -> DataFrame:
    """X1/X2 in one narrow pass: every column of ``docs`` but the HTML, with
    ``status`` (``ok`` or ``failed``) and ``matches``, the elements of the
    path in document order. Only they leave the Python worker."""
    wanted = parse_path(path)
    keep = [c for c in docs.columns if c != html_col]
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField("status", T.StringType()), T.StructField("matches", T.ArrayType(MATCH))])

    def run(batches):
        for batch in batches:
            for rest, parsed in _chunks(batch, html_col):
                found = [[r for r in rows if wanted.matches(r[2], r[3], r[5])] for _, rows in parsed]
                yield _with_lists(rest, [how for how, _ in parsed], "matches", found, MATCH.names)

    return docs.select(*keep, html_col).mapInArrow(run, schema)


def html_trees(docs: DataFrame, full: frozenset[str] | None, html_col: str = "html") -> DataFrame:
    """Every column of ``docs`` but the HTML, with ``status`` and ``elements``,
    all elements in document order. What is beside their place and tag leaves
    the Python worker only for the tags in ``full`` (None: for all)."""
    keep = [c for c in docs.columns if c != html_col]
    element = T.StructType([f for f in ELEMENT_FIELDS if f.name in ("ord", "depth", "tag")] + MATCH.fields)
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField("status", T.StringType()), T.StructField("elements", T.ArrayType(element))])

    def run(batches):
        bare = (None,) * (len(ELEMENT_FIELDS) - 3)
        for batch in batches:
            for rest, parsed in _chunks(batch, html_col):
                found = [[r if full is None or r[2] in full else (*r[:3], *bare) for r in rows] for _, rows in parsed]
                yield _with_lists(rest, [how for how, _ in parsed], "elements", found, element.names)

    return docs.select(*keep, html_col).mapInArrow(run, schema)


def html_elements(docs: DataFrame, id_col: str = "doc_id", html_col: str = "html") -> DataFrame:
    """One row per element: ``(id, ord, depth, tag, parent_tag, attrs,
    texts, text, href)``. ``texts`` are the element's direct text nodes,
    ``text`` the text before its first child (``None`` when empty)."""
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType)] + ELEMENT_FIELDS)
    names = [f.name for f in ELEMENT_FIELDS]

    def run(batches):
        for batch in batches:
            for rest, parsed in _chunks(batch, html_col):
                of = pa.array([i for i, (_, rows) in enumerate(parsed) for _ in rows], pa.int64())
                rows = [r for _, rows in parsed for r in rows]
                yield pa.RecordBatch.from_arrays([rest.column(0).take(of), *_columns(rows, names)], [id_col, *names])

    return docs.select(id_col, html_col).mapInArrow(run, schema)


def link_fast_path(docs: DataFrame, id_col: str, html_col: str, pattern: str) -> DataFrame:
    """X3 fast path for a fixed markup shape: ``posexplode`` of a regex's
    group 1, entities unescaped. No Python worker."""
    from postroom.functions.html import unescape_basic

    return docs.select(
        id_col, F.posexplode(F.regexp_extract_all(F.col(html_col), F.lit(pattern), 1)).alias("pos", "href")
    ).withColumn("href", unescape_basic(F.col("href")))
