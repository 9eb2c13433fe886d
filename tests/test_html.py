"""HTML elements, path selection, extraction and discrepancy parsing
(FIXTURES.md 4)."""

import pytest
from pyspark.sql import functions as F

from postroom.operators import html_select as H
from postroom.operators.discrepancies import parse_discrepancies
from postroom.sources.html import parse_elements


def docs(spark, *htmls):
    return spark.createDataFrame([(i, h) for i, h in enumerate(htmls)], "doc_id long, html string")


@pytest.mark.parametrize(
    "path,html,expected",
    [
        ("//li/a", '<ul><li><a href="/x">f</a></li></ul><p><a href="/y">g</a></p>', ["/x"]),
        ("//a[text()='here']", '<a href="/x">here</a><a href="/y">there</a>', ["/x"]),
        ("//td/a[contains(text(),'txt')]", '<table><tr><td><a href="/x">a.txt</a><a href="/y">b.csv</a></td></tr></table>', ["/x"]),
        ("//li/a", '<ul><li><a href="/a?x=1&amp;y=2">1</a><li><a href="/b">2</a></ul>', ["/a?x=1&y=2", "/b"]),
    ],
)
def test_links(spark, path, html, expected):
    got = H.extract_links(docs(spark, html), path).orderBy("pos").collect()
    assert [r.href for r in got] == expected


def test_last_text(spark):
    d = docs(spark, "<p><b>one</b></p><p><b> two </b></p>", "<p>no strong</p>")
    got = {r.doc_id: r.value for r in H.extract_last(d, "//p/b", "text()").collect()}
    assert got == {0: "two", 1: None}
    got = {r.doc_id: r.value for r in H.extract_last(d, "//strong", "text()").collect()}
    assert got == {0: None, 1: None}


def test_parser_rules():
    rows = parse_elements('<div><p>a<p>b<ul><li>x<li>y</ul><script>var t="</p>";</script><br><img src=z></div>')
    by = [(r[2], r[3]) for r in rows]
    assert by == [("div", None), ("p", "div"), ("p", "div"), ("ul", "div"), ("li", "ul"), ("li", "ul"), ("script", "div"), ("br", "div"), ("img", "div")]
    texts = {r[2]: (r[5], r[6]) for r in parse_elements("<p>head<b>x</b>tail</p>")}
    assert texts["p"] == (["head", "tail"], "head")


def test_links_or_body(spark):
    d = docs(spark, '<li><a href="/x">x</a></li>', '<li><a href="/y">y</a></li>', "<p>no links</p>")
    d = d.unionByName(spark.createDataFrame([(3, None)], d.schema))
    got = sorted((r.doc_id, r.kind, r.href) for r in H.links_or_body(d, "//li/a", with_path=F.col("doc_id") != 1).collect())
    assert got == [(0, "link", "/x"), (1, "body", None), (3, "body", None)]
    assert H.links_or_body(d, None).where("kind = 'body'").count() == 4


BODY = """<div><p>Checking time 2024-01-02 03:04:05 with result: unmatched at 2024-01-01 00:00:00</p>
<p>Transaction in BQ NOT FOUND : a1, b2</p></div>"""


def test_discrepancies(spark):
    no_ts = "<div><p>Checking with result: nothing</p><p>Transaction in XY NOT FOUND : z</p></div>"
    two_colons = "<div><p>x with result: y</p><p>Transaction in BQ NOT FOUND : a: b</p></div>"
    no_result = "<div><p>Transaction in BQ NOT FOUND : a</p></div>"
    d = docs(spark, BODY, no_ts, two_colons, no_result)
    d = d.unionByName(spark.createDataFrame([(4, "<ul></ul>"), (5, None), (6, "")], d.schema))
    recs, errs = parse_discrepancies(d, "2024-01-05")
    got = sorted(tuple(r) for r in recs.collect())
    assert got == [
        (0, "2024-01-02 03:04:05", "2024-01-01 00:00:00", "BQ NOT FOUND", "a1"),
        (0, "2024-01-02 03:04:05", "2024-01-01 00:00:00", "BQ NOT FOUND", "b2"),
        (1, "2024-01-05", "2024-01-05", "XY NOT FOUND", "z"),
    ]
    assert sorted(r.doc_id for r in errs.collect()) == [2, 3, 4, 5, 6]


def test_attach_password(spark):
    from postroom.operators.html_select import attach_password

    bodies = spark.createDataFrame([("m1", "<p><b>pw1</b></p><p><b> pw2 </b></p>"), ("m2", "<p>none</p>")], "message_id string, html string")
    pw = H.extract_last(bodies, "//p/b", "text()", id_col="message_id")
    files = spark.createDataFrame([("m1", "a.zip"), ("m1", "b.zip"), ("m2", "c.zip")], "message_id string, file_name string")
    got = sorted((r.file_name, r.zip_password) for r in attach_password(files, pw).collect())
    assert got == [("a.zip", "pw2"), ("b.zip", "pw2"), ("c.zip", None)]


def test_link_fast_path_equals_parser_on_pages(spark):
    from pyspark.sql import functions as F

    from postroom.sources.html import link_fast_path

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select(F.col("page_id").alias("doc_id"), "html")
    fast = link_fast_path(pages, "doc_id", "html", r'<li><a href="([^"]*)"')
    parsed = H.extract_links(pages, "//li/a")
    assert sorted(tuple(r) for r in fast.collect()) == sorted(tuple(r) for r in parsed.collect())
