"""Paths of several steps."""

import pytest

from postroom.operators import html_select as H
from postroom.operators.paths import parse_steps, path_matches

HTML = """<html><body><div id="m"><p>one<b>x</b></p><section><p>two<b class="k">y</b><b>z</b></p></section></div>
<table><tr><td><a href="/1">in</a></td><td><div><a href="/2">out</a><a href="/3">out]</a></div></td></tr></table><a href="/4">in</a></body></html>"""


@pytest.mark.parametrize(
    "path,want",
    [
        ("//table//a", ["in", "out", "out]"]),
        ("//div/p/b", ["x"]),
        ("//div//p/b", ["x", "y", "z"]),
        ("//div//b[1]", ["x", "y"]),
        ("/html/body/a", ["in"]),
        ("/body/a", []),
        ("//body/*[2]//a[2]", ["out]"]),
        ("//div[@id='m']//b[@class]", ["y"]),
        ("//td//a[text()='out]']", ["out]"]),
        ("//p[contains(text(),'tw')]/b[2]", ["z"]),
        ("//table//table//a", []),
        ("//TD//*", ["in", None, "out", "out]"]),
    ],
)
def test_paths(spark, path, want):
    df = spark.createDataFrame([(1, HTML), (2, None), (3, "")], "doc_id long, html string")
    got = {r.doc_id: r for r in path_matches(df, path).collect()}
    assert [m.text for m in got[1].matches] == want
    assert got[2].status == "failed" and got[2].matches == [] and got[3].matches == []


@pytest.mark.parametrize("path", ["", "a", "//a[", "//a[last()]", "//a[text()='x'][2]", "//a/", "//a/@href"])
def test_refused(path):
    with pytest.raises(ValueError):
        parse_steps(path)


def test_links_take_any_path(spark):
    df = spark.createDataFrame([(1, HTML)], "doc_id long, html string")
    assert [r.href for r in H.extract_links(df, "//table//div/a").orderBy("pos").collect()] == ["/2", "/3"]
    assert H.extract_last(df, "//table//td/a", "text()").first().value == "in"
    assert [r.href for r in H.links_or_body(df, "/html/body/a").collect()] == ["/4"]


def test_two_tests_are_two_steps(spark):
    df = spark.createDataFrame([(1, "<p>a<b>c<a href='/1'>d</a></b></p><p>b<b>c<a href='/2'>d</a></b></p>")], "doc_id long, html string")
    assert [r.href for r in H.extract_links(df, "//p[text()='a']//a[text()='d']").collect()] == ["/1"]
    assert [r.href for r in H.extract_links(df, "/a").collect()] == []
