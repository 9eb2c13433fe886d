"""Records over blocks: the same whatever splits a file is read in."""

import csv
import io
import json
import os
import random

import pytest

from postroom.operators.schema import load_schema
from postroom.sources import blocks as B
from postroom.sources import records as REC


@pytest.fixture
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    yield lambda n: spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def values(rng):
    signs = ['"', "\n", ",", "\\", "a", "é", " ", "\r\n", '""', "\n\n"]
    return "".join(rng.choice(signs) for _ in range(rng.randint(0, 12)))


def test_scan_agrees_with_the_csv_reader():
    rng = random.Random(1)
    g = B.QuotedLines()
    for _ in range(300):
        rows = [[values(rng) for _ in range(3)] for _ in range(4)]
        text = io.StringIO(newline="")
        csv.writer(text, lineterminator="\n", quoting=csv.QUOTE_ALL).writerows(rows)
        inside, ends = False, []
        for line in text.getvalue()[:-1].split("\n"):
            inside, _ = g.scan(line, inside)
            ends.append(inside)
        assert ends.count(False) == 4 and not ends[-1]
    # a quote within a bare value opens nothing; one that is never closed holds all that follows
    assert g.scan('a"b,c', False) == (False, 0) and g.scan('a,"b', False) == (True, 0) and g.scan('b"",x', True) == (True, 0)


@pytest.mark.parametrize("split, skip", [(600, 0), (900, 2), (1 << 20, 1)])
def test_quoted_records(spark, tmp_dir, small_splits, split, skip):
    rng = random.Random(split)
    want = []
    for n in range(2):
        rows = [[f"{n}-{i}", values(rng) if i % 5 else "long\n" * 40, f"z{values(rng)}"] for i in range(60)]
        with open(os.path.join(tmp_dir, f"f{n}.csv"), "w", newline="") as f:
            f.write("".join(["title of some length, longer than a block, quite long\n" * 1] * skip))
            csv.writer(f, lineterminator="\n", quoting=csv.QUOTE_ALL).writerows(rows)
        want += rows
    schema = load_schema([{"name": c, "type": "STRING"} for c in "abc"])[0]
    small_splits(split)
    got = REC.read_delimited(spark, tmp_dir, schema, skip_leading_rows=skip, allow_quoted_newlines=True, on_error="fail", null_marker="NONE", path_col="p")
    rows = got.collect()
    assert sorted([r.a, r.b, r.c] for r in rows) == sorted(want)
    assert all(r.p.endswith(f"f{r.a[0]}.csv") for r in rows)


def test_a_title_over_blocks(spark, tmp_dir, small_splits):
    with open(os.path.join(tmp_dir, "a.tsv"), "w") as f:
        f.write("T" * 300 + "\nH\n" + "".join(f"{i}\tx{i}\n" for i in range(50)))
    schema = load_schema([{"name": "k", "type": "INTEGER"}, {"name": "v", "type": "STRING"}])[0]
    small_splits(200)
    got = REC.read_delimited(spark, tmp_dir, schema, field_delimiter="tab", skip_leading_rows=2, on_error="fail")
    assert sorted(r.k for r in got.collect()) == list(range(50))


def json_values(rng, n):
    signs = ['"', "\\", "}", "{", "[", "]", "\n", "é", "x", " "]
    text = lambda: "".join(rng.choice(signs) for _ in range(rng.randint(0, 15)))
    return [{"a": i, "b": text(), "c": {"d": [text(), text()], "e": {"f": text()}}} for i in range(n)]


@pytest.mark.parametrize("split, indent", [(400, None), (900, 2)])
def test_json_arrays(spark, tmp_dir, small_splits, split, indent):
    rng = random.Random(split)
    want = json_values(rng, 80)
    for n in range(2):
        with open(os.path.join(tmp_dir, f"f{n}.json"), "w") as f:
            f.write(json.dumps(want[n::2], indent=indent, ensure_ascii=False))
    for name, text in (("empty.json", "[]"), ("none.json", "")):
        with open(os.path.join(tmp_dir, name), "w") as f:
            f.write(text)
    small_splits(split)
    got = [json.loads(r.value) for r in B.json_objects(spark, tmp_dir).collect()]
    assert sorted(got, key=lambda r: r["a"]) == want
    df = REC.read_json_records(spark, tmp_dir)
    assert sorted((r.a, r.c.d[0]) for r in df.collect()) == [(w["a"], w["c"]["d"][0]) for w in want]


def test_a_cut_array_fails(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "a.json"), "w") as f:
        f.write('[{"a": 1}, {"a": 2')
    with pytest.raises(Exception, match="ends within its array"):
        B.json_objects(spark, tmp_dir).collect()
