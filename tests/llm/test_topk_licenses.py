import hashlib
import random
import re
from importlib import metadata

import numpy as np

from postroom.llm import licenses, topk

from .conftest import frame


def embeddings(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, 0) for i, v in rows], "vec_id long, embedding array<float>, score int, shard int, part int")


def brute(rows, every, k):
    held = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            held.append((i, [int(np.floor(256 * float(np.float32(x)))) for x in v]))
    out = []
    for at, (i, q) in enumerate(held):
        if i % every == 0:
            found = sorted((-sum(a * b for a, b in zip(q, v)), j) for other, (j, v) in enumerate(held) if other != at)
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(found[:k])]
    return sorted(out)


def rows_of(rng, n, width):
    return [(i, [rng.gauss(0, 0.3) for _ in range(width)]) for i in range(n)]


def test_against_brute_force(spark):
    rng = random.Random(1)
    rows = rows_of(rng, 400, 24)
    rows += [(1000 + i, list(rows[i % 5][1])) for i in range(60)]  # ties
    rows += [rows[50], (2000, None), (2001, [float("nan")] * 24), (2002, [None] + [1.0] * 23), (2003, [float("inf")] * 24), (None, [1.0] * 24), (2050, [0.0] * 24), (2051, [1.0]), (2100, [])]
    for shard_rows, query_rows in ((8192, 8192), (37, 3)):
        held = topk.vectors(embeddings(spark, rows))
        got = topk.top_k(held.where("vec_id % 50 = 0"), held, 5, shard_rows, query_rows).collect()
        assert sorted(tuple(r) for r in got) == brute(rows, 50, 5)


def test_few_and_none(spark):
    held = topk.vectors(embeddings(spark, [(0, [1.0]), (50, [2.0])]))
    assert sorted(tuple(r) for r in topk.top_k(held, held, 5).collect()) == [(0, 1, 50, 131072), (50, 1, 0, 131072)]
    # rows of one id are all searched and asked
    held = topk.vectors(embeddings(spark, [(2, [0.1, 0.0]), (2, [9.0, 0.0]), (50, [1.0, 0.0]), (50, [1.0, 0.0])]))
    got = sorted(tuple(r) for r in topk.top_k(held.where("vec_id = 50"), held, 2).collect())
    assert got == [(50, 1, 2, 589824), (50, 1, 2, 589824), (50, 2, 50, 65536), (50, 2, 50, 65536)]
    none = topk.vectors(embeddings(spark, []))
    assert topk.top_k(none, none).count() == 0


def canonical(text):
    out = []
    for line in (text or "").lower().split("\n"):
        if re.search(r"^[^\w©(]*(copyright *(\(c\)|©|[0-9<\[{]|by )|\(c\) *\w|© *\w|all rights reserved)", line):
            continue
        words = re.sub(r"[\W_]+", " ", line).strip().split(" ")
        if joined := " ".join(licenses.SPELLINGS.get(w, w) for w in words):
            out.append(joined)
    return out


def test_scan(spark, odd_rows, no_docs):
    mit = licenses.KNOWN["MIT"][1]
    changed = "Copyright (c) 2020 Someone\n\n" + mit.upper().replace(". ", ".\n").replace("SUBLICENSE", "sublicence").replace(",", " ;")
    notice = "LICENCED under the Apache Licence -- version 2.0"
    rows = odd_rows + [(100, changed, "en", "a"), (101, f"text before\n{notice}\nafter", "en", "a"), (102, notice, "en", "a"), (102, notice, "en", "a"), (103, mit + " And more.", "en", "a"), (104, "All rights reserved.", "en", "a")]
    got = licenses.license_scan(frame(spark, rows), licenses.known_licenses(spark)).collect()
    assert sorted((str(r["doc_id"]), r["digest"]) for r in got) == sorted((str(i), hashlib.sha256(" ".join(canonical(t)).encode()).hexdigest()) for i, t, _, _ in rows)
    by = {r["doc_id"]: r for r in got}
    assert by[100]["license"] == "MIT" and by[102]["license"] == "Apache-2.0" and by[103]["license"] is None and by[104]["license"] is None
    assert by[101]["license"] is None and by[101]["line_licenses"] == "Apache-2.0" and by[101]["n_license_lines"] == 1
    assert sum(r["doc_id"] == 102 and r["n_license_lines"] == 1 for r in got) == 2
    assert licenses.license_scan(no_docs, licenses.known_licenses(spark)).count() == 0
    empty = licenses.known_licenses(spark).limit(0)
    assert all(r["license"] is None and not r["n_license_lines"] for r in licenses.license_scan(frame(spark, rows), empty).collect())


MIT_FILE = """MIT License

Copyright (c) 2024 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""


def test_license_files_and_other_notices(spark):
    # unmodified files of installed packages; those that aren't installed are left out
    wanted = [("requests", "LICENSE", "Apache-2.0"), ("idna", "LICENSE.md", "BSD-3-Clause"), ("zstandard", "LICENSE", "BSD-3-Clause"), ("xxhash", "LICENSE", "BSD-2-Clause"), ("pytest", "LICENSE", "MIT")]
    files = [("MIT", MIT_FILE)]
    for package, name, license in wanted:
        try:
            files += [(license, f.read_text()) for f in metadata.files(package) or [] if f.name == name and "dist-info" in str(f)]
        except metadata.PackageNotFoundError:
            pass
    lines = [("MIT", "This project is licensed under the MIT License."), ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"), ("MPL-2.0", "Distributed under the terms of the Mozilla Public License, version 2.0"), ("CC-BY-4.0", "This work is licensed under a text")]
    rows = [(i, t, "en", "a") for i, (_, t) in enumerate(files)] + [(100 + i, f"before\n{t}\nafter", "en", "a") for i, (_, t) in enumerate(lines)]
    got = {r["doc_id"]: r for r in licenses.license_scan(frame(spark, rows), licenses.known_licenses(spark)).collect()}
    assert [got[i]["license"] for i in range(len(files))] == [name for name, _ in files]
    assert [got[100 + i]["line_licenses"] for i in range(len(lines))] == ["MIT", "GPL-2.0", "MPL-2.0", ""]
