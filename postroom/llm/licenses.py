"""License scans by canonical digests.

A text is normalised line by line: lower case, copyright lines dropped, every run of signs other
than letters and numbers one space, equivalent spellings replaced. Its lines joined by spaces are
digested, so line breaks don't matter, and the digest of the entire text is hash-joined with those
of the known licences: full texts, which are data files, and notices, made of their names. Each
single line is digested and joined as well, which finds notices inside longer texts. All with
DataFrame functions.

Defined results: null and empty texts have the digest of nothing and no licence; a row of the
documents gives one row, equal rows equal ones; without known licences nothing is found; an empty
table gives no rows; other columns are never read. Texts of any length are read whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from importlib import resources
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postroom.llm import common

#: Spellings that count as the same, from the public guidelines for matching licences.
SPELLINGS = {
    "acknowledgement": "acknowledgment", "analogue": "analog", "analyse": "analyze", "artefact": "artifact",
    "authorisation": "authorization", "authorised": "authorized", "calibre": "caliber", "cancelled": "canceled",
    "capitalisations": "capitalizations", "catalogue": "catalog", "categorise": "categorize", "centre": "center",
    "emphasised": "emphasized", "favour": "favor", "favourite": "favorite", "fulfil": "fulfill", "initialise": "initialize",
    "judgement": "judgment", "labelling": "labeling", "labour": "labor", "licence": "license", "licenced": "licensed",
    "maximise": "maximize", "modelled": "modeled", "modelling": "modeling", "noncommercial": "non commercial", "offence": "offense",
    "optimise": "optimize", "organisation": "organization", "organise": "organize", "practise": "practice",
    "programme": "program", "realise": "realize", "recognise": "recognize", "signalling": "signaling",
    "sublicence": "sublicense", "utilisation": "utilization", "whilst": "while", "wilful": "willful", "http": "https",
}
#: What a copyright line begins with, after signs, in lower case.
COPYRIGHT = r"^[^\p{L}\p{N}©(]*(copyright *(\(c\)|©|[0-9<\[{]|by )|\(c\) *[0-9\p{L}]|© *[0-9\p{L}]|all rights reserved)"
SIGNS = r"[^\p{L}\p{N}]+"
#: Known licences and notices; the SQL has these only. ``license_texts`` holds the full
#: texts, a file for each licence.
KNOWN = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0."],
    "MIT": [
        "Released under the MIT License.",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED
"AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY
CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ],
    "ISC": [
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED
"AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL
DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE
OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    ],
    "0BSD": [
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT,
OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
SOFTWARE.""",
    ],
}

#: Lines that a full text's title takes, and other titles that are in use.
TITLE_LINES = {
    "0BSD": 1, "Apache-2.0": 3, "Artistic-1.0-Perl": 1, "BSD-2-Clause": 1, "BSD-3-Clause": 1, "BSL-1.0": 1, "CC-BY-3.0": 2, "CC0-1.0": 2, "GFDL-1.2": 2, "GFDL-1.3": 2,
    "GPL-1.0": 2, "GPL-2.0": 2, "GPL-3.0": 2, "ISC": 1, "LGPL-2.0": 2, "LGPL-2.1": 2, "LGPL-3.0": 2, "MIT": 1, "MPL-1.1": 2, "MPL-2.0": 1, "Zlib": 1,
}
TITLES = {
    "0BSD": ["BSD Zero Clause License", "Zero-Clause BSD License", "0BSD License"],
    "BSD-2-Clause": ["The BSD 2-Clause License", "BSD 2-Clause \"Simplified\" License", "The 2-Clause BSD License", "Simplified BSD License", "BSD License"],
    "BSD-3-Clause": ["The BSD 3-Clause License", "BSD 3-Clause \"New\" or \"Revised\" License", "The 3-Clause BSD License", "New BSD License", "BSD License"],
    "ISC": ["The ISC License", "ISC License (ISC)"], "MIT": ["The MIT License (MIT)", "The MIT License", "MIT License (MIT)"],
    "Unlicense": ["The Unlicense", "Unlicense"], "Zlib": ["The zlib License", "zlib/libpng License"],
}
#: Equivalent passages of full texts; any choice of them is the same licence;
#: passages with a bar are parts that change together.
PASSAGES = {
    "BSD": [
        [
            "THE COPYRIGHT HOLDERS AND CONTRIBUTORS|THE COPYRIGHT HOLDER OR CONTRIBUTORS", "THE COPYRIGHT HOLDERS AND CONTRIBUTORS|THE COPYRIGHT OWNER OR CONTRIBUTORS",
            "THE COPYRIGHT HOLDERS AND CONTRIBUTORS|THE COPYRIGHT HOLDERS OR CONTRIBUTORS", "THE AUTHOR AND CONTRIBUTORS|THE AUTHOR OR CONTRIBUTORS",
            "THE AUTHORS AND CONTRIBUTORS|THE AUTHORS OR CONTRIBUTORS", "THE REGENTS AND CONTRIBUTORS|THE REGENTS OR CONTRIBUTORS",
        ],
        ["the name of the copyright holder nor", "the name of the copyright holders nor", "the names of the copyright holders nor", "the name of the copyright owner nor", "the name of the author nor", "the name of the University nor"],
    ],
    "ISC": [["and/or distribute", "and distribute"]],
    "GPL": [["51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA", "59 Temple Place, Suite 330, Boston, MA 02111-1307 USA", "675 Mass Ave, Cambridge, MA 02139, USA"]],
}
#: What a licence is called in notices of one line, and the words around it.
NAMES = {
    "0BSD": ["BSD Zero Clause License", "Zero-Clause BSD License"], "AGPL-3.0": ["GNU Affero General Public License, version 3", "GNU AGPLv3", "AGPLv3", "AGPL v3"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache-2.0 License", "Apache 2.0", "Apache License v2.0"],
    "BSD-2-Clause": ["BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License"], "BSD-3-Clause": ["BSD 3-Clause License", "3-Clause BSD License", "New BSD License"],
    "BSL-1.0": ["Boost Software License, Version 1.0", "Boost Software License 1.0"], "CC0-1.0": ["CC0", "CC0 1.0", "CC0 1.0 Universal", "Creative Commons CC0 1.0 Universal License"],
    "CC-BY-3.0": ["CC BY 3.0", "Creative Commons Attribution 3.0 Unported License"],
    "CC-BY-4.0": ["CC BY 4.0", "Creative Commons Attribution 4.0 International License", "Creative Commons Attribution 4.0 License"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License", "Creative Commons Attribution-NonCommercial 4.0 License"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License", "Creative Commons Attribution-ShareAlike 4.0 License"],
    "GPL-2.0": ["GNU General Public License, version 2", "GNU General Public License v2.0", "GNU GPL version 2", "GNU GPLv2", "GPLv2", "GPL v2"],
    "GPL-3.0": ["GNU General Public License, version 3", "GNU General Public License v3.0", "GNU GPL version 3", "GNU GPLv3", "GPLv3", "GPL v3"],
    "ISC": ["ISC License"], "LGPL-2.1": ["GNU Lesser General Public License, version 2.1", "GNU LGPL version 2.1", "LGPLv2.1", "LGPL v2.1"],
    "LGPL-3.0": ["GNU Lesser General Public License, version 3", "GNU LGPL version 3", "LGPLv3", "LGPL v3"], "MIT": ["MIT License", "MIT Licence", "MIT"],
    "MPL-2.0": ["Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "MPL 2.0"], "Unlicense": ["Unlicense"], "Zlib": ["zlib License"],
}
SUBJECTS = ["", *[f"This {x} is " for x in ("work", "software", "project", "program", "package", "library", "file", "code", "document")]]
VERBS = ["licensed under", "released under", "distributed under", "available under"]
ARTICLES = ["", "the ", "the terms of the "]


def normalised_lines(text: Column) -> Column:
    """The lines of a text that have something left, normalised."""
    same = F.create_map(*[F.lit(x) for pair in SPELLINGS.items() for x in pair])

    def one(line: Column) -> Column:
        plain = F.trim(F.regexp_replace(line, SIGNS, " "))
        words = F.transform(F.split(plain, " "), lambda w: F.coalesce(F.try_element_at(same, w), w))
        return F.when(line.rlike(COPYRIGHT), "").otherwise(F.array_join(words, " "))

    return F.filter(F.transform(F.split(F.lower(F.coalesce(text, F.lit(""))), "\n"), one), lambda x: x != "")


def digests(rows: DataFrame, text: str = "text") -> DataFrame:
    """``rows`` with ``lines`` (digests of its normalised lines) and ``digest`` of the entire text."""
    held = rows.withColumn("_lines", normalised_lines(F.col(text)))
    return held.withColumns({"digest": F.sha2(F.array_join("_lines", " "), 256), "lines": F.transform("_lines", lambda x: F.sha2(x, 256))}).drop("_lines")


def _choices(text: str, passages: list[list[str]]) -> Iterator[str]:
    """``text`` with every choice of the equivalent passages it has."""

    def words(part: str) -> re.Pattern[str]:
        return re.compile(r"\s+".join(map(re.escape, part.split(" "))))

    held = [p for p in passages if words(p[0].split("|")[0]).search(text)]
    for chosen in product(*held):
        out = text
        for p, new in zip(held, chosen):
            for old_part, new_part in zip(p[0].split("|"), new.split("|")):
                out = words(old_part).sub(new_part, out)
        yield out


def full_texts() -> Iterator[tuple[str, str]]:
    """``license, text`` of all full texts: with their title, another one or none, with and without
    instructions after the terms, numbers of conditions, and in equivalent passages."""
    for file in sorted(resources.files("postroom.llm").joinpath("license_texts").iterdir(), key=lambda f: f.name):
        name = file.name.removesuffix(".txt")
        lines = file.read_text("utf-8").splitlines()
        begin = [i for i, x in enumerate(lines) if x.strip()][TITLE_LINES.get(name, 0)]
        titles, body = ["", "\n".join(lines[:begin]), *TITLES.get(name, [])], "\n".join(lines[begin:])
        bodies = [body]
        if len(parts := re.split(r"(\n[ =-]*END OF TERMS AND CONDITIONS[ =-]*\n|\n(?=ADDENDUM: ))", body)) > 1:
            bodies += [parts[0], parts[0] + parts[1]]
        if name.startswith("BSD"):
            bodies.append(re.sub(r"(?m)^[0-9]\. ", "* ", body))
        family = name.removeprefix("L").split("-")[0]
        for title, one in product(titles, bodies):
            for text in _choices(one, PASSAGES.get(family, [])):
                yield name, f"{title}\n\n{text}"


def notices() -> Iterator[tuple[str, str]]:
    """``license, text`` of notices of one line."""
    for name, called in NAMES.items():
        for words in product(SUBJECTS, VERBS, ARTICLES, called):
            yield name, f"{words[0]}{words[1]} {words[2]}{words[3]}"
        for end in ("", "-only", "-or-later") if "GPL" in name else ("",):
            yield name, f"SPDX-License-Identifier: {name}{end}"


def known_licenses(spark: SparkSession, known: dict[str, list[str]] | None = None) -> DataFrame:
    given = [(name, text) for name, texts in (KNOWN if known is None else known).items() for text in texts]
    if known is None:
        given += [*full_texts(), *notices()]
    return spark.createDataFrame(given, "license string, text string")


def license_scan(docs: DataFrame, known: DataFrame) -> DataFrame:
    """``doc_id, digest, license`` (of the entire text, or null), ``n_license_lines`` and
    ``line_licenses`` (names, sorted, with commas) for each row of ``docs``; ``known`` has ``license``
    and ``text``."""
    c = F.col
    table = digests(known).where(F.size("lines") > 0).groupBy("digest").agg(F.min("license").alias("license"))
    table = common.small(common.staged(table, "licenses"))
    rows = digests(docs.select("doc_id", "text")).withColumn("key", F.sha2(F.coalesce("text", F.lit("")), 256)).drop("text")
    lines = rows.select("doc_id", "key", F.posexplode("lines").alias("at", "digest")).join(table, "digest")
    # equal rows have equal lines at equal places: each counts once
    found = lines.groupBy("doc_id", "key", "at").agg(F.min("license").alias("license")).groupBy("doc_id", "key").agg(
        F.count("*").alias("n_license_lines"), F.array_join(F.array_sort(F.collect_set("license")), ",").alias("line_licenses")
    )
    whole = rows.drop("lines").join(table, "digest", "left")
    return whole.join(found.withColumnsRenamed({"doc_id": "_id", "key": "_key"}), c("doc_id").eqNullSafe(c("_id")) & (c("key") == c("_key")), "left").select(
        "doc_id", "digest", "license", F.coalesce("n_license_lines", F.lit(0).cast("long")).alias("n_license_lines"), F.coalesce("line_licenses", F.lit("")).alias("line_licenses")
    )


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(common.table(spark, sf_dir, "documents"), known_licenses(spark))


def _sql_text(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_PLAIN = f"trim(regexp_replace(x, {_sql_text(SIGNS)}, ' ', 'g'))"
_SAME = "CASE w " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in SPELLINGS.items()) + " ELSE w END"
_LINES = f"""list_filter(list_transform(string_split(lower(coalesce(text, '')), chr(10)), lambda x:
    CASE WHEN regexp_matches(x, {_sql_text(COPYRIGHT)}) THEN '' ELSE array_to_string(list_transform(string_split({_PLAIN}, ' '), lambda w: {_SAME}), ' ') END), lambda x: x <> '')"""
OP7_SQL = f"""
WITH known(license, text) AS (VALUES {", ".join(f"({_sql_text(k)}, {_sql_text(t)})" for k, texts in KNOWN.items() for t in texts)}),
t AS (SELECT sha256(array_to_string({_LINES}, ' ')) AS digest, min(license) AS license FROM known GROUP BY 1),
d AS (SELECT row_number() OVER () AS n, doc_id, {_LINES} AS lines FROM documents),
f AS (
  SELECT n, count(*) AS k, string_agg(DISTINCT t.license, ',' ORDER BY t.license) AS names
  FROM (SELECT n, sha256(unnest(lines)) AS digest FROM d) JOIN t USING (digest) GROUP BY n
)
SELECT doc_id, sha256(array_to_string(lines, ' ')) AS digest, t.license AS license, CAST(coalesce(f.k, 0) AS BIGINT) AS n_license_lines,
  coalesce(f.names, '') AS line_licenses
FROM d LEFT JOIN f USING (n) LEFT JOIN t ON t.digest = sha256(array_to_string(d.lines, ' '))
"""
