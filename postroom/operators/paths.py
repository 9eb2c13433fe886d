"""Paths of any number of steps over HTML.

A path is a chain of ``/tag`` (child) and ``//tag`` (descendant) steps, ``*``
for any tag. A step may have tests in brackets: a place among its parent's
children of that tag (``[2]``, first only), ``[text()='v']``,
``[contains(text(),'v')]``, ``[@name]`` and ``[@name='v']``.

Elements come in document order, so the open ancestors of each are a stack, by
depth. The structural join is one pass with that stack: an entry says which
steps its element matches, and which it or any element around it does; a child
step asks the former of the parent, a descendant step the latter. Each
document is one row and nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postroom.sources.html import html_trees


class Step(NamedTuple):
    child: bool
    tag: str
    place: int | None
    #: (what is tested, attribute name, value)
    tests: tuple[tuple[str, str | None, str | None], ...]


_STEP = re.compile(r"""(//|/)([A-Za-z][\w-]*|\*)((?:\[(?:[^\]'"]|'[^']*'|"[^"]*")*\])*)""")
_TEST = re.compile(r"""\[((?:[^\]'"]|'[^']*'|"[^"]*")*)\]""")
_KINDS = (
    ("place", re.compile(r"""^(?P<v>[1-9]\d*)$""")),
    ("equals", re.compile(r"""^text\(\)\s*=\s*(?P<q>['"])(?P<v>.*)(?P=q)$""")),
    ("contains", re.compile(r"""^contains\(\s*text\(\)\s*,\s*(?P<q>['"])(?P<v>.*)(?P=q)\s*\)$""")),
    ("attribute", re.compile(r"""^@(?P<name>[\w-]+)(?:\s*=\s*(?P<q>['"])(?P<v>.*)(?P=q))?$""")),
)
#: Steps are bits of a whole number.
MOST_STEPS = 30


def parse_steps(path: str) -> list[Step]:
    """The steps of a path; a path that isn't one raises ``ValueError``."""
    steps, at, text = [], 0, path.strip()
    while at < len(text):
        m = _STEP.match(text, at)
        if not m:
            raise ValueError(f"unsupported path: {path}")
        place, tests = None, []
        for inner in _TEST.findall(m[3]):
            kind, found = next(((k, f) for k, r in _KINDS if (f := r.match(inner.strip()))), (None, None))
            if found is None or (kind == "place" and (tests or place)):
                raise ValueError(f"unsupported test: [{inner}]")
            if kind == "place":
                place = int(found["v"])
            else:
                tests.append((kind, found.groupdict().get("name", "").lower() or None if kind == "attribute" else None, found["v"]))
        steps.append(Step(m[1] == "/", m[2].lower(), place, tuple(tests)))
        at = m.end()
    if not steps or len(steps) > MOST_STEPS:
        raise ValueError(f"unsupported path: {path}")
    return steps


def _passes(e: Column, step: Step) -> Column:
    ok = F.lit(True)
    for kind, name, value in step.tests:
        if kind == "equals":
            ok = ok & F.array_contains(e["texts"], value)
        elif kind == "contains":
            ok = ok & F.get(e["texts"], F.lit(0)).contains(value)
        elif value is None:
            ok = ok & F.map_contains_key(e["attrs"], F.lit(name))
        else:
            ok = ok & (F.try_element_at(e["attrs"], F.lit(name)) == value)
    return F.coalesce(ok, F.lit(False))


def _bits(flags: list[Column], first: int = 0) -> Column:
    out = F.lit(0)
    for k, flag in enumerate(flags):
        out = out + F.when(flag, F.lit(1 << (first + k))).otherwise(F.lit(0))
    return out


def _has(bits: Column, place: int) -> Column:
    return bits.bitwiseAND(F.lit(1 << place)) != 0


def found_at(elements: Column, steps: list[Step]) -> Column:
    """The places (from 0) of the elements that the steps lead to."""
    each = F.transform(elements, lambda e: F.struct(
        e["depth"].alias("depth"),
        _bits([F.lit(True) if s.tag == "*" else e["tag"] == s.tag for s in steps]).alias("tag"),
        _bits([_passes(e, s) for s in steps]).alias("test"),
    ))
    none = F.array(*[F.lit(0)] * len(steps))
    entry = lambda own, around, counts: F.struct(own.alias("own"), around.alias("around"), counts.alias("counts"))
    placed = any(s.place for s in steps)

    def take(state: Column, e: Column) -> Column:
        # the document itself is the first entry, so a parent stands at its child's depth
        open_ = F.slice(state["stack"], F.lit(1), e["depth"] + 1)
        parent = F.get(open_, e["depth"])
        counts = F.array(*[F.get(parent["counts"], F.lit(k)) + F.when(_has(e["tag"], k), 1).otherwise(0) for k in range(len(steps))]) if placed else parent["counts"]
        flags = []
        for k, s in enumerate(steps):
            ok = _has(e["tag"], k) & _has(e["test"], k) & _has(parent["own"] if s.child else parent["around"], k)
            flags.append(ok & (F.get(counts, F.lit(k)) == s.place) if s.place else ok)
        own = _bits(flags, 1)
        above = F.concat(F.slice(state["stack"], F.lit(1), e["depth"]), F.array(entry(parent["own"], parent["around"], counts))) if placed else open_
        stack = F.concat(above, F.array(entry(own, parent["around"].bitwiseOR(own), none)))
        found = F.when(_has(own, len(steps)), F.concat(state["found"], F.array(state["n"]))).otherwise(state["found"])
        return F.struct(stack.alias("stack"), found.alias("found"), (state["n"] + 1).alias("n"))

    start = F.struct(F.array(entry(F.lit(1), F.lit(1), none)).alias("stack"), F.array().cast("array<int>").alias("found"), F.lit(0).alias("n"))
    return F.aggregate(each, start, take, lambda state: state["found"])


def _trees(docs: DataFrame, steps: list[list[Step]], html_col: str) -> DataFrame:
    told = [s.tag for path in steps for i, s in enumerate(path) if s.tests or i == len(path) - 1]
    return html_trees(docs, None if "*" in told else frozenset(told), html_col)


def _matches(steps: list[Step]) -> Column:
    return F.transform(found_at(F.col("elements"), steps), lambda i: F.get(F.col("elements"), i))


def path_matches(docs: DataFrame, path: str, html_col: str = "html") -> DataFrame:
    """Every column of ``docs`` but the HTML, with ``status`` (``ok`` or
    ``failed``) and ``matches``, the elements of the path in document order."""
    steps = parse_steps(path)
    return _trees(docs, [steps], html_col).withColumn("matches", _matches(steps)).drop("elements")


def paths_matches(docs: DataFrame, paths: Sequence[str], html_col: str = "html") -> DataFrame:
    """``path_matches`` of several paths, each document parsed once: a row a
    document and path, with ``path``."""
    steps = [parse_steps(path) for path in paths]
    trees = _trees(docs, steps, html_col)
    each = F.array(*[F.struct(F.lit(path).alias("path"), _matches(s).alias("matches")) for path, s in zip(paths, steps)])
    return trees.select(*[c for c in trees.columns if c != "elements"], F.inline(each))
