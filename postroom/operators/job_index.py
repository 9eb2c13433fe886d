"""Routing to thousands of jobs by an index of their predicates.

``routing.route_messages`` evaluates every job on every message, which is right for tens of jobs.
Here each job stands in an index under one thing that its messages must have:

- a piece of the text it looks for in sender, subject or recipient, the piece that fewest jobs share;
- else its label, its time window, or both together. A window is cut into dyadic intervals, at most two
  of each length, so that a message's time lies in one of them and is found by equality;
- else nothing: such jobs meet every message, which they match as a rule.

A message's own pieces, labels and intervals are looked up by an equi-join, each job found is checked
in full against the message, and a job is found once a message at most. Only lengths, columns and
labels that jobs use are looked up. The index goes to the messages' tasks while its bytes are few;
beyond that both sides are shuffled by the key.

Results are those of ``route_messages``: null columns of a message match no predicate on them, a job
given twice counts twice, no jobs give no rows. Rows hold headers, not bodies, when they are looked up.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postroom.functions.timewin import UNIX_EPOCH, in_window
from postroom.operators.routing import is_true

#: Code points of a piece, at most.
PIECE = 4
#: Seconds about the epoch that intervals cover: 2 ** SPAN, half of them before it.
SPAN = 36
#: An index of so many bytes goes to every task.
BROADCAST_BYTES = 32 << 20
#: The columns that jobs look for texts in, and how a job calls them; what tells most comes first.
TEXTS = {"sender": "from", "subject": "subject", "recipient": "to"}
INDEX = "_kind string, _piece string, _level int, _node long, _job string, _from string, _subject string, _to string, _label string, _after long, _before long, _attachment boolean"


def _needles(job: Mapping) -> dict[str, str]:
    found = {k: str(job[k]).lower() for k in ("from", "to") if job.get(k)}
    if job.get("subject"):
        found["subject"] = str(job["subject"]).strip("*").lower()
    return found


def _pieces(needle: str) -> set[str]:
    n = min(PIECE, len(needle))
    return {needle[i : i + n] for i in range(len(needle) - n + 1)} if n else set()


def dyadic(low: int, high: int) -> Iterator[tuple[int, int]]:
    """``(level, node)`` of the intervals ``[node << level, (node + 1) << level)`` that make up ``[low, high)``."""
    level = 0
    while low < high:
        if low & 1:
            yield level, low
            low += 1
        if high & 1:
            high -= 1
            yield level, high
        low, high, level = low >> 1, high >> 1, level + 1


def _place(second: int) -> int:
    return min(max(second + (1 << SPAN - 1), 0), (1 << SPAN) - 1)


def index_rows(jobs: Sequence[Mapping]) -> list[tuple]:
    """The index, a row for each job and thing that it stands under."""
    shared = Counter((c, p) for j in jobs for c, k in TEXTS.items() for p in _pieces(_needles(j).get(k, "")))
    rows = []
    for j in jobs:
        held = _needles(j)
        after, before = (None if j.get(k) is None else int(j[k]) for k in ("after", "before"))
        full = (str(j["job"]), held.get("from"), held.get("subject"), held.get("to"), j.get("label") or None, after, before, j.get("attachment") is not None and is_true(j["attachment"]))
        under = [(shared[c, p], -len(p), i, c, p) for i, (c, k) in enumerate(TEXTS.items()) for p in _pieces(held.get(k, ""))]
        if under:
            *_, column, piece = min(under, key=lambda u: (u[0], u[1], u[2], u[4]))
            rows.append((column, piece, None, None, *full))
        elif after is None and before is None:
            rows.append(("label", j.get("label") or "", None, None, *full))
        else:
            low = 0 if after is None else _place(after)
            high = 1 << SPAN if before is None else _place(before - 1) + 1
            # a window that ends before it begins is none, wherever its ends are placed
            if after is None or before is None or after < before:
                rows += [("time", j.get("label") or "", level, node, *full) for level, node in dyadic(low, high)]
    return rows


def _lookups(messages: DataFrame, rows: list[tuple]) -> DataFrame:
    """``messages`` with a row for each ``_key`` of theirs that the index may hold, each key once. Only
    numbers are exploded; the keys are made from them afterwards, in generated code."""
    one, text_lengths = F.lit(1), {c: sorted({len(r[1]) for r in rows if r[0] == c}) for c in TEXTS}
    plain = {kind: {bool(r[1]) for r in rows if r[0] == kind} for kind in ("label", "time")}
    levels = sorted({r[2] for r in rows if r[0] == "time"})
    empty = F.array().cast("array<string>")

    def labels(kind: str) -> Column:
        own = F.filter(F.array_distinct("label_ids"), lambda x: x.isNotNull() & (x != "")) if True in plain[kind] else empty
        own = F.coalesce(own, empty)
        return F.concat(own, F.array(F.lit(""))) if False in plain[kind] else own

    held = {f"_{c}_text": F.lower(F.col(c)) for c, lengths in text_lengths.items() if lengths}
    held |= {f"_{kind}_labels": labels(kind) for kind in plain if plain[kind]}
    if levels:
        micros = F.timestamp_diff("MICROSECOND", F.lit(UNIX_EPOCH).cast("timestamp_ntz"), F.col("internal_ts").cast("timestamp_ntz"))
        seconds = ((micros - F.pmod(micros, F.lit(1_000_000))) / 1_000_000).cast("long")
        held["_second"] = F.least(F.greatest(seconds + (1 << SPAN - 1), F.lit(0)), F.lit((1 << SPAN) - 1))

    none, no_level, no_node = F.lit(None).cast("long"), F.lit(None).cast("int"), F.lit(None).cast("long")
    parts: list[tuple[Column, Callable[[Column], Column]]] = []
    for c, lengths in text_lengths.items():
        for n in lengths:

            def piece(i: Column, c: str = c, n: int = n) -> Column:
                found = F.substring(F.col(f"_{c}_text"), i + one, F.lit(n))
                # where a piece stands again it has been looked up
                return F.when(F.call_function("instr", F.col(f"_{c}_text"), found) == i + one, _key(F.lit(c), found, no_level, no_node))

            parts.append((F.length(f"_{c}_text") - (n - 1), piece))
    if plain["label"]:
        parts.append((F.size("_label_labels"), lambda i: _key(F.lit("label"), F.get("_label_labels", i), no_level, no_node)))
    if levels:

        def interval(i: Column) -> Column:
            level = F.get(F.array(*[F.lit(x) for x in levels]), i % len(levels))
            label = F.get("_time_labels", F.floor(i / len(levels)).cast("int"))
            return _key(F.lit("time"), label, level, F.call_function("shiftright", F.col("_second"), level))

        parts.append((F.when(F.col("_second").isNotNull(), F.size("_time_labels") * len(levels)), interval))

    begin, key = F.lit(0), F.when(F.lit(False), none)
    for k, (_, made) in enumerate(parts):
        end = begin + F.col(f"_n{k}")
        key, begin = key.when(F.col("_i") < end, made(F.col("_i") - begin)), end
    counted = messages.withColumns(held).withColumns({f"_n{k}": F.greatest(F.coalesce(n, F.lit(0)), F.lit(0)) for k, (n, _) in enumerate(parts)})
    total = begin
    return counted.where(total > 0).withColumn("_i", F.explode(F.sequence(F.lit(0), total - 1))).withColumn("_key", key)


def _key(kind: Column, piece: Column, level: Column, node: Column) -> Column:
    """Unequal things with one key cost a check, never a result."""
    return F.xxhash64(kind, piece, level.cast("int"), node.cast("long"))


def _fits() -> Column:
    def has(column: str, needle: str) -> Column:
        return F.col(needle).isNull() | F.coalesce(F.lower(F.col(column)).contains(F.col(needle)), F.lit(False))

    found = has("sender", "_from") & has("subject", "_subject") & has("recipient", "_to")
    found = found & (F.col("_label").isNull() | F.coalesce(F.array_contains("label_ids", F.col("_label")), F.lit(False)))
    return found & in_window("internal_ts", F.col("_after"), F.col("_before")) & (~F.col("_attachment") | F.coalesce("has_attachment", F.lit(False)))


def route_many(messages: DataFrame, jobs: Sequence[Mapping]) -> DataFrame:
    """One row per (message, matching job), as ``route_messages`` gives."""
    kept = [c for c in messages.columns if c != "job"]
    rows = index_rows(jobs)
    if not rows:
        return messages.withColumn("job", F.lit(None).cast("string")).limit(0)
    index = messages.sparkSession.createDataFrame(rows, INDEX)
    index = index.withColumn("_key", _key(F.col("_kind"), F.col("_piece"), F.col("_level"), F.col("_node"))).drop("_kind", "_piece", "_level", "_node")
    if sum(100 + sum(len(x) for x in r if isinstance(x, str)) * 4 for r in rows) <= BROADCAST_BYTES:
        index = F.broadcast(index)
    looked = _lookups(messages.select(*[F.col(f"`{c}`") for c in kept]), rows)
    return looked.join(index, "_key").where(_fits()).select(*[F.col(f"`{c}`") for c in kept], F.col("_job").alias("job"))
