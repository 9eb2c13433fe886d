"""Records of files that are read in blocks, where a line is not a record
(SURVEY 2.1 S5b, S5c, S6).

A quoted value may hold line ends, and a JSON array may stand on one line.
Whether a place is inside a quoted value depends on all that comes before it
in the file, which is why such files are usually read by one task each. Here
they are read in Spark's splits, in two passes over a small automaton:

1. Each block (a file's split) is scanned from both start states, outside
   and inside quotes. What comes out, one row a block, is the state it ends
   in, how much deeper it ends, and how many records begin in it.
2. Block rows are composed in file order by window functions: the last block
   that ends in one state whatever it began with, and the parity of the
   blocks since then that swap the states, give every block's start state;
   running sums give its depth and the number of its first record.
3. Each block is cut, once, into records from its known start; the cut is
   written. Records that lie in one block come out as they are; pieces at the ends of blocks (two a block
   at most) are put together by a shuffle.

Pieces are lines for delimited text, and what ends with ``}`` for JSON, so
that a file of one line splits too. Only splits in which a piece begins have
a row. Results don't depend on how the files are split.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postroom.session import work_path

PATH = "_path"
#: Blocks whose start states are broadcast; more are joined by a shuffle.
BROADCAST_BLOCKS = 1_000_000


class QuotedLines:
    """Lines of delimited text. A quote opens a value only where a field
    begins; inside, a doubled quote is a quote."""

    end = "\n"

    def __init__(self, sep: str = ",", quote: str = '"'):
        self.sep, self.quote = sep, quote
        q = re.escape(quote)
        self.closing = re.compile(f"[^{q}]*+(?:{q}{q}[^{q}]*+)*+{q}", re.S)

    def base(self, piece: str) -> int:
        return 0

    def scan(self, piece: str, inside: bool) -> tuple[bool, int]:
        """Whether the piece ends inside quotes, and how much deeper."""
        if self.quote not in piece:
            return inside, 0
        at, size = 0, len(piece)
        while True:
            if inside or piece.startswith(self.quote, at):
                closed = self.closing.match(piece, at if inside else at + len(self.quote))
                if closed is None:
                    return True, 0
                inside, at = False, closed.end()
            at = piece.find(self.sep, at)
            if at < 0 or at >= size:
                return False, 0
            at += len(self.sep)


class JsonValues:
    """Pieces of JSON text up to and with a ``}``. Records are the objects of
    an array, or those that follow each other without one."""

    end = "}"
    _closing = re.compile(r'[^"\\]*+(?:\\.[^"\\]*+)*+"', re.S)
    _string = re.compile(r'"[^"\\]*+(?:\\.[^"\\]*+)*+"', re.S)

    def base(self, piece: str) -> int:
        """The depth at which a file's records stand, by its first sign."""
        return 1 if piece.lstrip("﻿ \t\r\n").startswith("[") else 0

    def scan(self, piece: str, inside: bool) -> tuple[bool, int]:
        text = piece + self.end
        if inside:
            closed = self._closing.match(text)
            if closed is None:
                return True, 0
            text = text[closed.end():]
        if '"' in text:
            text = self._string.sub("", text)
            cut = text.find('"')
            if cut >= 0:
                text, inside = text[:cut], True
            else:
                inside = False
        else:
            inside = False
        return inside, text.count("{") + text.count("[") - text.count("}") - text.count("]")


def _pieces(spark: SparkSession, path, end: str, encoding: str = "UTF-8") -> DataFrame:
    """``value, _path, _block, _row`` in file order within a partition. The
    encoding must be one in which ``end`` is one byte, the same as in ASCII."""
    value = F.col("value") if encoding.upper().replace("-", "") == "UTF8" else F.decode(F.col("value").cast("binary"), encoding)
    return spark.read.option("lineSep", end).text(path).select(
        value.alias("value"), F.col("_metadata.file_path").alias(PATH), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_row")
    )


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[list, int, int]]:
    """``[path, block]``, first row and number of rows, of each stretch of
    rows of one block: a path is as long as a line, and the same for many."""
    size, columns = batch.num_rows, [batch.column(PATH), batch.column("_block")]
    if not size:
        return
    paths, blocks = (pc.not_equal(c.slice(1), c.slice(0, size - 1)) for c in columns)
    cuts = [0, *(pc.indices_nonzero(pc.or_(paths, blocks)).to_numpy() + 1).tolist(), size]
    for first, end in zip(cuts, cuts[1:]):
        yield [c[first].as_py() for c in columns], first, end - first


_EFFECTS = f"{PATH} string, _block long, ends_out boolean, ends_in boolean, deeper_out long, deeper_in long, n_out long, n_in long, base int"


def _effects(pieces: DataFrame, grammar) -> DataFrame:
    """One row a block: where it leads from either start state."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        key, tracks, base = None, [], 0

        def close() -> None:
            if key is not None:
                (a, da, na), (b, db, nb) = tracks
                rows.append((*key, a, b, da, db, na, nb, base))

        for batch in batches:
            for at, first, size in _runs(batch):
                values = batch.column("value").slice(first, size).to_pylist()
                if at != key:
                    close()
                    key, tracks, base = at, [[False, 0, 0], [True, 0, 0]], grammar.base(values[0])
                (a, da, na), (b, db, nb) = tracks
                for value in values:
                    na, nb, same = na + (not a), nb + (not b), a == b
                    a, deeper = grammar.scan(value, a)
                    da += deeper
                    if not same:  # from one state the two go on as one
                        b, deeper = grammar.scan(value, b)
                    else:
                        b = a
                    db += deeper
                tracks = [[a, da, na], [b, db, nb]]
        close()
        yield pa.RecordBatch.from_pydict({name: pa.array([r[i] for r in rows], kind) for i, (name, kind) in enumerate(fields)})

    kinds = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_(), "int": pa.int32()}
    fields = [(name, kinds[kind]) for name, kind in (f.split() for f in _EFFECTS.split(", "))]
    return pieces.select("value", PATH, "_block").mapInArrow(run, _EFFECTS)


def block_starts(effects: DataFrame) -> DataFrame:
    """``_path, _block, inside, depth, first, base, last``: the state each
    block begins in, composed from the effects of all blocks before it."""
    order = Window.partitionBy(PATH).orderBy("_block")
    upto, before = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(Window.unboundedPreceding, -1)
    swaps = F.when(~F.col("ends_in") & F.col("ends_out"), 1).otherwise(0)
    known = F.when(F.col("ends_in") == F.col("ends_out"), F.struct(F.col("ends_out").alias("state"), F.col("swapped").alias("at")))
    told = effects.withColumn("swapped", F.sum(swaps).over(upto)).withColumn("known", F.last(known, ignorenulls=True).over(before))
    parity = (F.coalesce(F.lag("swapped").over(order), F.lit(0)) - F.coalesce(F.col("known.at"), F.lit(0))) % 2
    told = told.withColumn("inside", F.coalesce(F.col("known.state"), F.lit(False)) != (parity == 1))
    mine = lambda name: F.when(F.col("inside"), F.col(f"{name}_in")).otherwise(F.col(f"{name}_out"))
    return told.select(
        PATH, "_block", "inside", F.coalesce(F.sum(mine("deeper")).over(before), F.lit(0)).alias("depth"),
        F.coalesce(F.sum(mine("n")).over(before), F.lit(0)).alias("first"), F.first("base").over(upto).alias("base"),
        F.lead("_block").over(order).isNull().alias("last"),
    )


def _placed(pieces: DataFrame, starts: DataFrame) -> DataFrame:
    """Pieces with their block's start, still in order."""
    if starts.count() <= BROADCAST_BLOCKS:  # one row a block: a million are some 100 TB
        return pieces.join(F.broadcast(starts), [PATH, "_block"])
    return pieces.join(starts, [PATH, "_block"]).repartition(PATH, "_block").sortWithinPartitions(PATH, "_block", "_row")


WHOLE, TAIL, HEAD = 0, 1, 2
_CUT = f"{PATH} string, _block long, _index long, _kind int, value string"


def _cut(placed: DataFrame, grammar) -> DataFrame:
    """The records that lie in one block (``WHOLE``), and the pieces of others: the
    end of the one a block begins in (``TAIL``), and what is open at its end
    (``HEAD``; a ``TAIL`` too if the block lies within one record)."""
    end = grammar.end

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        key, held, kind = None, [], WHOLE
        inside, depth, base, index, last = False, 0, 0, 0, False

        def give(kind: int) -> None:
            out.append((*key, index, kind, end.join(held)))

        def close() -> None:
            if key is not None and held:
                give(TAIL if kind == TAIL else HEAD)
            elif last and base > 0:
                raise ValueError(f"{key[0]} ends within its array")

        for batch in batches:
            for at, start, size in _runs(batch):
                if at != key:
                    close()
                    inside, depth, first, base, last = (batch.column(c)[start].as_py() for c in ("inside", "depth", "first", "base", "last"))
                    key, held = at, []
                    open_ = inside or depth != base and key[1] > 0
                    kind, index = (TAIL, first - 1) if open_ else (WHOLE, first)
                for value in batch.column("value").slice(start, size).to_pylist():
                    held.append(value)
                    inside, deeper = grammar.scan(value, inside)
                    depth += deeper
                    if not inside and depth == base:
                        give(kind)
                        held, kind, index = [], WHOLE, index + 1
            if len(out) >= 1000:
                yield made(out)
                out.clear()
        close()
        yield made(out)

    def made(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.large_string())
        return pa.RecordBatch.from_pydict({f.split()[0]: pa.array([r[i] for r in rows], kinds[i]) for i, f in enumerate(_CUT.split(", "))})

    return placed.select("value", PATH, "_block", "inside", "depth", "first", "base", "last").mapInArrow(run, _CUT)


def _joined(pieces: DataFrame, end: str) -> DataFrame:
    """Records put together from their pieces. In file order a record's
    pieces are its head and the tails up to the next head."""
    order = Window.partitionBy(PATH).orderBy("_block", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    group = pieces.withColumn("_record", F.sum((F.col("_kind") == HEAD).cast("int")).over(order))
    held = group.groupBy(PATH, "_record").agg(F.min("_index").alias("_index"), F.sort_array(F.collect_list(F.struct("_block", "_kind", "value"))).alias("held"))
    return held.select(PATH, "_index", F.array_join(F.col("held.value"), end).alias("value"))


def block_records(spark: SparkSession, path, grammar, encoding: str = "UTF-8") -> DataFrame:
    """``_path, _index, value``: the records of the files at ``path``; for
    lines, _index counts a file's records from 0. The last of a file may be
    unfinished."""
    pieces = _pieces(spark, path, grammar.end, encoding)
    stage = work_path(spark, "blocks")
    effects = _effects(pieces, grammar)
    effects.write.parquet(stage)
    starts = block_starts(spark.read.schema(effects.schema).parquet(stage))
    cut = _cut(_placed(pieces, starts), grammar)
    # written: a load checks its records before it gives them, and cutting is dear
    stage = work_path(spark, "block-records")
    cut.write.parquet(stage)
    cut = spark.read.schema(cut.schema).parquet(stage)
    whole = cut.where(F.col("_kind") == WHOLE).select(PATH, "_index", "value")
    return whole.unionByName(_joined(cut.where(F.col("_kind") != WHOLE), grammar.end))


def quoted_records(spark: SparkSession, path, sep: str = ",", quote: str = '"', skip: int = 0, encoding: str = "UTF-8") -> DataFrame:
    """``_path, value``: the records of delimited files whose
    quoted values may hold line ends, without each file's first ``skip``
    records and without empty lines."""
    records = block_records(spark, path, QuotedLines(sep, quote), encoding).where(F.col("_index") >= skip)
    # a line may end with a carriage return; within a value it stays
    return records.select(PATH, F.regexp_replace("value", r"\r\z", "").alias("value")).where("value <> ''")


def json_objects(spark: SparkSession, path) -> DataFrame:
    """``_path, value``: the objects of files that hold a JSON array, or
    objects one after the other, as JSON text on one line. A file that ends
    within its array fails; what is left of any other is a value of its own."""
    records = block_records(spark, path, JsonValues())
    # between objects stand commas, brackets and space; line ends in JSON are space
    text = F.translate(F.regexp_replace("value", r"^[\x{FEFF}\s,\[\]]+", ""), "\r\n", "  ")
    records = records.select(PATH, text.alias("value")).where("trim(value) <> ''")
    return records.select(PATH, F.concat("value", F.lit("}")).alias("value"))
