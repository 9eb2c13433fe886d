"""Near-duplicates by bottom-k sketches of one hash function, confirmed on full shingle sets.

Each document keeps the ``SKETCH`` smallest hashes of its shingle set. Of the bottom k of a union,
each value lies in both sets with the sets' Jaccard similarity, so a pair at the limit shares fewer
than ``least_common(k)`` of them with a chance below ``LOSS``. Equal sets are one class, which gets a
number; the rest works on classes.

Inverted lists: of its ``KEYS`` smallest values a class is listed under its rarest ones only, so many
that two sets with ``least_common`` values in common still meet in a list (prefix filter). Within a
list, pairs whose sizes and union sketches allow the limit are likely. A list gives no pairs but what
connects its likely ones: a few rows a member, however large the group. Components of all that are
the loose components; two linked classes always are in one.

The likely pairs that came out are confirmed by intersecting full sets, the sets of a class's
partners streaming past its own. Where a loose component then still has more than one label, its
full sets, each sent once as a rule, meet in cells, and intersections of classes with different
labels are counted exactly by products of 0/1 matrices. Again only what connects labels comes out.
In a component the members of the most frequent label meet the others, never each other.

Lists longer than ``PART_ROWS`` and components of more than ``PART_VALUES`` values are cut into parts
and all pairs of parts meet, each in a task of its own; a class with many partners has them dealt to
parts of ``PART_PAIRS``. Components are found by large-star / small-star over tables in the shared
folder.

Defined results: a text without words has an empty set, is linked with nothing and kept; a null
``doc_id`` is no candidate for a component's name, and a component without any id is named null
(all its rows are kept); rows that share an id each go by their own text; repeated rows one row each;
an empty table gives no rows; other columns are never read. Texts of any length are read whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postroom.llm import common
from postroom.llm.simhash import _union, components

WORDS, PERCENT = 5, 80
#: Smallest hashes that are listed, and kept for union sketches.
KEYS, SKETCH = 28, 32
#: The chance that a sketch hides a pair that is just similar enough.
LOSS = 1e-9
#: Classes in a list up to which all its pairs are tried at once; rows of a part of a longer list.
SHORT_ROWS, PART_ROWS = 64, 4096
#: Partners of a class that one task confirms, and pairs held at a time.
PART_PAIRS, BLOCK_PAIRS = 512, 50_000
#: Rows of lists that a task holds at a time; values of a part of a component; sides of a product.
HELD_ROWS, PART_VALUES, TILE_ROWS, TILE_VALUES = 20_000, 1_000_000, 512, 4096
#: Words of a sketch's bits.
BIT_WORDS = 8
#: Bytes of a hash that a sketch holds, and the value that fills the place of those a small set doesn't have.
VALUE_BYTES = 3
NONE = np.uint32(0xFFFFFF)
LOWER = bytes.maketrans(bytes(range(0x41, 0x5B)), bytes(range(0x61, 0x7B)))


def least_common(k: int, percent: int = PERCENT, loss: float = LOSS) -> int:
    """The largest t so that of k values, each common with a chance of ``percent``, fewer than t are
    with a chance of at most ``loss``."""
    p, below, t = percent / 100, 0.0, 0
    while t < k and (below := below + math.comb(k, t) * p**t * (1 - p) ** (k - t)) <= loss:
        t += 1
    return t


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def shingle_sets(texts: list[str], words: int) -> list[np.ndarray]:
    """The sorted hashes of each text's distinct shingles."""
    held = [t.encode().translate(LOWER).split() for t in texts]
    size = np.fromiter(map(len, held), np.int64, len(held))
    flat = [w for h in held for w in h]
    if not flat:
        return [np.zeros(0, np.uint64)] * len(texts)
    kind, distinct = pd.factorize(np.array(flat, object))
    word = np.fromiter(map(xxhash.xxh3_64_intdigest, distinct), np.uint64, len(distinct))[kind]
    n = len(word)
    every = np.zeros(max(0, n - words + 1), np.uint64)
    for k in range(words):
        every = mixed(every * np.uint64(0x9E3779B97F4A7C15) + word[k : k + len(every)])
    out, at = [], 0
    for k in size.tolist():
        if k >= words:
            out.append(np.unique(every[at : at + k - words + 1]))
        else:
            one = np.zeros(min(k, 1), np.uint64)
            for w in word[at : at + k]:
                one = mixed(one * np.uint64(0x9E3779B97F4A7C15) + w)
            out.append(one)
        at += k
    return out


def set_id(held: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(held.tobytes())


def signature(held: np.ndarray) -> bytes:
    """The ``SKETCH`` smallest hashes, their upper bytes: those keep the order, and values that are
    equal by chance can only make a pair look more similar."""
    out = np.full(SKETCH, NONE)
    low = np.minimum(held[:SKETCH] >> np.uint64(64 - 8 * VALUE_BYTES), np.uint64(NONE - 1))
    out[: len(low)] = low
    return out.view(np.uint8).reshape(SKETCH, 4)[:, :VALUE_BYTES].tobytes()


def values(signatures: list[bytes]) -> np.ndarray:
    """The signatures' values, a row each."""
    wide = np.zeros((len(signatures), SKETCH, 4), np.uint8)
    wide[:, :, :VALUE_BYTES] = np.frombuffer(b"".join(signatures), np.uint8).reshape(-1, SKETCH, VALUE_BYTES)
    return wide.reshape(-1, 4 * SKETCH).view(np.uint32)


def sketches(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``doc_id, n, sid, keys, sig``: set size, set id (null for an empty set), smallest hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in common.chunks(batch, ["doc_id", "text"]):
                sets = shingle_sets(texts, words)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(ids, pa.int64()), "n": pa.array([len(s) for s in sets], pa.int64()),
                    "sid": pa.array([set_id(s) if len(s) else None for s in sets], pa.binary()),
                    "keys": pa.array([s[:KEYS].view(np.int64) for s in sets], pa.list_(pa.int64())), "sig": pa.array([signature(s) for s in sets], pa.binary()),
                })

    return docs.select("doc_id", "text").mapInArrow(common.lean(run), "doc_id long, n long, sid binary, keys array<long>, sig binary")


def full_sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """``cid, held``: the sets of the classes ``wanted`` (cid, sid, least), from the texts anew."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for (texts,) in common.chunks(batch, ["text"]):
                sets = shingle_sets(texts, words)
                yield pa.RecordBatch.from_pydict({"sid": pa.array([set_id(s) for s in sets], pa.binary()), "held": pa.array([s.tobytes() for s in sets], pa.binary())})

    # an id may be shared by texts of which only some are wanted: the set id decides
    ids = common.small(wanted.select(F.col("least").alias("doc_id")).where("doc_id is not null").distinct())
    rows = docs.select("doc_id", "text").join(ids, "doc_id", "left_semi")
    if not wanted.where("least is null").isEmpty():
        rows = rows.unionByName(docs.select("doc_id", "text").where("doc_id is null"))
    found = rows.select("text").mapInArrow(common.lean(run), "sid binary, held binary")
    return found.join(common.small(wanted.select("sid", "cid")), "sid").select("cid", "held").dropDuplicates(["cid"])


def postings(classes: DataFrame, percent: int) -> DataFrame:
    """``key, cid, df``: the rarest of each class's smallest values, as many as the prefix filter
    asks for, without those that no other class has; df is how many classes have the value."""
    keyed = classes.select("cid", F.explode("keys").alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("df")).where("df > 1")
    ranked = keyed.join(shared, "key").groupBy("cid").agg(F.sort_array(F.collect_list(F.struct("df", "key"))).alias("ranked"))
    n, m = F.col("n"), F.least(F.col("n"), F.lit(KEYS))
    # a set that is whole in its sketch, and too small for partners that aren't, shares its part
    least = F.when(100 * n < percent * (KEYS + 1), F.ceil(n * percent / 100)).otherwise(F.lit(least_common(KEYS, percent)))
    # values of its own come first in its order; they are in no list
    take = (m - least + 1 - (m - F.size("ranked"))).cast("int")
    held = ranked.join(classes.select("cid", "n"), "cid").withColumn("take", take).where("take > 0")
    return held.select("cid", F.explode(F.slice("ranked", F.lit(1), F.col("take"))).alias("r")).select("r.key", "cid", "r.df")


class Rows:
    """Rows of lists as arrays: class numbers, sizes, signatures, and whatever else they carry."""

    def __init__(self, batch: pa.Table):
        batch = batch.combine_chunks()
        self.count = batch.num_rows
        self.cid = batch.column("cid").to_numpy()
        self.sig = values(batch.column("sig").to_pylist())
        self.n = batch.column("n").to_numpy()
        self.table = batch
        # the sketch's values as bits: two sketches share no more values than bits, but for those
        # of one sketch that fall on the same bit
        real = self.sig != NONE
        bits = np.zeros((self.count, 64 * BIT_WORDS), bool)
        bits[np.nonzero(real)[0], self.sig[real] % (64 * BIT_WORDS)] = True
        self.bits = np.packbits(bits, axis=1, bitorder="little").view(np.uint64).reshape(self.count, BIT_WORDS)
        self.slack = real.sum(1) - bits.sum(1)

    def column(self, name: str) -> np.ndarray:
        return self.table.column(name).to_numpy()

    def pairs(self, i: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({side: pa.array(self.cid[at], pa.int64()) for side, at in (("a", i), ("b", j))})


def union_sketch(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many of the bottom ``SKETCH`` values of each pair's union are in both, and how many of
    all values of the two sketches."""
    both = np.sort(np.concatenate([a, b], axis=1), axis=1)
    real = both != NONE
    again = np.zeros(both.shape, bool)
    again[:, 1:] = (both[:, 1:] == both[:, :-1]) & real[:, 1:]
    rank = np.cumsum(real & ~again, axis=1, dtype=np.int16)
    return (again & (rank <= SKETCH)).sum(1), again.sum(1)


def _allowed(rows: Rows, i: np.ndarray, j: np.ndarray, shared: np.ndarray, bottom: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs may be at the limit, given (at most) how many values their sketches share."""
    small, large = np.minimum(rows.n[i], rows.n[j]), np.maximum(rows.n[i], rows.n[j])
    # sets that are whole in their sketches are compared as they are
    return np.where(large <= SKETCH, 100 * shared >= percent * (small + large - shared), bottom >= least_common(SKETCH, percent))


def likely(rows: Rows, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs may be at the limit or above, by sizes, sketches' bits and union sketches."""
    at = np.flatnonzero(100 * np.minimum(rows.n[i], rows.n[j]) >= percent * np.maximum(rows.n[i], rows.n[j]))
    most = np.bitwise_count(rows.bits[i[at]] & rows.bits[j[at]]).sum(1, dtype=np.int64) + np.minimum(rows.slack[i[at]], rows.slack[j[at]])
    at = at[_allowed(rows, i[at], j[at], most, most, percent)]
    out = np.zeros(len(i), bool)
    if len(at):
        bottom, shared = union_sketch(rows.sig[i[at]], rows.sig[j[at]])
        out[at] = _allowed(rows, i[at], j[at], shared, bottom, percent)
    return out


def _ranges(first: np.ndarray, last: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of each row with rows first to last (not included), in blocks."""
    n = np.maximum(last - first, 0)
    ends = np.cumsum(n)
    at = 0
    while at < len(n):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BLOCK_PAIRS, "right")))
        held = n[at:stop]
        i = np.repeat(np.arange(at, stop), held)
        yield i, np.arange(len(i)) + np.repeat(first[at:stop] - (np.cumsum(held) - held), held)
        at = stop


def _lists(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[Rows]:
    """Whole lists, some thousand rows at a time; the rows come sorted by ``key``."""
    held: list[pa.RecordBatch] = []
    rows = 0

    def cut(last: bool) -> Iterator[Rows]:
        nonlocal held, rows
        table = pa.Table.from_batches(held).combine_chunks()
        stop = table.num_rows
        if not last:
            # the last list may go on in the next batch
            same = np.ones(stop, bool)
            for k in key:
                values = table.column(k).to_numpy()
                same &= values == values[-1]
            stop = int(np.argmax(same))
        if stop:
            yield Rows(table.slice(0, stop))
        held, rows = table.slice(stop).to_batches(), table.num_rows - stop

    for batch in batches:
        if len(batch):
            held.append(batch)
            rows += len(batch)
        if rows >= HELD_ROWS:
            yield from cut(False)
    if rows:
        yield from cut(True)


def _starts(rows: Rows, key: list[str]) -> np.ndarray:
    new = np.ones(rows.count, bool)
    if rows.count:
        new[1:] = False
        for k in key:
            values = rows.column(k)
            new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def candidates(listed: DataFrame, percent: int, short_rows: int = SHORT_ROWS, part_rows: int = PART_ROWS) -> DataFrame:
    """``a, b, real`` for the lists ``key, cid, df, n, sig``: pairs that connect what the likely pairs
    of each list connect; real: the pair is itself likely. A list over ``part_rows`` is cut into
    parts, and all pairs of parts meet."""
    parts = F.ceil(F.col("df") / part_rows).cast("int")
    own = listed.withColumn("parts", parts).withColumn("p", F.pmod(F.xxhash64("cid"), F.col("parts")).cast("int"))
    dealt = own.withColumn("q", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "key", F.least("p", "q").alias("i"), F.greatest("p", "q").alias("j"), "cid", "n", "sig",
    )
    key = ["key", "i", "j"]

    def made(rows: Rows, i: list, j: list, real: bool) -> pa.RecordBatch:
        i, j = np.concatenate([np.zeros(0, np.int64), *i]), np.concatenate([np.zeros(0, np.int64), *j])
        batch = rows.pairs(np.minimum(i, j), np.maximum(i, j))
        return batch.append_column("real", pa.array(np.full(len(i), real)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _lists(batches, key):
            start = _starts(rows, key)
            size = np.diff(np.append(start, rows.count))
            label = np.arange(rows.count)
            found_i, found_j = [], []
            # short lists: all pairs at once; each class's first likely partner, and what connects all
            end = np.repeat(np.where(size <= short_rows, start + size, 0), size)
            for i, j in _ranges(label + 1, end):
                near = likely(rows, i, j, percent)
                i, j = i[near], j[near]
                label = _union(label, i, j)
                _, first = np.unique(j, return_index=True)
                found_i.append(i[first])
                found_j.append(j[first])
            joined = np.flatnonzero(label != np.arange(rows.count))
            if len(joined):
                yield made(rows, [joined], [label[joined]], False)
            # long ones: each class with those that nothing connects with it yet
            for a, n in zip(start[size > short_rows].tolist(), size[size > short_rows].tolist()):
                of = np.arange(n)
                for k in range(n - 1):
                    others = k + 1 + np.flatnonzero(of[k + 1 :] != of[k])
                    if not len(others):
                        continue
                    near = others[likely(rows, np.full(len(others), a + k), a + others, percent)]
                    if len(near):
                        found_i.append(np.full(len(near), a + k))
                        found_j.append(a + near)
                        of[np.isin(of, of[near])] = of[k]
            yield made(rows, found_i, found_j, True)

    found = dealt.repartition(*key).sortWithinPartitions(*key, "cid").mapInArrow(common.lean(run), "a long, b long, real boolean")
    return found.groupBy("a", "b").agg(F.max("real").alias("real"))


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose sets (cid, held) are similar enough."""
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / PART_PAIRS).cast("int").alias("parts"))
    dealt = pairs.join(parts, "a").select("a", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"), "b")
    first = parts.select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(None).cast("long").alias("b"))
    a_set, b_set = sets.select(F.col("cid").alias("a"), "held"), sets.select(F.col("cid").alias("b"), "held")
    both = first.join(a_set, "a").select("a", "part", "b", "held").unionByName(dealt.join(b_set, "b").select("a", "part", "b", "held"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = np.zeros(0, np.uint64)
        for batch in batches:
            found: list[tuple[int, int]] = []
            for a, b, raw in zip(*(batch.column(c).to_pylist() for c in (0, 2, 3))):
                held = np.frombuffer(raw, np.uint64)
                if b is None:
                    mine = held
                    continue
                shared = len(np.intersect1d(mine, held, assume_unique=True))
                if 100 * shared >= percent * (len(mine) + len(held) - shared):
                    found.append((a, b))
            yield pa.RecordBatch.from_pydict({side: pa.array([p[k] for p in found], pa.int64()) for k, side in enumerate("ab")})

    # a class's own set comes before those of its partners
    return both.repartition("a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first()).mapInArrow(common.lean(run), "a long, b long")


def _shared(sets: list[np.ndarray], others: list[np.ndarray]) -> np.ndarray:
    """How many values each set shares with each other one, exactly: products of 0/1 matrices, some
    values at a time."""
    size = np.array([len(x) for x in [*sets, *others]])
    owner = np.repeat(np.arange(len(size)), size)
    _, place, n = np.unique(np.concatenate([*sets, *others]), return_inverse=True, return_counts=True)
    # values that only one set has are shared with none
    common_ = n[place] > 1
    number = np.cumsum(n > 1) - 1
    owner, place = owner[common_], number[place[common_]]
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    out = np.zeros((len(sets), len(others)), np.int64)
    for low in range(0, int(place[-1]) + 1 if len(place) else 0, TILE_VALUES):
        a, b = np.searchsorted(place, [low, low + TILE_VALUES])
        held = np.zeros((len(size), TILE_VALUES), np.float32)
        held[owner[a:b], place[a:b] - low] = 1
        # whole numbers below 2^24 are exact in single precision
        out += (held[: len(sets)] @ held[len(sets) :].T).astype(np.int64)
    return out


def cells(members: DataFrame, sets: DataFrame, percent: int, part_values: int = PART_VALUES) -> DataFrame:
    """``a, b``: pairs that connect the labels of each loose component as far as links of its
    members connect them. ``members`` has cid, n, loose and label; sets has cid and held."""
    label = members.groupBy("loose", "label").agg(F.count("*").alias("m"), F.sum("n").alias("values"))
    each = label.groupBy("loose").agg(
        F.max_by("label", F.struct("m", "label")).alias("main"), F.count("*").alias("labels"), F.sum("m").alias("m"), F.sum("values").alias("values"),
        F.max_by("m", F.struct("m", "label")).alias("main_m"), F.max_by("values", F.struct("m", "label")).alias("main_values"),
    ).where("labels > 1")
    cut = lambda m, values: F.greatest(F.lit(1), F.ceil(values / part_values), F.ceil(m / PART_ROWS)).cast("int")
    each = each.select("loose", "main", cut(F.col("main_m"), F.col("main_values")).alias("x"), cut(F.col("m") - F.col("main_m"), F.col("values") - F.col("main_values")).alias("y"))
    rows = members.join(each, "loose")
    own = F.pmod(F.xxhash64("cid", F.lit(3)), F.when(F.col("label") == F.col("main"), F.col("x")).otherwise(F.col("y"))).cast("int")
    rows = rows.withColumn("own", own)
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    cell = lambda i, j: F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"))
    # of the main label: their part with every part of the others (i counts from -1 down)
    main = F.transform(upto("y"), lambda q: cell(-1 - F.col("own"), q))
    rest = F.concat(F.transform(upto("x"), lambda p: cell(-1 - p, F.col("own"))), F.transform(upto("y"), lambda q: cell(F.least(q, F.col("own")), F.greatest(q, F.col("own")))))
    dealt = rows.withColumn("cell", F.explode(F.when(F.col("label") == F.col("main"), main).otherwise(rest)))
    dealt = dealt.select(F.xxhash64("loose").alias("key"), "cell.i", "cell.j", "cid", "label", (F.col("label") == F.col("main")).alias("is_main")).join(sets, "cid")
    key = ["key", "i", "j"]

    def connect(rows: list[tuple]) -> tuple[list[int], list[int]]:
        """Rows of one cell: cid, label, is_main, set."""
        rows = sorted(rows, key=lambda r: (r[2], len(r[3]), r[0]))
        kind = pd.factorize(np.array([r[1] for r in rows], object))[0]
        first = np.unique(kind, return_index=True)[1]
        label, n = first[kind], np.array([len(r[3]) for r in rows])
        begun = label.copy()
        tiles = [np.arange(k, min(k + TILE_ROWS, len(rows))) for k in range(0, len(rows), TILE_ROWS)]
        for s, x in enumerate(tiles):
            for y in tiles[s:]:
                if len(np.unique(label[np.concatenate([x, y])])) == 1 or 100 * min(n[x].max(), n[y].max()) < percent * max(n[x].min(), n[y].min()):
                    continue
                shared = _shared([rows[k][3] for k in x], [rows[k][3] for k in y])
                i, j = np.nonzero(100 * shared >= percent * (n[x][:, None] + n[y] - shared))
                i, j = x[i], y[j]
                apart = label[i] != label[j]
                label = _union(label, i[apart], j[apart])
        joined = np.unique(begun[label[begun] != begun])
        return [rows[k][0] for k in label[joined]], [rows[k][0] for k in joined]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []

        def close() -> pa.RecordBatch:
            a, b = connect(held) if held else ([], [])
            return pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

        for batch in batches:
            for k, i, j, cid, name, is_main, raw in zip(*(batch.column(c).to_pylist() for c in (*key, "cid", "label", "is_main", "held"))):
                if (k, i, j) != at:
                    yield close()
                    at, held = (k, i, j), []
                held.append((cid, name, is_main, np.frombuffer(raw, np.uint64)))
        yield close()

    return dealt.repartition(*key).sortWithinPartitions(*key).mapInArrow(common.lean(run), "a long, b long")


def links(docs: DataFrame, classes: DataFrame, words: int, percent: int, short_rows: int = SHORT_ROWS, part_rows: int = PART_ROWS, part_values: int = PART_VALUES) -> DataFrame:
    """``a, b``: pairs that connect exactly the classes (cid, sid, least, n, keys, sig) that chains of
    links connect."""
    listed = common.staged(postings(classes, percent), "postings")
    found = common.staged(candidates(listed.join(classes.select("cid", "n", "sig"), "cid"), percent, short_rows, part_rows), "candidates")
    pairs = found.where("real").select("a", "b")
    loose = named(components(found.select("a", "b")), "loose")
    members = common.staged(loose.join(classes.select("cid", "sid", "n", "least"), "cid"), "loose-members")
    sets = common.staged(full_sets(docs, members.select("cid", "sid", "least"), words), "sets")
    sure = common.staged(confirmed(pairs, sets, percent), "links")
    # a component of two was confirmed or refuted by its one pair
    several = members.groupBy("loose").agg(F.count("*").alias("m")).where("m > 2").select("loose")
    label = named(components(sure), "label")
    members = members.join(several, "loose", "left_semi").join(label, "cid", "left").withColumn("label", F.coalesce("label", "cid"))
    return sure.unionByName(cells(common.staged(members, "labelled"), sets, percent, part_values))


def named(linked: DataFrame, name: str) -> DataFrame:
    """``cid`` and its component for every node, the components' own among them."""
    every = linked.unionByName(linked.select(F.col("component").alias("node"), "component").distinct())
    return common.staged(every.select(F.col("node").alias("cid"), F.col("component").alias(name)), name)


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, short_rows: int = SHORT_ROWS, part_rows: int = PART_ROWS, part_values: int = PART_VALUES) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for each row of ``docs``."""
    rows = common.staged(sketches(docs, words), "sketches")
    grouped = rows.where("sid is not null").groupBy("sid").agg(
        F.min("doc_id").alias("least"), F.any_value("n").alias("n"), F.any_value("keys").alias("keys"), F.any_value("sig").alias("sig")
    )
    # numbers are those of the written table, whatever is computed again
    classes = common.staged(grouped.withColumn("cid", F.monotonically_increasing_id()), "classes")
    linked = components(links(docs, classes, words, percent, short_rows, part_rows, part_values))
    # the smallest document of each component, over the few classes that are linked at all
    members = named(linked, "component").join(classes.select("cid", "least"), "cid")
    first = members.groupBy("component").agg(F.min("least").alias("first"))
    place = members.join(first, "component").select("cid", "first", F.lit(True).alias("linked"))
    place = classes.select("cid", "sid", "least").join(place, "cid", "left").select("sid", F.when(F.col("linked"), F.col("first")).otherwise(F.col("least")).alias("component_id"))
    full = rows.where("sid is not null").join(place, "sid").select("doc_id", "n", "component_id")
    empty = rows.where("sid is null").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return full.unionByName(empty).select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op11_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(common.table(spark, sf_dir, "documents"), words=2)
