"""Near-duplicates by SimHash, linked through BK-trees.

Fingerprints that differ in at most ``BITS`` bits are linked. A pair within that distance agrees on
all bits of at least ``t`` of ``BITS + t`` bands, so every pair meets in the shard of some agreeing
bands; ``t`` grows with the number of fingerprints so that a shard of even keys stays small. In each
shard the fingerprints form a BK-tree (children keyed by their Hamming distance to the parent), and
each one follows only the edges that can lead to its neighbours. A shard gives no pairs but a
spanning forest of its links, so a large group of near copies costs a row a fingerprint.

Shard trees travel by shuffle, not by broadcast: together they grow with the corpus. A shard above
``SHARD_ROWS`` fingerprints is cut into parts; a task then builds the trees of two parts at most.

Components are found by alternating large-star and small-star steps over tables in the shared
folder; nothing is collected.

Defined results: a null text, and one without words, has fingerprint zero and is linked like any
other; ``component_id`` is null where no row of a component has an id; repeated rows one row each; an empty table gives no rows; other columns are never read.
Texts of any length are read whole, with all repeated shingles.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postroom.llm import common

WORDS = 4
BITS = 4
SEED = 42
#: Fingerprints in a shard of even keys, about, and the size above which a shard is cut.
EVEN_ROWS = 300
SHARD_ROWS = 20_000
#: Pairs of a query and a node that a task holds at a time.
FRONTIER = 1_000_000
LOWER = bytes.maketrans(bytes(range(0x41, 0x5B)), bytes(range(0x61, 0x7B)))


def fingerprint(text: str, words: int = WORDS) -> int:
    held = text.encode().translate(LOWER).split()
    if not held:
        return 0
    if len(held) <= words:
        hashes = [xxhash.xxh64_intdigest(b" ".join(held), SEED)]
    else:
        # a shingle is a run of bytes of the words joined by single spaces
        joined = memoryview(b" ".join(held))
        ends = np.cumsum(np.fromiter(map(len, held), np.int64, len(held)) + 1)
        begin = np.append(0, ends[: -words]).tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], SEED) for a, b in zip(begin, (ends[words - 1 :] - 1).tolist())]
    total = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 65_536):
        part = np.array(hashes[k : k + 65_536], np.uint64)
        total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * total > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``doc_id, text_hash, fp``: the fingerprint as a signed long; a narrow pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in common.chunks(batch, ["doc_id", "text"]):
                found = np.array([fingerprint(t, words) for t in texts], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_pydict({"doc_id": pa.array(ids, pa.int64()), "text_hash": pa.array([common.text_hash(t) for t in texts], pa.int64()), "fp": pa.array(found)})

    return docs.select("doc_id", "text").mapInArrow(common.lean(run), "doc_id long, text_hash long, fp long")


class BKTrees:
    """BK-trees of many shards at once, as arrays. ``fp`` and ``shard`` of all nodes; a shard's
    nodes are one run. A node's children are a run of ``child``, ordered by their distance to it."""

    def __init__(self, fp: np.ndarray, shard: np.ndarray):
        self.fp = fp
        n = len(fp)
        self.root = np.flatnonzero(np.append(True, shard[1:] != shard[:-1])) if n else np.zeros(0, np.int64)
        parent, edge = np.full(n, -1), np.zeros(n, np.int64)
        size = np.diff(np.append(self.root, n))
        rest = np.setdiff1d(np.arange(n), self.root)
        at = np.repeat(self.root, size)[rest]
        while len(rest):
            # all that stand below the same node at the same distance: the first becomes its child
            far = np.bitwise_count(fp[rest] ^ fp[at]).astype(np.int64)
            group = at * 65 + far
            _, first, which = np.unique(group, return_index=True, return_inverse=True)
            parent[rest[first]], edge[rest[first]] = at[first], far[first]
            chosen = rest[first][which]
            stay = chosen != rest
            rest, at = rest[stay], chosen[stay]
        node = np.flatnonzero(parent >= 0)
        key = parent[node] * 65 + edge[node]
        order = np.argsort(key, kind="stable")
        self.child, self.key = node[order], key[order]

    def within(self, fp: np.ndarray, root: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Numbers of queries and of nodes within ``bits`` of them, in parts of bounded size; each
        query starts at the given root."""
        work = [(np.arange(len(fp)), root)]
        while work:
            query, node = work.pop()
            if len(query) > FRONTIER:
                half = len(query) // 2
                work += [(query[:half], node[:half]), (query[half:], node[half:])]
                continue
            far = np.bitwise_count(fp[query] ^ self.fp[node]).astype(np.int64)
            near = far <= bits
            if near.any():
                yield query[near], node[near]
            low = np.searchsorted(self.key, node * 65 + np.maximum(far - bits, 0))
            high = np.searchsorted(self.key, node * 65 + np.minimum(far + bits, 64), "right")
            n = high - low
            if total := int(n.sum()):
                ends = np.cumsum(n)
                work.append((np.repeat(query, n), self.child[np.arange(total) + np.repeat(low - (ends - n), n)]))


def _union(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after joining all a with b; a label is the smallest member's number."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return label
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(label[label], label):
            label = label[label]


def _forest(fp: np.ndarray, shard: np.ndarray, side: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the links in each shard. side: 0, 1 for the parts of a cut
    shard that meet here (then only links across them count), 2 for a whole one."""
    if not len(fp):
        return fp, fp
    start = np.flatnonzero(np.append(True, shard[1:] != shard[:-1]))
    size = np.diff(np.append(start, len(fp)))
    tree = BKTrees(fp, shard)
    label = np.arange(len(fp))
    ask = np.flatnonzero(side > 0)
    for query, node in tree.within(fp[ask], np.repeat(start, size)[ask], bits):
        query = ask[query]
        real = (query != node) & ((side[query] == 2) | (side[node] == 0))
        label = _union(label, query[real], node[real])
    joined = np.flatnonzero(label != np.arange(len(fp)))
    return fp[joined], fp[label[joined]]


def bands(rows: int, bits: int = BITS) -> tuple[int, list[tuple[int, ...]], list[int]]:
    """How many bands, the sets of bands that are keys, and where bands begin."""
    for t in range(1, 6):
        n = bits + t
        if rows / 2 ** (64 * t / n) <= EVEN_ROWS or t == 5:
            return n, list(combinations(range(n), t)), [round(64 * i / n) for i in range(n + 1)]
    raise AssertionError


def links(found: DataFrame, bits: int = BITS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Edges ``a, b`` between distinct fingerprints (column fp, one row each) that connect exactly
    what chains of pairs within ``bits`` connect."""
    n, sets, cut = bands(found.count(), bits)
    masks = [sum(((1 << (cut[i + 1] - cut[i])) - 1) << cut[i] for i in held) for held in sets]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keyed = found.select("fp", F.explode(F.array(*[F.struct(F.lit(k).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("v")) for k, m in enumerate(signed)])).alias("k")).select("fp", "k.*")

    # shards over the limit, few or none: their rows go to every pair of parts that theirs is in
    large = keyed.groupBy("t", "v").agg(F.count("*").alias("n")).where(F.col("n") > shard_rows)
    large = common.staged(large.withColumn("parts", F.ceil(F.col("n") / shard_rows).cast("int")).drop("n"), "large-shards")
    part = F.pmod(F.xxhash64("fp", F.lit(7)), F.col("parts")).cast("int")
    if large.isEmpty():
        dealt = keyed.select("fp", "t", "v", F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(2).alias("side"))
    else:
        own = keyed.join(common.small(large), ["t", "v"], "left").withColumn("p", F.when(F.col("parts").isNull(), F.lit(0)).otherwise(part))
        other = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("parts"), F.lit(1)) - 1))
        dealt = own.withColumn("q", other).select(
            "fp", "t", "v", F.least("p", "q").alias("i"), F.greatest("p", "q").alias("j"),
            F.when(F.col("p") == F.col("q"), 2).when(F.col("p") < F.col("q"), 0).otherwise(1).alias("side"),
        )
    shard = ["t", "v", "i", "j"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        rows = 0

        def out(frame: pd.DataFrame) -> pd.DataFrame:
            key = frame[shard].to_numpy()
            number = np.cumsum(np.append(0, (key[1:] != key[:-1]).any(1)))
            a, b = _forest(frame["fp"].to_numpy().view(np.uint64), number, frame["side"].to_numpy(), bits)
            return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

        for batch in batches:
            held.append(batch)
            rows += len(batch)
            if rows >= 4 * shard_rows:
                frame = pd.concat(held, ignore_index=True)
                # the last shard may go on in the next batch
                last = (frame[shard] == frame[shard].iloc[-1]).all(axis=1).to_numpy()
                begin = int(np.argmax(last))
                if begin:
                    yield out(frame[:begin])
                held, rows = [frame[begin:]], len(frame) - begin
        if rows:
            yield out(pd.concat(held, ignore_index=True))

    return dealt.repartition(*shard).sortWithinPartitions(*shard, "fp").mapInPandas(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) for every node of the edges ``a, b``, by
    alternating large-star and small-star until nothing changes."""

    def staged_edges(df: DataFrame) -> DataFrame:
        return common.staged(df.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())

    def star(df: DataFrame) -> DataFrame:
        """Each edge with the smallest neighbour of its a: partial sums first, then a join that
        Spark can split where a node has very many edges."""
        return df.join(df.groupBy("a").agg(F.min("b").alias("m")), "a")

    edges = staged_edges(edges)
    before = mark(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = star(both).where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct()
        tied = star(large)
        edges = staged_edges(tied.select(F.col("b").alias("a"), F.col("m").alias("b")).union(tied.select("a", F.col("m").alias("b"))))
        after = mark(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))


def simhash_groups(docs: DataFrame, words: int = WORDS, bits: int = BITS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``doc_id, text_hash, fingerprint, component_id, component`` for each row of ``docs``; component
    is a fingerprint of the component, the same for all its rows, also where none has an id."""
    rows = common.staged(fingerprints(docs, words), "fingerprints")
    return groups_of(rows, bits, shard_rows)


def groups_of(rows: DataFrame, bits: int = BITS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The same for rows ``doc_id, fp`` in a table; other columns are carried along."""
    distinct = common.staged(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    linked = components(links(distinct.select("fp"), bits, shard_rows))
    # the smallest document of each component, over the few fingerprints that are linked at all
    named = linked.unionByName(linked.select(F.col("component").alias("node"), "component").distinct())
    members = named.join(distinct, F.col("node") == F.col("fp")).select("fp", "component", "least")
    first = members.groupBy("component").agg(F.min("least").alias("first"))
    linked = common.staged(members.join(first, "component").select("fp", "component", "first"), "linked")
    place = distinct.join(linked, "fp", "left").select("fp", F.coalesce("first", "least").alias("component_id"), F.coalesce("component", "fp").alias("component"))
    carried = [c for c in rows.columns if c != "fp"]
    return rows.join(place, "fp").select(*carried, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "component")


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(common.table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")
