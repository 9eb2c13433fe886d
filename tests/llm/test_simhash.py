import numpy as np
import pandas as pd
import pytest
import xxhash

from postroom.llm import simhash as S

from .conftest import frame


def brute_fingerprint(text):
    lower = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
    w = (text or "").encode().translate(lower).split()
    if not w:
        return 0
    shingles = [b" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fp, bits=4):
    near = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= bits
    label = np.arange(len(fp))
    while True:
        new = np.array([label[m].min() for m in near])
        if (new == label).all():
            return label
        label = new


def test_table(odd_docs, odd_rows, no_docs):
    rows = [r for r in odd_rows if r[0] is not None]
    fp = np.array([brute_fingerprint(t) for _, t, _, _ in rows], np.uint64)
    label = brute_components(fp)
    least = {k: min(rows[i][0] for i in np.flatnonzero(label == k)) for k in set(label)}
    want = sorted((rows[i][0], f"{int(fp[i]):016x}", least[label[i]]) for i in range(len(rows)))
    got = sorted(tuple(r) for r in S.simhash_groups(odd_docs).select("doc_id", "fingerprint", "component_id").collect() if r[0] is not None)
    assert got == want
    assert S.simhash_groups(no_docs).count() == 0


@pytest.mark.parametrize("shard_rows", [20_000, 40])
def test_chains_and_cut_shards(spark, shard_rows):
    rng = np.random.default_rng(0)
    base = rng.integers(0, 2**63, 30, dtype=np.uint64)
    x = base[rng.integers(0, 30, 1500)].copy()
    for _ in range(6):
        x ^= np.where(rng.random(1500) < 0.6, np.uint64(1) << rng.integers(0, 64, 1500, dtype=np.uint64), np.uint64(0))
    rows = spark.createDataFrame(pd.DataFrame({"doc_id": np.arange(1500), "fp": x.view(np.int64)}))
    got = S.groups_of(rows, shard_rows=shard_rows).toPandas().sort_values("doc_id")
    assert (got["component_id"].to_numpy() == brute_components(x)).all()


def test_a_long_path_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)], "a long, b long")
    got = S.components(edges).collect()
    assert {r["node"] for r in got} >= set(range(1, 201)) and {r["component"] for r in got} == {0}


def test_tree_finds_all_within():
    rng = np.random.default_rng(1)
    fp = rng.integers(0, 2**12, 300, dtype=np.uint64)
    shard = np.repeat([0, 1, 2], 100)
    tree = S.BKTrees(fp, shard)
    root = np.repeat([0, 100, 200], 100)
    got = {(int(q), int(n)) for qs, ns in tree.within(fp, root, 2) for q, n in zip(qs, ns)}
    near = (np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 2) & (shard[:, None] == shard[None, :])
    assert got == {(int(a), int(b)) for a, b in zip(*np.nonzero(near))}


def test_bands_grow():
    few, many = S.bands(1000), S.bands(10**9)
    assert few[0] == 5 and len(few[1]) == 5 and many[0] > 5


def test_near_copies(spark):
    words = [f"w{i}" for i in range(400)]
    text = " ".join(words)
    rows = [(5, text, "en", "a"), (3, text.upper().replace("W", "W"), "en", "a"), (9, " ".join(words[:399] + ["other"]), "en", "a"), (1, " ".join(reversed(words)), "en", "a")]
    got = {r["doc_id"]: r["component_id"] for r in S.simhash_groups(frame(spark, rows)).collect()}
    assert got[5] == got[3] == 3 and got[1] == 1
