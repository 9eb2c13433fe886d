import gc
import random
import tracemalloc
import weakref
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from postroom.llm import common, packing, pretokens, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_counts_as_the_library(library):
    rng = random.Random(1)
    signs = "'sstremvlld  \n\t 　aZé1٣½!?*$中🙂" + "'" * 3
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 30))) for _ in range(2000)]
    texts += ["", "<|endoftext|>", "a<|endoftext|> <|endoftext|>b  ", "'s's'sx 'll 'r", "a" * 3000, "x\x00y", "Ɤᲊ"]
    ranges = ((1, 0x2FFF), (0x3000, 0xD7FF), (0xE000, 0x1FFFF))
    texts += ["".join(chr(rng.randint(*rng.choice(ranges))) for _ in range(40)) for _ in range(1000)]
    want = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert token_counts.count_tokens(texts, PATH).tolist() == want


def test_ids_as_the_library(library):
    texts = ["", "one <|endoftext|> two", "it's\n\n so ", "Ünïcode 中文"]
    ids, stop = packing.token_ids(texts, PATH)
    parts = np.split(ids, stop[:-1])
    assert [p.tolist() for p in parts] == [library.encode(t, add_special_tokens=False).ids + [2] for t in texts]


def test_ids_with_few_places(library, monkeypatch):
    """Pre-tokens that fall on one place put each other out; each still gets its own ids."""
    monkeypatch.setattr(token_counts, "SLOTS", 4)
    own = token_counts.Merges(PATH)
    rng = random.Random(2)
    seen = 0
    for _ in range(6):
        texts = ["".join(rng.choice("ab é中\x00") for _ in range(rng.randint(1, 12))) for _ in range(100)]
        texts += ["a", "a\x00", "a\x00\x00", "b" * 24, "b" * 25, "é" * 12, "é" * 13, "\x00" * 9]
        pieces = pretokens.Pieces(texts)
        ids, n = own.tokens(pieces)
        want = [library.encode(t, add_special_tokens=False).ids for t in texts]
        assert ids.tolist() == [x for w in want for x in w]
        assert np.bincount(pieces.text_of, n, len(texts)).tolist() == list(map(len, want))
        assert own.tokens(pieces, ids=False)[1].tolist() == n.tolist()
        seen += int((own.known_size > 0).sum())
    assert seen


def test_worker_keeps_no_long_pretokens():
    """What a worker keeps doesn't grow with the texts that it has seen."""
    token_counts.count_tokens(["any"], PATH)
    tracemalloc.start()
    try:
        for k in range(60):
            token_counts.count_tokens([chr(97 + k % 26) + "xyzzy" * 4000 + chr(97 + k // 26)], PATH)
        gc.collect()
        assert tracemalloc.get_traced_memory()[0] < 1 << 20
    finally:
        tracemalloc.stop()


def test_ids_are_freed(spark):
    """A worker lives on after its task: no chunk's ids may stay with it."""
    docs = spark.createDataFrame([(i, "a b c d " * 500) for i in range(10)], "doc_id long, text string").coalesce(1)
    made: list = []
    whole = packing.token_ids

    def watched(*args):
        ids, stop = whole(*args)
        made.append(weakref.ref(ids))
        return ids, stop

    held = {}
    with pytest.MonkeyPatch.context() as m:
        m.setattr(packing, "token_ids", watched)
        m.setattr(common, "lean", lambda run: held.setdefault("run", run))
        packing.token_pieces(docs)
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(10)), "text": pa.array(["a b c d " * 500] * 10)})
    with pytest.MonkeyPatch.context() as m:
        m.setattr(packing, "token_ids", watched)
        lengths = [(b.column("length").to_pylist(), [len(x) for x in b.column("ids").to_pylist()]) for b in held["run"]([batch])]
    assert lengths and all([4 * n for n in a] == b for a, b in lengths)
    gc.collect()
    assert made and all(r() is None for r in made)


def test_table(odd_docs, odd_rows, library, no_docs):
    got = sorted(map(str, token_counts.token_counts(odd_docs).collect()))
    want = []
    for i, t, _, _ in odd_rows:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        want.append(f"Row(doc_id={i}, n_bytes={len((t or '').encode())}, n_tokens={n}, over_limit={n > 512})")
    assert got == sorted(want)
    assert token_counts.token_counts(no_docs).count() == 0


def check_packing(rows, capacity=1024):
    by: dict = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in by.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_packing_table(odd_docs, odd_rows, library, no_docs):
    rows = packing.packed_digests(odd_docs).collect()
    check_packing(rows)
    got = Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows)
    want: Counter = Counter()
    for i, t, _, _ in odd_rows:
        ids = np.array(library.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        n = -(-len(ids) // 1024)
        cut = [0, *(len(ids) - 1024 * (n - 1 - k) for k in range(n))]
        for k, (a, b) in enumerate(zip(cut, cut[1:])):
            want[i, k, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    assert got == want
    assert packing.packed_digests(no_docs).count() == 0


def test_plan_is_tight():
    rng = np.random.default_rng(5)
    lengths = rng.integers(1, 1025, 5000)
    plan = packing.best_fit(dict(Counter(lengths.tolist())))
    assert plan.sequences <= 1.01 * max(lengths.sum() / 1024, (lengths > 512).sum())
    assert packing.best_fit({}).sequences == 0
    assert packing.best_fit({1: 2048}).sequences == 2
    assert packing.best_fit({400: 5}).sequences == 3


def test_hot_length_is_salted(spark):
    rows = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit(0).alias("piece"), F.when(F.col("id") % 3 > 0, 1000).otherwise(F.col("id") % 1000 + 1).cast("long").alias("length"))
    placed = packing.pack(common.staged(rows, "test"), group_rows=100).collect()
    assert len(placed) == 5000
    check_packing(placed)


def test_too_long_is_an_error(spark):
    with pytest.raises(ValueError, match="longer"):
        packing.pack(spark.range(1).select(F.col("id").alias("doc_id"), F.lit(0).alias("piece"), F.lit(2000).cast("long").alias("length")))


def brute_fills(lengths, capacity):
    """Piece by piece: what each sequence holds."""
    large, small = (sorted((k for k in lengths if (3 * k > capacity) == big), reverse=True) for big in (True, False))
    fills = []
    while large:
        held = large.pop(0)
        beside = next((i for i, b in enumerate(large) if held + b <= capacity), None)
        fills.append(held + (0 if beside is None else large.pop(beside)))
    for k in small:
        tightest = max((f for f in fills if f + k <= capacity), default=None)
        if tightest is None:
            fills.append(k)
        else:
            fills[fills.index(tightest)] += k
    return fills


def test_plan_is_that_of_single_pieces():
    rng = random.Random(9)
    for round_ in range(300):
        capacity = rng.choice([5, 12, 31, 100])
        most = rng.choice([capacity, max(1, capacity // 2), max(1, capacity // 4)])
        counts = {}
        for _ in range(rng.randint(1, 80)):
            k = rng.randint(1, most) if rng.random() < 0.7 else max(1, most // 3)
            counts[k] = counts.get(k, 0) + 1
        plan = packing.best_fit(counts, capacity)
        key = plan.length << 44 | plan.rank
        held = {}
        for k, n in counts.items():
            for rank in range(n):
                at = int(np.searchsorted(key, k << 44 | rank, "right")) - 1
                held.setdefault(int(plan.sequence[at] + rank - plan.rank[at]), []).append((int(plan.offset[at]), k))
        assert sorted(held) == list(range(plan.sequences))
        for pieces in held.values():
            pieces.sort()
            assert [o for o, _ in pieces] == [sum(k for _, k in pieces[:i]) for i in range(len(pieces))]
        want = brute_fills([k for k, n in counts.items() for _ in range(n)], capacity)
        assert sorted(sum(k for _, k in x) for x in held.values()) == sorted(want), round_
