"""Token counts by rank-synchronous array merging.

Distinct pre-tokens of a chunk are held as one ragged numpy array of symbols. In each round every
sequence merges all places of its own lowest-rank pair at once; a sequence without such a pair is
done and its surviving symbols are its tokens. Only pre-tokens that a worker has not seen lately
are merged: it keeps short ones in a table of ``SLOTS`` places, each holding the latest that fell
there with its whole bytes, so a place is believed only for the very same pre-token.

Defined results: null and empty text 0 bytes and 0 tokens; repeated rows one row each; empty table
no rows; other columns are never read. A text of any length is counted whole.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from postroom.llm import common, pretokens

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 512
#: Places for pre-tokens that a worker remembers, a power of two; those it does have at most so many
#: bytes (in numbers of eight) and tokens.
SLOTS, HEADS, MOST_IDS = 1 << 19, 3, 8
#: Characters of text that are cut into tokens at a time: a dozen arrays have a number for each.
CHUNK_CHARS = 200_000
NONE = np.int64(1 << 40)
#: Odd numbers that mix the bytes of a pre-token into its place.
MIX = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB], np.uint64)


class Merges:
    """The vocabulary's merges as arrays; ``ids`` and ``counts`` of pre-tokens by them."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            held = json.load(f)
        vocab, merges = held["model"]["vocab"], held["model"]["merges"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        key = left << 20 | right
        order = np.argsort(key)
        self.keys = key[order]
        self.ranks = order.astype(np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)[order]
        self.special = {x["content"]: x["id"] for x in held["added_tokens"]}
        # bytes are written as printable characters in the vocabulary: those that are printable as
        # themselves, the others as the characters from 256 on, in order
        own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        sign = {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in set(own))}
        self.first = np.array([vocab[sign[b]] for b in range(256)], np.int64)
        # by two bytes, whose pairs are most of those looked up
        self.byte_rank, self.byte_made = self._pairs(np.repeat(self.first, 256), np.tile(self.first, 256), np.ones(1 << 16, bool))
        # the remembered pre-tokens: bytes (0 for an empty place), how many bytes and ids, ids
        self.known_heads, self.known_size = np.zeros((HEADS, SLOTS), np.uint64), np.zeros(SLOTS, np.uint8)
        self.known_ids, self.known_n = np.zeros((MOST_IDS, SLOTS), np.uint32), np.zeros(SLOTS, np.uint8)

    def _pairs(self, left: np.ndarray, right: np.ndarray, same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rank of each pair, ``NONE`` if it isn't one, and the symbol it makes."""
        key = left << 20 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & same, self.ranks[at], NONE), self.made[at]

    def merge(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Surviving symbols of all pieces, flat, and how many each has."""
        raw = [p.encode() for p in pieces]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        flat = np.frombuffer(b"".join(raw), np.uint8)
        symbols = self.first[flat]
        seq = np.repeat(np.arange(len(raw)), size)
        # rank[i], made[i]: of the pair of symbols i and i + 1
        rank, made = np.full(len(symbols), NONE), np.zeros(len(symbols), np.int64)
        two = flat[:-1].astype(np.uint16) << 8 | flat[1:]
        rank[:-1], made[:-1] = np.where(seq[1:] == seq[:-1], self.byte_rank[two], NONE), self.byte_made[two]
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbols):
            head = np.flatnonzero(np.append(True, seq[1:] != seq[:-1]))
            lowest = np.repeat(np.minimum.reduceat(rank, head), np.diff(np.append(head, len(symbols))))
            live = lowest < NONE
            done.append((seq[~live], symbols[~live]))
            hit = np.flatnonzero(live & (rank == lowest))
            # in a run of one symbol the pairs overlap: every other one counts, from the left
            new = np.append(True, np.diff(hit) != 1)[: len(hit)]
            place = np.arange(len(hit))
            hit = hit[(place - np.maximum.accumulate(np.where(new, place, 0))) % 2 == 0]
            symbols[hit] = made[hit]
            live[hit + 1] = False
            at = (np.cumsum(live) - 1)[hit]
            symbols, seq, rank, made = symbols[live], seq[live], rank[live], made[live]
            # only pairs beside a merged symbol are new
            at = np.concatenate([at, at[at > 0] - 1])
            inner = at[at + 1 < len(symbols)]
            rank[at] = NONE
            rank[inner], made[inner] = self._pairs(symbols[inner], symbols[inner + 1], seq[inner] == seq[inner + 1])
        if not done:
            return np.zeros(0, np.int64), np.zeros(len(raw), np.int64)
        seq = np.concatenate([s for s, _ in done])
        order = np.argsort(seq, kind="stable")
        return np.concatenate([x for _, x in done])[order], np.bincount(seq, minlength=len(raw))

    def tokens(self, pieces: pretokens.Pieces, ids: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces, flat (none unless ``ids``), and how many each has."""
        heads, size = pieces.head_bytes(HEADS)
        mixed = (heads * MIX[:, None]).sum(0, dtype=np.uint64)
        mixed = (mixed ^ mixed >> np.uint64(32)) * MIX[0]
        slot = (mixed >> np.uint64(64 - SLOTS.bit_length() + 1)).astype(np.int64)
        hit = self.known_size[slot] == size
        for k in range(HEADS):
            hit &= self.known_heads[k][slot] == heads[k]
        n = self.known_n[slot].astype(np.int64)
        late = np.flatnonzero(~hit)
        kind, first, new = pieces.distinct(late)
        symbols, made = self.merge(new)
        n[late] = made[kind]
        flat = np.zeros(0, "<u4")
        if ids:
            flat = np.empty(int(n.sum()), "<u4")
            start, found = np.cumsum(n) - n, np.flatnonzero(hit)
            for k in range(MOST_IDS):
                found = found[n[found] > k]
                flat[start[found] + k] = self.known_ids[k][slot[found]]
            own = n[late]
            inside = np.arange(int(own.sum())) - np.repeat(np.cumsum(own) - own, own)
            flat[np.repeat(start[late], own) + inside] = symbols[np.repeat((np.cumsum(made) - made)[kind], own) + inside]
        self._keep(late[first], slot, heads, size, symbols, made)
        return flat, n

    def _keep(self, piece: np.ndarray, slot: np.ndarray, heads: np.ndarray, size: np.ndarray, symbols: np.ndarray, made: np.ndarray) -> None:
        begin = np.cumsum(made) - made
        short = np.flatnonzero((size[piece] <= 8 * HEADS) & (made <= MOST_IDS))
        # one for each place
        place, which = np.unique(slot[piece[short]], return_index=True)
        short = short[which]
        piece = piece[short]
        self.known_size[place], self.known_n[place] = size[piece], made[short]
        for k in range(HEADS):
            self.known_heads[k][place] = heads[k][piece]
        for k in range(MOST_IDS):
            more = made[short] > k
            self.known_ids[k][place[more]] = symbols[begin[short[more]] + k]


@lru_cache(4)
def merges(path: str) -> Merges:
    return Merges(path)


def count_tokens(texts: list[str], path: str) -> np.ndarray:
    parts, owner = pretokens.units(texts)
    pieces = pretokens.Pieces(parts)
    n = np.bincount(owner[pieces.text_of], merges(path).tokens(pieces, ids=False)[1], len(texts)).astype(np.int64)
    # a special string stands between two parts of a text
    return n + np.bincount(owner, minlength=len(texts)) - 1


def token_counts(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for each row of ``docs``; a narrow pass."""
    path = path or public_tokenizers.path(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in common.chunks(batch, ["doc_id", "text"], most=CHUNK_CHARS):
                n = count_tokens(texts, path)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(ids, pa.int64()),
                    "n_bytes": pa.array([len(t.encode()) for t in texts], pa.int64()),
                    "n_tokens": pa.array(n, pa.int64()),
                    "over_limit": pa.array(n > limit, pa.bool_()),
                })

    return docs.select("doc_id", "text").mapInArrow(common.lean(run), "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(common.table(spark, sf_dir, "documents"))
