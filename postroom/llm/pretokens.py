"""Pre-tokens of the byte-level vocabularies, found with numpy on whole chunks of text.

The split is the one of ``public_tokenizers.PATTERN``: contractions, runs of letters, numbers or
other signs with at most one space before them, and white space.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np

from postroom.llm.common import code_points, same

OTHER, LETTER, NUMBER, SPACE, END = range(5)
SENTINEL = 0x110000
SPECIAL = "<|endoftext|>"
#: Code points with the property White_Space.
WHITE_SPACE = (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
#: What may follow an apostrophe as a contraction.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")
#: By a number of bytes, a mask of as many low ones.
LOW_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)




@lru_cache(1)
def char_classes() -> np.ndarray:
    """A class for each code point. Those that this Python's Unicode tables don't know yet are put
    to the tokenizer library: its tables may be newer."""
    import public_tokenizers
    from tokenizers import Tokenizer

    table = np.zeros(SENTINEL + 1, np.uint8)
    kinds = {"L": LETTER, "N": NUMBER}
    unknown = []
    for c in range(SENTINEL):
        kind = unicodedata.category(chr(c))
        if kind == "Cn":
            unknown.append(c)
        elif kind[0] in kinds:
            table[c] = kinds[kind[0]]
    cut = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).pre_tokenizer.pre_tokenize_str
    for c in unknown:
        if c < 0x32400:
            table[c] = LETTER if len(cut(f"a{chr(c)}")) == 1 else NUMBER if len(cut(f"1{chr(c)}")) == 1 else OTHER
    table[list(WHITE_SPACE)] = SPACE
    table[SENTINEL] = END
    return table


class Pieces:
    """The pre-tokens of a list of texts: ``text_of`` is the number of each one's text, ``begin`` and
    ``size`` its place in the texts, which are held as one string with a sentinel after each."""

    def __init__(self, texts: list[str]):
        self.joined, self.codes, ends = code_points(texts, SENTINEL)
        begin = _starts(self.codes)
        size = np.diff(np.append(begin, len(self.codes)))
        real = self.codes[begin] != SENTINEL
        self.begin, self.size = begin[real], size[real]
        self.text_of = np.searchsorted(ends, self.begin)

    def distinct(self, some: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """A number for each of the pre-tokens ``some`` that equal ones share; by that number, which
        of ``some`` is the first, and the string."""
        begin, size = self.begin[some], self.size[some]
        kind, first = same(self.joined, self.codes, begin, size)
        return kind, first, [self.joined[a : a + n] for a, n in zip(begin[first].tolist(), size[first].tolist())]

    def head_bytes(self, words: int) -> tuple[np.ndarray, np.ndarray]:
        """The first ``8 * words`` UTF-8 bytes of each as little-endian numbers, zeros after its end;
        and how many bytes it has."""
        codes = self.codes
        # a sentinel is one byte of the string
        wide = 1 + ((codes >= 0x80) & (codes != SENTINEL)).astype(np.uint8)
        wide += (codes >= 0x800) & (codes != SENTINEL)
        wide += (codes >= 0x10000) & (codes != SENTINEL)
        stop = np.cumsum(wide, dtype=np.int64)
        start = stop[self.begin] - wide[self.begin]
        n = stop[self.begin + self.size - 1] - start
        raw = self.joined.encode() + bytes(8 * words)
        at = np.ndarray((len(raw) - 7,), "<u8", raw, strides=(1,))
        heads = np.empty((words, len(n)), np.uint64)
        for k in range(words):
            heads[k] = at[np.minimum(start + 8 * k, len(at) - 1)] & LOW_BYTES[np.clip(n - 8 * k, 0, 8)]
        return heads, n


def _starts(codes: np.ndarray) -> np.ndarray:
    """Where pre-tokens begin; a run of sentinels counts as one."""
    cls = char_classes()[codes]
    start = np.ones(len(codes), bool)
    np.not_equal(cls[1:], cls[:-1], out=start[1:])

    # the last of some white space before other text is cut off; a plain space joins that text
    first = np.flatnonzero(start[1:] & (cls[:-1] == SPACE) & (cls[1:] != END)) + 1
    start[first - 1] = True
    start[first[codes[first - 1] == 0x20]] = False

    # contractions: an apostrophe that begins a pre-token, then the given letters
    mark = np.flatnonzero((codes[:-1] == 0x27) & start[:-1] & (cls[1:] == LETTER))
    for tail in CONTRACTIONS:
        found = mark
        for k, letter in enumerate(tail, 1):
            found = found[found + k < len(codes)]
            found = found[codes[found + k] == ord(letter)]
        start[found + 1] = False
        after = found + 1 + len(tail)
        start[after[cls[after] == LETTER]] = True
    return np.flatnonzero(start)


def units(texts: list[str]) -> tuple[list[str], np.ndarray]:
    """Texts cut at the special string, which the library takes as one token by default, and for
    each part the number of its text."""
    parts: list[str] = []
    owner: list[int] = []
    for i, t in enumerate(texts):
        cut = t.split(SPECIAL) if SPECIAL in t else (t,)
        parts.extend(cut)
        owner.extend([i] * len(cut))
    return parts, np.asarray(owner, np.int64)
