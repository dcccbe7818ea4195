"""Words of whole texts as numpy arrays, a few MB of text at a time.

A word is a maximal run of bytes other than space and ``\\t\\n\\v\\f\\r``; none of these bytes occurs inside a multi-byte
UTF-8 character. Hashes are 64-bit polynomials over random byte codes, mixed afterwards: two given different strings
agree with a chance of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 2_000_000
U64 = np.uint64

_random = np.random.RandomState(20250101)
_BYTE_CODES = _random.randint(1, 2**62, 256).astype(U64) * U64(2) + U64(1)
_BASE = U64(0x9E3779B97F4A7C15)
_BASE_INVERSE = U64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_STEP = 0xD6E8FEB86659FD93
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_powers = {"up": np.ones(1, U64), "down": np.ones(1, U64)}


def _power(which: str, n: int) -> np.ndarray:
    """Powers 0 to n-1 of the base, or of its inverse."""
    if len(_powers[which]) < n:
        base = _BASE if which == "up" else _BASE_INVERSE
        steps = np.full(max(n, CHUNK_BYTES + 4096), base, U64)
        steps[0] = 1
        _powers[which] = np.multiply.accumulate(steps)
    return _powers[which][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the SplitMix64 finaliser)."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each span; equal bytes have equal hashes wherever they stand."""
    sums = np.zeros(len(data) + 1, U64)
    np.cumsum(_BYTE_CODES[data] * _power("up", len(data)), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _power("down", len(data) + 1)[starts] + (ends - starts).astype(U64))


def sequence_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """A hash of each run of ``k`` words, by the index of its first; runs may cross documents, so mask them."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    h, scale = np.zeros(n, U64), 1
    for j in range(k):
        h += words[j:j + n] * U64(scale)
        scale = scale * _STEP % 2**64
    return mix(h)


@dataclass
class Chunk:
    """Some documents: their bytes with one space after each, and their words."""

    rows: np.ndarray  # index of each document in its Arrow batch
    data: np.ndarray  # bytes
    doc_start: np.ndarray  # first byte of each document
    doc_end: np.ndarray
    starts: np.ndarray = field(init=False)  # of words
    ends: np.ndarray = field(init=False)
    doc: np.ndarray = field(init=False)  # document of each word
    first: np.ndarray = field(init=False)  # index of each document's first word
    counts: np.ndarray = field(init=False)  # words of each document

    def __post_init__(self) -> None:
        space = _IS_SPACE[self.data]
        edge = np.flatnonzero(space[1:] != space[:-1]) + 1
        if len(space) and not space[0]:
            edge = np.concatenate([[0], edge])
        self.starts, self.ends = edge[0::2], edge[1::2]  # the last byte is a space, so every word ends
        self.first = np.searchsorted(self.starts, self.doc_start)
        after = np.searchsorted(self.starts, self.doc_end)
        self.counts = after - self.first
        self.doc = np.repeat(np.arange(len(self.rows)), self.counts)

    def hashes(self, lower: bool = False) -> np.ndarray:
        return span_hashes(_LOWER[self.data] if lower else self.data, self.starts, self.ends)

    def windows(self, k: int) -> np.ndarray:
        """Indexes of words that start a run of ``k`` words within their document."""
        n = len(self.doc) - k + 1
        return np.flatnonzero(self.doc[:n] == self.doc[k - 1:]) if n > 0 else np.zeros(0, np.int64)

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i]:self.ends[i]].tobytes()


def chunks(texts: pa.Array, at_most: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """The documents of an Arrow column in order, cut between documents; null counts as empty."""
    lengths = np.asarray(pc.fill_null(pc.binary_length(texts), 0)).astype(np.int64)
    total = np.cumsum(lengths + 1)
    lo = 0
    while lo < len(lengths):
        before = total[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(total, before + at_most, "right")))
        part = texts.slice(lo, hi - lo).cast(pa.binary() if pa.types.is_string(texts.type) else pa.large_binary())
        data = np.frombuffer(b" ".join([t or b"" for t in part.to_pylist()]) + b" ", np.uint8)
        ends = total[lo:hi] - before - 1
        yield Chunk(np.arange(lo, hi), data, ends - lengths[lo:hi], ends)
        lo = hi


def flat_ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenation of the ranges ``start .. start + length``."""
    total = int(lengths.sum())
    offset = np.cumsum(lengths) - lengths
    return np.repeat(starts - offset, lengths) + np.arange(total)
