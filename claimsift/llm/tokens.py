"""Token ids of whole texts, with the public byte-level vocabulary.

The pre-tokeniser never joins two words, and a word takes at most the one space before it along. So a text whose words
are separated by single spaces or single other white space is the concatenation of its words' ids, and each distinct word
of a chunk is encoded once. Any other text is encoded as a whole. Both give the ids of the ``tokenizers`` library, which
itself encodes texts that hold a special token's string.
"""

from __future__ import annotations

import base64
import json
import re
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa

from claimsift.llm.words import Chunk, U64, flat_ranges

#: White space to the pre-tokeniser beyond the six ASCII characters that separate words here.
OTHER_SPACE = re.compile("[\x1c-\x1f\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
NEWLINE_FIRST = U64(0xA0761D6478BD642F)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@dataclass
class Encoder:
    """``path`` is a ``tokenizers`` file of a byte-level BPE; it is opened on the executors."""

    path: str

    @cached_property
    def _library(self):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    @cached_property
    def _specials(self) -> list[str]:
        with open(self.path) as f:
            return [x["content"] for x in json.load(f).get("added_tokens", [])]

    @cached_property
    def _fast(self):
        """The same merges in an encoder without offsets, several times as fast."""
        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        return tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _encode(self, texts: list[str]) -> list[list[int]]:
        if self.path == default_vocabulary():
            return [self._fast.encode_ordinary(t) for t in texts]
        return [self._whole(t) for t in texts]

    def _whole(self, text: str) -> list[int]:
        return self._library.encode(text, add_special_tokens=False).ids

    def encode(self, chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a chunk's documents one after another, and how many each document has."""
        docs = len(chunk.rows)
        raw = [chunk.data[a:b].tobytes() for a, b in zip(chunk.doc_start.tolist(), chunk.doc_end.tolist())]
        single = self._splits(chunk, raw)
        if not len(chunk.doc):
            counts = np.zeros(docs, np.int64)
            ids = np.zeros(0, np.uint32)
        else:
            # A word after a space is encoded with it; after other white space, that comes first, as ids of its own.
            first = np.zeros(len(chunk.doc), bool)
            first[chunk.first[chunk.counts > 0]] = True
            before = np.where(chunk.starts > 0, chunk.data[chunk.starts - 1], 0)
            key = chunk.hashes() ^ (np.where(first, 0, before).astype(U64) * NEWLINE_FIRST)
            _, at, of = np.unique(key, return_index=True, return_inverse=True)
            lead = np.where(first[at], 1, 0)
            spans = zip((chunk.starts[at] - 1 + lead).tolist(), chunk.ends[at].tolist())
            pieces = self._encode([chunk.data[a:b].tobytes().decode() for a, b in spans])
            size = np.array([len(p) for p in pieces])
            flat = np.array([i for p in pieces for i in p], np.uint32)
            begin = np.cumsum(size) - size
            ids = flat[flat_ranges(begin[of], size[of])]
            counts = np.bincount(chunk.doc, size[of], minlength=docs).astype(np.int64)
        if single.all():
            return ids, counts
        parts = np.split(ids, np.cumsum(counts)[:-1])
        for i in np.flatnonzero(~single).tolist():
            text = raw[i].decode()
            special = any(s in text for s in self._specials)
            parts[i] = np.array(self._whole(text) if special else self._encode([text])[0], np.uint32)
        return np.concatenate(parts), np.array([len(p) for p in parts])

    def _splits(self, chunk: Chunk, raw: list[bytes]) -> np.ndarray:
        """Documents that are just their words with one white space between neighbours."""
        length = chunk.doc_end - chunk.doc_start
        words = np.add.reduceat(np.append(chunk.ends - chunk.starts, 0), np.minimum(chunk.first, len(chunk.starts)))
        words = np.where(chunk.counts > 0, words, 0)
        single = (words + np.maximum(chunk.counts - 1, 0) == length)
        # No white space at either end, so that all of it lies between words.
        has = np.flatnonzero(chunk.counts > 0)
        single[has] &= chunk.starts[chunk.first[has]] == chunk.doc_start[has]
        single[has] &= chunk.ends[chunk.first[has] + chunk.counts[has] - 1] == chunk.doc_end[has]
        marks = tuple(s.encode() for s in self._specials)
        for i, text in enumerate(raw):
            if single[i] and (any(m in text for m in marks) or not text.isascii() and OTHER_SPACE.search(text.decode())):
                single[i] = False
        return single


def with_end(ids: np.ndarray, counts: np.ndarray, end: int | None) -> tuple[np.ndarray, np.ndarray]:
    """The ids with ``end`` after each document."""
    if end is None:
        return ids, counts
    out = np.full(len(ids) + len(counts), end, np.uint32)
    out[flat_ranges(np.cumsum(counts + 1) - (counts + 1), counts)] = ids
    return out, counts + 1


def id_array(ids: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Runs of ids as little-endian unsigned 32-bit binaries."""
    offsets = np.concatenate([[0], np.cumsum(lengths * 4)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(
        np.ascontiguousarray(ids.astype("<u4", copy=False)))])
