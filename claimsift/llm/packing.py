"""Operators 9 and 10: documents packed into sequences of a fixed number of tokens.

Documents longer than a sequence, and only those, are cut into full pieces after one that takes up the rest. Full pieces
are sequences of their own; the others are packed

* *best-fit-decreasing* (9): of a block of documents, the longest first, each into the sequence with the least room that
  holds it, found in a tree over room sizes;
* *bounded-space best-fit* (10): as they are read, the longest of a few MB of text first, each into the fullest open sequence that holds it, found in a
  bitset with one bit per free space; when too many are open, the fullest closes.

Every task packs the documents it reads and nothing is shuffled: the work follows the scan, a lost task is repeated by
itself, and only the last few sequences of each task are not full.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, types as T

from claimsift.llm.common import lean, ready
from claimsift.llm.tokens import Encoder, default_vocabulary, id_array, with_end
from claimsift.llm.words import chunks


@dataclass(frozen=True)
class Packing:
    """``end`` is the id after each document (None: none); ``open_sequences`` bounds operator 10's open sequences and
    ``block_tokens`` what operator 9 holds at a time."""

    length: int = 2048
    vocabulary: str | None = None
    end: int | None = 0
    open_sequences: int = 512
    block_tokens: int = 2_000_000


def cut(counts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document, number, start and length of each piece; the first of a long document is its remainder."""
    pieces = np.maximum(1, -(-counts // length))
    doc = np.repeat(np.arange(len(counts)), pieces)
    number = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    head = (counts - (pieces - 1) * length)[doc]
    start = np.where(number == 0, 0, head + (number - 1) * length)
    return doc, number, start, np.where(number == 0, head, length)


class OpenSequences:
    """A fixed number of open sequences in a bitset keyed by free space."""

    def __init__(self, length: int, most: int, first_id: int) -> None:
        self.length, self.most, self.next_id = length, most, first_id
        self.bits, self.open = 0, 0
        self.at: list[list[int]] = [[] for _ in range(length + 1)]

    def place(self, size: int) -> tuple[int, int]:
        """Sequence and offset for a piece. Empty pieces take no space."""
        fits = self.bits >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            sequence = self._take(free)
        else:
            free, sequence = self.length, self.next_id
            self.next_id += 1
        if free > size:
            self._put(free - size, sequence)
            if self.open > self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)
        return sequence, self.length - free

    def _take(self, free: int) -> int:
        held = self.at[free]
        sequence = held.pop()
        if not held:
            self.bits ^= 1 << free
        self.open -= 1
        return sequence

    def _put(self, free: int, sequence: int) -> None:
        self.at[free].append(sequence)
        self.bits |= 1 << free
        self.open += 1


class RoomTree:
    """Counts of sequences by room in a segment tree; finds the least room of at least a given size."""

    def __init__(self, length: int) -> None:
        self.leaves = 1 << (length + 1).bit_length()
        self.tree = [0] * (2 * self.leaves)
        self.held: list[list[int]] = [[] for _ in range(length + 1)]

    def add(self, room: int, sequence: int) -> None:
        self.held[room].append(sequence)
        self._count(room, 1)

    def take(self, room: int) -> int:
        self._count(room, -1)
        return self.held[room].pop()

    def _count(self, room: int, by: int) -> None:
        node = room + self.leaves
        while node:
            self.tree[node] += by
            node >>= 1

    def least(self, size: int) -> int | None:
        node = size + self.leaves
        if self.tree[node]:
            return size
        while node > 1:  # up to the first subtree on the right that holds one, then down to its first
            if not node & 1 and self.tree[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.tree[2 * node] else 2 * node + 1
                return node - self.leaves
            node >>= 1
        return None


def best_fit_decreasing(sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence, from 0, and offset of each piece."""
    sequence, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    tree, opened = RoomTree(length), 0
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        room = tree.least(size)
        if room is None:
            room, number = length, opened
            opened += 1
        else:
            number = tree.take(room)
        sequence[i], offset[i] = number, length - room
        if room > size:
            tree.add(room - size, number)
    return sequence, offset


def pack_bounded(docs: DataFrame, text: str = "text", packing: Packing = Packing()) -> DataFrame:
    """Operator 10: one row per piece with the columns of ``docs`` other than the text, and ``piece, start, length, ids,
    sequence_id, offset``.

    ``ids`` are little-endian unsigned 32-bit numbers. Null and empty texts are a piece with nothing but the end id (none:
    an empty piece). Repeated rows are packed each. An empty table gives no rows. Input columns of the new names are
    replaced. Sequence ids are unique but not gapless.
    """
    ready(docs.sparkSession)
    docs = docs.drop("piece", "start", "length", "ids", "sequence_id", "offset")
    place = docs.columns.index(text)
    kept = [i for i, c in enumerate(docs.columns) if c != text]
    encoder = Encoder(packing.vocabulary or default_vocabulary())
    new = [T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
           T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType()),
           T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    schema = T.StructType([*[docs.schema[i] for i in kept], *new])
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = OpenSequences(packing.length, packing.open_sequences, TaskContext.get().partitionId() << 40)
        for batch in batches:
            for chunk in chunks(batch.column(place)):
                ids, counts = with_end(*encoder.encode(chunk), packing.end)
                doc, number, start, length = cut(counts, packing.length)
                sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
                for i in np.argsort(-length, kind="stable").tolist():
                    sequence[i], offset[i] = bins.place(int(length[i]))
                part = batch.slice(chunk.rows[0], len(chunk.rows))
                yield pa.RecordBatch.from_arrays([
                    *[part.column(i).take(pa.array(doc)) for i in kept], pa.array(number.astype(np.int32)),
                    pa.array(start.astype(np.int64)), pa.array(length.astype(np.int64)), id_array(ids, length),
                    pa.array(sequence), pa.array(offset)], names)

    return docs.mapInArrow(lean(run), schema)


PACKED = ("sequence_id long, n_tokens long, ids binary, cu_seqlens array<int>, positions_reset array<int>, "
          "pieces array<struct<doc:{kind},piece:int,start:long,length:long>>")


def pack_decreasing(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    packing: Packing = Packing()) -> DataFrame:
    """Operator 9: one row per sequence: its ids as one row of the id matrix, padded with zeros to full length;
    ``cu_seqlens``, where its pieces start and the last one ends; ``positions_reset``, the position of the first token of
    each piece in its document; and the pieces themselves, so that every document can be put together again.

    Null and empty texts are a piece with nothing but the end id; without end ids they are a piece of no tokens in some
    sequence. Repeated rows are packed each. An empty table gives no rows. Other columns are ignored.
    """
    ready(docs.sparkSession)
    encoder, length = Encoder(packing.vocabulary or default_vocabulary()), packing.length
    kind = docs.schema[doc_id].dataType
    schema = PACKED.format(kind=kind.simpleString())
    rows = docs.select(docs[doc_id].alias("doc"), docs[text].cast("string").alias("text"))

    def packed(names: list[pa.Array], ids: list[np.ndarray], counts: list[np.ndarray], first: int) -> pa.RecordBatch:
        name, ids, counts = pa.concat_arrays(names), np.concatenate(ids), np.concatenate(counts)
        doc, number, start, size = cut(counts, length)
        sequence, offset = best_fit_decreasing(size, length)
        order = np.lexsort((number, offset, sequence))
        n = int(sequence.max()) + 1
        matrix = np.zeros((n, length), np.uint32)
        begin = np.cumsum(size) - size
        flat = np.repeat(sequence * length + offset - begin, size) + np.arange(len(ids))
        matrix.ravel()[flat] = ids
        per = np.bincount(sequence, minlength=n)
        edge = np.concatenate([[0], np.cumsum(per)]).astype(np.int32)
        used = np.bincount(sequence, size, minlength=n).astype(np.int64)
        # Starts of the pieces, and at the end of each sequence its number of tokens.
        ends = np.insert(offset[order], edge[1:], used)
        pieces = pa.StructArray.from_arrays(
            [name.take(pa.array(doc[order])), pa.array(number[order].astype(np.int32)),
             pa.array(start[order].astype(np.int64)), pa.array(size[order].astype(np.int64))],
            names=["doc", "piece", "start", "length"])
        return pa.RecordBatch.from_arrays([
            pa.array(first + np.arange(n)), pa.array(used), id_array(matrix.ravel(), np.full(n, length)),
            pa.ListArray.from_arrays(pa.array(edge + np.arange(n + 1, dtype=np.int32)), pa.array(ends.astype(np.int32))),
            pa.ListArray.from_arrays(pa.array(edge), pa.array(start[order].astype(np.int32))),
            pa.ListArray.from_arrays(pa.array(edge), pieces),
        ], ["sequence_id", "n_tokens", "ids", "cu_seqlens", "positions_reset", "pieces"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, held = TaskContext.get().partitionId() << 40, 0
        block: tuple[list, list, list] = ([], [], [])
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                ids, counts = with_end(*encoder.encode(chunk), packing.end)
                for part, x in zip(block, (batch.column(0).slice(chunk.rows[0], len(chunk.rows)), ids, counts)):
                    part.append(x)
                held += len(ids)
                if held >= packing.block_tokens:
                    out = packed(*block, first)
                    first, held, block = first + out.num_rows, 0, ([], [], [])
                    yield from (out.slice(i, 256) for i in range(0, out.num_rows, 256))
        if block[0]:
            yield packed(*block, first)

    return rows.mapInArrow(lean(run), schema)
