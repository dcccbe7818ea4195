"""Operator 7: words in windows of 20 that stand earlier in the corpus, found by FM-indexes of shards.

Equal windows hold the same rarest 5-word gram (the one with the smallest hash), so cutting each document where that gram
changes gives segments that can be dealt to shards by it, and all occurrences of a window meet in one shard:

1. Chunks of whole documents are written once. Their grams, packed, go to ranges of hashes, which send back the ones that
   occur twice: the other segments hold no repeated window and stay where they are.
2. A gram in more than :data:`HOT` segments would make one shard large, so windows of such segments are dealt by a hash
   of the whole window, again only those found twice. Equal segments of a chunk are sent once.
3. Each shard indexes its segments in an FM-index, streams them backwards through it, and returns for every window its
   earliest place. Chunks mark what stands earlier elsewhere and write the words that are left.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from claimsift.llm.common import U64, expand, lean, lean_group, lean_groups, pack, parts, ready, squeeze, staged, unpack
from claimsift.llm.fmindex import FMIndex, joined_text, matching_windows
from claimsift.llm.words import Chunk, chunks, flat_ranges, mix, sequence_hashes

GRAM = 5
KEY_BITS = 44
HOT = 2_000
LAST_ID = np.int64(2**63 - 1)
CHUNK = 2_000_000
#: Shards for each piece of other keyed work: an index takes many times the memory of its words.
SHARDS = 3


def _content(batch: pa.RecordBatch) -> bytes:
    out = io.BytesIO()
    with pa.ipc.new_stream(out, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(batch)
    return out.getvalue()


class Pieces:
    """Segments of the documents of a chunk: runs of windows with the same rarest gram."""

    def __init__(self, chunk: Chunk, window: int) -> None:
        self.chunk, self.window = chunk, window
        self.words = chunk.hashes()
        at = chunk.windows(window)
        self.at = at
        if not len(at):
            self.start = self.count = self.key = self.same = np.zeros(0, np.int64)
            return
        grams = sequence_hashes(self.words, GRAM) >> U64(64 - KEY_BITS) << U64(64 - KEY_BITS)
        # The place breaks ties, and separates two occurrences of one gram.
        grams |= np.arange(len(grams), dtype=U64) & U64(2**(64 - KEY_BITS) - 1)
        least, span, need = grams, 1, window - GRAM + 1
        while span * 2 <= need:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        rest = need - span
        least = np.minimum(least[:len(least) - rest], least[rest:]) if rest else least
        mine = least[at]
        cut = np.concatenate([[True], (mine[1:] != mine[:-1]) | (at[1:] != at[:-1] + 1)])
        first = np.flatnonzero(cut)
        self.start, self.count = at[first], np.diff(np.append(first, len(at)))
        self.key = mine[first] >> U64(64 - KEY_BITS)
        self.same = self.content(self.start, self.count + window - 1)

    def content(self, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """A hash of each run of words, wherever it stands."""
        if not hasattr(self, "_sums"):
            base = 0xD6E8FEB86659FD93
            up = np.full(len(self.words) + 1, base, U64)
            down = np.full(len(self.words) + 1, pow(base, -1, 2**64), U64)
            up[0] = down[0] = 1
            self._down = np.multiply.accumulate(down)
            self._sums = np.concatenate([[U64(0)], np.cumsum(self.words * np.multiply.accumulate(up)[:-1])])
        return mix((self._sums[start + length] - self._sums[start]) * self._down[start] + length.astype(U64))

    def bytes_of(self, start: int, length: int) -> bytes:
        c = self.chunk
        return c.data[c.starts[start]:c.ends[start + length - 1]].tobytes()


def _once(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first of each value, and how often it occurs."""
    _, first, count = np.unique(values, return_index=True, return_counts=True)
    return first, count


def _keyed(keys: np.ndarray, at: np.ndarray, count: np.ndarray, ranges: int) -> Iterator[tuple[int, bytes]]:
    order = np.argsort(keys)
    keys, at, count = keys[order], at[order], count[order]
    bounds = np.array([-(-(i << KEY_BITS) // ranges) for i in range(ranges + 1)], U64)
    cuts = np.searchsorted(keys, bounds)
    for r in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist():
        s = slice(cuts[r], cuts[r + 1])
        yield r, pack(np.diff(keys[s], prepend=U64(0)), at[s].astype(U64), count[s].astype(U64))


def _rows(number: int, keyed: Iterator[tuple[int, bytes]]) -> pa.RecordBatch:
    found = list(keyed)
    return pa.RecordBatch.from_arrays(
        [pa.array([r for r, _ in found], pa.int32()), pa.array([number] * len(found), pa.int64()),
         pa.array([x for _, x in found], pa.binary())], ["part", "chunk", "packed"])


def _one(content: bytes, text: str) -> tuple[pa.RecordBatch, Chunk]:
    batch = pa.ipc.open_stream(content).read_next_batch()
    (chunk,) = chunks(batch.column(text), 2**62)
    return batch, chunk


def _chunked(docs: DataFrame, text: str, window: int) -> DataFrame:
    """``chunk, content, keys``: documents in bulk, with the distinct segments' grams."""
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for chunk in chunks(batch.column(place), CHUNK):
                pieces = Pieces(chunk, window)
                first, count = _once(pieces.same)
                keys = pack(pieces.key[first].astype(U64), first.astype(U64), count.astype(U64))
                part = batch.slice(chunk.rows[0], len(chunk.rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number]), pa.array([_content(part)], pa.binary()), pa.array([keys], pa.binary())],
                    ["chunk", "content", "keys"])
                number += 1

    return docs.mapInArrow(lean(run), "chunk long, content binary, keys binary")


def _dealt(table: DataFrame, ranges: int) -> DataFrame:
    """``part, chunk, packed`` from packed key, place and count per chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, keys in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                yield _rows(number, _keyed(*unpack(keys), ranges))

    return table.mapInArrow(lean(run), "part int, chunk long, packed binary")


def _repeated(table: pa.Table) -> pa.Table:
    """Of one range: per chunk, the places of keys that occur twice or more in all, and how often they do."""
    received = [unpack(x) for x in table["packed"].to_pylist()]
    keys = np.concatenate([np.cumsum(x[0]) for x in received])
    count = np.concatenate([x[2] for x in received]).astype(np.int64)
    values, at = np.unique(keys, return_inverse=True)
    total = np.bincount(at, count, minlength=len(values)).astype(np.int64)[at]
    ids, rows, offset = [], [], 0
    for number, x in zip(table["chunk"].to_pylist(), received):
        mine = total[offset:offset + len(x[0])]
        offset += len(x[0])
        if (hit := mine > 1).any():
            ids.append(number)
            rows.append(pack(x[1][hit], mine[hit].astype(U64)))
    return pa.table({"chunk": pa.array(ids, pa.int64()), "packed": pa.array(rows, pa.binary())})


PARCEL = "part int, chunk long, kind int, packed binary, words binary"


def _parcels(number: int, doc_ids: np.ndarray, pieces: Pieces, key: np.ndarray, start: np.ndarray, count: np.ndarray,
             kind: int, ranges: int) -> Iterator[tuple]:
    """Distinct runs of windows for their shards: their words, and their earliest place in this chunk."""
    if not len(start):
        return
    part = ((key * U64(ranges)) >> U64(KEY_BITS)).astype(np.int64)
    same = pieces.content(start, count + pieces.window - 1)
    doc = pieces.chunk.doc[start]
    word = start - pieces.chunk.first[doc]
    order = np.lexsort((word, doc_ids[doc], same, part))
    new = np.concatenate([[True], same[order][1:] != same[order][:-1]])
    at = order[new]
    cuts = np.searchsorted(part[at], np.arange(ranges + 1))
    for r in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist():
        a = at[cuts[r]:cuts[r + 1]]
        words = b" ".join(pieces.bytes_of(s, n + pieces.window - 1) for s, n in zip(start[a].tolist(), count[a].tolist()))
        packed = pack(start[a].astype(U64), count[a].astype(U64), doc_ids[doc[a]].view(U64), word[a].astype(U64))
        yield r, number, kind, packed, squeeze(words)


def _ids(batch: pa.RecordBatch, name: str) -> np.ndarray:
    """Document ids as 64-bit numbers; null comes after all others."""
    return np.asarray(batch.column(name).cast(pa.int64()).fill_null(int(LAST_ID))).astype(np.int64)


def _cut(doc_id: str, text: str, window: int, ranges: int, most: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        """Of one chunk: segments whose gram repeats; of hot grams only the keys of their windows (kind 1, no words)."""
        out: list[tuple] = []
        if left.num_rows and right.num_rows:
            number = left["chunk"][0].as_py()
            batch, chunk = _one(left["content"][0].as_py(), text)
            pieces = Pieces(chunk, window)
            seg, total = (np.concatenate(x) for x in zip(*[unpack(x) for x in right["packed"].to_pylist()]))
            seg, hot = seg.astype(np.int64), total > most
            cold = np.flatnonzero(np.isin(pieces.same, pieces.same[seg[~hot]]))  # all copies: any may be the earliest
            out += _parcels(number, _ids(batch, doc_id), pieces, pieces.key[cold], pieces.start[cold],
                            pieces.count[cold], 0, ranges)
            if hot.any():
                h = seg[hot]
                at = flat_ranges(pieces.start[h], pieces.count[h])
                # A distinct segment stands for all its copies here, so its windows count as often.
                every = np.sort(pieces.same)
                copies = np.searchsorted(every, pieces.same[h], "right") - np.searchsorted(every, pieces.same[h], "left")
                key = pieces.content(at, np.full(len(at), window)) >> U64(64 - KEY_BITS)
                values, first, inverse = np.unique(key, return_index=True, return_inverse=True)
                times = np.bincount(inverse, np.repeat(copies, pieces.count[h])).astype(np.int64)
                out += [(r, number, 1, x, b"") for r, x in _keyed(values, at[first], times, ranges)]
        return _parcel_table(out)
    return run


def _cut_windows(doc_id: str, text: str, window: int, ranges: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        """Of one chunk: the windows under hot grams that occur twice."""
        out: list[tuple] = []
        if left.num_rows and right.num_rows:
            batch, chunk = _one(left["content"][0].as_py(), text)
            pieces = Pieces(chunk, window)
            at = np.concatenate([unpack(x)[0] for x in right["packed"].to_pylist()]).astype(np.int64)
            # The same window elsewhere in the chunk may stand earlier.
            every = pieces.content(pieces.at, np.full(len(pieces.at), window)) >> U64(64 - KEY_BITS)
            wanted = every[np.searchsorted(pieces.at, at)]
            start = pieces.at[np.isin(every, wanted)]
            key = every[np.searchsorted(pieces.at, start)]
            out += _parcels(left["chunk"][0].as_py(), _ids(batch, doc_id), pieces, key, start,
                            np.ones(len(start), np.int64), 1, ranges)
        return _parcel_table(out)
    return run


def _parcel_table(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [()] * 5
    kinds = (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
    return pa.table([pa.array(list(c), k) for c, k in zip(columns, kinds)],
                    names=["part", "chunk", "kind", "packed", "words"])


def _searched(window: int):
    def run(table: pa.Table) -> pa.Table:
        """Of one shard: the earliest place of every window, for each chunk."""
        received = [unpack(x) for x in table["packed"].to_pylist()]
        hashes = []
        for words in table["words"].to_pylist():
            (chunk,) = chunks(pa.array([expand(words)], pa.binary()).cast(pa.string()), 2**62)
            hashes.append(chunk.hashes())
        symbol = np.unique(np.concatenate(hashes), return_inverse=True)[1].astype(np.int64) + 1
        start, count, doc, word = (np.concatenate([x[i] for x in received]).astype(np.int64) for i in range(4))
        length = count + window - 1
        begin = np.cumsum(length) - length
        same = _run_hashes(symbol, begin, length)
        _, first, which = np.unique(same, return_index=True, return_inverse=True)
        text, placed = joined_text(symbol, begin[first], length[first])
        piece, offset, row = matching_windows(FMIndex(text), text, placed, length[first], window)
        # Earliest place of each distinct segment, then of each window.
        ids, rank = np.unique(doc, return_inverse=True)
        place = (rank.astype(np.int64) << 32) + word
        earliest = np.full(len(first), LAST_ID)
        np.minimum.at(earliest, which, place)
        best = np.full(len(text), LAST_ID)
        np.minimum.at(best, row, earliest[piece] + offset)
        order = np.lexsort((offset, piece))
        answer = best[row[order]]
        per = count[first]
        at = np.cumsum(per) - per
        out, done = [], 0
        for x in received:
            mine = which[done:done + len(x[0])]
            done += len(x[0])
            n = per[mine]
            found = answer[flat_ranges(at[mine], n)]
            along = np.arange(len(found)) - np.repeat(np.cumsum(n) - n, n)
            out.append(pack(x[0], x[1], ids[found >> 32].view(U64), ((found & 0xFFFFFFFF) - along).view(U64)))
        return pa.table({"chunk": table["chunk"], "kind": table["kind"], "packed": pa.array(out, pa.binary())})
    return run


def _run_hashes(symbol: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Equal runs of symbols have equal numbers: two independent 64-bit sums, told apart exactly enough to be one key."""
    base = 0x9E3779B97F4A7C15
    up = np.full(len(symbol) + 1, base, U64)
    down = np.full(len(symbol) + 1, pow(base, -1, 2**64), U64)
    up[0] = down[0] = 1
    up, down = np.multiply.accumulate(up), np.multiply.accumulate(down)
    sums = np.concatenate([[U64(0)], np.cumsum(mix(symbol.astype(U64)) * up[:-1])])
    return mix((sums[begin + length] - sums[begin]) * down[begin] + length.astype(U64))


def _removed(pieces: Pieces, doc_ids: np.ndarray, answers: list[tuple[int, bytes]]) -> np.ndarray:
    """Which words of the chunk stand in a window that starts earlier elsewhere."""
    window, chunk = pieces.window, pieces.chunk
    gone = np.zeros(len(chunk.doc) + 1, np.int32)
    own = pieces.chunk.doc
    for kind in (0, 1):
        received = [unpack(x) for k, x in answers if k == kind]
        if not received:
            continue
        start, count, doc, base = (np.concatenate([x[i] for x in received]).astype(np.int64) for i in range(4))
        if kind == 0:
            known, every, length = pieces.same, pieces.start, pieces.count
            wanted = known[np.searchsorted(every, start)]
        else:
            known, every = pieces.content(pieces.at, np.full(len(pieces.at), window)), pieces.at
            length = np.ones(len(every), np.int64)
            wanted = known[np.searchsorted(every, start)]
        order = np.argsort(wanted)
        wanted, count, first = wanted[order], count[order], (np.cumsum(count) - count)[order]
        at = np.minimum(np.searchsorted(wanted, known), len(wanted) - 1)
        hit = np.flatnonzero(wanted[at] == known)
        n = length[hit]
        w = flat_ranges(every[hit], n)  # windows here, and their answers
        a = flat_ranges(first[at[hit]], n)
        along = np.arange(len(w)) - np.repeat(np.cumsum(n) - n, n)
        mine, word = doc_ids[own[w]], w - chunk.first[own[w]]
        earlier = (doc[a] < mine) | ((doc[a] == mine) & (base[a] + along < word))
        np.add.at(gone, w[earlier], 1)
        np.add.at(gone, w[earlier] + window, -1)
    return np.cumsum(gone[:-1]) > 0


def _rest(doc_id: str, text: str, window: int, schema: T.StructType):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        """Of one chunk: its documents with the words that are left."""
        tables = []
        for content in left["content"].to_pylist():
            batch, chunk = _one(content, text)
            pieces = Pieces(chunk, window)
            answers = list(zip(right["kind"].to_pylist(), right["packed"].to_pylist()))
            gone = _removed(pieces, _ids(batch, doc_id), answers)
            removed = np.bincount(chunk.doc[gone], minlength=len(chunk.rows))
            kept = []
            for i, (f, n, r) in enumerate(zip(chunk.first.tolist(), chunk.counts.tolist(), removed.tolist())):
                at = f + np.flatnonzero(~gone[f:f + n]) if r else np.arange(f, f + n)
                if not len(at):
                    kept.append(b"")
                    continue
                # Neighbours that one space separates are copied in one go.
                s, e = chunk.starts[at], chunk.ends[at]
                apart = np.flatnonzero((s[1:] != e[:-1] + 1) | (chunk.data[e[:-1]] != 0x20))
                lo, hi = s[np.concatenate([[0], apart + 1])].tolist(), e[np.append(apart, len(e) - 1)].tolist()
                kept.append(b" ".join(chunk.data[x:y].tobytes() for x, y in zip(lo, hi)))
            full = pa.Table.from_batches([batch])
            full = full.append_column("n_words", pa.array(chunk.counts.astype(np.int64)))
            full = full.append_column("n_removed", pa.array(removed.astype(np.int64)))
            tables.append(full.append_column("kept", pa.array(kept, pa.binary()).cast(pa.string())))
        return pa.concat_tables(tables)
    return run


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = 20,
                   hot: int = HOT) -> DataFrame:
    """The columns of ``docs`` with ``n_words``, ``n_removed`` and ``kept``: the words that no window covers which starts
    earlier (in a smaller document id, or further up in the same document), joined by one space.

    Windows are judged on the input. Ids are whole numbers; null comes after all others, and rows that repeat an id are
    the same document, so neither is earlier than the other. Null, empty and short texts lose nothing; their ``kept``
    is their words, empty if there are none. An empty table gives no rows. Columns of these three names in the input
    are replaced. ``hot`` only sets how the work is dealt out, never the result.
    """
    spark = ready(docs.sparkSession)
    docs = docs.drop("n_words", "n_removed", "kept")
    ranges = SHARDS * parts(spark)
    chunked = staged(_chunked(docs, text, window), "chunks")
    content = chunked.select("chunk", "content").groupBy("chunk")

    def twice(dealt: DataFrame) -> DataFrame:
        return dealt.groupBy("part").applyInArrow(lean_group(_repeated), "chunk long, packed binary")

    found = twice(_dealt(chunked.select("chunk", "keys"), ranges))
    parcels = staged(content.cogroup(found.groupBy("chunk")).applyInArrow(
        lean_groups(_cut(doc_id, text, window, ranges, hot)), PARCEL), "segments")
    to_shards = parcels.filter("kind = 0")
    windows = parcels.filter("kind = 1").select("part", "chunk", "packed")
    if not windows.isEmpty():
        more = content.cogroup(twice(windows).groupBy("chunk")).applyInArrow(
            lean_groups(_cut_windows(doc_id, text, window, ranges)), PARCEL)
        to_shards = to_shards.union(more)
    answers = to_shards.groupBy("part").applyInArrow(
        lean_group(_searched(window)), "chunk long, kind int, packed binary")
    schema = T.StructType([*docs.schema.fields, T.StructField("n_words", T.LongType()),
                           T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())])
    return content.cogroup(answers.groupBy("chunk")).applyInArrow(
        lean_groups(_rest(doc_id, text, window, schema)), schema)
