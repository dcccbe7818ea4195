"""Operator 13: the prefix trie of conversations, from sorted sequences and a range-minimum structure.

Each conversation is a sequence of turn digests. The sequences are sorted over the cluster and cut into pieces of bounded
size. Within a piece the lengths that neighbours have in common (LCPs) go into a sparse table of range minima; every
candidate prefix then finds how far it reaches to the left and to the right by binary search in that table, each for
itself, which gives its interval of members without walking a tree. A subtree is a run of candidates in sorted order, so
sums over it are differences of running sums.

A prefix whose interval ends inside its piece is finished there. Those that touch an end of their piece are prefixes of its
first or last sequence, at most two per depth; they are merged over the pieces by grouping on depth and digest. So a
beginning that a third of all conversations share costs one row per piece and depth, not a task of its own.

A turn that no other conversation has at its position ends what a conversation can share: it and what precedes it make the
sequence, and the turns behind it are nodes of one member each, written straight from the rows. A hot conversation is
therefore never gathered beyond its shared beginning, which takes 20 bytes a turn and is the only thing that must fit a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from claimsift.llm.common import ready, running, staged

DIGEST = 16
PIECE_ROWS, PIECE_BYTES = 16_384, 8_000_000
EMPTY = hashlib.sha256(b"").hexdigest()
NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
FINISHED, PENDING, EDGE = 0, 1, 2
FOUND = ("kind int, piece long, side int, spanning boolean, conv_id long, depth long, parent_conv_id long, n_convs long, "
         "n_children long, n_leaves long, saved_tokens long, ends string, digest binary, parent binary, bytes long, "
         "goes_on int")


def turn_digest(role: Column, text: Column) -> Column:
    """128 bits of a turn's role and text, as hex."""
    told = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.substring(F.sha2(told, 256), 1, 2 * DIGEST)


def numbered_turns(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                   text: str = "text") -> DataFrame:
    """``conv_id, n, digest, bytes`` per turn; ``n`` numbers all turns in the order of conversation and turn, null turns
    first, turns of the same number by digest. Null role or text counts as empty, rows without a conversation are left
    out. The order is global, so no task sorts a whole conversation."""
    told = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = conversations.filter(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).alias("turn"),
        turn_digest(F.coalesce(F.col(role).cast("string"), F.lit("")), told).alias("digest"),
        F.octet_length(told).alias("bytes"))
    order = [F.asc("conv_id"), F.asc_nulls_first("turn"), F.asc("digest")]
    return running(rows, order, {"n": F.lit(1).cast("long")}, "turns").drop("turn")


def rebuilt_from_heads(turns: DataFrame, heads: Column, longest: int = 8, group: int = 5) -> tuple[DataFrame, DataFrame]:
    """Every conversation c with the first ``heads`` turns of conversation c - c % ``group`` in place of its own.

    ``heads`` is an expression on ``conv_id`` whose values are at most ``longest``. Takes the numbered turns; gives
    ``conv_id, pos, digest, bytes`` per rebuilt turn (positions from 1), and ``conv_id, full`` with the rebuilt length of
    each conversation, which may be 0. Negative ids count towards 0 like positive ones: -3 belongs to conversation 0.
    """
    first = F.col("conv_id") - F.col("conv_id") % group
    own = turns.groupBy("conv_id").agg((F.min("n") - 1).alias("before"), F.count("*").alias("own")).select(
        "*", heads.cast("long").alias("h"), first.alias("base"))
    bases = own.filter("conv_id = base").select(F.col("conv_id").alias("base"), F.col("own").alias("there"))
    taken = F.least("h", F.coalesce("there", F.lit(0)))
    convs = staged(own.join(bases, "base", "left").select(
        "conv_id", "before", "h", taken.alias("taken"),
        (taken + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("full")), "convs")
    placed = turns.join(convs, "conv_id").withColumn("pos", F.col("n") - F.col("before"))
    rest = placed.filter("pos > h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "digest", "bytes")
    c = F.col("conv_id")
    step = F.sequence(F.when(c > 0, 0).otherwise(1 - group), F.when(c < 0, 0).otherwise(group - 1))
    led = placed.filter((c % group == 0) & (F.col("pos") <= longest)).select(
        F.explode(F.transform(step, lambda i: c + i)).alias("conv_id"), "pos", "digest", "bytes").filter(
        F.col("pos") <= heads).join(convs.select("conv_id"), "conv_id", "left_semi")
    return staged(rest.unionByName(led), "rebuilt"), convs.select("conv_id", "full")


def prefix_trie(turns: DataFrame, convs: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """The nodes of the trie of all conversations, as columns ``NODE``.

    ``turns`` has ``conv_id, pos, digest, bytes`` with positions 1 to ``full`` of each conversation, ``convs`` its
    ``conv_id`` once with ``full``. A node is a distinct sequence of first turns; its ``conv_id`` is the smallest member,
    ``parent_conv_id`` that of its parent (null at the root), ``saved_tokens`` the bytes that need not be read again if
    every node of its subtree is read once, ``ends_sha256`` the hash of the ids that end there, ascending, joined by
    commas. SHA-256 takes bytes in order, so the ids of one node that end in several pieces pass through one task, as
    text and in a stream; nothing else does. Conversations without turns end at the root. Without any there is no node.
    ``piece_rows`` bounds the sequences of a piece. Other columns are ignored.
    """
    spark = ready(turns.sparkSession)
    alone = turns.groupBy("pos", "digest").agg(F.count("*").alias("n"), F.min("conv_id").alias("conv_id")).filter(
        "n = 1").groupBy("conv_id").agg(F.min("pos").alias("cut"))
    lengths = staged(convs.select("conv_id", "full").join(alone, "conv_id", "left"), "lengths")
    marked = turns.join(lengths, "conv_id")
    shared = marked.filter("cut IS NULL OR pos <= cut").groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("pos", "digest", "bytes"))).alias("turns"))
    keyed = lengths.join(shared, "conv_id", "left").select(
        "conv_id", "full", F.coalesce(F.unhex(F.array_join("turns.digest", "")), F.lit(b"")).alias("key"),
        F.coalesce("turns.bytes", F.array().cast("array<int>")).alias("bytes"))
    keyed = staged(keyed, "keys")
    order = ["key", "conv_id"]
    pieces = keyed.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(
        *order).select("conv_id", "full", "key", "bytes")
    found = staged(pieces.mapInArrow(_pieces(piece_rows), FOUND), "nodes")
    edges = _merged(found.filter(F.col("kind") == EDGE))
    known = edges["local"].select("piece", (F.col("depth") + 1).alias("depth"), F.col("digest").alias("parent"),
                                  F.col("least").alias("parent_conv_id"))
    finished = found.filter(F.col("kind") == FINISHED).withColumnRenamed("ends", "ends_sha256").select(*NODE)
    pending = found.filter(F.col("kind") == PENDING).withColumnRenamed("ends", "ends_sha256").drop("parent_conv_id").join(
        known, ["piece", "depth", "parent"]).select(*NODE)
    last = F.col("pos") == F.col("full")
    tails = marked.filter("pos > cut").select(
        "conv_id", F.col("pos").cast("long").alias("depth"), F.col("conv_id").alias("parent_conv_id"),
        F.lit(1).cast("long").alias("n_convs"), F.when(last, 0).otherwise(1).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"),
        F.when(last, F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(F.lit(EMPTY)).alias("ends_sha256"))
    return finished.unionByName(pending).unionByName(edges["nodes"]).unionByName(tails)


def range_minima(values: np.ndarray) -> list[np.ndarray]:
    """``t[k][i]`` is the least of ``values[i:i + 2**k]``."""
    table = [values]
    while 2 ** len(table) <= len(values):
        half = 2 ** (len(table) - 1)
        table.append(np.minimum(table[-1][:-half], table[-1][half:]))
    return table


def reach_right(table: list[np.ndarray], row: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """Last row that shares at least ``depth`` with each row."""
    at, n = row.copy(), len(table[0])
    for k in reversed(range(len(table))):
        step = 2**k
        fits = np.flatnonzero(at + step < n)
        go = fits[table[k][at[fits] + 1] >= depth[fits]]
        at[go] += step
    return at


def reach_left(table: list[np.ndarray], row: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """First row that shares at least ``depth`` with each row."""
    at = row.copy()
    for k in reversed(range(len(table))):
        step = 2**k
        fits = np.flatnonzero(at >= step)
        go = fits[table[k][at[fits] - step + 1] >= depth[fits]]
        at[go] -= step
    return at


def least_between(table: list[np.ndarray], lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    out, level = np.empty(len(lo), np.int64), np.frexp((hi - lo + 1).astype(np.float64))[1] - 1
    for k in np.unique(level):
        i = np.flatnonzero(level == k)
        out[i] = np.minimum(table[k][lo[i]], table[k][hi[i] - 2**k + 1])
    return out


def common_lengths(digests: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Digests that each sequence shares with the one before; -1 for the first, whose neighbour lies elsewhere."""
    common = np.zeros(len(size), np.int64)
    common[0] = -1
    limit = np.concatenate([[0], np.minimum(size[1:], size[:-1])])
    depth, rows = 0, np.flatnonzero(limit > 0)
    while len(rows):
        rows = rows[(digests[first[rows] + depth] == digests[first[rows - 1] + depth]).all(axis=1)]
        depth += 1
        common[rows] = depth
        rows = rows[limit[rows] > depth]
    return common


def _chain(key: memoryview) -> list[bytes]:
    """A digest of each prefix, from the empty one on."""
    h = hashlib.sha256()
    out = [h.digest()[:DIGEST]]
    for at in range(0, len(key), DIGEST):
        h.update(key[at:at + DIGEST])
        out.append(h.copy().digest()[:DIGEST])
    return out


def _pieces(piece_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, size, count = [], 0, 0, 0
        first = TaskContext.get().partitionId() << 32
        step = min(piece_rows, 1024)
        for whole in batches:
            for at in range(0, whole.num_rows, step):
                part = whole.slice(at, step)
                held.append(part)
                rows, size = rows + part.num_rows, size + sum(len(k.as_buffer()) for k in part.column(2))
                if rows >= piece_rows or size >= PIECE_BYTES:
                    yield from _nodes(pa.Table.from_batches(held), first + count)
                    held, rows, size, count = [], 0, 0, count + 1
        if rows:
            yield from _nodes(pa.Table.from_batches(held), first + count)
    return run


def _nodes(piece: pa.Table, number: int) -> Iterator[pa.RecordBatch]:
    """The nodes that begin in a piece of sorted sequences."""
    piece = piece.combine_chunks()
    conv, full = np.asarray(piece["conv_id"]), np.asarray(piece["full"])
    keys = b"".join(piece["key"].to_pylist())
    size = np.asarray([len(k.as_buffer()) for k in piece["key"]]) // DIGEST
    weights = np.asarray(piece["bytes"].combine_chunks().flatten(), np.int64)
    n, first = len(conv), np.cumsum(size) - size
    digests = np.frombuffer(keys, np.uint64).reshape(-1, 2)
    common = common_lengths(digests, first, size)
    table = range_minima(common)

    # Candidates: each depth at which a sequence leaves the one before it.
    count = size - common
    start = np.concatenate([[0], np.cumsum(count)])
    row = np.repeat(np.arange(n), count)
    depth = np.arange(len(row)) - start[row] + common[row] + 1
    hi = reach_right(table, row, depth)
    fresh = (depth == common[row] + 1) & (row > 0)
    parent = np.arange(len(row)) - 1
    up = reach_left(table, row[fresh], depth[fresh] - 1)
    parent[fresh] = start[up] + depth[fresh] - 1 - (common[up] + 1)
    edge = (row == 0) | (hi == n - 1)

    inner = ~edge
    children = np.bincount(parent[inner], minlength=len(row)) if inner.any() else np.zeros(len(row), np.int64)
    own = np.zeros(len(row), np.int64)
    deep = np.flatnonzero(depth > 0)
    own[deep] = weights[first[row[deep]] + depth[deep] - 1]
    last_bytes = own.copy()
    own = np.where(inner, own * (hi - row), 0)
    saved, leaves = np.concatenate([[0], np.cumsum(own)]), np.concatenate([[0], np.cumsum(inner & (children == 0))])
    end, here = start[hi + 1], np.arange(len(row))
    least = least_between(range_minima(conv), row, hi)
    goes_on = ((depth == size[row]) & (full[row] > depth)).astype(np.int64)

    ends = np.full(len(row), EMPTY, object)
    ends[edge] = None
    for a, b in zip((heads := np.flatnonzero(count > 0)), [*heads[1:], n]):
        if full[a] == size[a]:
            text, at = ",".join(map(str, conv[a:b].tolist())), start[a + 1] - 1
            ends[at] = text if edge[at] else hashlib.sha256(text.encode()).hexdigest()

    left, right = _chain(memoryview(keys)[:DIGEST * size[0]]), _chain(memoryview(keys)[DIGEST * first[-1]:])
    at = lambda i, d: (left if row[i] == 0 else right)[d]  # noqa: E731  digest of a prefix of the first or last sequence
    digest, above = np.full(len(row), None, object), np.full(len(row), None, object)
    for i in np.flatnonzero(edge):
        digest[i], above[i] = at(i, depth[i]), at(i, depth[i] - 1) if depth[i] else None
    pending = inner & edge[parent]
    for i in np.flatnonzero(pending):
        above[i] = at(parent[i], depth[i] - 1)
    kind = np.where(edge, EDGE, np.where(pending, PENDING, FINISHED))
    columns = [
        pa.array(kind, pa.int32()), pa.array(np.full(len(row), number)), pa.array((row > 0).astype(np.int32)),
        pa.array((row == 0) & (hi == n - 1)), pa.array(least), pa.array(depth), pa.array(least[parent], mask=kind != FINISHED),
        pa.array(hi - row + 1), pa.array(children + np.where(inner, goes_on, 0)), pa.array(leaves[end] - leaves[here]),
        pa.array(saved[end] - saved[here]), pa.array(ends, pa.string()), pa.array(digest, pa.binary()),
        pa.array(above, pa.binary()), pa.array(last_bytes), pa.array(goes_on, pa.int32()),
    ]
    whole = pa.RecordBatch.from_arrays(columns, [f.split(" ")[0] for f in FOUND.split(", ")])
    yield from (whole.slice(j, 8192) for j in range(0, whole.num_rows, 8192))


def _merged(edges: DataFrame) -> dict[str, DataFrame]:
    """``nodes``: the nodes that touch an end of some piece. ``local``: the smallest member of each, by piece."""
    node = ["depth", "digest"]
    whole = edges.groupBy(*node).agg(
        F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("least"), F.sum("n_children").alias("inner"),
        F.sum("goes_on").alias("goes_on"), F.max("bytes").alias("bytes"), F.min("piece").alias("owner"),
        F.max("parent").alias("parent"))
    whole = staged(whole, "edges")
    below = whole.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("digest")).agg(
        F.count("*").alias("outer"))
    under = whole.select((F.col("depth") + 1).alias("depth"), F.col("digest").alias("parent"),
                         F.col("least").alias("parent_conv_id"))
    counted = staged(whole.join(below, node, "left").join(under, ["depth", "parent"], "left").withColumn(
        "branches", F.col("inner") + F.coalesce("outer", F.lit(0))), "branches")

    # What an edge node itself adds is counted in the first piece that has it, for all prefixes of it there.
    mine = F.col("piece") == F.col("owner")
    local = staged(edges.select("piece", "side", "spanning", *node, "n_leaves", "saved_tokens").join(
        counted.select(*node, "owner", "least", "n_convs", "bytes", "branches"), node).select(
        "piece", "side", "spanning", *node, "least", "n_leaves", "saved_tokens",
        F.when(mine, (F.col("n_convs") - 1) * F.col("bytes")).otherwise(0).alias("own"),
        F.when(mine & (F.col("branches") == 0), 1).otherwise(0).alias("leaf")), "local")
    chain = Window.partitionBy("piece", "side").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    other = Window.partitionBy("piece")

    def within(own: str) -> Column:
        right = F.sum(F.when(F.col("side") == 1, F.col(own)).otherwise(0)).over(other)
        return F.sum(own).over(chain) + F.when(F.col("spanning"), right).otherwise(0)

    sums = local.select(*node, (F.col("n_leaves") + within("leaf")).alias("n_leaves"),
                        (F.col("saved_tokens") + within("own")).alias("saved_tokens"))
    totals = sums.groupBy(*node).agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    told = edges.filter("ends IS NOT NULL").select(*node, "piece", "ends").repartition(*node).sortWithinPartitions(
        *node, "piece")
    hashes = told.mapInArrow(_hashed, "depth long, digest binary, ends_sha256 string")
    nodes = counted.join(totals, node).join(hashes, node, "left").select(
        F.col("least").alias("conv_id"), "depth", "parent_conv_id", "n_convs",
        (F.col("branches") + F.col("goes_on")).alias("n_children"), "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"))
    return {"nodes": nodes, "local": local}


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One hash per node, over what its pieces hold, in order."""
    names, open_node, h = ["depth", "digest", "ends_sha256"], None, None

    def closed():
        return pa.RecordBatch.from_arrays(
            [pa.array([open_node[0]]), pa.array([open_node[1]], pa.binary()), pa.array([h.hexdigest()])], names)

    for batch in batches:
        for depth, digest, _, text in zip(*(c.to_pylist() for c in batch.columns)):
            if (depth, digest) != open_node:
                if open_node:
                    yield closed()
                open_node, h = (depth, digest), hashlib.sha256(text.encode())
            else:
                h.update(b"," + text.encode())
    if open_node:
        yield closed()
