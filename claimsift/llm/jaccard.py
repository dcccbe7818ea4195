"""Operator 3: documents whose word shingles overlap, by an exact set-similarity join.

Every document becomes the set of its 5-word shingles (48-bit hashes); documents with equal sets form a class. The join
keeps all links between classes without ever comparing all pairs of a group:

1. *Counts.* Chunks of documents send their shingles, packed, to ranges of shingles, which send back those that a second
   class holds, with their frequency. Shingles found once never count towards an overlap, so a class with fewer than
   75 % of shared shingles has no partner and goes no further.
2. *Index lists.* Shingles in order of frequency, a class is listed under its first ones only, as many as a partner
   cannot all miss. A list is in order of set size. What a member still has from its position in the list on bounds what
   it can share, and so the sizes of its partners: they are one block of the list, found by binary search, and everything
   before and behind it is skipped. A member whose block holds nobody else leaves the list. The pairs of a short list are
   masked by the same bounds.
3. *Hubs.* A long list pairs each member that is left only with its hub, the member whose shingles are the most common. The overlaps
   with the hub bound the overlap of any two members from both sides: |x&y| >= |x&h| + |y&h| - |h| and
   |x&y| <= min(|x&h|, |y&h|) + min(|x'|-|x&h|, |y'|-|y&h|), where x' is what x shares with any class. So the answers of a set follow from those of the hub
   it resembles; only pairs that the bounds leave open, and that links do not already connect, are computed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from claimsift.llm.common import U64, lean, lean_group, pack, parts, ready, signed, staged, unpack, unsigned
from claimsift.llm.components import connected_components
from claimsift.llm.words import Chunk, chunks, mix, sequence_hashes

TOKEN_BITS, DOC_BITS = U64(48), U64(16)
CHUNK = 3_000_000
#: Lists up to this length emit their pairs; longer ones go by their hub. Either way gives the same links.
SHORT_LIST = 12


def shingle_keys(chunk: Chunk, k: int) -> np.ndarray:
    """Sorted distinct ``shingle << 16 | document`` of a chunk. Fewer than ``k`` words are one shingle."""
    h = chunk.hashes(lower=True)
    at = chunk.windows(k)
    tokens, docs = [sequence_hashes(h, k)[at] if len(at) else np.zeros(0, U64)], [chunk.doc[at]]
    for m in range(1, k):
        short = np.flatnonzero(chunk.counts == m)
        whole = sum((h[chunk.first[short] + j] * U64(2 * j + 3) for j in range(m)), np.zeros(len(short), U64))
        tokens.append(mix(whole * U64(k) + U64(m)))
        docs.append(short)
    keys = np.concatenate(tokens) >> DOC_BITS << DOC_BITS | np.concatenate(docs).astype(U64)
    keys.sort()
    return keys[np.concatenate([[True], keys[1:] != keys[:-1]])] if len(keys) else keys


def _doc(keys: np.ndarray) -> np.ndarray:
    return (keys & U64(0xFFFF)).astype(np.int64)


def set_prints(keys: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Set size and a 64-bit fingerprint of each document's set, whatever the order of its elements."""
    doc = _doc(keys)
    sizes = np.bincount(doc, minlength=docs)
    sums = np.zeros(docs, U64)
    np.add.at(sums, doc, mix(keys >> DOC_BITS))
    return sizes, mix(sums + sizes.astype(U64))


def document_sets(docs: DataFrame, doc_id: str, text: str, k: int) -> DataFrame:
    """``doc_id, n_shingles, print``; the print of a document without words is null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(1), CHUNK):
                sizes, prints = set_prints(shingle_keys(chunk, k), len(chunk.rows))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(chunk.rows[0], len(chunk.rows)), pa.array(sizes.astype(np.int64)),
                    pa.array(signed(prints), mask=sizes == 0)], ["doc_id", "n_shingles", "print"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(
        lean(run), f"doc_id {kind}, n_shingles long, print long")


def _bounds(ranges: int) -> np.ndarray:
    return np.array([-(-(i << 48) // ranges) for i in range(ranges + 1)], U64)


def _deltas(values: np.ndarray) -> np.ndarray:
    return np.diff(values, prepend=U64(0))


def _sent(docs: DataFrame, text: str, k: int, ranges: int) -> DataFrame:
    """``part, chunk, packed``: the shingles of each chunk by range; the first of a chunk also lists its sets."""
    bounds = _bounds(ranges)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # prints of this partition: copies within it are sent once
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for chunk in chunks(batch.column(0), CHUNK):
                keys = shingle_keys(chunk, k)
                sizes, prints = set_prints(keys, len(chunk.rows))
                new = np.zeros(len(sizes), bool)
                for i in np.flatnonzero(sizes):
                    if (p := int(prints[i])) not in seen:
                        seen.add(p)
                        new[i] = True
                keys = keys[new[_doc(keys)]]
                if not len(keys):
                    continue
                tokens, doc = keys >> DOC_BITS, (np.cumsum(new) - 1)[_doc(keys)].astype(U64)
                cuts = np.searchsorted(tokens, bounds)
                used = np.flatnonzero(cuts[1:] > cuts[:-1])
                sets = (prints[new], sizes[new].astype(U64))
                rows = [pack(_deltas(tokens[cuts[r]:cuts[r + 1]]), doc[cuts[r]:cuts[r + 1]],
                             *(sets if r == used[0] else ())) for r in used]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(used.astype(np.int32)), pa.array(np.full(len(used), number)), pa.array(rows, pa.binary())],
                    ["part", "chunk", "packed"])
                number += 1

    return docs.select(F.col(text).cast("string").alias("text")).mapInArrow(
        lean(run), "part int, chunk long, packed binary")


def _shared(table: pa.Table) -> pa.Table:
    """Of one range: per chunk, the shingles that are found more than once, with their frequency."""
    chunk, received = np.asarray(table["chunk"]), [unpack(x) for x in table["packed"].to_pylist()]
    tokens = [np.cumsum(x[0]) for x in received]
    every = np.sort(np.concatenate(tokens))
    edge = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1], [True]]))
    often = np.flatnonzero(np.diff(edge) > 1)
    values, counts = every[edge[often]], np.diff(edge)[often].astype(U64)
    ids, rows = [], []
    for number, mine, x in zip(chunk.tolist(), tokens, received):
        at = np.searchsorted(values, mine)
        hit = values[np.minimum(at, len(values) - 1)] == mine if len(values) else np.zeros(len(mine), bool)
        if hit.any() or len(x) > 2:
            ids.append(number)
            rows.append(pack(_deltas(mine[hit]), x[1][hit], counts[at[hit]], *x[2:]))
    return pa.table({"chunk": pa.array(ids, pa.int64()), "packed": pa.array(rows, pa.binary())})


def least_overlap(n: np.ndarray, percent: int) -> np.ndarray:
    """Shingles that a set of size ``n`` shares with any partner, at least."""
    return (percent * n + 99) // 100


def _gathered(percent: int):
    def run(table: pa.Table) -> pa.Table:
        """Of one chunk: the sets that have enough shared shingles to have a partner, rarest first."""
        received = [unpack(x) for x in table["packed"].to_pylist()]
        prints, sizes = next(x[3:] for x in received if len(x) > 3)
        tokens = np.concatenate([np.cumsum(x[0]) for x in received])
        doc, count = (np.concatenate([x[i] for x in received]).astype(np.int64) for i in (1, 2))
        order = np.lexsort((tokens, count, doc))
        tokens, doc, count = tokens[order], doc[order], count[order]
        held = np.bincount(doc, minlength=len(prints))
        common = np.bincount(doc, count, minlength=len(prints)) / np.maximum(1, sizes.astype(np.int64))
        start = np.cumsum(held) - held
        kept = np.flatnonzero(held >= np.maximum(1, least_overlap(sizes.astype(np.int64), percent)))
        return pa.table({
            "print": pa.array(signed(prints[kept])), "size": pa.array(sizes[kept].astype(np.int64)),
            "common": pa.array(common[kept]),
            "tokens": pa.array([tokens[start[i]:start[i] + held[i]].tobytes() for i in kept], pa.binary())})
    return run


def candidate_sets(docs: DataFrame, text: str, k: int, percent: int) -> DataFrame:
    """``print, size, common, tokens`` of the classes that can have a partner, once each."""
    spark = docs.sparkSession
    shared = _sent(docs, text, k, parts(spark)).groupBy("part").applyInArrow(
        lean_group(_shared), "chunk long, packed binary")
    sets = shared.groupBy("chunk").applyInArrow(
        lean_group(_gathered(percent)), "print long, size long, common double, tokens binary")
    return sets.dropDuplicates(["print"])


def _listed(sets: DataFrame, percent: int, ranges: int) -> DataFrame:
    """``part, packed``: the index entries of the sets of a batch, by range of shingles."""
    bounds = _bounds(ranges)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            prints, sizes = unsigned(batch.column(0)), np.asarray(batch.column(1))
            rank = np.asarray(batch.column(2)).view(U64)  # non-negative doubles sort as their bits
            held = [np.frombuffer(x, U64) for x in batch.column(3).to_pylist()]
            lists = np.array([len(x) for x in held]) - least_overlap(sizes, percent) + 1
            token = np.concatenate([x[:n] for x, n in zip(held, lists)])
            at = np.repeat(np.arange(len(held)), lists)
            # What is left from a position on, itself included.
            left = np.concatenate([len(x) - np.arange(n) for x, n in zip(held, lists)])
            order = np.argsort(token)
            token, at, left = token[order], at[order], left[order]
            cuts = np.searchsorted(token, bounds)
            used = np.flatnonzero(cuts[1:] > cuts[:-1])
            rows = []
            for r in used:
                s = slice(cuts[r], cuts[r + 1])
                rows.append(pack(_deltas(token[s]), prints[at[s]], sizes[at[s]].astype(U64), left[s].astype(U64),
                                 rank[at[s]]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(used.astype(np.int32)), pa.array(rows, pa.binary())], ["part", "packed"])

    return sets.select("print", "size", "common", "tokens").mapInArrow(lean(run), "part int, packed binary")


def _reach(na: np.ndarray, nb: np.ndarray, bound: np.ndarray, percent: int) -> np.ndarray:
    """Whether an overlap of ``bound`` would do for sets of these sizes."""
    return 100 * bound >= percent * (na + nb - bound)


def _with_partner(of: np.ndarray, size: np.ndarray, left: np.ndarray, percent: int) -> np.ndarray:
    """Entries whose block of possible partners holds another entry.

    Entries are in order of list (``of``) and size. A set of size a that can share at most ``left`` has partners of sizes b
    with percent * a <= 100 * b <= 100 * 100 * a / percent and 100 * left >= percent * (a + b - left).
    """
    low = (percent * size + 99) // 100
    high = np.minimum(100 * size // percent, (100 + percent) * left // percent - size)
    wide = int(max(size.max(initial=0), high.max(initial=0))) + 2
    place = of * wide + size
    first = np.searchsorted(place, of * wide + low, "left")
    behind = np.searchsorted(place, of * wide + np.maximum(high, -1), "right")
    return behind - first - ((low <= size) & (size <= high)) > 0


def _paired(percent: int):
    def run(table: pa.Table) -> pa.Table:
        """Of one range: pairs of short lists, and the pairs of hub and member of long ones."""
        received = [unpack(x) for x in table["packed"].to_pylist()]
        token = np.concatenate([np.cumsum(x[0]) for x in received])
        prints, size, left, rank = (np.concatenate([x[i] for x in received]) for i in range(1, 5))
        size, left = size.astype(np.int64), left.astype(np.int64)
        order = np.lexsort((prints, size, token))
        token, prints, size, left, rank = (x[order] for x in (token, prints, size, left, rank))
        edge = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1], [True]]))
        start, length = edge[:-1], np.diff(edge)
        found: list[tuple[np.ndarray, np.ndarray, bool]] = []
        for n in range(2, SHORT_LIST + 1):
            # A list is in order of size: pairs are masked where the smaller set is too small, or where the positions
            # leave too little to share.
            lists = start[length == n]
            for gap in range(1, n):
                for i in range(n - gap):
                    x, y = lists + i, lists + i + gap
                    most = np.minimum(np.minimum(left[x], left[y]), size[x])
                    ok = _reach(size[x], size[y], most, percent)
                    found.append((prints[x[ok]], prints[y[ok]], False))
        long = np.flatnonzero(length > SHORT_LIST)
        if len(long):
            of = np.repeat(np.arange(len(long)), length[long])
            at = np.concatenate([np.arange(s, s + n) for s, n in zip(start[long], length[long])])
            some = _with_partner(of, size[at], left[at], percent)
            of, at = np.unique(of[some], return_inverse=True)[1], at[some]
            order = np.lexsort((prints[at], ~rank[at], of))  # the most common first
            hub = at[order][np.searchsorted(of, np.arange(of.max(initial=-1) + 1))][of]
            found.append((prints[hub][hub != at], prints[at][hub != at], True))
        if not found:
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64()), "hub": pa.array([], pa.bool_())})
        a, b = (np.concatenate([x[i] for x in found]) for i in (0, 1))
        hub = np.concatenate([np.full(len(x[0]), x[2]) for x in found])
        turn = (a > b) & ~hub
        a, b = np.where(turn, b, a), np.where(turn, a, b)
        order = np.lexsort((hub, b, a))
        a, b, hub = a[order], b[order], hub[order]
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (hub[1:] != hub[:-1])
        return pa.table({"a": signed(a[new]), "b": signed(b[new]), "hub": hub[new]})
    return run


PAIR = ("a", "b", "hub", "a_size", "b_size", "a_held", "b_held")


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        known, left = None, None
        shared = []
        for x, y in zip(batch.column("a_tokens"), batch.column("b_tokens")):
            x = x.as_buffer()
            if known is None or not x.equals(known):
                known, left = x, np.sort(np.frombuffer(x, U64))
            right = np.frombuffer(y.as_buffer(), U64)
            at = np.searchsorted(left, right)
            shared.append(int((left[np.minimum(at, len(left) - 1)] == right).sum()))
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in PAIR), pa.array(shared, pa.int64())], [*PAIR, "shared"])


def _computed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The columns :data:`PAIR` and ``shared`` of pairs of classes; ``held`` counts shingles that other classes have."""
    def side(s: str) -> DataFrame:
        return sets.select(F.col("print").alias(s), F.col("size").alias(f"{s}_size"), F.col("tokens").alias(f"{s}_tokens"),
                           F.expr("octet_length(tokens) div 8").alias(f"{s}_held"))
    joined = pairs.join(side("b"), "b").join(side("a"), "a")
    return joined.select(*PAIR, "a_tokens", "b_tokens").mapInArrow(
        lean(_overlaps), "a long, b long, hub boolean, a_size long, b_size long, a_held long, b_held long, shared long")


def _linked(overlap: str, a_size: str, b_size: str, percent: int) -> F.Column:
    return F.expr(f"100 * ({overlap}) >= {percent} * ({a_size} + {b_size} - ({overlap}))")


def class_links(docs: DataFrame, text: str, k: int = 5, percent: int = 75) -> DataFrame:
    """``a, b``: links between prints of different sets that connect all classes which similarity connects."""
    spark = docs.sparkSession
    sets = staged(candidate_sets(docs, text, k, percent), "sets")
    pairs = _listed(sets, percent, parts(spark)).groupBy("part").applyInArrow(
        lean_group(_paired(percent)), "a long, b long, hub boolean")
    first = staged(_computed(pairs.groupBy("a", "b").agg(F.max("hub").alias("hub")), sets), "overlaps")
    links = first.filter(_linked("shared", "a_size", "b_size", percent)).select("a", "b")
    spokes = first.filter("hub").select(
        F.col("a").alias("h"), F.col("b").alias("x"), F.col("a_size").alias("h_size"), F.col("b_size").alias("x_size"),
        F.col("b_held").alias("x_held"), F.col("shared").alias("x_shared"))
    if spokes.isEmpty():
        return links
    roots = connected_components(links, "a", "b")
    def rooted(frame: DataFrame, node: str) -> DataFrame:
        root = roots.select(F.col("node").alias(node), F.col("root").alias(f"{node}_root"))
        return frame.join(root, node, "left").withColumn(f"{node}_root", F.coalesce(f"{node}_root", node))
    spokes = staged(rooted(rooted(spokes, "x"), "h"), "spokes")
    apart = spokes.filter("x_root <> h_root").select(
        "h", *[F.col(f"x{c}").alias(f"y{c}") for c in ("", "_size", "_held", "_shared", "_root")])
    # What the hub's answers leave open between a member that it is not linked to and any other member.
    most = "least(x_shared, y_shared) + least(x_held - x_shared, y_held - y_shared)"
    open_pairs = spokes.alias("s").join(
        apart.alias("t"),
        F.expr("s.h = t.h AND x_root <> y_root AND (x_root = h_root OR x < y)")
        & _linked(most, "x_size", "y_size", percent))
    sure = _linked("x_shared + y_shared - h_size", "x_size", "y_size", percent)
    decided = open_pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), sure.alias("sure"))
    decided = staged(decided.groupBy("a", "b").agg(F.max("sure").alias("sure")), "open")
    second = _computed(decided.filter("NOT sure").select("a", "b", F.lit(False).alias("hub")), sets)
    return links.union(decided.filter("sure").select("a", "b")).union(
        second.filter(_linked("shared", "a_size", "b_size", percent)).select("a", "b"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = 5,
                    percent: int = 75) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for each row of ``docs``.

    Two documents link when at least ``percent`` per cent of the union of their sets is shared; the component id is the
    smallest document id that links reach. Null, empty and blank texts have no shingles and are their own component.
    Rows that repeat an id or a text are equal sets and share a component; a component without any id has a null one.
    An empty table gives no rows. Other columns are ignored, whatever their names. Read ``docs`` from storage: chunks
    are told apart by the partition they are read in.
    """
    ready(docs.sparkSession)
    members = staged(document_sets(docs, doc_id, text, k), "members")
    roots = connected_components(class_links(docs, text, k, percent), "a", "b").select(
        F.col("node").alias("print"), "root")
    classes = members.filter("print IS NOT NULL").groupBy("print").agg(F.min("doc_id").alias("least"))
    rooted = staged(classes.join(roots, "print", "left").select("print", "least", F.coalesce("root", "print").alias("root")),
                    "classes")
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(smallest, "root").select("print", "component_id")
    joined = members.join(named, "print", "left")
    own = F.when(F.col("print").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return joined.select("doc_id", "n_shingles", own.alias("component_id"))
