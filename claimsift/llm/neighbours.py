"""Operator 11: approximate nearest neighbours over a graph built by NN-descent.

Equal vectors form one node. A node's first list of neighbours comes from blocks along a few random sortings. Then, round
by round, lists improve through their neighbours' neighbours: every node tells the nodes on its list that it lists them
(a shuffle), sends its code to all nodes that list it or that it lists (a second), each node compares those that met there
with each other, and what beats the end of a list goes to its owner (a third). An entry takes part as new once, later only
against new ones, and a round takes a bounded sample of a list and of those that list a node, so a node that all others
list costs no more than others. Rounds end when few entries change.

Queries are nodes too. A greedy search starts from a query's own list and opens the nearest unopened nodes of its beam, again
by shuffles, until all of the beam is open. Codes are vectors of 8-bit numbers, whose inner products are whole numbers and
so do not depend on the order of adding; the best of the beam are compared again by the vectors themselves.

Nodes are dealt to parts by a hash of their number, and the parts grow in number with the nodes. Each round is written to
the shared folder, so a lost executor repeats no more than the round at hand. What reaches the driver is a count a round.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from claimsift.llm.common import U64, pack, parts, ready, staged, unpack
from claimsift.llm.words import mix


@dataclass(frozen=True)
class Graph:
    """``neighbours``: length of a list. ``sample``: new and old entries of a list, and of those that list a node, that meet
    in a round. ``orders`` random sortings cut into blocks of ``block`` give the first lists. Building ends after ``rounds``
    or once fewer than ``least_change`` of the entries change. ``beam`` nodes are kept per query and ``step`` opened at a
    time; the best ``exact`` are compared by the vectors. A part has ``per_part`` nodes at most, on average, and not many
    fewer than ``least_part``, since every part may write to every other."""

    neighbours: int = 24
    sample: int = 12
    orders: int = 6
    block: int = 256
    rounds: int = 12
    least_change: float = 0.01
    beam: int = 320
    step: int = 80
    exact: int = 32
    per_part: int = 20_000
    least_part: int = 500
    seed: int = 11


STATE, CODES, FOUND, LISTED, MET, COUNT, QUERY, OPEN, ASKED = range(9)
MESSAGE = "part int, kind int, n long, packed binary"
NAMES = ["part", "kind", "n", "packed"]
NONE = -1


def _messages(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [[], [], [], []]
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.binary())
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], NAMES)


def _dealt(kind: int, part: np.ndarray, *arrays: np.ndarray) -> list[tuple]:
    """One message to each part that gets any of the entries."""
    order = np.argsort(part, kind="stable")
    part = part[order]
    edges = [*np.flatnonzero(np.diff(part, prepend=-1)).tolist(), len(part)]
    return [(int(part[a]), kind, b - a, pack(*[x[order[a:b]].ravel() for x in arrays])) for a, b in zip(edges, edges[1:])]


def _read(table: pa.Table, kind: int, width: int) -> list[np.ndarray]:
    """The arrays of all messages of a kind, each joined in an order of their own."""
    found = sorted(p for k, p in zip(table["kind"].to_pylist(), table["packed"].to_pylist()) if k == kind)
    arrays = [unpack(p) for p in found]
    return [np.concatenate([a[i] for a in arrays]) if arrays else np.zeros(0, U64) for i in range(width)]


def _ids(a: np.ndarray) -> np.ndarray:
    return a.view(np.int64)


def _bits(a: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(a, np.float32).view(np.uint32)


def _reals(a: np.ndarray) -> np.ndarray:
    return a.astype(np.uint32).view(np.float32)


def _home(node: np.ndarray, count: int) -> np.ndarray:
    return (mix(node.astype(np.int64).view(U64)) % U64(count)).astype(np.int64)


def _likeness(a: np.ndarray, b: np.ndarray, scale_a: np.ndarray, scale_b: np.ndarray) -> np.ndarray:
    """Inner products of codes, all of ``a`` with all of ``b`` within each block. Products of 8-bit numbers add up to whole
    numbers that the floating type holds, so the result is the same in any order."""
    kind = np.float32 if a.shape[-1] <= 1024 else np.float64
    whole = a.astype(kind) @ np.swapaxes(b.astype(kind), -1, -2)
    return (whole * (scale_a[..., :, None] * scale_b[..., None, :])).astype(np.float32)


def _ranked(row: np.ndarray, *order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by row and then by ``order``, and the place of each entry within its row."""
    by = np.lexsort((*reversed(order), row))
    sorted_row = row[by]
    first = np.searchsorted(sorted_row, sorted_row)
    return by, np.arange(len(row)) - first


def _first_of(row: np.ndarray, limit: int, *order: np.ndarray) -> np.ndarray:
    by, place = _ranked(row, *order)
    return by[place < limit]


@dataclass
class Lists:
    """Nodes of a part with their codes and, nearest first, the entries of their lists."""

    node: np.ndarray
    code: np.ndarray
    scale: np.ndarray
    near: np.ndarray
    like: np.ndarray
    mark: np.ndarray  # 0 old, 1 new, 2 new and meeting in this round, 3 old and meeting

    def message(self, part: int) -> tuple:
        return (part, STATE, len(self.node), pack(
            self.node, self.code.view(U64).ravel(), _bits(self.scale), self.near.ravel(), _bits(self.like.ravel()),
            self.mark.ravel()))

    @classmethod
    def read(cls, table: pa.Table) -> "Lists":
        node, code, scale, near, like, mark = _read(table, STATE, 6)
        n = len(node)
        shape = (n, len(near) // n if n else 0)
        return cls(_ids(node), code.view(np.int8).reshape(n, -1) if n else np.zeros((0, 8), np.int8), _reals(scale),
                   _ids(near).reshape(shape), _reals(like).reshape(shape), mark.astype(np.int8).reshape(shape))


# -- vectors -----------------------------------------------------------------------------------------------------------


def _valid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as bytes of doubles, scaled by a power of two so that their squares stay in range; null if invalid."""
    for batch in batches:
        out = []
        for v in batch.column(1):
            values = v.values if v.is_valid else None
            if values is None or values.null_count or not len(values):
                out.append(None)
                continue
            x = np.asarray(values).astype(np.float64)
            if not np.isfinite(x).all() or not x.any():
                out.append(None)
                continue
            out.append((np.ldexp(x, -np.frexp(np.abs(x).max())[1]) + 0.0).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["vec_id", "vec"])


def _codes(vectors: list[bytes], dims: int) -> tuple[np.ndarray, np.ndarray]:
    """8-bit codes of the unit vectors, padded to whole machine words, and what one unit of a code is worth."""
    x = np.frombuffer(b"".join(vectors), np.float64).reshape(-1, dims)
    x = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
    most = np.abs(x).max(axis=1)
    code = np.zeros((len(x), -(-dims // 8) * 8), np.int8)
    code[:, :dims] = np.rint(x * (127 / most)[:, None])
    return code, _scales(code)


def _scales(code: np.ndarray) -> np.ndarray:
    return (1 / np.sqrt((code.astype(np.float64) ** 2).sum(axis=1))).astype(np.float32)


# -- building ----------------------------------------------------------------------------------------------------------


def _sorted_codes(dims: int, graph: Graph, bits: int):
    """Each node once per sorting: by the sides of ``bits`` random planes it lies on, then along a random direction."""
    rng = np.random.RandomState(graph.seed)
    planes = rng.standard_normal((graph.orders, dims, bits + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                code, scale = _codes(part.column(1).to_pylist(), dims)
                rows = pa.array([c.tobytes() for c in code], pa.binary())
                for o in range(graph.orders):
                    side = code[:, :dims].astype(np.float64) @ planes[o]
                    cell = (side[:, :bits] > 0) @ (1 << np.arange(bits)) if bits else np.zeros(len(code), np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(code), o, np.int32)), pa.array(cell.astype(np.int64)), pa.array(side[:, bits]),
                         part.column(0), rows, pa.array(scale)], ["o", "cell", "along", "node", "code", "scale"])
    return run


def _blocks(graph: Graph, count: int):
    """The nearest within each block of rows that follow each other."""
    def compared(o, node, code, scale):
        like = _likeness(code, code, scale, scale)
        np.fill_diagonal(like, -9)
        k = min(graph.neighbours, len(node) - 1)
        rows = np.argpartition(-like, k - 1, axis=1)[:, :k] if k > 0 else np.zeros((len(node), 0), np.int64)
        u = np.repeat(np.arange(len(node)), k)
        w = rows.ravel()
        out = _dealt(FOUND, _home(node[u], count), node[u], node[w], _bits(like[u, w]))
        if o == 0:
            out += _dealt(CODES, _home(node, count), node, code.view(U64))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.select([0, 3, 4, 5]).columns)):
                if held and (row[0] != held[0][0] or len(held) == graph.block):
                    yield from cut(held)
                    held = []
                held.append(row)
        if held:
            yield from cut(held)

    def cut(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        o, node, code, scale = zip(*held)
        code = np.frombuffer(b"".join(code), np.int8).reshape(len(node), -1)
        yield from _messages(compared(o[0], np.array(node), code, np.array(scale, np.float32))).to_batches()
    return run


def _merge(graph: Graph, count: int, round_: int):
    """Lists with the found entries laid in, and, to the nodes listed, word of those that meet in the next round."""
    def run(table: pa.Table) -> pa.Table:
        lists = Lists.read(table)
        u, w, s = _read(table, FOUND, 3)
        part = table["part"][0].as_py()
        if not len(lists.node):
            lists = _begun(table, graph)
        node, k = lists.node, graph.neighbours
        row = np.searchsorted(node, _ids(u))
        old_row, _ = np.nonzero(lists.near != NONE)
        have = lists.near != NONE
        rows = np.concatenate([old_row, row])
        near = np.concatenate([lists.near[have], _ids(w)])
        like = np.concatenate([lists.like[have], _reals(s)])
        fresh = np.concatenate([np.zeros(len(old_row), np.int8), np.ones(len(row), np.int8)])
        mark = np.concatenate([np.where(lists.mark[have] == 1, 1, 0), np.ones(len(row), np.int64)]).astype(np.int8)
        by, place = _ranked(rows, near, fresh)
        again = (place > 0) & (np.concatenate([[NONE], near[by][:-1]]) == near[by])
        by = by[~again]
        order, place = _ranked(rows[by], -like[by], near[by])
        by = by[order[place < k]]
        place = place[place < k]
        changed = int(fresh[by].sum())
        lists = Lists(node, lists.code, lists.scale, np.full((len(node), k), NONE), np.full((len(node), k), -2, np.float32),
                      np.zeros((len(node), k), np.int8))
        r = rows[by]
        lists.near[r, place], lists.like[r, place], lists.mark[r, place] = near[by], like[by], mark[by]
        # Entries that meet in the next round: a sample of the new and of the old ones, by a hash of the pair.
        i, j = np.nonzero(lists.near != NONE)
        new = lists.mark[i, j] == 1
        lot = mix(mix(node[i].view(U64)) ^ lists.near[i, j].view(U64) ^ U64(round_))
        pick = _first_of(2 * i + new, graph.sample, lot)
        i, j, new, lot = i[pick], j[pick], new[pick], lot[pick]
        lists.mark[i, j] = np.where(new, 2, 3)
        to, who = lists.near[i, j], node[i]
        few = _first_of(2 * np.unique(to, return_inverse=True)[1] + new, graph.sample, lot)
        told = _dealt(LISTED, _home(to[few], count), to[few], who[few], new[few].astype(np.uint8))
        return _messages([lists.message(part), (part, COUNT, changed, b""), *told])
    return run


def _begun(table: pa.Table, graph: Graph) -> Lists:
    node, code = _read(table, CODES, 2)
    n = len(node)
    code = code.view(np.int8).reshape(n, -1) if n else np.zeros((0, 8), np.int8)
    by = np.argsort(_ids(node))
    code = code[by]
    shape = (n, graph.neighbours)
    return Lists(_ids(node)[by], code, _scales(code), np.full(shape, NONE), np.full(shape, -2, np.float32), np.zeros(shape, np.int8))


def _send(graph: Graph, count: int):
    """Each node's code to those that list it and those that it lists."""
    def run(table: pa.Table) -> pa.Table:
        lists = Lists.read(table)
        to, who, new = _read(table, LISTED, 3)
        row, new = np.searchsorted(lists.node, _ids(to)), new.astype(np.int64)
        who = _ids(who)
        few = _first_of(2 * row + new, graph.sample, mix(who.view(U64)))
        i, j = np.nonzero(lists.mark >= 2)
        ahead = lists.mark[i, j] == 2
        # A node that lists many others but is listed by few tells only as many of each centre as the centre may take.
        centre, mine = lists.near[i, j], i
        back = _first_of(2 * np.unique(centre, return_inverse=True)[1] + ahead, graph.sample, mix(lists.node[mine].view(U64)))
        centre = np.concatenate([who[few], centre[back]])
        mine = np.concatenate([row[few], mine[back]])
        new = np.concatenate([new[few], ahead[back].astype(np.int64)])
        worst = np.where(lists.near[:, -1] == NONE, -2, lists.like[:, -1]).astype(np.float32)
        out, home = [], _home(centre, count)
        for p in np.unique(home):
            at = np.flatnonzero(home == p)
            some, which = np.unique(mine[at], return_inverse=True)
            out.append((int(p), MET, len(at), pack(
                centre[at], which, new[at], lists.node[some], lists.code[some].view(U64).ravel(), _bits(worst[some]))))
        return _messages(out)
    return run


def _meet(graph: Graph, count: int):
    """Those that meet at a node compared with each other; pairs of two old ones were compared before."""
    most = 2 * graph.sample

    def run(table: pa.Table) -> pa.Table:
        centre, member, new, codes, worst, base = [], [], [], [], [], 0
        nodes = []
        for packed in sorted(table["packed"].to_pylist()):
            c, which, fresh, node, code, w = unpack(packed)
            centre.append(_ids(c)), member.append(which.astype(np.int64) + base), new.append(fresh.astype(np.int64))
            nodes.append(_ids(node)), codes.append(code.view(np.int8).reshape(len(node), -1)), worst.append(_reals(w))
            base += len(node)
        centre, member, new, node = map(np.concatenate, (centre, member, new, nodes))
        code, worst = np.concatenate(codes), np.concatenate(worst)
        scale = _scales(code)
        # Once per centre and node, as new if it is new to either.
        by, place = _ranked(centre, node[member], -new)
        twice = (place > 0) & (np.concatenate([[NONE], node[member[by]][:-1]]) == node[member[by]])
        by = by[~twice]
        by = by[np.sort(_first_of(2 * np.unique(centre[by], return_inverse=True)[1] + new[by], most,
                                  mix(node[member[by]].view(U64))))]
        order = np.lexsort((node[member[by]], -new[by], centre[by]))
        by = by[order]
        centre, member, new = centre[by], member[by], new[by]
        begin = np.flatnonzero(np.diff(centre, prepend=-2))
        size = np.diff([*begin, len(centre)])
        fresh = np.add.reduceat(new, begin) if len(begin) else np.zeros(0, np.int64)
        u, w, s = [], [], []
        use = np.flatnonzero((fresh > 0) & (size > 1))
        use = use[np.argsort(size[use], kind="stable")]
        for at in range(0, len(use), 256):
            some = use[at:at + 256]
            width, left = size[some].max(), fresh[some].max()
            grid = begin[some][:, None] + np.minimum(np.arange(width), size[some][:, None] - 1)
            m = member[grid]
            like = _likeness(code[m[:, :left]], code[m], scale[m[:, :left]], scale[m])
            i, j = np.arange(left)[None, :, None], np.arange(width)[None, None, :]
            real = (i < fresh[some][:, None, None]) & (j < size[some][:, None, None]) & (i < j)
            c, a, b = np.nonzero(real & ((like > worst[m[:, :left]][:, :, None]) | (like > worst[m][:, None, :])))
            x, y, value = m[c, a], m[c, b], like[c, a, b]
            for p, q in ((x, y), (y, x)):
                good = value > worst[p]
                u.append(node[p[good]]), w.append(node[q[good]]), s.append(value[good])
        if not u:
            return _messages([])
        u, w, s = np.concatenate(u), np.concatenate(w), np.concatenate(s)
        by, place = _ranked(u, w)
        by = by[(place == 0) | (np.concatenate([[NONE], w[by][:-1]]) != w[by])]
        by = by[_first_of(u[by], graph.neighbours, -s[by], w[by])]
        return _messages(_dealt(FOUND, _home(u[by], count), u[by], w[by], _bits(s[by])))
    return run


def _of_kind(table: DataFrame, *kinds: int) -> DataFrame:
    return table.filter(F.col("kind").isin(*kinds))


def build_graph(nodes: DataFrame, dims: int, count: int, total: int, graph: Graph) -> DataFrame:
    """Messages of kind ``STATE``: the lists of all ``nodes`` (``node, vec``), in ``count`` parts."""
    spark = nodes.sparkSession
    bits = max(0, int(np.ceil(np.log2(max(1, total / (4 * graph.block))))))
    rows = nodes.select("node", "vec").mapInArrow(
        _sorted_codes(dims, graph, bits), "o int, cell long, along double, node long, code binary, scale float")
    order = ["o", "cell", "along", "node"]
    blocks = rows.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(
        *order).mapInArrow(_blocks(graph, count), MESSAGE)
    state = staged(blocks.groupBy("part").applyInArrow(_merge(graph, count, 0), MESSAGE), "graph")
    for round_ in range(1, graph.rounds + 1):
        met = _of_kind(state, STATE, LISTED).groupBy("part").applyInArrow(_send(graph, count), MESSAGE)
        found = met.groupBy("part").applyInArrow(_meet(graph, count), MESSAGE)
        merged = _of_kind(state, STATE).unionByName(found).groupBy("part").applyInArrow(_merge(graph, count, round_), MESSAGE)
        state = staged(merged, "graph")
        changed = _of_kind(state, COUNT).agg(F.sum("n")).first()[0] or 0
        if changed < graph.least_change * graph.neighbours * total:
            break
    return _of_kind(state, STATE)


# -- searching ---------------------------------------------------------------------------------------------------------


@dataclass
class Beams:
    """Queries of a part, the nearest nodes each has found so far and which of them are open."""

    query: np.ndarray
    code: np.ndarray
    near: np.ndarray
    like: np.ndarray
    opened: np.ndarray

    def message(self, part: int) -> tuple:
        return (part, QUERY, len(self.query), pack(
            self.query, self.code.view(U64).ravel(), self.near.ravel(), _bits(self.like.ravel()), self.opened.ravel()))

    @classmethod
    def read(cls, table: pa.Table) -> "Beams":
        query, code, near, like, opened = _read(table, QUERY, 5)
        n = len(query)
        shape = (n, len(near) // n if n else 0)
        return cls(_ids(query), code.view(np.int8).reshape(n, -1) if n else np.zeros((0, 8), np.int8),
                   _ids(near).reshape(shape), _reals(like).reshape(shape), opened.astype(np.int8).reshape(shape))

    def next_open(self, step: int, count: int) -> list[tuple]:
        """Opens the nearest unopened nodes of each beam and tells their parts."""
        i, j = np.nonzero((self.near != NONE) & (self.opened == 0))
        some = _first_of(i, step, j)
        i, j = i[some], j[some]
        self.opened[i, j] = 1
        node = self.near[i, j]
        return _dealt(OPEN, _home(node, count), node, self.query[i]) if len(i) else []


def _start(graph: Graph, count: int):
    def run(table: pa.Table) -> pa.Table:
        lists, (wanted,) = Lists.read(table), _read(table, ASKED, 1)
        row = np.searchsorted(lists.node, np.unique(_ids(wanted)))
        if not len(row):
            return _messages([])
        wide = max(graph.beam, graph.neighbours)
        beams = Beams(lists.node[row], lists.code[row], np.full((len(row), wide), NONE),
                      np.full((len(row), wide), -2, np.float32), np.zeros((len(row), wide), np.int8))
        k = lists.near.shape[1]
        beams.near[:, :k], beams.like[:, :k] = lists.near[row], lists.like[row]
        told = beams.next_open(graph.step, count)
        return _messages([beams.message(table["part"][0].as_py()), *told])
    return run


def _expand(count: int):
    """The lists of opened nodes, to the queries that opened them."""
    def run(table: pa.Table) -> pa.Table:
        lists, (node, query) = Lists.read(table), _read(table, OPEN, 2)
        row, query = np.searchsorted(lists.node, _ids(node)), _ids(query)
        near = lists.near[row]
        i, j = np.nonzero(near != NONE)
        q, w = query[i], near[i, j]
        by, place = _ranked(q, w)
        by = by[(place == 0) | (np.concatenate([[NONE], w[by][:-1]]) != w[by])]
        return _messages(_dealt(FOUND, _home(q[by], count), q[by], w[by]) if len(by) else [])
    return run


def _ask(graph: Graph, count: int):
    """What a beam has not got yet, with the query's code, to the nodes' parts."""
    def run(table: pa.Table) -> pa.Table:
        beams, (q, w) = Beams.read(table), _read(table, FOUND, 2)
        row, w = np.searchsorted(beams.query, _ids(q)), _ids(w)
        i, j = np.nonzero(beams.near != NONE)
        rows, ids = np.concatenate([i, row, np.arange(len(beams.query))]), np.concatenate([beams.near[i, j], w, beams.query])
        known = np.ones(len(rows), np.int8)
        known[len(i):len(i) + len(row)] = 2
        by, place = _ranked(rows, ids, known)
        by = by[(known[by] == 2) & ((place == 0) | (np.concatenate([[NONE], ids[by][:-1]]) != ids[by]))]
        rows, ids = rows[by], ids[by]
        out, home = [], _home(ids, count)
        worst = beams.like[:, graph.beam - 1]
        for p in np.unique(home):
            at = np.flatnonzero(home == p)
            some, which = np.unique(rows[at], return_inverse=True)
            out.append((int(p), ASKED, len(at), pack(
                ids[at], which, beams.query[some], beams.code[some].view(U64).ravel(), _bits(worst[some]))))
        return _messages(out)
    return run


def _answer(count: int):
    """Likeness of the asked nodes, where it beats the end of the beam."""
    def run(table: pa.Table) -> pa.Table:
        lists, out = Lists.read(table), []
        for kind, packed in zip(table["kind"].to_pylist(), table["packed"].to_pylist()):
            if kind != ASKED:
                continue
            ids, which, query, code, worst = unpack(packed)
            row, which = np.searchsorted(lists.node, _ids(ids)), which.astype(np.int64)
            code = code.view(np.int8).reshape(len(query), -1)
            scale, worst, value = _scales(code), _reals(worst), np.empty(len(row), np.float32)
            for a in range(0, len(row), 8192):
                r, c = row[a:a + 8192], which[a:a + 8192]
                wide = np.float32 if code.shape[1] <= 1024 else np.float64
                whole = np.einsum("ij,ij->i", lists.code[r].astype(wide), code[c].astype(wide))
                value[a:a + 8192] = whole * (lists.scale[r] * scale[c])
            good = value > worst[which]
            q = _ids(query)[which[good]]
            out += _dealt(FOUND, _home(q, count), q, _ids(ids)[good], _bits(value[good])) if len(q) else []
        return _messages(out)
    return run


def _improve(graph: Graph, count: int):
    def run(table: pa.Table) -> pa.Table:
        beams, (q, w, s) = Beams.read(table), _read(table, FOUND, 3)
        i, j = np.nonzero(beams.near != NONE)
        rows = np.concatenate([i, np.searchsorted(beams.query, _ids(q))])
        near, like = np.concatenate([beams.near[i, j], _ids(w)]), np.concatenate([beams.like[i, j], _reals(s)])
        opened = np.concatenate([beams.opened[i, j], np.zeros(len(q), np.int8)])
        order, place = _ranked(rows, -like, near)
        by, place = order[place < graph.beam], place[place < graph.beam]
        for a, empty in ((beams.near, NONE), (beams.like, -2), (beams.opened, 0)):
            a[:] = empty
        r = rows[by]
        beams.near[r, place], beams.like[r, place], beams.opened[r, place] = near[by], like[by], opened[by]
        told = beams.next_open(graph.step, count)
        return _messages([beams.message(table["part"][0].as_py()), *told])
    return run


def search(lists: DataFrame, wanted: DataFrame, count: int, graph: Graph) -> DataFrame:
    """``query, node`` with the ``exact`` nearest of each beam, for the nodes ``wanted``."""
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node = np.asarray(batch.column(0))
            if len(node):
                yield from _messages(_dealt(ASKED, _home(node, count), node)).to_batches()

    asked = wanted.select("node").mapInArrow(deal, MESSAGE)
    beams = staged(lists.unionByName(asked).groupBy("part").applyInArrow(_start(graph, count), MESSAGE), "beams")
    while not _of_kind(beams, OPEN).isEmpty():
        queries = _of_kind(beams, QUERY)
        opened = lists.unionByName(_of_kind(beams, OPEN)).groupBy("part").applyInArrow(_expand(count), MESSAGE)
        asks = queries.unionByName(opened).groupBy("part").applyInArrow(_ask(graph, count), MESSAGE)
        answers = lists.unionByName(asks).groupBy("part").applyInArrow(_answer(count), MESSAGE)
        beams = staged(queries.unionByName(answers).groupBy("part").applyInArrow(_improve(graph, count), MESSAGE), "beams")

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            b = Beams.read(pa.Table.from_batches([batch]))
            i, j = np.nonzero(b.near[:, :graph.exact] != NONE)
            # A query's own node may hold other rows with the same vector.
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([b.query[i], b.query])),
                                              pa.array(np.concatenate([b.near[i, j], b.query]))], ["query", "node"])

    return _of_kind(beams, QUERY).mapInArrow(best, "query long, node long")


def _cosines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        score = []
        for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            x, y = np.frombuffer(a, np.float64), np.frombuffer(b, np.float64)
            score.append(float(x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y))))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score, pa.float64())],
                                         ["query", "node", "score"])


def nearest_neighbours(vectors: DataFrame, wanted: str = "vec_id % 50 = 0", k: int = 5, vec_id: str = "vec_id",
                       embedding: str = "embedding", graph: Graph = Graph()) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of each row for which ``wanted`` (SQL on the id, named
    ``vec_id``) holds, nearest first, by cosine in double precision, ties to the smaller id.

    Candidates are all rows but the query's own; a row that repeats an id is a vector of its own, but rows that repeat an id
    and its vector ask once. Rows without an id, null, empty and zero
    vectors and those with null or non-finite numbers take no part, vectors of different dimensions are not compared.
    Where fewer than ``k`` candidates exist, all are returned; an empty table gives no rows. Other columns are ignored.
    Of equal vectors ``k + 1`` ids stand for their node, which is all that an answer can hold. Recall is measured in the
    tests.
    """
    spark = ready(vectors.sparkSession)
    kind = vectors.schema[vec_id].dataType.simpleString()
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).cast("array<double>").alias("v"))
    parsed = staged(rows.filter("vec_id IS NOT NULL").mapInArrow(_valid, f"vec_id {kind}, vec binary").filter(
        "vec IS NOT NULL"), "vectors")
    few = F.row_number().over(Window.partitionBy("vec").orderBy("vec_id")) <= k + 1
    classes = parsed.withColumn("few", few).filter("few").groupBy("vec").agg(
        F.sort_array(F.collect_list("vec_id")).alias("ids"))
    nodes = staged(classes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    asking = staged(parsed.filter(wanted).distinct().withColumnRenamed("vec_id", "query_id").join(
        nodes.select("vec", "node"), "vec"), "asking")
    pairs = None
    for size, total in nodes.groupBy(F.octet_length("vec")).count().collect():  # one row per dimension
        mine = F.octet_length("vec") == size
        count = max(min(parts(spark), -(-total // graph.least_part)), -(-total // graph.per_part))
        lists = build_graph(nodes.filter(mine), size // 8, count, total, graph)
        here = search(lists, asking.filter(mine).select("node").distinct(), count, graph)
        pairs = here if pairs is None else pairs.unionByName(here)
    if pairs is None:
        return spark.createDataFrame([], f"query_id {kind}, rank int, vec_id {kind}, score double")
    scored = pairs.join(nodes.select(F.col("node").alias("query"), F.col("vec").alias("x")), "query").join(
        nodes.select("node", F.col("vec").alias("y")), "node").select("query", "node", "x", "y").mapInArrow(
        _cosines, "query long, node long, score double")
    # Each node stands for its ids; a query's own id is taken out once.
    answers = asking.select("query_id", F.col("node").alias("query")).join(scored, "query").join(
        nodes.select("node", "ids"), "node")
    own = F.when(F.col("node") == F.col("query"), F.array_position("ids", F.col("query_id"))).otherwise(F.lit(0))
    ids = F.filter(F.transform("ids", lambda v, i: F.struct((i + 1).alias("at"), v.alias("id"))), lambda s: s["at"] != own)
    found = answers.select("query_id", "query", "score", F.explode(F.slice(ids, 1, k)).alias("hit")).select(
        "query_id", "query", "score", F.col("hit.id").alias("vec_id"))
    place = F.row_number().over(Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
