"""Operator 5: near-duplicate embeddings by randomly rotated binary codes.

Equal vectors form a class. Classes are assigned to the nearest of a number of centres, and probe the members of several
more. A member is kept as one sign bit per dimension of its rotated offset from the centre, with the offset's length and
the correction factor that makes the estimated inner product unbiased. The spread of that estimate is known, so a pair
whose upper confidence bound stays below the threshold is left, and the cosine of every other pair is computed in full.

Links are counted and condensed where they are found: a task returns, per class, how many vectors it links and one edge to
the rest of its group. Cells are cut into blocks, so no task grows with a cell. Pairs that neither vector's probes reach
are not found. So the number of probes follows the cells: it is the least with which a stated share of links at the
threshold, the hardest to find, is reached; such links are made up from sampled vectors by turning each in a random
direction. The share of links found is measured in the tests and given in the README.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from claimsift.llm.common import parts, ready, staged
from claimsift.llm.components import connected_components


@dataclass(frozen=True)
class Index:
    """``per_cell`` sets the number of centres (at most ``cells``), fitted on at most ``sample`` classes; ``probes`` is the
    least number of cells a class is compared with, ``reached`` the share of made-up links at the threshold that the probes
    must reach, ``spread`` the width of the confidence bound in standard errors, ``block`` the members or probes of a cell
    in one task."""

    per_cell: int = 500
    cells: int = 16_384
    sample: int = 60_000
    probes: int = 12
    reached: float = 0.98
    spread: float = 4.5
    block: int = 2_000
    seed: int = 5


def _valid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The vector as bytes of doubles, scaled by a power of two so that its square has a value; null where it has nothing
    to compare."""
    for batch in batches:
        out = []
        for v in batch.column(1):
            values = v.values if v.is_valid else None
            if values is None or values.null_count or not len(values):
                out.append(None)
                continue
            x = np.asarray(values).astype(np.float64)
            if np.isfinite(x).all() and x.any():
                out.append((np.ldexp(x, -np.frexp(np.abs(x).max())[1]) + 0.0).tobytes())
            else:
                out.append(None)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["vec_id", "vec"])


def _units(vectors: list[bytes], dims: int) -> np.ndarray:
    x = np.frombuffer(b"".join(vectors), np.float64).reshape(-1, dims)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def fit_centres(units: np.ndarray, cells: int, seed: int) -> np.ndarray:
    """Unit centres by a few rounds of spherical k-means."""
    rng = np.random.RandomState(seed)
    centres = units[rng.permutation(len(units))[:cells]].copy()
    for _ in range(6):
        near = np.concatenate([(units[i:i + 4096] @ centres.T).argmax(axis=1) for i in range(0, len(units), 4096)])
        sums = np.zeros_like(centres)
        np.add.at(sums, near, units)
        size = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        centres = np.where(size > 0, sums / np.where(size > 0, size, 1), centres)
    return centres


def nearest(units: np.ndarray, centres: np.ndarray, probes: int) -> np.ndarray:
    """The ``probes`` nearest centres of each vector, nearest first, ties to the smaller number."""
    like = units @ centres.T
    if probes < len(centres):
        near = np.sort(np.argpartition(-like, probes - 1, axis=1)[:, :probes], axis=1)
    else:
        near = np.broadcast_to(np.arange(len(centres)), like.shape)
    order = np.argsort(-np.take_along_axis(like, near, axis=1), axis=1, kind="stable")
    return np.take_along_axis(near, order, axis=1)


def probes_needed(units: np.ndarray, centres: np.ndarray, threshold: float, index: Index) -> int:
    """The least number of probes with which the share ``index.reached`` of links at the threshold is found."""
    if len(centres) <= index.probes or threshold >= 1:
        return min(index.probes, len(centres))
    rng = np.random.RandomState(index.seed + 1)
    x = units[rng.permutation(len(units))[:1000]]
    aside = rng.standard_normal(x.shape)
    aside -= (aside * x).sum(axis=1, keepdims=True) * x
    y = threshold * x + np.sqrt(1 - threshold**2) * aside / np.sqrt((aside * aside).sum(axis=1, keepdims=True))

    def rank(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Centres that are nearer to ``a`` than the one nearest to ``b``."""
        like, home = a @ centres.T, (b @ centres.T).argmax(axis=1)
        return (like > like[np.arange(len(a)), home][:, None]).sum(axis=1)

    either = np.sort(np.minimum(rank(x, y), rank(y, x)))
    return int(np.clip(either[int(np.ceil(index.reached * len(either))) - 1] + 1, index.probes, len(centres)))


def rotation(dims: int, seed: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.RandomState(seed).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def encode(offsets: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sign bits of the rotated offsets, their lengths, and their inner products with what the bits stand for."""
    turned = offsets @ turn
    size = np.sqrt((offsets * offsets).sum(axis=1))
    factor = np.abs(turned).sum(axis=1) / np.sqrt(offsets.shape[1]) / np.where(size > 0, size, 1)
    return np.packbits(turned > 0, axis=1), size, factor


def upper_bounds(bits: np.ndarray, size: np.ndarray, factor: np.ndarray, query: np.ndarray, turn: np.ndarray,
                 spread: float) -> np.ndarray:
    """Upper bounds of the inner products of offsets (rows: queries, columns: members)."""
    dims = query.shape[1]
    signs = np.unpackbits(bits, axis=1, count=dims).astype(np.float32) * 2 - 1
    turned = (query @ turn).astype(np.float32)
    estimate = (turned @ signs.T) / np.sqrt(dims)
    safe = np.where(factor > 0, factor, 1)
    error = spread * np.sqrt(np.maximum(0, 1 - factor**2)) / safe / np.sqrt(max(1, dims - 1))
    reach = np.sqrt((query * query).sum(axis=1))[:, None]
    return size * (estimate / safe + error * reach) + 1e-5


def _spread_out(cells: np.ndarray, keys: np.ndarray, blocks: np.ndarray, other: np.ndarray):
    """Own block of each row, and rows repeated for each block of the other side."""
    own = (keys.view(np.uint64) % blocks[cells].astype(np.uint64)).astype(np.int64)
    times = other[cells]
    row = np.repeat(np.arange(len(cells)), times)
    return own[row], row, np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)


def _placed(dims: int, centres: np.ndarray, turn: np.ndarray, probes: int, home_blocks, probe_blocks):
    """Members with their codes and probes, dealt to (cell, block of members, block of probes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                raw = batch.column(1).to_pylist()
                x, key, copies = _units(raw, dims), np.asarray(batch.column(0)), np.asarray(batch.column(2))
                near = nearest(x, centres, probes)
                home = near[:, 0]
                bits, size, factor = encode(x - centres[home], turn)
                own, row, other = _spread_out(home, key, home_blocks, probe_blocks)
                members = _rows(0, home[row], own, other, key[row], copies[row], [raw[i] for i in row], home[row], near[row],
                                [bits[i].tobytes() for i in row], size[row], factor[row])
                flat, who = near.ravel(), np.repeat(np.arange(len(x)), probes)
                own, row, other = _spread_out(flat, key[who], probe_blocks, home_blocks)
                i = who[row]
                asked = _rows(1, flat[row], other, own, key[i], copies[i], [raw[j] for j in i], home[i], near[i][:, :0],
                              [None] * len(i), np.zeros(len(i)), np.zeros(len(i)))
                yield members
                yield from (asked.slice(j, 4096) for j in range(0, asked.num_rows, 4096))
    return run


PLACED = ("cell int, home_block int, probe_block int, probe boolean, key long, copies long, vec binary, home int, "
          "near binary, bits binary, size double, factor double")


def _rows(probe, cell, home_block, probe_block, key, copies, vec, home, near, bits, size, factor) -> pa.RecordBatch:
    ints = [pa.array(np.asarray(x).astype(np.int32)) for x in (cell, home_block, probe_block)]
    lists = pa.array([n.astype(np.int32).tobytes() for n in near], pa.binary())
    return pa.RecordBatch.from_arrays(
        [*ints, pa.array(np.full(len(key), bool(probe))), pa.array(key), pa.array(copies), pa.array(vec, pa.binary()),
         pa.array(home.astype(np.int32)), lists, pa.array(bits, pa.binary()), pa.array(size), pa.array(factor)],
        [f.split(" ")[0] for f in PLACED.split(", ")])


def _compared(dims: int, centres: np.ndarray, turn: np.ndarray, index: Index, threshold: float):
    empty = pa.table({"key": pa.array([], pa.int64()), "root": pa.array([], pa.int64()), "links": pa.array([], pa.int64())})

    def run(table: pa.Table) -> pa.Table:
        """Of one block: per linked class, an edge and the vectors it links."""
        asked = np.asarray(table["probe"])
        m, p = table.filter(pa.array(~asked)), table.filter(pa.array(asked))
        if not m.num_rows or not p.num_rows:
            return empty
        cell = m["cell"][0].as_py()
        y, x = _units(m["vec"].to_pylist(), dims), _units(p["vec"].to_pylist(), dims)
        bits = np.frombuffer(b"".join(m["bits"].to_pylist()), np.uint8).reshape(len(y), -1)
        c = centres[cell]
        bound = upper_bounds(bits, np.asarray(m["size"]), np.asarray(m["factor"]), x - c, turn, index.spread)
        # <x, y> = <x - c, y - c> + <x, c> + <y, c> - <c, c>
        bound += (x @ c)[:, None] + (y @ c)[None, :] - c @ c
        yk, xk = np.asarray(m["key"]), np.asarray(p["key"])
        i, j = np.nonzero((bound >= threshold) & (xk[:, None] != yk[None, :]))
        exact = np.concatenate([np.einsum("ij,ij->i", x[i[a:a + 65536]], y[j[a:a + 65536]])
                                for a in range(0, max(1, len(i)), 65536)])
        i, j = i[exact >= threshold], j[exact >= threshold]
        if not len(i):
            return empty
        # If the member probes this class's cell as well, that cell counts the link for the member.
        near = np.frombuffer(b"".join(m["near"].to_pylist()), np.int32).reshape(len(y), -1)
        back = (near[j] == np.asarray(p["home"])[i][:, None]).any(axis=1)
        yc, xc = np.asarray(m["copies"]), np.asarray(p["copies"])
        links_x = np.bincount(i, yc[j], minlength=len(x)).astype(np.int64)
        links_y = np.bincount(j, xc[i] * ~back, minlength=len(y)).astype(np.int64)
        root_x, root_y = xk.copy(), yk.copy()
        while True:
            before = root_x.sum(), root_y.sum()
            np.minimum.at(root_x, i, root_y[j])
            np.minimum.at(root_y, j, root_x[i])
            if before == (root_x.sum(), root_y.sum()):
                break
        tx, ty = np.unique(i), np.unique(j)
        return pa.table({"key": np.concatenate([xk[tx], yk[ty]]), "root": np.concatenate([root_x[tx], root_y[ty]]),
                         "links": np.concatenate([links_x[tx], links_y[ty]])})
    return run


def near_duplicate_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding",
                           threshold: float = 0.9, index: Index = Index()) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for each row of ``vectors``.

    Vectors that are null, empty, zero or hold null or non-finite numbers link with nothing and are their own component.
    Vectors of different dimensions are not compared. Rows with equal vectors link with each other; rows that repeat an
    id are vectors of their own. ``component_id`` is the smallest id reachable by links. An empty table gives no rows.
    Other columns are ignored, whatever their names.
    """
    spark = ready(vectors.sparkSession)
    kind = vectors.schema[vec_id].dataType.simpleString()
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).cast("array<double>").alias("v"))
    parsed = staged(rows.mapInArrow(_valid, f"vec_id {kind}, vec binary"), "vectors").withColumn(
        "key", F.when(F.col("vec").isNotNull(), F.xxhash64("vec")))
    classes = staged(parsed.filter("vec IS NOT NULL").groupBy("key").agg(
        F.first("vec").alias("vec"), F.count("*").alias("copies"), F.min("vec_id").alias("least")), "classes")
    found = None
    for size, in classes.select(F.octet_length("vec")).distinct().collect():  # one row per dimension
        mine = classes.filter(F.octet_length("vec") == size)
        here = _links(mine, size // 8, threshold, index)
        found = here if found is None else found.union(here)
    own = F.when(F.col("vec").isNull(), F.col("vec_id"))
    if found is None:
        return parsed.select("vec_id", F.lit(0).cast("long").alias("n_links"), own.alias("component_id"),
                             F.lit(True).alias("kept"))
    found = staged(found, "found")
    roots = connected_components(found, "key", "root").withColumnsRenamed({"node": "key"})
    links = found.groupBy("key").agg(F.sum("links").alias("links"))
    named = staged(classes.drop("vec").join(roots, "key", "left").join(links, "key", "left").select(
        "key", "copies", "least", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "key").alias("root")), "named")
    smallest = named.groupBy("root").agg(F.min("least").alias("smallest"))
    answers = named.join(smallest, "root").select("key", (F.col("links") + F.col("copies") - 1).alias("links"), "smallest")
    joined = parsed.drop("vec").join(answers, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("smallest"))
    return joined.select("vec_id", F.coalesce("links", F.lit(0)).alias("n_links"), component.alias("component_id"),
                         component.eqNullSafe(F.col("vec_id")).alias("kept"))


def _links(classes: DataFrame, dims: int, threshold: float, index: Index) -> DataFrame:
    """``key, root, links`` per task and linked class."""
    spark, count = classes.sparkSession, classes.count()
    cells = int(np.clip(count // index.per_cell, 1, index.cells))
    sample = classes.orderBy("key").select("vec").limit(min(index.sample, 16 * cells + 1000)).collect()
    units = _units([r["vec"] for r in sample], dims)
    centres = fit_centres(units, cells, index.seed)
    turn, probes = rotation(dims, index.seed), probes_needed(units, centres, threshold, index)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                near = nearest(_units(batch.column(0).slice(at, 1024).to_pylist(), dims), centres, probes)
                n = np.bincount(near[:, 0], minlength=cells), np.bincount(near.ravel(), minlength=cells)
                some = np.flatnonzero(n[1])
                yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n[0][some]), pa.array(n[1][some])],
                                                 ["cell", "members", "probes"])

    # One row per cell, of which there are at most index.cells.
    sizes = classes.select("vec").mapInArrow(counted, "cell long, members long, probes long").groupBy("cell").agg(
        F.sum("members"), F.sum("probes")).collect()
    blocks = np.ones((2, cells), np.int64)
    for cell, members, asked in sizes:
        blocks[:, cell] = max(1, -(-members // index.block)), max(1, -(-asked // index.block))
    placed = classes.select("key", "vec", "copies").mapInArrow(
        _placed(dims, centres, turn, probes, blocks[0], blocks[1]), PLACED)
    return placed.groupBy("cell", "home_block", "probe_block").applyInArrow(
        _compared(dims, centres, turn, index, threshold), "key long, root long, links long")
