"""Nearest neighbours against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimsift.llm import neighbours
from claimsift.llm.neighbours import Graph, nearest_neighbours

SCHEMA = "vec_id long, embedding array<double>"


def exact(rows, k=5):
    """(query, rank, vec_id) by plain comparison; rows that repeat an id and its vector ask once."""
    valid = [(i, np.array(v, float)) for i, v in rows
             if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    unit = [(i, (s := v / np.abs(v).max()) / np.sqrt(s @ s)) for i, v in valid]
    out, asked = {}, set()
    for a, (i, x) in enumerate(unit):
        if i % 50 or (i, tuple(valid[a][1])) in asked:
            continue
        asked.add((i, tuple(valid[a][1])))
        scored = sorted((-round(float(x @ y), 12), j) for b, (j, y) in enumerate(unit) if b != a and len(y) == len(x))
        out.setdefault(i, []).append([(j, -s) for s, j in scored[:k]])
    return out


def answers(spark, rows, **options):
    df = spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v]) for i, v in rows], SCHEMA)
    df = df.withColumns({c: F.lit("clash") for c in ("node", "vec", "ids", "rank", "score", "query")}).repartition(3)
    got = {}
    for r in nearest_neighbours(df, **options).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return {q: sorted(v) for q, v in got.items()}


def recall(found, wanted):
    hits = [len({j for _, j, _ in found.get(q, [])} & {j for j, _ in near[0]}) / len(near[0]) for q, near in wanted.items()]
    return float(np.mean(hits))


@pytest.mark.parametrize("clustered", [False, True])
def test_recall(spark, clustered):
    rng = np.random.RandomState(4)
    x = rng.standard_normal((3_000, 32))
    if clustered:
        x = 0.4 * x + rng.standard_normal((30, 32))[rng.randint(0, 30, 3_000)]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    # A graph and a beam small enough that a search can fail.
    found = answers(spark, rows, graph=Graph(neighbours=12, sample=8, orders=2, block=64, beam=64, step=16, per_part=300))
    assert recall(found, exact(rows)) >= 0.9
    assert all([r for r, _, _ in v] == [1, 2, 3, 4, 5] for v in found.values())


def test_small_tables_are_exact(spark):
    rng = np.random.RandomState(5)
    base = rng.standard_normal(8)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((120, 8)))]
    rows += [(200 + i, base.tolist()) for i in range(40)] + [(300 + i, (2 * base).tolist()) for i in range(3)]
    rows += [(50, base.tolist()), (100, base.tolist()), (100, base.tolist()), (7, base.tolist())]
    rows += [(400, None), (450, []), (500, [0.0] * 8), (550, [1.0, None] + [0.0] * 6), (600, [float("nan")] * 8),
             (650, [float("inf")] * 8), (None, base.tolist())]
    rows += [(700, [1e200, 1e199]), (701, [1e-200, 1e-201]), (702, [1.0, 0.2]), (703, [-1.0, 0.1])]  # of another dimension
    found, wanted = answers(spark, rows), exact(rows)
    assert found.keys() == wanted.keys()
    for q, near in wanted.items():
        assert sorted((r, j, round(s, 9)) for r, j, s in found[q]) == sorted(
            (r + 1, j, round(s, 9)) for one in near for r, (j, s) in enumerate(one)), q


def test_empty_and_lonely(spark):
    assert answers(spark, []) == {} == answers(spark, [(50, [1.0, 2.0])])
    assert answers(spark, [(50, [1.0, 2.0]), (3, [2.0, 1.0])])[50][0][:2] == (1, 3)


def test_likeness_does_not_depend_on_the_block():
    rng = np.random.RandomState(6)
    code, scale = neighbours._codes([v.tobytes() for v in rng.standard_normal((50, 24))], 24)
    whole = neighbours._likeness(code, code, scale, scale)
    assert (whole == whole.T).all()
    assert (neighbours._likeness(code[3:9], code[20:41], scale[3:9], scale[20:41]) == whole[3:9, 20:41]).all()
    assert abs(whole.diagonal() - 1).max() < 1e-5
