"""Near-duplicate embeddings: vectors of extreme length, odd tables, and the number of probes."""

import numpy as np
import pytest

from claimsift.llm import embeddings
from claimsift.llm.embeddings import Index, near_duplicate_vectors, nearest, probes_needed

SCHEMA = "vec_id long, embedding array<double>"


def found(spark, tmp_path, rows):
    path = str(tmp_path / "vectors")
    spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v]) for i, v in rows],
                          SCHEMA).write.parquet(path)
    return sorted(tuple(r) for r in near_duplicate_vectors(spark.read.parquet(path)).collect())


def test_finite_vectors_of_any_length_link(spark, tmp_path):
    rows = [(1, [1e200, 1e199]), (2, [1e-200, 1e-201]), (3, [1.0, 0.1]), (4, [-1e308, 1e307]), (5, [5e-324, 0.0]),
            (6, [0.0, 0.0]), (7, [float("inf"), 1.0]), (8, [0.0, -1.0])]
    # A vector of the least number points along the first axis, within 0.9 of the first three.
    assert found(spark, tmp_path, rows) == [
        (1, 3, 1, True), (2, 3, 1, False), (3, 3, 1, False), (4, 0, 4, True), (5, 3, 1, False), (6, 0, 6, True),
        (7, 0, 7, True), (8, 0, 8, True)]


def test_repeated_ids_and_two_dimensions(spark, tmp_path):
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [2.0, 0.0]), (3, [1.0, 0.0, 0.0]), (4, [1.0, 0.01, 0.0])]
    assert found(spark, tmp_path, rows) == [
        (1, 0, 1, True), (1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 1, 3, True), (4, 1, 3, False)]


def test_an_empty_table_gives_no_rows(spark, tmp_path):
    assert found(spark, tmp_path, []) == []


def test_nearest_equals_a_full_sort():
    rng = np.random.RandomState(1)
    x, centres = rng.standard_normal((40, 6)), rng.standard_normal((50, 6))
    full = np.argsort(-(x @ centres.T), axis=1, kind="stable")
    for probes in (1, 7, 49, 50):
        assert (nearest(x, centres, probes) == full[:, :probes]).all()


@pytest.mark.parametrize("cells", [8, 200, 2000])
def test_probes_follow_the_cells(cells):
    rng = np.random.RandomState(2)
    units = rng.standard_normal((4000, 32))
    units /= np.sqrt((units**2).sum(axis=1, keepdims=True))
    centres = units[:cells]
    probes = probes_needed(units, centres, 0.9, Index())
    assert min(12, cells) <= probes <= cells and probes_needed(units, centres, 1.0, Index()) == min(12, cells)
    aside = rng.standard_normal(units.shape)
    aside -= (aside * units).sum(axis=1, keepdims=True) * units
    others = 0.9 * units + np.sqrt(0.19) * aside / np.sqrt((aside**2).sum(axis=1, keepdims=True))
    a, b = nearest(units, centres, probes), nearest(others, centres, probes)
    share = ((a == b[:, :1]).any(axis=1) | (b == a[:, :1]).any(axis=1)).mean()
    assert share >= Index().reached - 0.02
    assert embeddings.fit_centres(units, cells, 1).shape == centres.shape
