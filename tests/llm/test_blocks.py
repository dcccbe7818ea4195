"""Index lists of the similarity join: blocks of possible partners, and lists that boilerplate makes long."""

import random

import numpy as np
import pytest

from claimsift.llm import jaccard
from tests.llm import brute


@pytest.mark.parametrize("percent", [50, 75, 90])
def test_blocks_hold_all_possible_partners(percent):
    rng = np.random.RandomState(percent)
    of = np.sort(rng.randint(0, 40, 400))
    size = rng.randint(1, 60, 400)
    order = np.lexsort((size, of))
    of, size = of[order], size[order]
    left = np.maximum(1, size - rng.randint(0, 12, 400))
    kept = jaccard._with_partner(of, size, left, percent)
    for i in range(400):
        possible = [
            j for j in range(400) if j != i and of[j] == of[i]
            and percent * max(size[i], size[j]) <= 100 * min(size[i], size[j])
            and 100 * left[i] >= percent * (size[i] + size[j] - left[i])]
        assert kept[i] == bool(possible)
    none = np.zeros(0, np.int64)
    assert len(jaccard._with_partner(none, none, none, percent)) == 0


def boilerplate(n, common=40, own=10, seed=1):
    rng = random.Random(seed)
    shared = [f"c{i}" for i in range(common)]
    return [(i, " ".join(shared + [f"w{rng.randrange(10**9)}" for _ in range(own)])) for i in range(n)]


def test_shared_boilerplate_gives_no_pairs(spark, tmp_path):
    """Every document is in the same long lists, and no two can reach the similarity."""
    rows = boilerplate(3_000)
    path = str(tmp_path / "docs")
    spark.createDataFrame(rows, "doc_id long, text string").repartition(4).write.parquet(path)
    docs = spark.read.parquet(path)
    sets = jaccard.staged(jaccard.candidate_sets(docs, "text", 5, 75), "sets")
    pairs = jaccard._listed(sets, 75, 8).groupBy("part").applyInArrow(jaccard._paired(75), "a long, b long, hub boolean")
    assert pairs.count() == 0
    assert all(r.component_id == r.doc_id for r in jaccard.near_duplicates(docs).collect())


@pytest.mark.parametrize("seed", range(3))
def test_mixed_boilerplate_equals_brute_force(spark, tmp_path, seed):
    """Templates of several lengths with edits around the threshold, in lists longer than those that are enumerated."""
    rng = random.Random(seed)
    templates = [[f"t{k}_{i}" for i in range(rng.randrange(15, 60))] for k in range(3)]
    rows = []
    for i in range(160):
        words = list(rng.choice(templates))
        for _ in range(rng.randrange(0, 5)):
            at = rng.randrange(len(words))
            words[at:at + rng.randrange(0, 2)] = [f"e{rng.randrange(40)}"] * rng.randrange(0, 3)
        words += [f"own{rng.randrange(10**6)}" for _ in range(rng.randrange(0, 8))]
        rows.append((i, " ".join(words)))
    path = str(tmp_path / "docs")
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(path)
    got = {r.doc_id: r.component_id for r in jaccard.near_duplicates(spark.read.parquet(path)).collect()}
    assert got == brute.components(rows)
