"""Importance resampling against plain Python."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimsift.llm import resampling
from claimsift.llm.resampling import Draw, Features

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text, spec):
    w = WORD.findall((text or "").translate(LOWER))
    runs = [" ".join(w[i:i + k]) for k in range(spec.shortest, spec.longest + 1) for i in range(len(w) - k + 1)]
    return len(w), [zlib.crc32(r.encode()) % spec.buckets for r in runs]


def brute(docs, target, spec, draw):
    corpus, aim = Counter(), Counter()
    per_doc = [(i, *features(t, spec)) for i, t in docs]
    for _, _, f in per_doc:
        corpus.update(f)
    for t in target:
        aim.update(features(t, spec)[1])
    s_all, t_all, b = sum(corpus.values()), sum(aim.values()), spec.buckets
    gain = {x: math.floor(1000 * math.log((aim[x] + 1.0) * (s_all + b) / ((corpus[x] + 1.0) * (t_all + b)))) for x in range(b)}
    rows = []
    for i, n, f in per_doc:
        h = int(hashlib.sha256(f"{draw.seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[x] for x in f) // len(f) if f else 0
        rows.append((i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    order = sorted((r for r in rows if r[1] >= draw.least_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2], r[1]))
    drawn = order[:draw.percent * len(order) // 100]
    undrawn = list((Counter(rows) - Counter(drawn)).elements())
    return Counter([(*r, i + 1) for i, r in enumerate(drawn)] + [(*r, None) for r in undrawn])


def texts(n, seed):
    rng = np.random.RandomState(seed)
    vocabulary = ["Alpha", "beta", "Éa", "ÄÖ", "x1", "snake_case", "don't", "a-b", "日本", "\x00", "\n", "42"]
    return [" ".join(rng.choice(vocabulary, rng.randint(0, 60))) for _ in range(n)]


@pytest.mark.parametrize("spec, draw", [
    (Features(), Draw()), (Features(1, 3, 97), Draw(30, 5, 7)), (Features(2, 2, 10), Draw(100, 0)), (Features(1, 2, 50), Draw(0))])
def test_draw_equals_brute_force(spark, spec, draw):
    docs = list(enumerate(texts(120, 1))) + [(None, "alpha beta " * 30), (None, None), (500, None), (501, ""), (502, "--"),
                                             (3, "repeated id " * 20), (3, "repeated id " * 20), (503, "wort " * 60_000)]
    target = [*texts(20, 2), None, ""]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns(
        {c: F.lit("clash") for c in ("score", "weight", "rank", "place", "bucket", "n")}).repartition(3)
    got = resampling.resample(df, spark.createDataFrame([(t,) for t in target], "text string"), spec=spec, draw=draw)
    assert got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert Counter(map(tuple, got.collect())) == brute(docs, target, spec, draw)


def test_runs_do_not_reach_over_documents():
    for parts in (["a b", "c d e", "", "f"], ["", ""], ["x"], []):
        words, whose, bucket = resampling.batch_features([p.encode() for p in parts], Features(1, 3, 1000))
        each = [features(p, Features(1, 3, 1000)) for p in parts]
        assert words.tolist() == [n for n, _ in each]
        got = [sorted(bucket[whose == i].tolist()) for i in range(len(parts))]
        assert got == [sorted(f) for _, f in each]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "word " * 30), (2, None)], "doc_id long, text string")
    assert resampling.resample(none, some).collect() == []
    got = {r.doc_id: r for r in resampling.resample(some, none, draw=Draw(100)).collect()}
    assert got[1].rank == 1 and got[2].rank is None and got[1].weight < 0
