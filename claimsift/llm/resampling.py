"""Operator 12: documents drawn by importance towards a target distribution of hashed n-grams.

Texts are taken a batch at a time: the batch's texts are joined with a separator that is in no word, one pass of a regular
expression finds all words, and a binary search of their places among the documents' offsets tells whose they are. Runs of
words that reach over a separator are masked before the buckets are counted. The counts of all documents and of the target
give each bucket a gain; a document's weight is the mean gain of its features, and noise of the Gumbel distribution, fixed
by its id, turns the highest scores into a draw without replacement.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from claimsift.llm.common import ready, running, staged

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
SEPARATOR = b"\0"
BATCH_BYTES = 1_000_000


@dataclass(frozen=True)
class Features:
    """Runs of ``shortest`` to ``longest`` words, hashed to ``buckets`` (the driver holds two numbers per bucket)."""

    shortest: int = 1
    longest: int = 1
    buckets: int = 10_000


@dataclass(frozen=True)
class Draw:
    """``percent`` of the documents with at least ``least_words`` words are drawn; ``seed`` fixes the noise."""

    percent: int = 10
    least_words: int = 20
    seed: int = 2024


def batch_features(texts: list[bytes], spec: Features) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words of each text, and of each feature its text and its bucket."""
    offsets = np.cumsum([0, *[len(t) + 1 for t in texts]])[:-1]
    found = [(m.start(), m.group()) for m in WORD.finditer(SEPARATOR.join(texts).lower())]
    doc = np.searchsorted(offsets, np.fromiter((at for at, _ in found), np.int64, len(found)), "right") - 1
    words = [w for _, w in found]
    docs, hashes = [], []
    for k in range(spec.shortest, spec.longest + 1):
        last = len(words) - k + 1
        if last <= 0:
            break
        inside = doc[:last] == doc[k - 1:]
        runs = words if k == 1 else (b" ".join(words[i:i + k]) for i in np.flatnonzero(inside))
        docs.append(doc[:last][inside])
        hashes.append(np.fromiter(map(zlib.crc32, runs), np.int64, int(inside.sum())))
    whose = np.concatenate(docs) if docs else np.zeros(0, np.int64)
    bucket = np.concatenate(hashes) % spec.buckets if hashes else np.zeros(0, np.int64)
    return np.bincount(doc, minlength=len(texts)), whose, bucket


def _batches(column: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """Whole texts, about a batch's bytes at a time, with the index of the first; null counts as empty."""
    held, size, first = [], 0, 0
    for i, value in enumerate(column):
        text = value.as_buffer().to_pybytes() if value.is_valid else b""
        held.append(text)
        size += len(text)
        if size >= BATCH_BYTES:
            yield first, held
            held, size, first = [], 0, i + 1
    if held:
        yield first, held


def bucket_counts(texts: DataFrame, text: str, spec: Features) -> np.ndarray:
    """Features in each bucket over all rows; each task sends one row per bucket it has."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(spec.buckets, np.int64)
        for batch in batches:
            for _, part in _batches(batch.column(0)):
                total += np.bincount(batch_features(part, spec)[2], minlength=spec.buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    rows = texts.select(F.col(text).cast("string")).mapInArrow(run, "bucket long, n long")
    counts = np.zeros(spec.buckets, np.int64)
    for bucket, n in rows.groupBy("bucket").agg(F.sum("n")).collect():  # at most spec.buckets rows
        counts[bucket] = n
    return counts


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm by which each bucket is more frequent in the target, with one added to every count."""
    width = len(corpus)
    all_corpus, all_target = int(corpus.sum()), int(target.sum())
    return np.array([
        math.floor(1000 * math.log(float(t + 1) * float(all_corpus + width) / (float(s + 1) * float(all_target + width))))
        for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def noise(doc_id: Column, seed: int) -> Column:
    """Thousandths of Gumbel noise that depends on the id only; a null id counts as an empty one."""
    told = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(told, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def resample(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text",
             spec: Features = Features(), draw: Draw = Draw()) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` for each row of ``docs``.

    ``weight`` is the floored mean gain of its features (0 without any), ``rank`` its place from 1 among the drawn, which
    are the highest scores of rows with enough words, ties to smaller ids, null ids last; undrawn rows have none. Rows that
    repeat an id count and are drawn each for itself. Null texts have no words. An empty corpus gives no rows, an empty
    target gains from smoothing alone. Other columns are ignored, whatever their names.
    """
    spark = ready(docs.sparkSession)
    gains = bucket_gains(bucket_counts(docs, text, spec), bucket_counts(target, target_text, spec))

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, part in _batches(batch.column(1)):
                words, whose, bucket = batch_features(part, spec)
                n = np.bincount(whose, minlength=len(part))
                total = np.bincount(whose, gains[bucket], minlength=len(part)).astype(np.int64)  # whole numbers below 2**53
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(part)), pa.array(words), pa.array(n), pa.array(total // np.maximum(n, 1))],
                    ["doc_id", "n_words", "n_features", "weight"])

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(
        weighed, f"doc_id {kind}, n_words long, n_features long, weight long")
    scored = staged(rows.withColumn("score", F.col("weight") + noise(F.col("doc_id"), draw.seed)), "scored")
    enough = F.col("n_words") >= draw.least_words
    drawn = draw.percent * scored.filter(enough).count() // 100
    order = [F.desc(enough), F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("n_words")]
    placed = running(scored, order, {"place": F.lit(1).cast("long")}, "ranked")
    rank = F.when(enough & (F.col("place") <= drawn), F.col("place"))
    return placed.select("doc_id", "n_words", "n_features", "weight", "score", rank.alias("rank"))
