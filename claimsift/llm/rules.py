"""Operator 8: quality rules as a learned decision list.

Counts of each whole text give features; labels of a bounded sample teach an ordered list of rules, each a conjunction of
thresholds that drops a text. Rules are grown by information gain on two thirds of the sample, cut back on the last third,
kept only if they are right there, and what they cover is taken out before the next one is learned. The list is applied as
one ordered conditional expression of Spark.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from claimsift.llm.common import ready, staged
from claimsift.llm.words import Chunk, chunks, sequence_hashes, span_hashes

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks")
REPEATED_RUN = 8


def _is_one_of(characters: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(characters)] = True
    return table


_SYMBOL, _MARK = _is_one_of(b"#*$%&|<>"), _is_one_of(b"!?")
_UPPER = _is_one_of(bytes(range(65, 91)))
_SPACE = _is_one_of(b"\x20\t\n\v\f\r")


@dataclass(frozen=True)
class Learning:
    """At most ``sample`` labelled rows are learned from. A rule has at most ``conditions`` thresholds, taken from
    ``cuts`` quantiles per feature, and must be right for ``precision`` of at least ``least`` texts it was not grown on."""

    sample: int = 20_000
    rules: int = 12
    conditions: int = 4
    cuts: int = 64
    precision: float = 0.9
    least: int = 3
    seed: int = 17


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    value: float


@dataclass
class DecisionList:
    """Rules in order; the first whose conditions all hold drops the text, and a text without such a rule is kept."""

    rules: list[list[Condition]] = field(default_factory=list)

    def number(self) -> Column:
        """The number of the first rule that holds, from 1; null if none does."""
        chosen = None
        for i, rule in enumerate(self.rules, 1):
            holds = F.lit(True)
            for c in rule:
                column = FEATURES[c.feature]()
                holds = holds & ((column > c.value) if c.above else (column <= c.value))
            chosen = F.when(holds, F.lit(i)) if chosen is None else chosen.when(holds, F.lit(i))
        return F.lit(None).cast("int") if chosen is None else chosen


def _per_word(name: str):
    return lambda: F.try_divide(F.col(name).cast("double"), F.col("n_words"))


#: Features of a text from its counts; null for a text without words, to which no rule applies.
FEATURES = {
    "words": lambda: F.when(F.col("n_words") > 0, F.col("n_words").cast("double")),
    "chars_per_word": _per_word("word_chars"),
    "symbols_per_word": _per_word("n_symbols"),
    "repeated_share": _per_word("n_repeat_words"),
    "marks_per_word": _per_word("n_marks"),
    "upper_share": lambda: F.try_divide(F.col("n_upper").cast("double"), F.col("word_chars")),
    "repeated_line_share": lambda: F.try_divide(F.col("n_dup_lines").cast("double"), F.col("n_lines")),
}


def repeated_run_words(chunk: Chunk, k: int = REPEATED_RUN) -> np.ndarray:
    """Per document, the words inside runs of ``k`` words that the document holds at least twice."""
    at = chunk.windows(k)
    if not len(at):
        return np.zeros(len(chunk.rows), np.int64)
    key, doc = sequence_hashes(chunk.hashes(), k)[at], chunk.doc[at]
    order = np.lexsort((key, doc))
    same = (key[order][1:] == key[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edges = np.zeros(len(chunk.doc) + 1, np.int64)
    edges[at[twice]] += 1  # each place starts one run
    edges[at[twice] + k] -= 1
    return np.bincount(chunk.doc[np.cumsum(edges[:-1]) > 0], minlength=len(chunk.rows))


def line_counts(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Per document, its lines with a word, and those of them that equal an earlier one."""
    start = np.sort(np.concatenate([chunk.doc_start, np.flatnonzero(chunk.data == 10) + 1]))
    end = np.append(start[1:], len(chunk.data)) - 1
    worded = np.searchsorted(chunk.starts, end) > np.searchsorted(chunk.starts, start)
    start, end = start[worded], end[worded]
    doc = np.searchsorted(chunk.doc_start, start, "right") - 1
    key = span_hashes(chunk.data, start, end)
    order = np.lexsort((key, doc))
    same = (key[order][1:] == key[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    docs = len(chunk.rows)
    return np.bincount(doc, minlength=docs), np.bincount(doc[order][1:][same], minlength=docs)


def text_counts(chunk: Chunk) -> dict[str, np.ndarray]:
    def per_document(found: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(found, dtype=np.int64)])
        return total[chunk.doc_end] - total[chunk.doc_start]

    lines, repeated = line_counts(chunk)
    return {
        "n_words": chunk.counts, "word_chars": per_document(~_SPACE[chunk.data] & (chunk.data & 0xC0 != 0x80)),
        "n_symbols": per_document(_SYMBOL[chunk.data]), "n_dup_lines": repeated,
        "n_repeat_words": repeated_run_words(chunk), "n_lines": lines, "n_upper": per_document(_UPPER[chunk.data]),
        "n_marks": per_document(_MARK[chunk.data]),
    }


def counted(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``doc_id`` and the counts of each whole text."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                counts = text_counts(chunk)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(chunk.rows[0], len(chunk.rows)),
                     *[pa.array(np.asarray(counts[c]).astype(np.int64)) for c in COUNTS]], ["doc_id", *COUNTS])

    kind = docs.schema[doc_id].dataType.simpleString()
    return rows.mapInArrow(run, ", ".join([f"doc_id {kind}", *[f"{c} long" for c in COUNTS]]))


def learn(features: np.ndarray, bad: np.ndarray, learning: Learning = Learning()) -> DecisionList:
    """Sequential covering. ``features`` has a column per entry of ``FEATURES``; ``bad`` tells what rules are to drop."""
    names, rules = list(FEATURES), []
    grown = np.random.RandomState(learning.seed).permutation(len(bad)) % 3 != 0
    left = np.ones(len(bad), bool)
    while len(rules) < learning.rules:
        rule = _grow(features[left & grown], bad[left & grown], names, learning)
        rule = _cut_back(rule, features[left & ~grown], bad[left & ~grown], names)
        held = _covers(rule, features, names) & left
        right, all_held = int((held & bad & ~grown).sum()), int((held & ~grown).sum())
        if not rule or all_held < learning.least or right < learning.precision * all_held:
            break
        rules.append(rule)
        left &= ~held
    return DecisionList(rules)


def _covers(rule: list[Condition], features: np.ndarray, names: list[str]) -> np.ndarray:
    covered = np.ones(len(features), bool)
    for c in rule:
        column = features[:, names.index(c.feature)]
        covered &= (column > c.value) if c.above else (column <= c.value)
    return covered


def _grow(features: np.ndarray, bad: np.ndarray, names: list[str], learning: Learning) -> list[Condition]:
    """Adds the condition of the highest gain until nothing good is covered or nothing is gained."""
    rule, covered = [], np.ones(len(bad), bool)
    while len(rule) < learning.conditions:
        x, y = features[covered], bad[covered]
        p, n = int(y.sum()), int((~y).sum())
        if not p or not n:
            break
        best, before = (1e-9, None), np.log2(p / (p + n))
        for i, name in enumerate(names):
            values = np.unique(x[:, i])
            middle = (values[1:] + values[:-1]) / 2
            if len(middle) > learning.cuts:
                middle = np.unique(middle[np.linspace(0, len(middle) - 1, learning.cuts).astype(int)])
            for value in middle.tolist():
                over = x[:, i] > value
                for above, held in ((True, over), (False, ~over)):
                    hit = int((held & y).sum())
                    if hit:
                        gain = hit * (np.log2(hit / int(held.sum())) - before)
                        if gain > best[0]:
                            best = gain, Condition(name, above, value)
        if best[1] is None:
            break
        rule.append(best[1])
        covered &= _covers([best[1]], features, names)
    return rule


def _cut_back(rule: list[Condition], features: np.ndarray, bad: np.ndarray, names: list[str]) -> list[Condition]:
    """The beginning of the rule that tells bad texts from good ones best; of equals, the shortest."""
    def worth(length: int) -> float:
        held = _covers(rule[:length], features, names)
        p, n = int((held & bad).sum()), int((held & ~bad).sum())
        return (p - n) / (p + n) if p + n else -1.0

    return rule[:max(range(1, len(rule) + 1), key=worth)] if rule else rule


def labelled_sample(counts: DataFrame, labels: DataFrame, label: str, learning: Learning) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of at most ``learning.sample`` rows, evenly spread by a hash of the id."""
    marks = labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("label")).filter(
        "_id IS NOT NULL AND label IN (0, 1)").distinct()
    known = counts.filter("n_words > 0").join(marks, F.col("doc_id") == F.col("_id"))
    hashed = F.xxhash64(F.col("doc_id").cast("string"), F.lit(learning.seed))
    share = min(1.0, learning.sample / max(1, labels.count()))
    rows = known.select(hashed.alias("h"), "label", *[f().alias(name) for name, f in FEATURES.items()]).filter(
        F.pmod("h", F.lit(1 << 30)) <= F.lit(int(share * (1 << 30))))
    rows = rows.orderBy("h", *FEATURES, "label").limit(learning.sample).collect()
    values = np.array([[0.0 if r[name] is None else r[name] for name in FEATURES] for r in rows]).reshape(-1, len(FEATURES))
    return values, np.array([r["label"] == 0 for r in rows], bool)


def apply_rules(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
                learning: Learning = Learning()) -> tuple[DataFrame, DecisionList]:
    """One row per row of ``docs`` with ``doc_id``, the counts, ``base_failed``, ``rule`` (the number of the rule that
    drops the text, null if none does) and ``kept``; and the decision list.

    ``labels`` has ``doc_id`` and a label, 1 for good and 0 for bad; rows with other or null values teach nothing, and
    without labels there is no rule. Null and empty texts have no words and fail the base rule. Repeated rows get equal
    answers, texts are counted as a whole whatever their length, an empty table gives no rows. Other columns are ignored,
    whatever their names.
    """
    ready(docs.sparkSession)
    counts = staged(counted(docs, doc_id, text), "counts")
    decisions = learn(*labelled_sample(counts, labels, label, learning), learning)
    base = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    judged = counts.select("*", base.alias("base_failed"), decisions.number().alias("rule"))
    return judged.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull()), decisions
