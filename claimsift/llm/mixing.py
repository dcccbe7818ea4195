"""Operator 1: sources mixed to target weights by weighted fair queueing. DataFrame functions only.

The documents of each source stand in a shuffled queue, once per allowed repeat. Each copy gets a virtual finish time:
the words of its source up to its own end, divided by the source's weight. Sorting all copies by finish time interleaves
the sources in proportion to their weights, and a source that has used up its repeats leaves its share to the others; the
mix is the longest prefix of that order within the budget. The targets are what this tends to, computed from the sizes of
the sources alone.

A queue is never held by one task: running totals go over ranges of (source, shuffle), so a source with a third of all
rows is spread over a third of the ranges. Texts are read once, to count words, and never shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from claimsift.llm.common import ready, running, staged


@dataclass(frozen=True)
class Mix:
    """``weights`` go to the sources by code point, null last, and repeat; the budget is ``share`` times all words; no
    document is taken more than ``repeats`` times."""

    weights: tuple[int, ...] = (5, 2, 1)
    share: float = 1.5
    repeats: int = 2
    seed: int = 7


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _sources(sized: DataFrame, mix: Mix) -> tuple[DataFrame, float]:
    """One row per source with its weight, size, place, the words of sources before it, and target; and the budget."""
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    placed = running(totals, [F.col("source").asc_nulls_last()],
                     {"place": F.lit(1), "words_to": F.col("source_size")}, "sources")
    weights = F.array(*[F.lit(w) for w in mix.weights])
    weighed = placed.select(
        "source", "source_size", "place", (F.col("words_to") - F.col("source_size")).alias("words_before"),
        F.get(weights, F.pmod(F.col("place") - 1, F.lit(len(mix.weights))).cast("int")).alias("weight"))
    most = (mix.repeats * F.col("source_size")).cast("double")
    filled = staged(running(
        weighed.withColumn("most", most).withColumn("level", F.col("most") / F.col("weight")),
        [F.col("level"), F.col("place")], {"filled": F.col("most"), "used": F.col("weight")}, "levels"), "shares")
    total, weight = filled.agg(F.sum("source_size"), F.sum("weight")).first()
    budget = mix.share * (total or 0)
    # In order of level, the sources before one are full. The common level of the others is the highest that any of them
    # would get if just those before it were.
    open_to = (F.lit(budget) - (F.col("filled") - F.col("most"))) / (F.lit(weight) - (F.col("used") - F.col("weight")))
    level = filled.agg(F.max(open_to)).first()[0]
    target = F.least(F.col("most"), F.lit(level or 0.0) * F.col("weight"))
    return filled.select("source", "source_size", "place", "words_before", "weight", target.alias("target")), budget


def mix_sources(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
                mix: Mix = Mix()) -> DataFrame:
    """``doc_id, source, size, source_size, weight, target, copies, taken, finish`` for each row of ``docs``.

    ``size`` counts the words of the whole text (null: 0), ``copies`` how often the mix takes the document, ``taken`` the
    words of that. Null is a source of its own, the last. The shuffle follows the id, so reruns agree; rows that repeat
    an id stand next to each other in the queue. Empty texts cost nothing. An empty table gives no rows. Other columns
    are ignored, whatever their names.
    """
    ready(docs.sparkSession)
    shuffle = F.md5(F.concat_ws(":", F.lit(str(mix.seed)), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))))
    sized = staged(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(text).alias("size"),
                               shuffle.alias("shuffle")), "sizes")
    sources, budget = _sources(sized, mix)
    known = sources.withColumnRenamed("source", "_source")
    queued = sized.join(known, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    order = [F.col(c) for c in ("place", "shuffle", "doc_id", "size")]
    queued = staged(running(queued, order, {"position": F.lit(1), "words_to": F.col("size")}, "queue"), "queued")

    def finish(copy: Column) -> Column:
        words = F.col("words_to") - F.col("words_before") + (copy - 1) * F.col("source_size")
        return words / F.col("weight")

    copies = F.sequence(F.lit(1), F.lit(mix.repeats))
    times = queued.select("place", "position", "size", "source_size", "weight", "words_to", "words_before",
                          F.explode(copies).alias("copy"))
    times = times.select(finish(F.col("copy")).alias("finish"), "place", "position", "copy", "size")
    rank = [F.col(c) for c in ("finish", "place", "position", "copy")]
    in_order = running(times, rank, {"queued": F.col("size")}, "times")
    last = in_order.filter(F.col("queued") <= F.lit(budget)).agg(F.max(F.struct(*rank)).alias("last")).first()["last"]
    if last is None:
        taken = F.lit(0)
    else:
        end = F.struct(F.lit(last["finish"]), F.lit(last["place"]).cast("long"), F.lit(last["position"]).cast("long"),
                       F.lit(last["copy"]))
        taken = F.size(F.filter(copies, lambda c: F.struct(finish(c), F.col("place"), F.col("position"), c) <= end))
    return queued.select(
        "doc_id", "source", "size", "source_size", "weight", "target", taken.alias("copies"),
        (taken * F.col("size")).cast("long").alias("taken"), finish(F.lit(1)).alias("finish"))
