"""The documents of a training run, from raw texts to packed sequences, in five stages.

Every stage reads what its predecessor wrote, works on all of it and hands the columns of ``documents`` on; the last one
returns the pieces of the sequences. Empty tables pass through all stages, extra columns travel along. Null ids and texts
are kept or dropped as the stage says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from claimsift.llm import jaccard, language, mixing, packing, substrings
from claimsift.llm.common import discarding, ready, staged

#: Columns that operators add to those of their input.
ADDED = {"held_out", "lang_pred", "score", "spans", "in_language", "n_words", "n_removed", "kept"}
#: Least share of a text's lettered words that must be in a learned language, be it one for all or several.
LEAST_SHARE = 0.5


def _aside(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with other names for columns that an operator would replace, and their names by column."""
    names = {c: c for c in docs.columns}
    for c in ADDED & names.keys():
        while names[c] in docs.columns or names[c] in ADDED:
            names[c] += "_"
    return docs.withColumnsRenamed(names), names


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without any letter and texts of which less than half of the words are in any learned language. Texts
    that switch language stay, and if nothing is labelled all texts with a letter do."""
    mine, names = _aside(docs)
    return language.identify(mine).filter(F.col("in_language") >= LEAST_SHARE).select(*[F.col(new).alias(c) for c, new in names.items()])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near copies. Of rows that share id and text the one whose
    other columns come first in order stays, nulls before all else. Rows without an id stay where no document with an id has
    their text or a near copy of it; of equal ones, one does."""
    members = jaccard.near_duplicates(docs)
    stays = members.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id").distinct()
    kept = docs.alias("d").join(stays.alias("s"), F.col("d.doc_id").eqNullSafe(F.col("s.doc_id")), "left_semi")
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    if not others:
        return kept.distinct()
    first = kept.groupBy("doc_id", "text").agg(F.min(F.struct(*[F.col(f"`{c}`") for c in others])).alias("_first"))
    return first.select(*[F.col(f"_first.`{c}`").alias(c) if c in others else F.col(f"`{c}`") for c in docs.columns])


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts words that a repeated window of 20 words covers. Texts that lose nothing stay as they were; a document that
    loses all its words goes."""
    mine, names = _aside(docs)
    cut = substrings.remove_repeats(mine)
    lost = F.col("n_removed") > 0
    changed = {"text": F.when(lost, F.col("kept")).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(lost, F.length("kept").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    left = cut.filter(~lost | (F.col("n_removed") < F.col("n_words")))
    return left.select(*[changed.get(c, F.col(new)).alias(c) for c, new in names.items()])


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats each document as often as the mix of the sources takes it, which may be never."""
    mixed = mixing.mix_sources(docs).filter("copies > 0")
    # Rows alike in id, source and size have one place in the mix's result.
    taken = mixed.groupBy("doc_id", "source", "size").agg(F.max("copies").alias("copies"))
    same = (F.col("d.doc_id").eqNullSafe(F.col("t.doc_id")) & F.col("d.source").eqNullSafe(F.col("t.source"))
            & (mixing.word_count("d.text") == F.col("t.size")))
    joined = docs.alias("d").join(taken.alias("t"), same)
    repeats = F.sequence(F.lit(1), F.col("t.copies"))
    row = F.struct(*[F.col(f"d.`{c}`").alias(c) for c in docs.columns])
    return joined.select(F.explode(F.transform(repeats, lambda _: row)).alias("row")).select("row.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequence and their place in it."""
    return packing.pack_bounded(docs)


STAGES = [
    ("language", identify_language),
    ("near_copies", drop_near_copies),
    ("repeats", cut_repeats),
    ("mix", mix_to_weights),
    ("pack", pack_sequences),
]

#: The model of the first stage and the open sequences of the last have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        with discarding(spark):  # a stage's own tables go once its result is written
            docs = staged(stage(spark, docs, sf_dir), f"stage_{name}", keep=True)
    return STAGES[-1][1](spark, docs, sf_dir)
