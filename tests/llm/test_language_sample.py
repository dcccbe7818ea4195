"""The sample that languages are learned from: the first documents by hash, however many there are."""

import zlib

import pytest
from pyspark.sql import functions as F

from claimsift.llm.language import Training, held_out, training_sample


NOT_HELD_OUT = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 3 != 1)


def plain(docs, training):
    """The same sample by one window over all documents."""
    rows = docs.filter("lang IS NOT NULL AND lang <> '' AND text IS NOT NULL").filter(~held_out(F.col("doc_id"))).select(
        F.xxhash64(F.col("doc_id").cast("string"), F.lit(training.seed)).alias("h"), "text", "lang").collect()
    out = []
    for lang in {r.lang for r in rows}:
        mine = sorted((r.h, r.text) for r in rows if r.lang == lang)
        last = [h for h, _ in mine][:training.documents][-1]
        out += [(t, lang) for h, t in mine if h <= last][:training.documents]
    return sorted(out)


@pytest.mark.parametrize("ids", ["many", "null", "one"])
def test_sample_is_the_first_by_hash(spark, ids):
    training = Training(documents=20)
    i = F.col("id")
    doc_id = {"many": i, "null": F.lit(None).cast("long"), "one": F.lit(NOT_HELD_OUT).cast("long")}[ids]
    docs = spark.range(3_000).select(
        doc_id.alias("doc_id"), F.concat(F.lit("text "), i.cast("string")).alias("text"),
        F.when(i % 100 == 0, "rare").when(i % 7 == 0, None).when(i % 11 == 0, "").otherwise("often").alias("lang"))
    got = sorted(training_sample(docs, "doc_id", "text", "lang", training))
    assert got == plain(docs, training)
    assert {lang for _, lang in got} == {"rare", "often"} and len(got) == 40
