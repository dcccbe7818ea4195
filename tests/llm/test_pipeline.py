"""Every stage of the pipeline on its own input, against plain Python."""

import uuid
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from claimsift.llm import common, sql
from tests.llm import brute
from tests.llm.test_operators import encoded, numbers

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def outputs(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    more = spark.createDataFrame(
        [(5001, None, None, "src1", 0), (5002, "12 34 ??", None, "src1", 8), (5003, "", None, None, 0)], docs.schema)
    docs.union(more).write.parquet(f"{folder}/input")
    frames = {"input": spark.read.parquet(f"{folder}/input")}
    docs = frames["input"]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(f"{folder}/{name}")
        docs = frames[name] = spark.read.parquet(f"{folder}/{name}")
    return frames


def rows(df):
    return [tuple(r) for r in df.select(*COLUMNS).collect()]


def test_language_stage(outputs):
    left = {r[0]: r for r in rows(outputs["language"])}
    given = {r[0]: r for r in rows(outputs["input"])}
    lettered = {i for i, r in given.items() if any(c.isalpha() for c in r[1] or "")}
    assert left == {i: given[i] for i in lettered}
    assert {5001, 5002, 5003}.isdisjoint(left)


def test_near_copies_stage(outputs):
    given = rows(outputs["language"])
    roots = brute.components([(r[0], r[1]) for r in given])
    assert sorted(rows(outputs["near_copies"])) == sorted(r for r in given if roots[r[0]] == r[0])
    assert len(given) > outputs["near_copies"].count()


def test_repeats_stage(outputs):
    given = rows(outputs["near_copies"])
    cut = brute.without_repeats([(r[0], r[1]) for r in given])
    expected = []
    for r in given:
        removed, kept = cut[r[0]]
        if not removed:
            expected.append(r)
        elif kept:
            text = " ".join(kept)
            expected.append((r[0], text, r[2], r[3], len(text)))
    assert Counter(rows(outputs["repeats"])) == Counter(expected)


def test_mix_stage(outputs):
    connection = duckdb.connect()
    documents = outputs["repeats"].toPandas()  # noqa: F841
    connection.register("documents", documents)
    taken = connection.execute(f"SELECT doc_id, taken // size FROM ({sql.OP1}) WHERE taken > 0").fetchall()
    got = Counter(r[0] for r in rows(outputs["mix"]))
    assert got == dict(taken)
    assert set(rows(outputs["mix"])) <= set(rows(outputs["repeats"]))


def test_pack_stage(outputs):
    given = rows(outputs["mix"])
    ids = encoded([(r[0], r[1]) for r in given])
    pieces = Counter()
    for r in outputs["pack"].collect():
        assert numbers(r["ids"]) == ids[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        pieces[r["doc_id"]] += r["length"]
    copies = Counter(r[0] for r in given)
    assert pieces == {i: n * len(ids[i]) for i, n in copies.items()}


def test_run_equals_the_stages(spark, outputs):
    got = corpus_pipeline.run(spark, SF_DIR)
    assert got.columns == outputs["pack"].columns
    assert got.select(F.sum("length")).first() == outputs["pack"].select(F.sum("length")).first()


@pytest.mark.parametrize("name", STAGES)
def test_odd_columns_and_rows(spark, tmp_path, name):
    odd = [(1, "many words of an odd text here", "en", "a", 5), (1, "many words of an odd text here", "en", "a", 5),
           (None, None, None, None, None), (2, "", "en", "a", 0), (3, "word " * 5000, "en", None, 25000),
           (None, "another text without any id", "en", "b", 3)]
    docs = spark.createDataFrame(odd, "doc_id long, text string, lang string, source string, n_chars long")
    for extra in ("score", "kept", "kept_", "_id", "copies", "size", "row", "chunk", "print"):
        docs = docs.withColumn(extra, F.lit(extra))
    docs.write.parquet(f"{tmp_path}/odd")
    got = STAGES[name](spark, spark.read.parquet(f"{tmp_path}/odd"), SF_DIR)
    if name != "pack":
        assert got.columns == docs.columns
    for r in got.collect():
        assert r["kept_"] == "kept_" and r["score"] == "score"
    empty = spark.createDataFrame([], docs.schema)
    empty.write.parquet(f"{tmp_path}/none")
    assert STAGES[name](spark, spark.read.parquet(f"{tmp_path}/none"), SF_DIR).count() == 0


def test_language_stage_without_labels(spark, tmp_path):
    rows = [(1, "many words of a text", None), (2, "12 34 ??", None), (3, "", None), (4, None, None), (None, "слова без метки", "")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/docs")
    left = corpus_pipeline.identify_language(spark, spark.read.parquet(f"{tmp_path}/docs"), SF_DIR)
    assert sorted((r[0] for r in left.select("doc_id").collect()), key=repr) == [1, None]


def test_language_stage_keeps_texts_in_several_languages(spark, tmp_path):
    """A text in three languages in equal parts stays, though none has half of it."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    parts = {}
    for r in docs.filter("lang IS NOT NULL AND size(split(text, ' ')) > 60").orderBy("doc_id").collect():
        parts.setdefault(r["lang"], " ".join(r["text"].split()[:50]))
    for i in range(3):
        mixed = [x for _, x in sorted(parts.items())][i:] + [x for _, x in sorted(parts.items())][:i]
        docs = docs.union(spark.createDataFrame([(10_000_000 + i, " ".join(mixed[:3]), None)], docs.schema))
    docs.write.parquet(f"{tmp_path}/docs")
    left = corpus_pipeline.identify_language(spark, spark.read.parquet(f"{tmp_path}/docs"), SF_DIR)
    assert {r[0] for r in left.filter("doc_id >= 10000000").select("doc_id").collect()} == {10_000_000 + i for i in range(3)}


def test_of_rows_with_the_same_id_and_text_one_stays(spark, tmp_path):
    rows = [(1, "t " * 9, "en", "x", 1), (1, "t " * 9, "de", "y", 1), (1, "t " * 9, None, "z", 2), (2, "other", "en", "b", 1),
            (2, "other", "en", "a", 1), (None, "no id", "en", "b", 1), (None, "no id", "en", None, 1)]
    kept = set()
    for seed in range(2):
        path = f"{tmp_path}/{seed}"
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
        docs.repartition(1 + 3 * seed, F.rand(seed)).write.parquet(path)
        left = STAGES["near_copies"](spark, spark.read.parquet(path), SF_DIR)
        assert left.columns == COLUMNS
        kept.add(tuple(sorted(map(tuple, left.collect()), key=repr)))
    assert kept == {tuple(sorted([(1, "t " * 9, None, "z", 2), (2, "other", "en", "a", 1), (None, "no id", "en", None, 1)], key=repr))}


def test_tables_of_the_stages_do_not_stay(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(common, "shared_folder", lambda _, purpose: f"{tmp_path}/claimsift/{purpose}-{uuid.uuid4().hex}")
    packed = corpus_pipeline.run(spark, SF_DIR)
    left = {p.parent.name for p in tmp_path.glob("claimsift/llm-*/*/_SUCCESS")}
    assert left == {f"stage_{name}" for name in STAGES if name != "pack"}
    assert packed.count() > 0
