"""Each operator on small tables: odd rows, and results against plain Python."""

import struct
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimsift.llm import embeddings, jaccard, language, licenses, mixing, packing, rules, sharding, substrings
from claimsift.llm.tokens import default_vocabulary
from tests.llm import brute

SF_DIR = "/root/testdata/sf0.001"
LONG = " ".join(f"word{i % 701}x{i}" for i in range(30_000))
ODD = [
    (1, "The quick brown fox\njumps over the lazy dog\njumps over the lazy dog", "en", "a"),
    (2, None, "en", "a"), (3, "", None, None), (4, " \n\t ", "en", "a"), (5, "123 456 !!", None, "b"),
    (6, LONG, "en", "a"), (7, LONG, "en", None), (8, "é ü " * 40, "fr", "b"), (8, "é ü " * 40, "fr", "b"),
    (9, "a\x1fb a b　c", None, "a"), (None, "some text with no id", "en", "a"), (None, None, None, None),
]
EXTRA = ("size", "key", "kept", "score", "piece", "component_id", "copies", "_range", "chunk")


def saved(df, folder):
    df.write.parquet(str(folder))
    return df.sparkSession.read.parquet(str(folder))


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    df = spark.createDataFrame(ODD, "doc_id long, text string, lang string, source string")
    df = df.select("*", *[F.lit("z").alias(c) for c in EXTRA])
    return saved(df, tmp_path_factory.mktemp("odd") / "docs")


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="module")
def texts(documents):
    return [(r["doc_id"], r["text"]) for r in documents.collect()]


def with_paths(docs):
    return docs.withColumn("path", F.concat_ws("/", F.lit("top"), "source", F.col("doc_id").cast("string")))


OPERATORS = {
    "mix": mixing.mix_sources, "licenses": lambda d: licenses.scan_licenses(with_paths(d)),
    "jaccard": jaccard.near_duplicates, "language": language.identify, "shards": sharding.assign_shards,
    "substrings": substrings.remove_repeats, "bounded": packing.pack_bounded, "decreasing": packing.pack_decreasing,
    "rules": lambda d: rules.apply_rules(d, d.select("doc_id", F.lit(1).alias("quality"), F.lit("z").alias("label")))[0],
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows(odd, name):
    rows = OPERATORS[name](odd).collect()
    if name == "decreasing":
        assert sorted({str(p["doc"]) for r in rows for p in r["pieces"]}) == sorted({str(x[0]) for x in ODD})
    elif name == "bounded":
        assert sum(r["piece"] == 0 for r in rows) == len(ODD)
    else:
        assert len(rows) == len(ODD)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, tmp_path, name):
    empty = saved(spark.createDataFrame([], "doc_id long, text string, lang string, source string"), tmp_path / "none")
    assert OPERATORS[name](empty).collect() == []


def test_near_copies_of_odd_rows(odd):
    got = {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in jaccard.near_duplicates(odd).collect()}
    assert got[(7, len(brute.shingles(LONG)))] == 6
    assert got[(2, 0)] == 2 and got[(3, 0)] == 3 and got[(4, 0)] == 4


def test_near_copies(documents, texts):
    expected = brute.components(texts)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.near_duplicates(documents).collect()}
    assert got == {i: (len(brute.shingles(t)), expected[i]) for i, t in texts}


def test_groups_of_copies(spark, tmp_path):
    """A large group of exact copies, and one of texts that differ in a word."""
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(base)) for i in range(300)]
    rows += [(1000 + i, " ".join(f"v{j}" if j != i % 60 else f"x{i}" for j in range(60))) for i in range(90)]
    docs = saved(spark.createDataFrame(rows, "doc_id long, text string").repartition(7), tmp_path / "groups")
    got = {r["doc_id"]: r["component_id"] for r in jaccard.near_duplicates(docs).collect()}
    assert got == brute.components(rows)


def test_repeats(spark, texts, tmp_path):
    rows = [*texts, (10_001, LONG), (10_002, "before " + LONG + " after"), (10_003, "again and " * 40)]
    docs = saved(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), tmp_path / "texts")
    got = {r["doc_id"]: (r["n_removed"], r["kept"]) for r in substrings.remove_repeats(docs).collect()}
    assert got == {i: (n, " ".join(w)) for i, (n, w) in brute.without_repeats(rows).items()}


def test_language_of_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language.identify(docs).filter("held_out AND lang IS NOT NULL AND lang_pred <> 'und'").select(
        "lang", "lang_pred").collect()
    assert sum(r[0] == r[1] for r in rows) >= 0.97 * len(rows)


def test_every_language_is_learned(spark, tmp_path):
    """More languages than the sample's full size is meant for, the last of them rare, one with null ids only."""
    rng = np.random.RandomState(5)
    lexicon = [["".join(rng.choice(list("abcdefghijklmnop"), 6)) for _ in range(30)] for _ in range(70)]
    rows = [(100 * s + i, " ".join(rng.choice(lexicon[s], 12)), f"l{s:02}") for s in range(69) for i in range(12 if s < 64 else 8)]
    rows += [(None, " ".join(rng.choice(lexicon[69], 12)), "l69") for _ in range(8)]
    docs = saved(spark.createDataFrame(rows, "doc_id long, text string, lang string"), tmp_path / "languages")
    found = language.identify(docs, training=language.Training(sequences=60)).select("lang", "lang_pred").collect()
    assert {r["lang_pred"] for r in found} == {f"l{s:02}" for s in range(70)}
    assert sum(r["lang"] == r["lang_pred"] for r in found) >= 0.95 * len(found)


def test_language_chances_of_blocks(monkeypatch):
    """Documents of any length, in any number of parts and blocks, as in one plain pass."""
    rng = np.random.RandomState(2)
    counts, transitions = np.array([1, 0, 200, 64, 65, 3, 130]), rng.standard_normal((5, 5))
    scores = rng.standard_normal((counts.sum(), 5))
    plain, step, at = [], np.exp(transitions), 0
    for n in counts:
        local = np.exp(scores[at:at + n])
        ahead, behind = np.ones((n, 5)), np.ones((n, 5))
        for t in range(n):
            behind[t] = ((behind[t - 1] if t else np.ones(5)) @ step) * local[t]
            behind[t] /= behind[t].sum()
        for t in range(n - 2, -1, -1):
            ahead[t] = step @ (local[t + 1] * ahead[t + 1])
            ahead[t] /= ahead[t].sum()
        plain.append(behind * ahead / (behind * ahead).sum(axis=1, keepdims=True))
        at += n
    for cells in (language.CELLS, 700):
        monkeypatch.setattr(language, "CELLS", cells)
        assert np.allclose(language.posteriors(scores, counts, transitions), np.concatenate(plain))


def test_language_of_switched_words(documents):
    """Spans cover every word of a text once."""
    for r in language.identify(documents).select("text", "lang_pred", "spans").collect():
        at = 0
        for span in r["spans"]:
            assert span["first"] == at
            at += span["words"]
        assert at == len(brute.words(r["text"]))


def test_vectors(spark, tmp_path):
    rng = np.random.RandomState(3)
    base = rng.standard_normal((40, 24))
    rows = [(i, (base[i % 40] + rng.standard_normal(24) * [0.0, 0.2, 0.5][i % 3]).tolist()) for i in range(240)]
    rows += [(900, None), (901, []), (902, [0.0] * 24), (903, [float("nan")] * 24), (904, [None] + [1.0] * 23)]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("key", F.lit("z"))
    got = embeddings.near_duplicate_vectors(saved(docs, tmp_path / "v")).collect()
    unit = np.array([r[1] for r in rows[:240]])
    unit /= np.sqrt((unit**2).sum(axis=1, keepdims=True))
    link = unit @ unit.T >= 0.9
    assert {r["vec_id"]: r["n_links"] for r in got} == {
        i: int(link[i].sum()) - 1 if i < 240 else 0 for i, _ in rows}
    for r in got:
        if r["vec_id"] < 240:
            reach, more = {r["vec_id"]}, {r["vec_id"]}
            while more:
                more = {int(j) for i in more for j in np.flatnonzero(link[i])} - reach
                reach |= more
            assert r["component_id"] == min(reach) and r["kept"] == (min(reach) == r["vec_id"])


@pytest.mark.parametrize("clustered", [False, True])
def test_share_of_links_found_with_many_cells(spark, tmp_path, clustered):
    """200 cells, of which each vector probes 12; every pair has a cosine of 0.9 to about 0.93."""
    rng = np.random.RandomState(9)
    base = rng.standard_normal((2000, 64)) + (6 * rng.standard_normal((20, 64))[rng.randint(20, size=2000)] / 8 if clustered else 0)
    base /= np.sqrt((base**2).sum(axis=1, keepdims=True))
    aside = rng.standard_normal((2000, 64))
    aside -= (aside * base).sum(axis=1, keepdims=True) * base
    aside /= np.sqrt((aside**2).sum(axis=1, keepdims=True))
    cosine = rng.uniform(0.902, 0.93, (2000, 1))
    vectors = np.concatenate([base, cosine * base + np.sqrt(1 - cosine**2) * aside])
    docs = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    found = embeddings.near_duplicate_vectors(saved(docs, tmp_path / "v"), index=embeddings.Index(per_cell=20)).collect()
    unit = vectors / np.sqrt((vectors**2).sum(axis=1, keepdims=True))
    links = (unit @ unit.T >= 0.9).sum(axis=1) - 1
    assert all(r["n_links"] <= links[r["vec_id"]] for r in found)
    share = sum(r["n_links"] for r in found) / links.sum()
    print(f"share of {links.sum() // 2} links found, clustered {clustered}: {share:.4f}")
    assert links.sum() >= 4000 and share >= 0.9


def test_counts_of_texts(spark, odd, texts):
    rows = [*texts, (7001, "a b\n\na b\n a b\nc\r\nc\r\n"), (7002, "# * $ & x" * 9), (7003, "one two three four five six seven eight " * 2)]
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: tuple(r[c] for c in names) for r in rules.counted(docs, "doc_id", "text").collect()}
    assert got == {i: brute.counts(t) for i, t in rows}
    got = Counter(tuple(r[c] for c in names) for r in rules.counted(odd, "doc_id", "text").collect())
    assert got == Counter(brute.counts(x[1]) for x in ODD)


def test_learned_rules_on_texts_they_have_not_seen(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "quality")
    seen = labels.filter("doc_id % 4 <> 0")
    judged, decisions = rules.apply_rules(docs, seen)
    assert decisions.rules
    table = {(r["quality"], r["kept"]): r["count"] for r in judged.join(labels.filter("doc_id % 4 = 0"), "doc_id").groupBy(
        "quality", "kept").count().collect()}
    good, bad = (table.get((q, True), 0) + table.get((q, False), 0) for q in (1, 0))
    assert table.get((1, True), 0) >= 0.9 * good and table.get((0, False), 0) >= 0.8 * bad


def test_decision_list_is_one_ordered_expression(spark):
    features = np.random.RandomState(0).uniform(0, 1, (3000, len(rules.FEATURES)))
    bad = (features[:, 2] > 0.7) | ((features[:, 3] > 0.8) & (features[:, 4] <= 0.5))
    found = rules.learn(features, bad)
    covered = np.zeros(3000, bool)
    for rule in found.rules:
        covered |= rules._covers(rule, features, list(rules.FEATURES))
    assert (covered == bad).mean() > 0.97
    assert not rules.learn(features[:0], bad[:0]).rules


def test_licences(spark):
    files = [
        ("p/LICENSE", "Released under the MIT License."), ("p/a.txt", "plain text here"), ("p/q/b.txt", None),
        ("p/q/r/LICENSE", "This work is licensed under the GNU General Public License, version 3."),
        ("p/q/r/c.txt", ""), ("p/q/r/s/d.txt", "words"), ("p/e.txt", "long text\nLicensed under the Apache License, Version 2.0.\nmore"),
        ("other/f.txt", "the work is of this and under"), ("pq/g.txt", "words"), ("h.txt", "words"), (None, "words"),
        ("p/i.txt", "Dies ist Text. " * 3000 + "\n\n# All rights reserved."),
    ]
    found = licenses.scan_licenses(spark.createDataFrame(files, "path string, text string").withColumn("near", F.lit(1)))
    got = {r["path"]: (r["license"], r["origin"], r["license_directory"]) for r in found.collect()}
    assert got == {
        "p/LICENSE": ("MIT", "file", "p"), "p/a.txt": ("MIT", "inherited", "p"), "p/q/b.txt": ("MIT", "inherited", "p"),
        "p/q/r/LICENSE": ("GPL-3.0", "file", "p/q/r"), "p/q/r/c.txt": ("GPL-3.0", "inherited", "p/q/r"),
        "p/q/r/s/d.txt": ("GPL-3.0", "inherited", "p/q/r"), "p/e.txt": ("Apache-2.0", "header", None),
        "other/f.txt": (None, "none", None), "pq/g.txt": (None, "none", None), "h.txt": (None, "none", None),
        None: (None, "none", None), "p/i.txt": ("LicenseRef-Reserved", "header", None),
    }


def test_licence_files_and_notices_inside_lines(spark):
    """Real licence files speak for the files below them, and a notice counts within a long line or paragraph."""
    folder = Path(__file__).parent / "license_files"
    real = {f.stem: f.read_text() for f in folder.glob("*.txt")}
    full = dict(licenses.full_texts())
    real |= {x: full[x] for x in ("AGPL-3.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0")}
    files = [row for x, t in real.items() for row in ((f"{x}/LICENSE", t), (f"{x}/src/a.txt", "plain text here"))]
    rest = " ".join(f"w{i}" for i in range(200))
    files += [
        ("in/a.txt", f"{rest} Released under the MIT License. {rest}"),
        ("in/b.txt", f"/* {rest}\n * {rest} Licensed under the Apache License, Version 2.0. {rest}\n * {rest} */"),
        ("in/c.txt", f"{rest}\n\n{real['MIT']}\n\n{rest} {rest}"), ("in/d.txt", rest), ("in/e.txt", rest + " the License of this work"),
    ]
    found = licenses.scan_licenses(spark.createDataFrame(files, "path string, text string").repartition(3))
    got = {r["path"]: (r["license"], r["origin"], r["license_directory"]) for r in found.collect()}
    expected = {f"{x}/LICENSE": (x, "file", x) for x in real} | {f"{x}/src/a.txt": (x, "inherited", x) for x in real}
    assert got == expected | {
        "in/a.txt": ("MIT", "header", None), "in/b.txt": ("Apache-2.0", "header", None), "in/c.txt": ("MIT", "header", None),
        "in/d.txt": (None, "none", None), "in/e.txt": (None, "none", None)}


def test_licence_weights_count_all_terms(spark):
    """Scores use the document frequencies of words of no template too."""
    import math

    files = [("a", "Licensed under the MIT license by common rarely")] + [(f"f{i}", "common words of the files") for i in range(50)]
    found = licenses.scan_licenses(
        spark.createDataFrame(files, "path string, text string"), threshold=0.1, templates=(("none", "zzz"),),
        full=(("MIT", "the MIT license"),)).filter("path = 'a'").first()

    def weight(n):
        return 1 + math.log(52 / (1 + n))

    square = weight(51) ** 2 + 2 * weight(1) ** 2  # the; mit, license
    other = weight(51) ** 2 + 4 * weight(1) ** 2  # common; licensed, under, by, rarely
    assert found["origin"] == "file"
    assert found["score"] == pytest.approx(math.sqrt(square / (square + other)))


def test_licence_cosines(texts):
    """The vectors give the same cosines as plain dictionaries."""
    import math
    import re

    known = licenses.Templates()
    some = [*[t for _, t in licenses.TEMPLATES], *[(t or "")[:400].replace("\n", " ") for _, t in texts[:40]]]
    terms = licenses.Terms(licenses._chunk_of(some))
    n = known.document_counts(terms)
    idf = licenses.inverse_frequencies(n, len(some))
    units, _, cosine = known.cosines(terms.doc, terms.key, idf)

    def bag(text):
        w = [re.sub(r"^[\x00-/:-@\[-`{-\x7f]+|[\x00-/:-@\[-`{-\x7f]+$", "", x.translate(brute.LOWER)) for x in brute.words(text)]
        return Counter(x for x in w if x)

    bags, vocabulary = [bag(t) for t in some], {w for _, t in licenses.TEMPLATES for w in bag(t)}
    weight = {w: 1 + math.log((1 + len(some)) / (1 + sum(w in b for b in bags))) for w in vocabulary}
    rare = max(weight.values())
    vectors = [{w: c * weight.get(w, rare) for w, c in b.items()} for b in bags]

    def cos(a, b):
        return sum(v * b.get(w, 0) for w, v in a.items()) / math.sqrt(
            sum(v * v for v in a.values()) * sum(v * v for v in b.values()))

    best = {int(u): c for u, c in zip(units, cosine)}
    for i, v in enumerate(vectors):
        expected = max((cos(v, t) for t in vectors[:len(licenses.TEMPLATES)]), default=0) if v else 0
        assert best.get(i, 0) == pytest.approx(expected, abs=1e-9)


def encoded(rows):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(default_vocabulary())
    return {i: tokenizer.encode(t or "", add_special_tokens=False).ids + [0] for i, t in rows}


def numbers(raw):
    return list(struct.unpack(f"<{len(raw) // 4}I", raw))


def test_bounded_packing(spark, texts):
    rows = [*texts, (9001, LONG), (9002, None), (9003, "")]
    pieces = packing.pack_bounded(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    whole, places = defaultdict(list), defaultdict(list)
    for r in sorted(pieces, key=lambda r: (r["doc_id"], r["piece"])):
        assert r["start"] == len(whole[r["doc_id"]])
        whole[r["doc_id"]] += numbers(r["ids"])
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    assert dict(whole) == encoded(rows)
    for at in places.values():
        end = 0
        for offset, length in sorted(at):
            assert offset == end
            end += length
        assert end <= 2048


def test_decreasing_packing(spark, texts):
    rows = [*texts, (9001, LONG), (9002, None)]
    found = packing.pack_decreasing(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    whole = defaultdict(dict)
    for r in found:
        ids, at = numbers(r["ids"]), r["cu_seqlens"]
        assert len(ids) == 2048 and at[0] == 0 and at[-1] == r["n_tokens"] and not any(ids[at[-1]:])
        for piece, lo, hi, start in zip(r["pieces"], at, at[1:], r["positions_reset"]):
            assert hi - lo == piece["length"] and start == piece["start"]
            whole[piece["doc"]][piece["piece"]] = ids[lo:hi]
    assert {i: [x for p in sorted(v) for x in v[p]] for i, v in whole.items()} == encoded(rows)


def test_shards_move_only_into_a_new_one():
    keys = np.random.RandomState(1).randint(0, 2**63, 20_000).astype(np.uint64)
    before, after = sharding.jump_hash(keys, 8), sharding.jump_hash(keys, 9)
    moved = before != after
    assert set(after[moved]) == {8} and 0.09 < moved.mean() < 0.13
