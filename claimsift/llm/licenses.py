"""Operator 2: licences of files, from notices in them, licence files and the directories above.

Lines, paragraphs, runs of words as long as a notice, and whole texts become sparse TF-IDF vectors, with the document
frequencies of all terms counted over all files, and are compared by cosine with notices, whole texts also with full
licence texts. A file that is nothing but a licence speaks for its directory, and a file without a notice of its own
takes the licence of the nearest directory above it that has such a file, found by joining paths.

No task needs the frequencies of all terms: a term weighs at least 1 and at most as much as one of a single file, which
bounds each cosine. Only units that may reach the threshold are written out, and the weights of their other terms joined.
"""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructField, StructType

from claimsift.llm.common import ready, signed, staged
from claimsift.llm.words import Chunk, chunks, flat_ranges, span_hashes

#: Notices by which works state their licence, with the licence's public identifier.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License. See LICENSE in the project root for license information."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                "option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                     "that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("LicenseRef-Reserved", "All rights reserved."),
)
#: A notice counts from this cosine on.
THRESHOLD = 0.75
#: Terms of word runs that are compared at a time.
BLOCK_TERMS = 400_000


def full_texts() -> tuple[tuple[str, str], ...]:
    """Full licence texts with their identifiers. Only the driver reads them; executors get their vectors."""
    folder = Path(__file__).parent / "license_texts"
    return tuple((file.stem, file.read_text("utf-8")) for file in sorted(folder.glob("*.txt")))

_WORD_BYTE = np.zeros(256, bool)
_WORD_BYTE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Terms:
    """The terms of a chunk: its words in lower case without punctuation at either end, and where they stand."""

    def __init__(self, chunk: Chunk) -> None:
        inside = np.flatnonzero(_WORD_BYTE[chunk.data])
        first, after = np.searchsorted(inside, chunk.starts), np.searchsorted(inside, chunk.ends)
        some = after > first
        start, end = inside[first[some]], inside[after[some] - 1] + 1
        self.key = span_hashes(_LOWER[chunk.data], start, end)
        self.doc = chunk.doc[some]
        newline = np.flatnonzero(chunk.data == 10)
        # Lines are told apart by the line ends and documents before them. A paragraph ends with an empty line.
        blank = newline[1:][_nothing_between(chunk.data, newline)]
        self.line = np.searchsorted(newline, start) + self.doc
        self.paragraph = np.searchsorted(blank, start) + self.doc


def _nothing_between(data: np.ndarray, newline: np.ndarray) -> np.ndarray:
    visible = np.concatenate([[0], np.cumsum(data > 32)])
    return visible[newline[1:]] == visible[newline[:-1]] if len(newline) > 1 else np.zeros(0, bool)


def _chunk_of(texts: list[str]) -> Chunk:
    (chunk,) = chunks(pa.array(texts), 1 << 30)
    return chunk


class Templates:
    """Templates as sparse vectors over the terms that occur in any of them."""

    def __init__(self, templates=TEMPLATES) -> None:
        self.names = [name for name, _ in templates]
        terms = Terms(_chunk_of([text for _, text in templates]))
        self.vocabulary, at = np.unique(terms.key, return_inverse=True)
        self.counts = np.zeros((len(templates), len(self.vocabulary)))
        np.add.at(self.counts, (terms.doc, at), 1)

    def place(self, keys: np.ndarray) -> np.ndarray:
        """Index in the vocabulary, or its length for a term of no template."""
        at = np.searchsorted(self.vocabulary, keys)
        held = self.vocabulary[np.minimum(at, len(self.vocabulary) - 1)] == keys
        return np.where(held, at, len(self.vocabulary))

    def document_counts(self, terms: Terms) -> np.ndarray:
        """In how many documents each term of the vocabulary occurs."""
        at = self.place(terms.key)
        known = at < len(self.vocabulary)
        pairs = np.unique(np.stack([terms.doc[known], at[known]]), axis=1)
        return np.bincount(pairs[1], minlength=len(self.vocabulary))

    def rows(self, idf: np.ndarray) -> np.ndarray:
        """The templates as vectors of length 1."""
        rows = self.counts * idf[:len(self.vocabulary)]
        return rows / np.sqrt((rows**2).sum(axis=1, keepdims=True))

    def products(self, unit: np.ndarray, keys: np.ndarray, idf: np.ndarray) -> Units:
        """Units with a term of a template, and their dot products with the templates."""
        at = self.place(keys)
        # A unit without any template term has cosine 0 with all.
        units = np.unique(unit[at < len(self.vocabulary)])
        of = np.searchsorted(units, unit)
        mine = (of < len(units)) & (units[np.minimum(of, max(0, len(units) - 1))] == unit) if len(units) else np.zeros(
            len(unit), bool)
        of, at, keys = of[mine], at[mine], keys[mine]
        order = np.lexsort((keys, of))
        of, at, keys = of[order], at[order], keys[order]
        edge = np.flatnonzero(np.concatenate([[True], (of[1:] != of[:-1]) | (keys[1:] != keys[:-1])])) if len(of) else of
        times = np.diff(np.append(edge, len(of))).astype(float)
        of, at, keys = of[edge], at[edge], keys[edge]
        known = at < len(self.vocabulary)
        weight = times[known] * idf[at[known]]
        dots = np.stack([np.bincount(of[known], weight * row[at[known]], minlength=len(units)) for row in self.rows(idf)], axis=1)
        best = dots.argmax(axis=1) if len(units) else np.zeros(0, np.int64)
        return Units(units, best, dots[np.arange(len(units)), best], np.bincount(of[known], weight**2, minlength=len(units)),
                     of[~known], keys[~known], times[~known])

    def cosines(self, unit: np.ndarray, keys: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Units with their best template and its cosine. The last entry of ``idf`` is for terms of no template."""
        found = self.products(unit, keys, idf)
        return found.unit, found.template, found.cosine(idf[-1])

    def runs(self, terms: Terms, idf: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Runs of words as long as a template that may reach the threshold with it, as first terms and lengths.

        A run's dot product is a difference of running sums. Its norm is at least that of its terms taken one by one,
        with weight 1 for those of no template.
        """
        at = self.place(terms.key)
        energy = np.concatenate([[0], np.cumsum(np.append(idf[:len(self.vocabulary)] ** 2, 1.0)[at])])
        for row, size in zip(self.rows(idf), self.counts.sum(axis=1).astype(int).tolist()):
            if size > len(at):
                continue
            gain = np.concatenate([[0], np.cumsum(np.append(row * idf[:len(self.vocabulary)], 0.0)[at])])
            near = gain[size:] - gain[:-size] >= (threshold - 1e-6) * np.sqrt(energy[size:] - energy[:-size])
            first = np.flatnonzero(near & (terms.doc[size - 1:] == terms.doc[:len(terms.doc) - size + 1]))
            for lo in range(0, len(first), max(1, BLOCK_TERMS // size)):
                some = first[lo:lo + max(1, BLOCK_TERMS // size)]
                yield some, np.full(len(some), size)


class Units:
    """Parts of texts with their best template, the dot product with it and the square of their norm, as far as it comes
    from terms of templates; their other terms are listed with the index of the unit and their number in it."""

    def __init__(self, unit, template, dot, square, of, keys, times) -> None:
        self.unit, self.template, self.dot, self.square = unit, template, dot, square
        self.of, self.keys, self.times = of, keys, times

    def cosine(self, weight: float) -> np.ndarray:
        """The cosines if each other term had this weight."""
        other = np.bincount(self.of, self.times**2, minlength=len(self.unit))
        return self.dot / np.sqrt(self.square + weight**2 * other)

    def folded(self, weight: float) -> Units:
        """With this weight for the other terms, none of which stay listed."""
        other = np.bincount(self.of, self.times**2, minlength=len(self.unit))
        return Units(self.unit, self.template, self.dot, self.square + weight**2 * other, *[x[:0] for x in (
            self.of, self.keys, self.times)])

    def only(self, which: np.ndarray) -> Units:
        keep = which[self.of]
        return Units(self.unit[which], self.template[which], self.dot[which], self.square[which],
                     (np.cumsum(which) - 1)[self.of[keep]], self.keys[keep], self.times[keep])

    @staticmethod
    def joined(some: list[Units]) -> Units:
        before = np.cumsum([0, *[len(u.unit) for u in some]])
        of = np.concatenate([u.of + n for u, n in zip(some, before)])
        return Units(*[np.concatenate([getattr(u, name) for u in some]) for name in ("unit", "template", "dot", "square")],
                     of, *[np.concatenate([getattr(u, name) for u in some]) for name in ("keys", "times")])

    def contenders(self, doc: np.ndarray, threshold: float, most: float) -> np.ndarray:
        """Which units may be the best of their document: they may reach the threshold and what is sure of another."""
        if not len(self.unit):
            return np.zeros(0, bool)
        upper, lower = self.cosine(1.0), self.cosine(most)
        order = np.lexsort((-lower, doc))
        first = np.concatenate([[True], doc[order][1:] != doc[order][:-1]])
        surest = np.zeros(len(doc), bool)
        surest[order[first]] = True
        sure = np.empty(len(doc))
        sure[order] = lower[order[first]][np.cumsum(first) - 1]
        return (upper >= threshold - 1e-9) & (surest | (upper > sure))


def inverse_frequencies(counts: np.ndarray, documents: int) -> np.ndarray:
    """``1 + ln((1 + documents) / (1 + count))`` per term; terms of no template weigh as much as the rarest of one."""
    idf = 1 + np.log((1 + documents) / (1 + counts))
    return np.append(idf, idf.max())


def frequencies(files: DataFrame, text: str) -> DataFrame:
    """``term, n``: in how many files each term occurs; the null term has the number of files."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        documents = 0
        for batch in batches:
            documents += batch.num_rows
            for chunk in chunks(batch.column(0)):
                terms = Terms(chunk)
                order = np.argsort(terms.key, kind="stable")  # documents stay in order
                key, doc = terms.key[order], terms.doc[order]
                new = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.zeros(0, bool)
                other = np.concatenate([[True], doc[1:] != doc[:-1]]) if len(key) else new
                edge = np.flatnonzero(new)
                n = np.add.reduceat((new | other).astype(np.int64), edge) if len(edge) else edge
                yield pa.RecordBatch.from_arrays([pa.array(signed(key[edge])), pa.array(n)], ["term", "n"])
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([documents])], ["term", "n"])

    rows = files.select(F.col(text).cast("string")).mapInArrow(run, "term long, n long")
    return rows.groupBy("term").agg(F.sum("n").alias("n"))


def weights(counted: DataFrame, templates: list[Templates]) -> tuple[list[np.ndarray], int]:
    """Weights of the templates' terms, and the number of files. One number per term of the templates reaches the driver."""
    counts = {r["term"]: r["n"] for r in counted.filter("listed").select("term", "n").collect()}
    documents = counted.filter("term IS NULL").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return [inverse_frequencies(np.array([counts.get(k, 0) for k in signed(t.vocabulary).tolist()]), documents)
            for t in templates], documents


CANDIDATE = pa.struct([("whole", pa.bool_()), ("license", pa.string()), ("dot", pa.float64()), ("square", pa.float64()),
                       ("terms", pa.list_(pa.int64())), ("times", pa.list_(pa.float64()))])


def candidates(files: DataFrame, path: str, text: str, notices: Templates, texts: Templates, idf: list[np.ndarray],
               documents: int, threshold: float, keep: tuple[str, ...] = ()) -> DataFrame:
    """``row, path, candidates``: each file, numbered, with the parts of its text that may decide on its licence. The
    columns of ``keep`` come along as ``keep_0`` and so on."""
    most = 1 + float(np.log((1 + documents) / 2))

    def found(chunk: Chunk) -> pa.Array:
        terms = Terms(chunk)
        best: list[tuple[bool, np.ndarray, np.ndarray, Units]] = []

        def add(whole: bool, templates: Templates, unit: np.ndarray, doc: np.ndarray, units: Units) -> None:
            where = np.unique(unit, return_index=True)
            of = doc[where[1]][np.searchsorted(where[0], units.unit)]
            keep = units.contenders(of, threshold, most)
            if keep.any():
                best.append((whole, of[keep], np.array(templates.names, object), units.only(keep)))

        add(True, texts, terms.doc, terms.doc, texts.products(terms.doc, terms.key, idf[1]))
        whole = notices.products(terms.doc, terms.key, idf[0])
        # A text is nothing but a notice if it has no other words, however common: all weigh as much as the rarest.
        add(True, notices, terms.doc, terms.doc, whole.folded(idf[0][-1]))
        add(False, notices, terms.doc, terms.doc, whole)
        for unit in (terms.paragraph, terms.line):
            add(False, notices, unit, terms.doc, notices.products(unit, terms.key, idf[0]))
        for first, size in notices.runs(terms, idf[0], threshold):
            at, unit = flat_ranges(first, size), np.repeat(np.arange(len(first)), size)
            add(False, notices, unit, terms.doc[at], notices.products(unit, terms.key[at], idf[0]))
        lists: list[list[dict]] = [[] for _ in chunk.rows]
        for kind in (True, False):
            some = [b for b in best if b[0] == kind]
            if not some:
                continue
            doc, units = np.concatenate([b[1] for b in some]), Units.joined([b[3] for b in some])
            name = np.concatenate([b[2][b[3].template] for b in some])
            keep = units.contenders(doc, threshold, most)
            doc, name, units = doc[keep], name[keep], units.only(keep)
            bounds = np.searchsorted(units.of, np.arange(len(doc) + 1))
            keys = signed(units.keys)
            for i, d in enumerate(doc.tolist()):
                lists[d].append({
                    "whole": kind, "license": name[i], "dot": units.dot[i], "square": units.square[i],
                    "terms": keys[bounds[i]:bounds[i + 1]], "times": units.times[bounds[i]:bounds[i + 1]]})
        return pa.array(lists, pa.list_(CANDIDATE))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                n = len(chunk.rows)
                same = [batch.column(i).slice(chunk.rows[0], n) for i in (0, *range(2, batch.num_columns))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(row, row + n)), found(chunk), *same], ["row", "candidates", "path", *kept])
                row += n

    kept = [f"keep_{i}" for i in range(len(keep))]
    rows = files.select(F.col(path).cast("string").alias("path"), F.col(text).cast("string").alias("text"),
                        *[F.col(c).alias(k) for c, k in zip(keep, kept)])
    struct = "array<struct<whole:boolean,license:string,dot:double,square:double,terms:array<long>,times:array<double>>>"
    schema = StructType([*StructType.fromDDL(f"row long, candidates {struct}, path string").fields,
                         *[StructField(k, rows.schema[k].dataType) for k in kept]])
    return rows.mapInArrow(run, schema)


def decided(found: DataFrame, counted: DataFrame, documents: int, threshold: float) -> DataFrame:
    """``path, license, score, is_license_file`` and what was kept: what the texts themselves say; no licence below the
    threshold."""
    each = found.select("row", F.posexplode("candidates").alias("unit", "c")).select("row", "unit", "c.*")
    terms = each.select("row", "unit", F.explode(F.arrays_zip("terms", "times")).alias("t")).select("row", "unit", "t.*")
    # A term that is not listed occurs in the one file only.
    weight = 1 + F.log((1 + documents) / (1 + F.coalesce("n", F.lit(1))))
    other = terms.join(counted, terms["terms"] == counted["term"], "left").groupBy("row", "unit").agg(
        F.sum(F.pow(F.col("times") * weight, 2)).alias("other"))
    judged = each.join(other, ["row", "unit"], "left").withColumn(
        "score", F.col("dot") / F.sqrt(F.col("square") + F.coalesce("other", F.lit(0.0)))).filter(F.col("score") >= threshold)
    # A text that is a licence as a whole comes first, then the best, then the first of equals.
    best = judged.groupBy("row").agg(F.min_by(
        F.struct("license", F.least("score", F.lit(1.0)).alias("score"), "whole"),
        F.struct(~F.col("whole"), -F.col("score"), "unit")).alias("best"))
    kept = [c for c in found.columns if c not in ("row", "candidates")]
    return found.select("row", *kept).join(best, "row", "left").select(
        *kept, "best.license", F.coalesce("best.score", F.lit(0.0)).alias("score"),
        F.coalesce("best.whole", F.lit(False)).alias("is_license_file"))


def directory(path: Column) -> Column:
    """The directory of a path, empty at the top; null for null."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def scan_licenses(files: DataFrame, path: str = "path", text: str = "text", threshold: float = THRESHOLD,
                  templates=TEMPLATES, full=None, keep: tuple[str, ...] = ()) -> DataFrame:
    """``path, license, score, origin, license_directory`` for each row of ``files``, after its columns of ``keep``.

    ``origin`` is ``file`` for a text that as a whole is a licence, by a notice of ``templates`` or a full text of ``full``
    (those of the package if None), ``header`` for a text with a notice in some line, paragraph or run of words, ``inherited`` for a text without one below a directory (its own first) that holds a licence file, else
    ``none`` with a null licence. Of several notices in a text the best match counts, of several licence files in a
    directory the best, then the smallest name. Null, empty and blank texts have no notice, but inherit. A null path
    is in no directory. Texts are compared as a whole, whatever their length; repeated rows get equal answers; an empty
    table gives no rows. Columns not in ``keep`` are ignored, whatever their names.
    """
    ready(files.sparkSession)
    notices, texts = Templates(templates), Templates(full_texts() if full is None else full)
    vocabulary = np.unique(np.concatenate([notices.vocabulary, texts.vocabulary]))
    listed = files.sparkSession.createDataFrame(pa.table({"term": signed(vocabulary)})).withColumn("listed", F.lit(True))
    # A term of one file need not be kept.
    counted = staged(frequencies(files, text).join(listed, "term", "left").filter("term IS NULL OR n > 1 OR listed"), "terms")
    idf, documents = weights(counted, [notices, texts])
    found = staged(candidates(files, path, text, notices, texts, idf, documents, threshold, keep), "candidates")
    own = staged(decided(found, counted.filter("term IS NOT NULL"), documents, threshold).withColumn(
        "directory", directory(F.col("path"))), "notices")
    # One row per directory with a licence file, and per directory that lacks something.
    holders = own.filter("is_license_file AND directory IS NOT NULL").groupBy("directory").agg(
        F.min(F.struct((-F.col("score")).alias("order"), "license", "score")).alias("best")).select(
        F.col("directory").alias("license_directory"), F.col("best.license").alias("found"), F.col("best.score").alias("cosine"))
    asking = own.filter("license IS NULL AND directory IS NOT NULL").select("directory").distinct()
    steps = F.split("directory", "/")
    above = asking.select("directory", F.explode(F.sequence(F.lit(0), F.size(steps))).alias("depth")).select(
        "directory", "depth", F.array_join(F.slice(F.split("directory", "/"), F.lit(1), F.col("depth")), "/").alias(
            "license_directory"))
    nearest = above.join(holders, "license_directory").groupBy("directory").agg(
        F.max_by(F.struct("license_directory", "found", "cosine"), "depth").alias("near"))
    joined = own.join(nearest, "directory", "left")
    inherited = F.col("license").isNull() & F.col("near").isNotNull()
    origin = (F.when(F.col("is_license_file"), "file").when(F.col("license").isNotNull(), "header")
              .when(inherited, "inherited").otherwise("none"))
    return joined.select(
        *[F.col(f"keep_{i}").alias(c) for i, c in enumerate(keep)], "path", F.coalesce("license", "near.found").alias("license"),
        F.when(inherited, F.col("near.cosine")).otherwise(F.col("score")).alias("score"), origin.alias("origin"),
        F.when(inherited, F.col("near.license_directory")).when(F.col("is_license_file"), F.col("directory")).alias(
            "license_directory"))
