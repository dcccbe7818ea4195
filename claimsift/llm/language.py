"""Operator 4: the language of texts by a linear-chain conditional random field over words.

A word's features are its byte n-grams with its ends marked (so that affixes are features of their own), and the language
for which the lexicon of the training sample has it. Weights of features and of transitions between languages are learned
together from word sequences, some of which switch language in the middle. Forward-backward then gives every word of a
text, of any length, the probability of each language; a document's language is the one with the largest sum.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from claimsift.llm.common import U64, lean, ready, staged
from claimsift.llm.words import Chunk, chunks, flat_ranges, mix, span_hashes

UNKNOWN = "und"
BUCKETS = 1 << 16
GRAMS = (1, 2, 3, 4)
BLOCK = 64
#: Least documents and sequences that a language is learned from, where it has them.
LEAST = 40
#: Numbers per array, about, in work that grows with the languages.
CELLS = 2_000_000
#: Bytes of text labelled at a time with up to eight languages, fewer with more: the arrays take some hundred times as much.
LABELLED_BYTES = 400_000


@dataclass(frozen=True)
class Training:
    """Bounds of what is learned from: documents per language, characters of each, word sequences per language.

    Every language is learned. With more than ``languages`` of them, documents and sequences per language go down in
    proportion, to ``LEAST`` at the lowest.
    """

    documents: int = 400
    characters: int = 2_000
    languages: int = 64
    sequences: int = 1_500
    length: int = 24
    epochs: int = 5
    seed: int = 11

    def per_language(self, most: int, languages: int) -> int:
        """``most`` up to the stated number of languages, less beyond."""
        return min(most, max(LEAST, most * self.languages // max(1, languages)))


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # by bucket and language
    lexicon: np.ndarray  # sorted hashes of words
    lexicon_language: np.ndarray
    lexicon_weight: np.ndarray  # by the lexicon's language and language
    transitions: np.ndarray


def lowered(data: np.ndarray) -> np.ndarray:
    """Bytes of a text with the Latin letters of one or two bytes in lower case."""
    out = data.copy()
    out[(data >= 65) & (data <= 90)] += 32
    after = np.flatnonzero(data[:-1] == 0xC3) + 1
    after = after[(data[after] >= 0x80) & (data[after] <= 0x9E) & (data[after] != 0x97)]
    out[after] += 0x20
    return out


class Vocabulary:
    """The distinct words of a chunk and their n-gram buckets."""

    def __init__(self, chunk: Chunk) -> None:
        data = lowered(chunk.data)
        self.hashes, first, self.of = np.unique(span_hashes(data, chunk.starts, chunk.ends), return_index=True,
                                                return_inverse=True)
        start, length = chunk.starts[first], chunk.ends[first] - chunk.starts[first]
        begin = np.cumsum(length + 2) - (length + 2)
        self.size = length + 2  # with a mark before and after
        text = np.full(int(self.size.sum()), 0x5E, np.uint8)
        text[flat_ranges(begin + 1, length)] = data[flat_ranges(start, length)]
        owner = np.repeat(np.arange(len(first)), self.size)
        self.buckets, self.owner = [], []
        code = np.zeros(len(text), U64)
        for n in range(1, max(GRAMS) + 1):
            code = code[:len(text) - n + 1] * U64(257) + text[n - 1:].astype(U64)
            if n in GRAMS:
                inside = owner[:len(code)] == owner[n - 1:]
                self.buckets.append((mix(code[inside] * U64(8) + U64(n)) & U64(BUCKETS - 1)).astype(np.int64))
                self.owner.append(owner[:len(code)][inside])
        self.buckets, self.owner = np.concatenate(self.buckets), np.concatenate(self.owner)
        order = np.argsort(self.owner, kind="stable")
        self.buckets, self.owner = self.buckets[order], self.owner[order]
        self.scale = 1 / np.sqrt(np.bincount(self.owner, minlength=len(first)).clip(1))
        ascii_letter = ((text | 32) >= 97) & ((text | 32) <= 122)
        self.lettered = np.bincount(owner[ascii_letter], minlength=len(first)) > 0
        wide = np.bincount(owner[text >= 0x80], minlength=len(first)) > 0
        for i in np.flatnonzero(wide & ~self.lettered).tolist():
            self.lettered[i] = any(c.isalpha() for c in text[begin[i]:begin[i] + self.size[i]].tobytes().decode())

    def scores(self, model: Model) -> np.ndarray:
        """Score of each word for each language."""
        out = np.zeros((len(self.hashes), len(model.languages)))
        if len(self.owner):
            edge = np.flatnonzero(np.concatenate([[True], self.owner[1:] != self.owner[:-1]]))
            ends = np.append(edge[1:], len(self.owner))
            step = max(1, CELLS // (16 * len(model.languages)))
            for lo in range(0, len(edge), step):
                some = edge[lo:lo + step]
                part = self.buckets[some[0]:ends[lo:lo + step][-1]]
                out[self.owner[some]] = np.add.reduceat(model.weights[part], some - some[0], axis=0)
        out *= self.scale[:, None]
        known = self.listed(model.lexicon, model.lexicon_language)
        out[known >= 0] += model.lexicon_weight[known[known >= 0]]
        out[~self.lettered] = 0
        return out

    def listed(self, lexicon: np.ndarray, language: np.ndarray) -> np.ndarray:
        """The lexicon's language of each word, -1 if it has none."""
        if not len(lexicon):
            return np.full(len(self.hashes), -1)
        at = np.minimum(np.searchsorted(lexicon, self.hashes), len(lexicon) - 1)
        return np.where(lexicon[at] == self.hashes, language[at], -1)


def _unit(x: np.ndarray, axis: int = -1) -> np.ndarray:
    return x / x.sum(axis=axis, keepdims=True)


def posteriors(scores: np.ndarray, counts: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Probability of each language for each word, by forward-backward over whole documents of ``counts`` words.

    Some documents at a time, so that the memory follows the words and languages, however short the documents.
    """
    n, states = scores.shape
    block = max(BLOCK, states)  # a block's matrix is no larger than what its words need
    total, ends = np.cumsum(-(-counts // block)), np.cumsum(counts)
    most, lo, out = max(1, CELLS // (block * states)), 0, []
    while lo < len(counts):
        before = total[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(total, before + most, "right")))
        part = counts[lo:hi]
        out.append(_posteriors(scores[ends[lo] - counts[lo]:ends[hi - 1]], part, transitions, block))
        lo = hi
    return np.concatenate(out) if len(out) > 1 else out[0] if out else scores


def _posteriors(scores: np.ndarray, counts: np.ndarray, transitions: np.ndarray, block: int) -> np.ndarray:
    """Posteriors of some documents. Documents are cut into blocks that advance together. A block's product of steps is a small matrix, so one pass over
    the blocks of a document gives what reaches each block from either side; the result is that of one long pass.
    """
    n, states = scores.shape
    if not n:
        return scores
    step = np.exp(transitions - transitions.max())
    local = np.exp(scores - scores.max(axis=1, keepdims=True))
    per = -(-counts // block)
    block_doc = np.repeat(np.arange(len(counts)), per)
    within = np.arange(int(per.sum())) - np.repeat(np.cumsum(per) - per, per)
    first = (np.cumsum(counts) - counts)[block_doc] + within * block
    size = np.minimum(block, counts[block_doc] - within * block)
    at = first[:, None] + np.arange(block)
    real = np.arange(block) < size[:, None]
    seen = local[np.minimum(at, n - 1)]

    # Documents of a single block need no products.
    many = np.flatnonzero((per > 1)[block_doc])
    place = np.full(len(first), -1)
    place[many] = np.arange(len(many))
    product = np.broadcast_to(np.eye(states), (len(many), states, states)).copy()
    for t in range(block if len(many) else 0):
        new = (product @ step) * seen[many, t, None, :]
        new /= new.sum(axis=(1, 2), keepdims=True)
        product = np.where(real[many, t, None, None], new, product)
    enter = np.full((len(first), states), 1 / states)
    leave = np.ones((len(first), states))
    order = np.argsort(within, kind="stable")  # all first blocks, then all second ones
    groups = np.split(order, np.cumsum(np.bincount(within))[:-1])
    for g in groups[1:]:
        enter[g] = _unit((enter[g - 1][:, None, :] @ product[place[g - 1]])[:, 0])
    for g in reversed(groups[1:]):
        leave[g - 1] = _unit((product[place[g]] @ leave[g][:, :, None])[:, :, 0])

    forward = np.empty((block, len(first), states))
    for t in range(block):
        enter = _unit((enter @ step) * seen[:, t])
        forward[t] = enter
    for t in reversed(range(block)):
        forward[t] *= leave
        leave = np.where(real[:, t, None], _unit((seen[:, t] * leave) @ step.T), leave)
    return _unit(forward.transpose(1, 0, 2)[real])


def fit(texts: list[str], labels: list[str], training: Training = Training()) -> Model | None:
    """Learns from whole given texts, on the driver; None without a word of a labelled text."""
    languages = sorted(set(labels))
    (chunk,) = list(chunks(pa.array(texts, pa.string()), 2**62)) or [None]
    if chunk is None or not len(chunk.doc):
        return None
    words = Vocabulary(chunk)
    number = {x: i for i, x in enumerate(languages)}
    label = np.array([number[x] for x in labels])[chunk.doc]
    states, rng = len(languages), np.random.RandomState(training.seed)
    pair, n = np.unique(words.of * states + label, return_counts=True)
    total = np.bincount(pair // states, n, minlength=len(words.hashes))
    order = np.lexsort((pair, -n, pair // states))
    top = order[np.searchsorted(pair[order] // states, np.arange(len(words.hashes)))]  # the first of equals
    most = pair[top] % states
    typical = (total >= 3) & (n[top] >= 0.8 * total) & words.lettered
    model = Model(languages, np.zeros((BUCKETS, states)), words.hashes[typical], most[typical],
                  np.zeros((states, states)), np.zeros((states, states)))
    listed = np.where(typical, most, -1)
    streams = [np.flatnonzero(label == s) for s in range(states)]
    present = [s for s in range(states) if len(streams[s])]
    sequences, target = [], []
    for _ in range(training.per_language(training.sequences, len(present))):
        for s in present:
            other = s if rng.rand() < 0.7 else present[rng.randint(len(present))]
            cut = rng.randint(1, training.length)
            take = lambda stream, k: stream[(rng.randint(len(stream)) + np.arange(k)) % len(stream)]
            sequences.append(np.concatenate([take(streams[s], cut), take(streams[other], training.length - cut)]))
            target.append([s] * cut + [other] * (training.length - cut))
    sequences, target = words.of[np.array(sequences)], np.array(target)
    starts = np.searchsorted(words.owner, np.arange(len(words.hashes) + 1))
    squares = [np.full_like(x, 1e-8) for x in (model.weights, model.lexicon_weight, model.transitions)]

    def learn(i: int, array: np.ndarray, gradient: np.ndarray, rate: float, rows=slice(None)) -> None:
        squares[i][rows] += gradient**2
        array[rows] -= rate * gradient / np.sqrt(squares[i][rows])

    for _ in range(training.epochs):
        for some in np.array_split(rng.permutation(len(sequences)), max(1, len(sequences) // 250)):
            used, place = np.unique(sequences[some], return_inverse=True)
            place = place.reshape(len(some), -1)
            span = starts[used + 1] - starts[used]
            flat, owner = words.buckets[flat_ranges(starts[used], span)], np.repeat(np.arange(len(used)), span)
            scores = np.zeros((len(used), states))
            np.add.at(scores, owner, model.weights[flat])
            scores *= words.scale[used][:, None]
            # Words outside the sample have no entry, so half of the entries are hidden at a time.
            hint = np.where(rng.rand(len(used)) < 0.5, listed[used], -1)
            scores[hint >= 0] += model.lexicon_weight[hint[hint >= 0]]
            scores[~words.lettered[used]] = 0
            counts = np.full(len(some), training.length)
            wrong = posteriors(scores[place.ravel()], counts, model.transitions).reshape(*place.shape, states)
            pairs = _pair_gradient(scores[place], model.transitions, target[some])
            np.put_along_axis(wrong, target[some][:, :, None], np.take_along_axis(wrong, target[some][:, :, None], 2) - 1, 2)
            gradient = np.zeros((len(used), states))
            np.add.at(gradient, place.ravel(), wrong.reshape(-1, states))
            gradient[~words.lettered[used]] = 0
            # Buckets that do not occur have no gradient.
            rows, of_row = np.unique(flat, return_inverse=True)
            full = np.zeros((len(rows), states))
            np.add.at(full, of_row, (gradient * words.scale[used][:, None])[owner])
            hints = np.zeros_like(model.lexicon_weight)
            np.add.at(hints, hint[hint >= 0], gradient[hint >= 0])
            learn(0, model.weights, full, 0.2, rows)
            learn(1, model.lexicon_weight, hints, 0.2)
            learn(2, model.transitions, pairs, 0.2)
    return model


def _pair_gradient(scores: np.ndarray, transitions: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Expected less observed transitions of equally long sequences."""
    step, local = np.exp(transitions), np.exp(scores - scores.max(axis=2, keepdims=True))
    length, states = scores.shape[1:]
    ahead = [np.ones((len(scores), states))]
    for t in range(length - 1, 0, -1):
        ahead.append(_unit((local[:, t] * ahead[-1]) @ step.T))
    ahead.reverse()
    behind, expected = _unit(local[:, 0]), np.zeros((states, states))
    for t in range(1, length):
        after = local[:, t] * ahead[t]
        whole = ((behind @ step) * after).sum(axis=1, keepdims=True)
        expected += step * ((behind / whole).T @ after)
        behind = _unit((behind @ step) * local[:, t])
    np.subtract.at(expected, (target[:, :-1].ravel(), target[:, 1:].ravel()), 1)
    return expected


def held_out(doc_id: Column) -> Column:
    """Documents that nothing is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_sample(docs: DataFrame, doc_id: str, text: str, lang: str, training: Training) -> list[tuple[str, str]]:
    """A bounded sample: equally many documents of each language, as far as it has them, by a hash of their id, and an
    excerpt of each."""
    hashed = F.xxhash64(F.col(doc_id).cast("string"), F.lit(training.seed))
    known = docs.filter(F.col(lang).isNotNull() & (F.col(lang) != "") & F.col(text).isNotNull() & ~held_out(F.col(doc_id))).select(
        hashed.alias("h"), F.col(text).alias("text"), F.col(lang).alias("lang"))

    def first(rows: DataFrame, most: int, *order: str) -> DataFrame:
        return rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= most)

    # Hashes alone first, so that no text is sorted but those of the sample; and of a language with many documents only the
    # least ones, about four times as many as are taken, so that no task sorts what every task has of it.
    hashes = known.select("lang", "h")
    totals = staged(hashes.groupBy("lang").agg(F.count("*").alias("n")), "totals")
    share = totals.select("lang", (F.lit(4.0 * training.documents) / F.col("n")).alias("share"))
    bound = (F.least("share", F.lit(0.999)) * F.lit(2.0**64) - F.lit(2.0**63)).cast("long")
    few = hashes.join(share, "lang").filter(F.when(F.col("share") >= 1, True).otherwise(F.col("h") < bound)).select("lang", "h")
    tops = staged(first(few, training.documents, "h"), "sample")
    got = totals.join(tops.groupBy("lang").agg(F.count("*").alias("got")), "lang", "left")
    if not got.filter(F.coalesce("got", F.lit(0)) < F.least("n", F.lit(training.documents))).isEmpty():
        tops = staged(first(hashes, training.documents, "h"), "sample")  # ids that repeat very often have few hashes
    languages = tops.select("lang").distinct().count()
    if not languages:
        return []
    most = training.per_language(training.documents, languages)
    last = tops.filter(F.col("rank") <= most).groupBy("lang").agg(F.max("h").alias("last"))
    room = F.greatest(F.length("text") - training.characters, F.lit(0)) + 1
    excerpt = F.col("text").substr((F.pmod("h", room) + 1).cast("int"), F.lit(training.characters))
    chosen = known.join(last, "lang").filter("h <= last").select("h", excerpt.alias("text"), "lang")
    rows = first(chosen, most, "h", "text").orderBy("h", "text", "lang")
    return [(r["text"], r["lang"]) for r in rows.collect()]


def predict(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score``, ``spans``, the runs of words of one language (language, first word, words)
    of each text, and ``in_language``, the share of its lettered words that some language has with a chance of at least a
    half; without a model that is 1 for any text with a letter. Columns of these names in the input are replaced."""
    docs = docs.drop("lang_pred", "score", "spans", "in_language")
    place = docs.columns.index(text)
    at_most = LABELLED_BYTES * 8 // max(8, len(model.languages) if model else 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(place), at_most):
                part = batch.slice(chunk.rows[0], len(chunk.rows))
                yield pa.RecordBatch.from_arrays([*part.columns, *_labelled(chunk, model)], names)

    spans = "array<struct<lang:string,first:long,words:long>>"
    schema = docs.withColumns({"lang_pred": F.lit("x"), "score": F.lit(0.5), "spans": F.lit(None).cast(spans), "in_language": F.lit(0.5)}).schema
    for f in schema.fields:
        f.nullable = True
    names = schema.fieldNames()
    return docs.mapInArrow(lean(run), schema)


SPAN = pa.struct([("lang", pa.string()), ("first", pa.int64()), ("words", pa.int64())])


def _labelled(chunk: Chunk, model: Model | None) -> list[pa.Array]:
    docs = len(chunk.rows)
    if model is None or not len(chunk.doc):
        lettered = Vocabulary(chunk) if len(chunk.doc) else None
        some = np.zeros(docs) if lettered is None else np.bincount(chunk.doc, lettered.lettered[lettered.of], minlength=docs) > 0
        return [pa.array([UNKNOWN] * docs), pa.array(np.zeros(docs)), pa.array([[]] * docs, pa.list_(SPAN)),
                pa.array(some.astype(float))]
    words = Vocabulary(chunk)
    chance = posteriors(words.scores(model)[words.of], chunk.counts, model.transitions)
    lettered = words.lettered[words.of]
    sums = np.stack([np.bincount(chunk.doc, chance[:, s] * lettered, minlength=docs)
                     for s in range(len(model.languages))], axis=1)
    some = sums.sum(axis=1)
    best = sums.argmax(axis=1)
    score = np.where(some > 0, sums.max(axis=1) / np.where(some > 0, some, 1), 0.0)
    clear = np.bincount(chunk.doc, (chance.max(axis=1) >= 0.5) & lettered, minlength=docs)
    inside = clear / np.bincount(chunk.doc, lettered, minlength=docs).clip(1)
    names = np.array([*model.languages, UNKNOWN], object)
    label = chance.argmax(axis=1)
    edge = np.flatnonzero(np.concatenate([[True], (label[1:] != label[:-1]) | (chunk.doc[1:] != chunk.doc[:-1])]))
    runs = pa.StructArray.from_arrays(
        [pa.array(names[label[edge]], pa.string()), pa.array((edge - chunk.first[chunk.doc[edge]]).astype(np.int64)),
         pa.array(np.diff(np.append(edge, len(label))).astype(np.int64))], fields=list(SPAN))
    offsets = np.searchsorted(chunk.doc[edge], np.arange(docs + 1)).astype(np.int32)
    return [pa.array(names[np.where(some > 0, best, len(model.languages))], pa.string()), pa.array(score.clip(0, 1)),
            pa.ListArray.from_arrays(pa.array(offsets), runs), pa.array(inside)]


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
             training: Training = Training()) -> DataFrame:
    """``docs`` with ``held_out``, ``lang_pred``, ``score`` (the language's share of the words' probability), ``spans``
    and ``in_language`` (see ``predict``).

    Learns from texts with a language outside the held-out third; a null or empty language is no label. A text that is
    null or has no letter, and any text if nothing is labelled, gets ``und`` and 0. Repeated rows get equal answers, very
    long texts are labelled as a whole, an empty table gives no rows. Input columns of the new names are replaced.
    """
    ready(docs.sparkSession)
    sample = training_sample(docs, doc_id, text, lang, training)
    model = fit([t for t, _ in sample], [x for _, x in sample], training) if sample else None
    return predict(docs, model, text).withColumn("held_out", held_out(F.col(doc_id)))
