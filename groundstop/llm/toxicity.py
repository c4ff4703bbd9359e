"""Toxicity by multiple-instance learning.

A document is a bag of sentences.  A sentence's probability is a logistic
function of the summed weights of its words; the document's is their
noisy-or, 1 - prod(1 - p).  Only document labels are needed: the loss of the
noisy-or reaches the sentences through its gradient, and the fitted
sentence probabilities tell which sentences offend.

A word's weight is the sum of the weights of its features: the whole word and
its first 4 to 10 bytes (as such, and as the start of a longer word), so
inflected forms share weight.  Only features that the labels set apart take
part: held by at least ``LEAST_TOXIC`` toxic documents of the sample, and by
``LEAST_SCORE`` standard deviations more of them than by chance.  A sentence
without any of them has probability 0, in the fit and in the scores.

What little the other harmless sentences have would still add up in a long
text, so a score is the noisy-or of the ``PASSAGE`` consecutive sentences in
which it is greatest: that of the whole text if it has no more, and whatever
the length, one offending sentence is enough.

The fit uses at most ``SAMPLE`` labelled documents, the first in the order
of a hash of their doc_id, whatever their length.  Their texts stay in
parallel tasks: these count the features of whole texts, and make of every
document the numbers of the telling features of its different sentences that
have any.  Only these arrays meet on one executor, ``FIT_BYTES`` of them at
most: a document whose arrays do not fit in what is left is passed over, and
of the telling features at most ``FEATURES`` count, those furthest from
chance.  Scores are computed for whole texts of all rows.

Cases: a null or empty text (and one without words) has no sentence and
scores 0; rows that repeat a doc_id are scored each; of several labels for a
doc_id the worst counts, null labels and ids teach nothing; a null doc_id is
not held out; without labels no word tells and every score is 0.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundstop.llm.chunks import lower_ascii, mix, slices, span_hashes, text_buffer, words
from groundstop.session import scratch_path, scratch_scope

SAMPLE, FEATURES, FIT_BYTES = 6_000, 1 << 18, 64 << 20
PREFIXES = (4, 5, 6, 7, 8, 10)
LEAST_TOXIC, LEAST_SCORE = 3, 4.0
ROUNDS, RATE, SHRINK, START_BIAS = 120, 0.15, 2e-5, -5.0
#: Consecutive sentences whose probabilities may add up to a score.
PASSAGE = 256

#: Bytes that part words: all but ASCII letters and digits and bytes of other scripts.
_GAP = np.ones(256, bool)
_GAP[list(b"0123456789abcdefghijklmnopqrstuvwxyz")] = False
_GAP[0x80:] = False
_STOP = np.zeros(256, bool)
_STOP[list(b".!?\n")] = True


class Bag:
    """Words and sentences of a chunk: word number and sentence of every token, features of every distinct word."""

    def __init__(self, texts: pa.Array):
        data, off = text_buffer(texts)
        self.data, self.off, self.rows = data, off, len(off) - 1
        data = lower_ascii(data)
        starts, ends, row = words(data, off, _GAP)
        stops = np.concatenate([[0], np.cumsum(_STOP[data])])
        part = stops[starts]
        new = np.ones(len(starts), bool)
        new[1:] = (part[1:] != part[:-1]) | (row[1:] != row[:-1])
        first = np.flatnonzero(new)
        self.sentence = np.cumsum(new) - 1
        self.sentence_row = row[first]
        last = np.append(first[1:], len(starts)) - 1
        self.begin, self.end = starts[first], ends[last] if len(first) else starts[:0]
        self.hashes, at, self.word = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        s, e = starts[at], ends[at]
        columns = [self.hashes] + [span_hashes(data, s, np.minimum(e, s + k)) + (e - s > k).astype(np.uint64) for k in PREFIXES]
        self.features = np.stack([mix(c) for c in columns], axis=1) if len(s) else np.zeros((0, 1 + len(PREFIXES)), np.uint64)


def _softplus(x: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, x)


def feature_counts(bag: Bag, toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature, documents of the chunk that hold it, toxic ones among them)."""
    words_of = max(1, len(bag.features))
    pairs = np.unique(bag.sentence_row[bag.sentence].astype(np.int64) * words_of + bag.word)  # distinct (document, word)
    document, held = pairs // words_of, pairs % words_of
    del pairs
    out = []
    for j in range(bag.features.shape[1]):
        # A word no longer than the prefix has its whole-word feature once more: counted in the first column.
        own = np.ones(len(bag.features), bool) if j == 0 else bag.features[:, j] != bag.features[:, 0]
        every, number = np.unique(bag.features[:, j], return_inverse=True)
        mine = own[held]
        seen = np.unique(document[mine] * max(1, len(every)) + number[held[mine]])
        of, at = np.divmod(seen, max(1, len(every)))
        total = np.bincount(at, minlength=len(every))
        some = np.flatnonzero(total)
        out.append((every[some], total[some], np.bincount(at, toxic[of], len(every)).astype(np.int64)[some]))
    return tuple(np.concatenate(column) for column in zip(*out, strict=True))


def telling_sentences(bag: Bag, kept: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of every row (times, length, number): its different sets of telling features, how many sentences have each, and the sorted numbers of each set one after the other."""
    number = numbered(bag.features, kept)
    has = (number < len(kept)).sum(axis=1)
    token = np.flatnonzero(has[bag.word] > 0)
    number = np.sort(number, axis=1)  # those of no feature last
    lens = has[bag.word[token]]
    first = np.cumsum(lens) - lens
    entry = number[np.repeat(bag.word[token], lens), np.arange(int(lens.sum())) - np.repeat(first, lens)].astype(np.int32)
    sentence = np.repeat(bag.sentence[token], lens)
    entry = entry[np.lexsort((entry, sentence))]
    start = np.flatnonzero(np.diff(sentence, prepend=-1))
    row, end = bag.sentence_row[sentence[start]], np.append(start[1:], len(sentence))
    edge, out = np.searchsorted(row, np.arange(bag.rows + 1)), []
    for i in range(bag.rows):
        times: dict[bytes, int] = {}
        for a, b in zip(start[edge[i]:edge[i + 1]].tolist(), end[edge[i]:edge[i + 1]].tolist(), strict=True):
            one = entry[a:b].tobytes()
            times[one] = times.get(one, 0) + 1
        out.append((np.fromiter(times.values(), np.int32, len(times)), np.fromiter((len(k) // 4 for k in times), np.int32, len(times)), np.frombuffer(b"".join(times), np.int32)))
    return out


def numbered(features: np.ndarray, kept: np.ndarray) -> np.ndarray:
    """Number of each feature in ``kept``, or one past its end."""
    at = np.searchsorted(kept, features)
    return np.where(np.append(kept, 0)[np.minimum(at, len(kept))] == features, at, len(kept)) if len(kept) else np.zeros(features.shape, np.int64)


def fit(number: np.ndarray, size: int, sentence: np.ndarray, times: np.ndarray, sentence_row: np.ndarray, toxic: np.ndarray, docs: int, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Weights of ``size`` features and the bias, by Adam on the noisy-or likelihood of ``docs`` documents.

    ``number`` and ``sentence`` name the features of the sentences, ``times``
    says how often a sentence occurs in its document; what has no telling
    feature has no part in the likelihood but in the count of documents.
    """
    weight, bias = np.zeros(size), START_BIAS
    m, v, mb, vb = np.zeros_like(weight), np.zeros_like(weight), 0.0, 0.0
    for t in range(1, rounds + 1):
        s = bias + np.bincount(sentence, weight[number], len(sentence_row))
        chance = 0.5 * (1 + np.tanh(s / 2))
        q = np.bincount(sentence_row, times * _softplus(s), len(toxic))
        slope = np.where(toxic, -1 / np.expm1(np.clip(q, 1e-6, 50)), 1.0) / max(1, docs)
        g = slope[sentence_row] * chance * times
        grad = np.bincount(number, g[sentence], size) + SHRINK * weight
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        gb = g.sum()
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb**2
        step = RATE * min(1.0, 2 * (1 - t / (rounds + 1)))
        a, b = 1 - 0.9**t, 1 - 0.99**t
        weight -= step * (m / a) / (np.sqrt(v / b) + 1e-8)
        bias -= step * (mb / a) / (np.sqrt(vb / b) + 1e-8)
    return weight, float(bias)


def _fit_table(table: pa.Table, size: int, docs: int, rounds: int) -> pa.Table:
    """One row with the fitted weights and bias, from rows (toxic, times, length, number) of ``_arrays``."""
    toxic = table["toxic"].to_numpy() > 0
    times, length, number = (np.frombuffer(b"".join(table[c].to_pylist()), "<i4") for c in ("times", "length", "number"))
    sentence_row = np.repeat(np.arange(len(toxic)), [len(x) // 4 for x in table["times"].to_pylist()])
    weight, bias = fit(number, size, np.repeat(np.arange(len(length), dtype=np.int32), length), times, sentence_row, toxic, docs, rounds)
    return pa.table({"weight": pa.array([weight.astype("<f8").tobytes()], pa.binary()), "bias": [bias]})


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for some in slices(batch, "text"):
            feature, total, bad = feature_counts(Bag(some.column("text")), some.column("toxic").to_numpy(zero_copy_only=False) > 0)
            yield pa.RecordBatch.from_arrays([pa.array(feature.view(np.int64)), pa.array(total), pa.array(bad)], ["feature", "total", "bad"])


def _arrays(batches: Iterator[pa.RecordBatch], kept: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for some in slices(batch, "text"):
            found = telling_sentences(Bag(some.column("text")), kept)
            yield pa.RecordBatch.from_arrays([some.column("doc_id"), some.column("toxic"), *(
                pa.array([x[k].astype("<i4").tobytes() for x in found], pa.binary()) for k in range(3))], ["doc_id", "toxic", "times", "length", "number"])


def held_out(doc_id: Column, folds: int = 5) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == 0, F.lit(False))


@dataclass(frozen=True)
class Model:
    """Sorted feature hashes, their weights and the bias; its size is bounded by the sample."""

    feature: np.ndarray
    weight: np.ndarray
    bias: float

    def logits(self, bag: Bag) -> np.ndarray:
        """Logit of every sentence of a chunk; minus infinity where no word tells."""
        number = numbered(bag.features, self.feature)
        by_word = np.append(self.weight, 0.0)[number].sum(axis=1)
        telling = np.bincount(bag.sentence, (number < len(self.feature)).any(axis=1)[bag.word], len(bag.sentence_row)) > 0
        return np.where(telling, self.bias + np.bincount(bag.sentence, by_word[bag.word], len(bag.sentence_row)), -np.inf)


def telling_features(sample: DataFrame) -> tuple[np.ndarray, int]:
    """Sorted hashes of the features that toxic documents hold far more often than by chance, and the number of documents."""
    docs, toxic = sample.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    rate = toxic / max(1, docs)
    counts = sample.select("text", "toxic").mapInArrow(_counts, "feature long, total long, bad long").groupBy("feature").agg(F.sum("total").alias("total"), F.sum("bad").alias("bad"))
    score = (F.col("bad") - F.col("total") * rate) / F.sqrt(F.col("total") * (rate * (1 - rate)) + 1e-12)
    kept = counts.select("feature", "bad", score.alias("score")).where((F.col("bad") >= LEAST_TOXIC) & (F.col("score") >= LEAST_SCORE))
    # At most ``FEATURES`` numbers.
    kept = kept.orderBy(F.desc("score"), "feature").limit(FEATURES).select("feature").toArrow()
    return np.sort(kept["feature"].to_numpy().view(np.uint64)), docs


def fitting(sizes: list[tuple[int, int]], room: int) -> list[int]:
    """The ids, of (id, bytes) in order, whose bytes fit in what those before have left of ``room``."""
    taken = []
    for i, size in sizes:
        if size <= room:
            taken.append(i)
            room -= size
    return taken


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, rounds: int = ROUNDS) -> Model:
    """Fit on labelled documents that are not held out; the stored sample goes with the fit."""
    with scratch_scope(docs.sparkSession):
        return _train(docs, labels, sample, rounds)


def _train(docs: DataFrame, labels: DataFrame, sample: int, rounds: int) -> Model:
    spark, base = docs.sparkSession, scratch_path(docs.sparkSession, "toxicity")
    marked = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("long").alias("toxic"))
    marked = marked.where(~held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    # At most ``sample`` rows of two integers.
    picked = docs.select("doc_id", "text").where("text IS NOT NULL").join(F.broadcast(marked), "doc_id").groupBy("doc_id").agg(F.max("text").alias("text"), F.max("toxic").alias("toxic"))
    picked.write.parquet(f"{base}/sample")
    picked = spark.read.parquet(f"{base}/sample")
    kept, known = telling_features(picked)
    if len(kept) == 0:
        return Model(np.zeros(0, np.uint64), np.zeros(0), START_BIAS)
    arrays = picked.select("doc_id", "text", "toxic").mapInArrow(functools.partial(_arrays, kept=kept), "doc_id long, toxic long, times binary, length binary, number binary")
    arrays.where(F.octet_length("number") > 0).write.parquet(f"{base}/arrays")
    arrays = spark.read.parquet(f"{base}/arrays")
    size = F.octet_length("times").cast("long") + F.octet_length("length") + F.octet_length("number")
    # At most ``sample`` rows of two integers.
    sizes = [tuple(r) for r in arrays.select("doc_id", size).orderBy(F.xxhash64("doc_id"), "doc_id").collect()]
    taken = fitting(sizes, FIT_BYTES)
    if len(taken) < len(sizes):
        arrays = arrays.join(F.broadcast(spark.createDataFrame([(i,) for i in taken], "doc_id long")), "doc_id")
        known -= len(sizes) - len(taken)
    columns = ["toxic", "times", "length", "number"]
    model = arrays.select(columns).groupBy(F.lit(1).alias("one")).applyInArrow(lambda t: _fit_table(t.select(columns), len(kept), known, rounds), "weight binary, bias double").first()
    if model is None:
        return Model(np.zeros(0, np.uint64), np.zeros(0), START_BIAS)
    return Model(kept, np.frombuffer(model["weight"], "<f8"), model["bias"])


RESULT = "doc_id long, held_out boolean, score double, predicted int, offending_start array<long>, offending_length array<long>"


def _scored(batches: Iterator[pa.RecordBatch], model: Model, folds: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for some in slices(batch):
            bag = Bag(some.column(1))
            s = model.logits(bag)
            score = _document_scores(bag, s)
            bad = np.flatnonzero(s >= 0)
            points = np.concatenate([[0], np.cumsum((bag.data & 0xC0) != 0x80)])
            row = bag.sentence_row[bad]
            lists = pa.array(np.searchsorted(row, np.arange(bag.rows + 1)).astype(np.int32))
            held = [i is not None and zlib.crc32(str(i).encode()) % folds == 0 for i in some.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                some.column(0), pa.array(held, pa.bool_()), pa.array(score), pa.array((score >= 0.5).astype(np.int32)),
                pa.ListArray.from_arrays(lists, pa.array(points[bag.begin[bad]] - points[bag.off[row]])),
                pa.ListArray.from_arrays(lists, pa.array(points[bag.end[bad]] - points[bag.begin[bad]]))],
                ["doc_id", "held_out", "score", "predicted", "offending_start", "offending_length"])


def _document_scores(bag: Bag, logits: np.ndarray) -> np.ndarray:
    mass = _softplus(logits)
    total = np.bincount(bag.sentence_row, mass, bag.rows)
    first = np.searchsorted(bag.sentence_row, np.arange(bag.rows + 1))
    for row in np.flatnonzero(np.diff(first) > PASSAGE).tolist():
        up_to = np.concatenate([[0.0], np.cumsum(mass[first[row]:first[row + 1]])])
        total[row] = (up_to[PASSAGE:] - up_to[:-PASSAGE]).max()
    return -np.expm1(-total)


def keep_clean(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose score is below the threshold."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch):
                bag = Bag(some.column(at))
                yield some.filter(pa.array(_document_scores(bag, model.logits(bag)) < threshold))

    return docs.mapInArrow(run, docs.schema)


def score(docs: DataFrame, model: Model, folds: int = 5) -> DataFrame:
    """Score every row of ``docs``; the offending sentences (probability 0.5 or more) are given in code points of the text."""
    return docs.select("doc_id", "text").mapInArrow(functools.partial(_scored, model=model, folds=folds), RESULT)
