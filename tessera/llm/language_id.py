"""Language identification by a linear-chain conditional random field over words.

Each word of a text has a language; hashed features of the word (itself, its first and last letters,
letter n-grams, membership in learned lexicons) score languages, learned transitions score
neighbours, and forward-backward gives each word's probabilities, so that text which changes its
language midway is labelled piece by piece.  A document's probabilities are the mean over all its
words, in which each of its first and last words may count a few times (a short text with a quotation
is labelled by what surrounds it; in a long text the ends have no more than their share).  How many
times is what best explains the labels of training documents that were left out of a first fit.

The field is trained on a bounded sample of labelled documents.  As their labels are for whole
documents, training sequences are stitched from pieces of different documents; that is where the
transitions are learned from.  Null texts and texts without letters are `und` with score 0, and so
is every text if nothing is labelled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table
from .tokens import FACTORS, Words, flat, mix, separators, steps

#: Training documents of each language, and training words, at most; the sequences' length.
PER_LANGUAGE, TRAINING_WORDS, LENGTH = 400, 240_000, 60
#: Words at either end, and how many times more than the others those of the start and the end may
#: count; one training document in LEFT_OUT is left out of the fit that these are judged by.
EDGE, MIXES, LEFT_OUT = 8, ((0, 0), (1, 1), (2, 2), (4, 4), (4, 1), (1, 4)), 5
#: Weight rows: 2**BITS hashed features; longest word starts, ends and inner n-grams.
BITS, AFFIXES, NGRAMS = 17, (1, 2, 3), (2, 3)
NOT_LETTERS = bytes(b for b in range(128) if not chr(b).isalpha())
STEP = 1 << 20


@dataclass
class Field:
    languages: list[str]
    weights: np.ndarray
    transitions: np.ndarray
    start: np.ndarray
    lexicon: np.ndarray  # sorted word hashes
    lexicon_language: np.ndarray
    mix: tuple[float, float] = MIXES[0]


class Vocabulary:
    """The distinct words of a batch: which one each word is, and the features of each."""

    def __init__(self, column: pa.Array):
        data, offsets = flat(column)
        upper = (data >= 0x41) & (data <= 0x5A)
        self.words = Words(data + (upper * 32).astype(np.uint8), offsets, separators(NOT_LETTERS))
        self.hashes, first, self.number = np.unique(self.words.hashes(0), return_index=True, return_inverse=True)
        self.starts, self.ends = self.words.starts[first], self.words.ends[first]
        self._span = lambda a, b, salt: mix(self.words.bytes.read(a, b - a) * FACTORS[0] + np.uint64(salt))

    def features(self, field: Field | None) -> tuple[np.ndarray, np.ndarray]:
        """(word, feature) pairs, by word."""
        n, size = len(self.hashes), self.ends - self.starts
        everyone = np.arange(n)
        words, codes = [everyone], [self.hashes]
        for k in AFFIXES:
            long = everyone[size > k]
            words += [long, long]
            codes += [self._span(self.starts[long], self.starts[long] + k, 16 + k), self._span(self.ends[long] - k, self.ends[long], 32 + k)]
        for k in NGRAMS:
            long = everyone[size >= k]
            count = size[long] - k + 1
            word = np.repeat(long, count)
            at = self.starts[word] + np.arange(len(word)) - np.repeat(np.concatenate(([0], np.cumsum(count)[:-1])), count) if len(long) else word
            words.append(word)
            codes.append(self._span(at, at + k, 48 + k))
        if field is not None and len(field.lexicon):
            at = np.minimum(np.searchsorted(field.lexicon, self.hashes), len(field.lexicon) - 1)
            hit = np.flatnonzero(field.lexicon[at] == self.hashes)
            words.append(hit)
            codes.append(mix(field.lexicon_language[at[hit]].astype(np.uint64) + np.uint64(1 << 20)))
        words, codes = np.concatenate(words), np.concatenate(codes) >> np.uint64(64 - BITS)
        order = np.argsort(words, kind="stable")
        return words[order], codes[order].astype(np.int64)


def _scores(word: np.ndarray, feature: np.ndarray, n: int, weights: np.ndarray) -> np.ndarray:
    """Each word's language scores: the sum of its features' weights."""
    return np.add.reduceat(weights[feature], np.searchsorted(word, np.arange(n))) if n else np.zeros((0, weights.shape[1]))


def marginals(scores: np.ndarray, off: np.ndarray, transitions: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Word probabilities by forward-backward over sequences laid end to end; all sequences that
    are long enough advance together, and messages are normalised in each step."""
    length = np.diff(off)
    order = np.argsort(-length, kind="stable")
    begin, length = off[:-1][order], length[order]
    emit = np.exp(scores - scores.max(axis=1, keepdims=True))
    step, first = np.exp(transitions), np.exp(start)
    alpha = np.empty_like(emit)
    longest = int(length[0]) if len(length) else 0
    active = np.searchsorted(-length, -np.arange(1, longest + 1), side="right")
    message = np.broadcast_to(first, (len(length), len(first)))
    for t in range(longest):
        at = begin[: active[t]] + t
        now = message[: active[t]] * emit[at]
        now /= now.sum(axis=1, keepdims=True)
        alpha[at] = now
        message = now @ step
    out = np.empty_like(emit)
    beta = np.ones((len(length), emit.shape[1]))
    for t in range(longest - 1, -1, -1):
        at = begin[: active[t]] + t
        both = alpha[at] * beta[: active[t]]
        out[at] = both / both.sum(axis=1, keepdims=True)
        back = (emit[at] * beta[: active[t]]) @ step.T
        beta[: active[t]] = back / back.sum(axis=1, keepdims=True)
    return out


def _documents(p: np.ndarray, off: np.ndarray, extra: tuple[float, float]) -> np.ndarray:
    """Mean word probabilities of each text (none empty), with words of its start and end counted more."""
    total = np.vstack((np.zeros(p.shape[1]), np.cumsum(p, axis=0)))
    a, b = off[:-1], off[1:]
    spans = ((a, b), (a, np.minimum(a + EDGE, b)), (np.maximum(b - EDGE, a), b))
    weights = (1, *extra)
    count = sum(w * (y - x) for w, (x, y) in zip(weights, spans, strict=True))
    return sum(w * (total[y] - total[x]) for w, (x, y) in zip(weights, spans, strict=True)) / count[:, None]


def train(texts: pa.Array, label: np.ndarray, languages: list[str]) -> Field:
    """A field fitted to all texts, with the mix that explains texts best that another fit left out."""
    # copies of a text are all left out or none
    out = np.unique(texts.fill_null("").to_numpy(zero_copy_only=False).astype(object), return_inverse=True)[1] % LEFT_OUT == LEFT_OUT - 1
    best = MIXES[0]
    if out.any():
        field = _fitted(texts.filter(pa.array(~out)), label[~out], languages)
        vocabulary = Vocabulary(texts.filter(pa.array(out)))
        off = vocabulary.words.off
        filled = np.flatnonzero(np.diff(off) > 0)
        if len(filled):
            p = marginals(_scores(*vocabulary.features(field), len(vocabulary.hashes), field.weights)[vocabulary.number], off, field.transitions, field.start)
            at = np.arange(len(filled)), label[out][filled]
            best = max(MIXES, key=lambda extra: np.log(_documents(p, np.append(off[filled], off[-1]), extra)[at] + 1e-3).sum())
    field = _fitted(texts, label, languages)
    field.mix = best
    return field


def _fitted(texts: pa.Array, label: np.ndarray, languages: list[str], rounds: int = 60, seed: int = 7) -> Field:
    """Maximum likelihood with a Gaussian prior, by Adam over all sequences."""
    vocabulary, k = Vocabulary(texts), len(languages)
    if not k:
        return Field([], np.zeros((0, 0)), np.zeros((0, 0)), np.zeros(0), np.zeros(0, np.uint64), np.zeros(0, np.int64))
    off = vocabulary.words.off
    document = np.repeat(np.arange(len(texts)), np.diff(off))
    # lexicons: words that one language has most of, in at least three documents
    pair = np.unique(vocabulary.number.astype(np.int64) * len(texts) + document)
    table_ = np.zeros((len(vocabulary.hashes), k))
    np.add.at(table_, (pair // len(texts), label[pair % len(texts)]), 1)
    sure = (table_.sum(axis=1) >= 3) & (table_.max(axis=1) >= 0.8 * table_.sum(axis=1))
    field = Field(languages, np.zeros((1 << BITS, k)), np.zeros((k, k)), np.zeros(k), vocabulary.hashes[sure], table_.argmax(axis=1)[sure])
    # sequences of LENGTH words from pieces of 5 to 30 words
    rng, filled = np.random.default_rng(seed), np.flatnonzero(np.diff(off) > 0)
    of_language = [filled[label[filled] == i] for i in range(k)]
    present = [i for i in range(k) if len(of_language[i])]
    if not present:
        return field
    pieces, total = [], min(TRAINING_WORDS, max(8 * len(vocabulary.words.starts), LENGTH)) // LENGTH * LENGTH
    have = 0
    while have < total:
        d = rng.choice(of_language[rng.choice(present)])
        n = int(min(rng.integers(5, 31), off[d + 1] - off[d]))
        at = int(rng.integers(off[d], off[d + 1] - n + 1))
        pieces.append(np.arange(at, at + n))
        have += n
    at = np.concatenate(pieces)[:total].reshape(-1, LENGTH)
    number, truth = vocabulary.number[at], label[document[at]]
    word, feature = vocabulary.features(field)
    pairs = np.zeros((k, k))
    np.add.at(pairs, (truth[:, :-1].ravel(), truth[:, 1:].ravel()), 1)
    onehot = np.eye(k)
    parameters = [field.weights, field.transitions, field.start]
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in parameters]
    for r in range(1, rounds + 1):
        scores = _scores(word, feature, len(vocabulary.hashes), field.weights)[number]
        emit = np.exp(scores - scores.max(axis=2, keepdims=True))
        step = np.exp(field.transitions)
        alpha, beta = np.empty_like(emit), np.empty_like(emit)
        message = np.broadcast_to(np.exp(field.start), emit[:, 0].shape)
        for t in range(LENGTH):
            alpha[:, t] = message * emit[:, t]
            alpha[:, t] /= alpha[:, t].sum(axis=1, keepdims=True)
            message = alpha[:, t] @ step
        beta[:, -1] = 1
        for t in range(LENGTH - 2, -1, -1):
            beta[:, t] = (emit[:, t + 1] * beta[:, t + 1]) @ step.T
            beta[:, t] /= beta[:, t].sum(axis=1, keepdims=True)
        p = alpha * beta
        p /= p.sum(axis=2, keepdims=True)
        expected = np.zeros((k, k))
        for t in range(LENGTH - 1):
            joint = alpha[:, t][:, :, None] * step[None] * (emit[:, t + 1] * beta[:, t + 1])[:, None, :]
            expected += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        error = onehot[truth] - p
        by_word = np.stack([np.bincount(number.ravel(), weights=error[:, :, i].ravel(), minlength=len(vocabulary.hashes)) for i in range(k)], axis=1)
        grads = [np.stack([np.bincount(feature, weights=by_word[word, i], minlength=1 << BITS) for i in range(k)], axis=1), pairs - expected, error[:, 0].sum(axis=0)]
        for q, g, (m, v) in zip(parameters, grads, moments, strict=True):
            g = g / number.size - 1e-5 * q
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            q += 0.15 * (m / (1 - 0.9**r)) / (np.sqrt(v / (1 - 0.99**r)) + 1e-8)
    return field


def held_out(doc_id: Column) -> Column:
    """Documents that nothing is learned from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def fit(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE) -> Field:
    """Train on at most `per_language` documents of each language that aren't held out."""
    known = documents.select(F.col(id_col).alias("_id"), F.col(lang_col).cast("string").alias("lang")).where("lang is not null and _id is not null").where(~held_out(F.col("_id")))
    # thin each language by hash to about twice what is wanted before ranking, so no group is large
    counts = known.groupBy("lang").agg(F.count("*").alias("n"))
    near = F.pmod(F.xxhash64("_id", F.lit(1)), F.lit(1 << 30)) < F.ceil((1 << 30) * 2.0 * per_language / F.col("n"))
    known = known.join(F.broadcast(counts), "lang").where(near)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("_id"), "_id"))
    chosen = known.withColumn("rank", rank).where(F.col("rank") <= per_language).select("_id", F.col("lang").alias("_lang"))
    rows = documents.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(chosen), "_id").select("text", "_lang").orderBy(F.xxhash64("text"), "text", "_lang").toArrow()
    languages = sorted(set(rows.column("_lang").to_pylist()))
    label = np.array([languages.index(x) for x in rows.column("_lang").to_pylist()], dtype=np.int64)
    return train(rows.column("text").combine_chunks(), label, languages)


def _predicted(field: Field):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text", STEP):
            n, letters = batch.num_rows, batch.column("letters").to_numpy(zero_copy_only=False).astype(bool)
            best, score = np.full(n, -1), np.zeros(n)
            if field.languages:
                vocabulary = Vocabulary(batch.column("text"))
                scores = _scores(*vocabulary.features(field), len(vocabulary.hashes), field.weights)
                off = vocabulary.words.off
                filled = np.flatnonzero((np.diff(off) > 0) & letters)
                if len(filled):
                    p = marginals(scores[vocabulary.number], off, field.transitions, field.start)
                    mean = _documents(p, off[np.append(np.flatnonzero(np.diff(off) > 0), n)], field.mix)[letters[np.diff(off) > 0]]
                    best[filled], score[filled] = mean.argmax(axis=1), np.clip(mean.max(axis=1), 0, 1)
            names = np.array([*field.languages, "und"], dtype=object)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names[best], pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"])

    return run


def predict(documents: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every whole text."""
    text = F.col(text_col).cast("string")
    rows = documents.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("letters"))
    rows = rows.mapInArrow(_predicted(field), f"doc_id {dict(rows.dtypes)['doc_id']}, lang_pred string, score double")
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return predict(documents, fit(documents))
