"""Toxicity by weak supervision.

1. Voters.  Spark counts each word and word start over all labelled training documents, by label.
   Lexicons are drawn from these counts and dealt to several lexicon voters; pattern voters look at
   shouting, marks and address.  Each votes 0 or 1.
2. Label model.  All documents vote; Spark counts each combination of votes (at most 2**voters), and
   expectation maximisation on these counts estimates the share of toxic documents, each voter's
   accuracy and, along a tree that links the voters most correlated within the classes, their
   correlations.  No label is used here.
3. Classifier.  A sparse logistic regression on hashed words, word starts and the lexicons' votes is
   fitted to the label model's posteriors of a bounded sample of training documents and scores every
   whole text.  By the votes, a lexicon word counts even if no document of the sample has it.

Texts are lower-cased (A-Z); null and empty texts have no words and get the score of the intercept.
Without labels of both classes nothing can be learned: every score is then 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import saved, small, table
from .decontamination import SEPARATORS
from .tokens import FACTORS, Words, flat, mix, separators, steps

#: Labelled documents that the classifier is fitted to, at most; lexicons are counted on all of them.
SAMPLE = 8000
#: Features: a word's hash, and the hashes of its first bytes, in 2**BITS buckets.
STARTS, BITS = (4, 5, 6), 22
#: Lexicon voters: (kind of feature, parts).  Kind 0: words, then STARTS.
LEXICONS = ((0, 3), (1, 2), (2, 2), (3, 2))
PATTERNS = 3
VOTERS = sum(parts for _, parts in LEXICONS) + PATTERNS
#: The kind of features that are lexicon votes; distinct features that a task counts before it merges them.
VOTE, MERGE = 1 + len(STARTS), 1 << 20
#: Features of the sample that the driver works on at once.
PIECE = 1 << 18


@dataclass
class Model:
    lexicons: list[np.ndarray] = field(default_factory=list)
    posterior: np.ndarray | None = None
    features: np.ndarray | None = None
    weights: np.ndarray | None = None
    intercept: float = 0.0


def _features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, Words]:
    """(row, kind, bucket) of each word and word start, and the words."""
    data, offsets = flat(column)
    upper = (data >= 0x41) & (data <= 0x5A)
    words = Words(data + (upper * 32).astype(np.uint8), offsets, separators(SEPARATORS))
    row = np.repeat(np.arange(len(column)), np.diff(words.off))
    rows, kinds, values = [row], [np.zeros(len(row), np.int8)], [words.hashes(0)]
    for kind, n in enumerate(STARTS, 1):
        long = np.flatnonzero(words.ends - words.starts >= n)
        rows.append(row[long])
        kinds.append(np.full(len(long), kind, np.int8))
        values.append(mix(words.bytes.read(words.starts[long], n) * FACTORS[0] + np.uint64(kind)))
    return np.concatenate(rows), np.concatenate(kinds), (np.concatenate(values) >> np.uint64(64 - BITS)).astype(np.int64), words


def _patterns(words: Words, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Votes of the pattern voters: many capitals, many exclamation marks, much of one word."""
    def share(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(mask)))
        return (total[offsets[1:]] - total[offsets[:-1]]) / np.maximum(np.diff(offsets), 1)

    n = np.diff(words.off)
    hashes = words.hashes()
    same = np.concatenate(([False], hashes[1:] == hashes[:-1])) if len(hashes) else np.zeros(0, bool)
    repeats = np.concatenate(([0], np.cumsum(same)))
    return np.stack([share((raw >= 0x41) & (raw <= 0x5A)) > 0.3, share(raw == 0x21) > 0.01, (repeats[words.off[1:]] - repeats[words.off[:-1]]) > 0.2 * np.maximum(n, 1)], axis=1)


def _lexicon_votes(model: Model, rows: np.ndarray, kinds: np.ndarray, buckets: np.ndarray, size: int) -> np.ndarray:
    """Whether each text has a feature of each lexicon."""
    votes = []
    for (kind, parts), lexicon in zip([(k, p) for k, n in LEXICONS for p in range(n)], model.lexicons, strict=True):
        own = kinds == kind
        at = np.minimum(np.searchsorted(lexicon, buckets[own]), max(len(lexicon) - 1, 0))
        hit = lexicon[at] == buckets[own] if len(lexicon) else np.zeros(int(own.sum()), bool)
        votes.append(np.bincount(rows[own][hit], minlength=size) > 0)
    return np.column_stack(votes)


def _votes(model: Model, column: pa.Array) -> np.ndarray:
    """The combination of votes of each text, one bit for each voter."""
    rows, kinds, buckets, words = _features(column)
    votes = np.column_stack([_lexicon_votes(model, rows, kinds, buckets, len(column)), _patterns(words, *flat(column))])
    return votes @ (1 << np.arange(votes.shape[1]))


def _coded(model: Model, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, code) of all features of texts, lexicon votes included; words may repeat."""
    rows, kinds, buckets, _ = _features(column)
    row, voter = np.nonzero(_lexicon_votes(model, rows, kinds, buckets, len(column)))
    return np.concatenate((rows, row)), np.concatenate((kinds.astype(np.int64) << BITS | buckets, VOTE << BITS | voter))


def _distinct(rows: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    both = np.unique(rows.astype(np.int64) << (BITS + 3) | codes)
    return both >> (BITS + 3), both & ((1 << (BITS + 3)) - 1)


def _merged(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """(code, n, bad) summed up by code."""
    codes, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return codes, *(np.bincount(at, weights=np.concatenate([p[i] for p in parts]), minlength=len(codes)) for i in (1, 2))


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many texts, and toxic texts, each feature is; a row of a text with n rows counts 1 / n."""
    parts = []
    for batch in steps(batches, "text"):
        rows, kinds, buckets, _ = _features(batch.column("text"))
        row, code = _distinct(rows, kinds.astype(np.int64) << BITS | buckets)
        weight = 1 / batch.column("n").to_numpy()
        parts.append(_merged([(code, weight[row], (weight * batch.column("toxic").to_numpy())[row])]))
        if len(parts) > 1 and sum(len(p[0]) for p in parts[1:]) > max(MERGE, len(parts[0][0])):
            parts = [_merged(parts)]
    if parts:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in _merged(parts)], names=["code", "n", "bad"])


def _least(toxic: int) -> float:
    """Toxic documents that a lexicon's feature needs: one in fifty while there are few, as less would
    let in whatever words near copies of one document share; ten are enough among any number."""
    return max(4.0, min(toxic / 50, 10.0))


def _lexicons(code: np.ndarray, strong: np.ndarray) -> list[np.ndarray]:
    """Buckets of the strong features, dealt by hash to the voters."""
    out = []
    for k, parts in LEXICONS:
        values = np.sort(code[strong & (code >> BITS == k)]) & ((1 << BITS) - 1)
        out += [values[(mix(values.astype(np.uint64)) % np.uint64(parts)).astype(int) == p] for p in range(parts)]
    return out


def _tree(tables: list[tuple[np.ndarray, np.ndarray]], shares: np.ndarray) -> dict[int, int | None]:
    """The tree over voters with the most mutual information within the classes: child to parent."""
    voters = len(tables[0][0])
    information = np.zeros((voters, voters))
    for (one, both), share in zip(tables, shares, strict=True):
        x, y = one[:, None], one[None, :]
        for joint, alone in ((both, x * y), (x - both, x * (1 - y)), (y - both, (1 - x) * y), (1 - x - y + both, (1 - x) * (1 - y))):
            joint = np.clip(joint, 1e-9, 1)
            information += share * joint * np.log(joint / np.clip(alone, 1e-9, 1))
    parent: dict[int, int | None] = {0: None}
    while len(parent) < voters:
        i, j = max(((i, j) for i in parent for j in range(voters) if j not in parent), key=lambda e: information[e])
        parent[j] = i
    return parent


def label_model(counts: np.ndarray, lexicons: int, patterns: int, rounds: int = 40) -> np.ndarray:
    """Posterior of class 1 for each combination of votes, from how often each occurs.

    Within a class the lexicon voters depend on each other along a tree, chosen anew in each round,
    and the few pattern voters have a joint table.  Lexicons start as better than chance, which
    settles which class is 1, and a prior as heavy as two corpora says that they seldom speak up,
    and then independently, in class 0: without it class 0 would take in groups of toxic documents
    whose voters are strongly correlated.  Patterns start as no evidence: both classes have a prior
    as heavy as the corpus that equals what all documents show.
    """
    code = np.arange(len(counts))
    votes = (code[:, None] >> np.arange(lexicons)[None, :]) & 1
    shape = code >> lexicons
    seen = np.flatnonzero(counts)
    v, n = votes[seen].astype(float), counts[seen].astype(float)
    every = np.bincount(shape[seen], weights=n, minlength=1 << patterns) + 1e-3
    q = np.where(v.sum(axis=1) >= 1, 0.9, 0.05)
    for _ in range(rounds):
        weights = (n * (1 - q), n * q)
        tables = []
        for weight, size, rate in ((weights[0], 2 * n.sum(), 0.002), (weights[1], 4.0, 0.25)):
            total = weight.sum() + size
            tables.append((((v * weight[:, None]).sum(axis=0) + size * rate) / total, ((v * weight[:, None]).T @ v + size * rate * rate) / total))
        shares = np.array([w.sum() + 1 for w in weights])
        shares /= shares.sum()
        logs = []
        for (one, both), share, weight in zip(tables, shares, weights, strict=True):
            own = np.bincount(shape[seen], weights=weight, minlength=1 << patterns) + every
            log = np.log(share) + np.log(own / own.sum())[shape]
            for j, i in _tree(tables, shares).items():
                p = one[j] if i is None else np.where(votes[:, i] == 1, both[i, j] / one[i], (one[j] - both[i, j]) / (1 - one[i]))
                p = np.clip(p, 1e-6, 1 - 1e-6)
                log = log + np.where(votes[:, j] == 1, np.log(p), np.log(1 - p))
            logs.append(log)
        posterior = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -50, 50)))
        q = posterior[seen]
    return posterior


def _summed(to: np.ndarray, values: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Sums of values[at] by to, in the order of a count by weights but a piece at a time, so that the driver holds no long arrays besides to and at."""
    out = np.zeros(size)
    for i in range(0, len(to), PIECE):
        np.add.at(out, to[i : i + PIECE].astype(np.intp), values[at[i : i + PIECE]])
    return out


def _numbered(codes: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different codes, in order, and the number of each code among them.  known: sorted, holds all of them."""
    number = np.empty(len(codes), np.int32)
    for i in range(0, len(codes), PIECE):
        number[i : i + PIECE] = np.searchsorted(known, codes[i : i + PIECE])
    there = np.zeros(len(known), bool)
    there[number] = True
    again = (np.cumsum(there) - 1).astype(np.int32)
    for i in range(0, len(codes), PIECE):
        number[i : i + PIECE] = again[number[i : i + PIECE]]
    return known[there], number


def _regression(row: np.ndarray, column: np.ndarray, size: int, width: int, target: np.ndarray, penalty: float, rounds: int = 150) -> tuple[np.ndarray, float]:
    """Logistic regression with an absolute-value penalty, by accelerated proximal gradients.  Rows are 0/1 features."""
    times = lambda w: _summed(row, w, column, size)
    back = lambda r: _summed(column, r, row, width)
    x = np.ones(width)
    for _ in range(20):
        x = back(times(x / np.linalg.norm(x)))
    step = 1 / (0.25 * (np.linalg.norm(x) / size + 1))
    w, b, z, c, t = np.zeros(width), 0.0, np.zeros(width), 0.0, 1.0
    for _ in range(rounds):
        error = (1 / (1 + np.exp(-np.clip(times(z) + c, -40, 40))) - target) / size
        new_w = z - step * back(error)
        new_w = np.sign(new_w) * np.maximum(np.abs(new_w) - step * penalty, 0)
        new_b = c - step * error.sum()
        new_t = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z, c = new_w + (t - 1) / new_t * (new_w - w), new_b + (t - 1) / new_t * (new_b - b)
        w, b, t = new_w, new_b, new_t
    return w, b


def held_out(doc_id: Column) -> Column:
    """Documents that nothing is learned from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def fit(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Model | None:
    """Learn from labels of documents that aren't held out; None if they don't have both classes."""
    known = labels.select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("toxic")).where("_id is not null and toxic is not null").where(~held_out(F.col("_id")))
    known = known.groupBy("_id").agg(F.max("toxic").alias("toxic"))
    rows = documents.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.select("_id", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), F.reverse("text")).alias("h2"), "text")
    # copies count once, by the one with the least id, which may have n rows
    texts = rows.drop("text").join(known, "_id").groupBy("_id", "h1", "h2").agg(F.max("toxic").alias("toxic"), F.count("*").alias("n"))
    texts = texts.groupBy("h1", "h2").agg(F.max("toxic").alias("toxic"), F.min(F.struct("_id", "n")).alias("first")).select("first._id", "h1", "h2", "toxic", "first.n")
    texts = saved(texts, "labelled")
    total, toxic = texts.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if toxic in (0, total):
        return None
    # every text adds up to 1, so the sums are whole numbers but for rounding
    counted = rows.join(small(texts), ["_id", "h1", "h2"]).select("text", "toxic", "n").mapInArrow(_tally, "code long, n double, bad double")
    counted = counted.groupBy("code").agg(F.round(F.sum("n")).alias("n"), F.round(F.sum("bad")).alias("bad"))
    strong = (F.col("bad") >= _least(toxic)) & ((F.col("bad") + 0.5) / (F.col("n") + 1) >= 0.85)
    usual = F.col("n").between(max(3, total / 500), max(0.2 * total, 3))
    counted = counted.select("code", strong.alias("strong"), usual.alias("usual")).where("strong or usual").toArrow()
    code, strong = counted.column("code").to_numpy(), counted.column("strong").to_numpy()
    model = Model(lexicons=_lexicons(code, strong))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << VOTERS, dtype=np.int64)
        for batch in steps(batches, "text"):
            total += np.bincount(_votes(model, batch.column("text")), minlength=1 << VOTERS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["votes", "n"])

    # the label model sees no votes of held-out documents either
    counted = documents.where(~held_out(F.col(id_col))).select(F.col(text_col).cast("string").alias("text")).mapInArrow(count, "votes long, n long").groupBy("votes").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(1 << VOTERS)
    counts[counted["votes"].to_numpy()] = counted["n"].to_numpy()
    model.posterior = label_model(counts, VOTERS - PATTERNS, PATTERNS)

    values = np.concatenate((np.sort(code), VOTE << BITS | np.arange(VOTERS - PATTERNS)))

    def chosen_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            rows, codes = _coded(model, batch.column("text"))
            at = np.minimum(np.searchsorted(values, codes), len(values) - 1)
            own = values[at] == codes
            row, codes = _distinct(rows[own], codes[own])
            lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32)), pa.array(codes.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([pa.array(_votes(model, batch.column("text"))), lists], names=["votes", "codes"])

    sampled = F.broadcast(texts.orderBy(F.xxhash64("_id"), "_id", "h1", "h2").limit(sample))
    drawn = rows.join(sampled, ["_id", "h1", "h2"]).dropDuplicates(["_id", "h1", "h2"]).select("text").mapInArrow(chosen_features, "votes long, codes array<int>").toArrow()
    votes, lists = np.array(drawn.column("votes")), drawn.column("codes")
    del drawn
    codes = np.concatenate([np.zeros(0, np.int32), *(part.flatten().to_numpy() for part in lists.chunks)])
    row = np.concatenate([np.zeros(0, np.int64), *(np.diff(part.offsets.to_numpy()) for part in lists.chunks)])
    del lists
    row = np.repeat(np.arange(len(votes), dtype=np.int32), row)
    values, column = _numbered(codes, values)
    del codes
    pa.default_memory_pool().release_unused()
    if not len(values):
        model.features, model.weights = values, np.zeros(0)
        model.intercept = float(np.log((model.posterior[votes].mean() + 1e-6) / (1 - model.posterior[votes].mean() + 1e-6)))
        return model
    weights, _ = _regression(row, column, len(votes), len(values), model.posterior[votes], 1e-3)
    # the penalty that chose the features also shrank their weights: fit these again with a tenth of it
    number = np.cumsum(weights != 0) - 1
    chosen = (weights != 0)[column]
    model.features = values[weights != 0]
    model.weights, model.intercept = _regression(row[chosen], number[column[chosen]], len(votes), len(model.features), model.posterior[votes], 1e-4)
    return model


def _scored(model: Model | None, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            score = np.zeros(batch.num_rows)
            if model is not None:
                total = np.full(batch.num_rows, model.intercept)
                if len(model.features):
                    rows, code = _coded(model, batch.column("text"))
                    at = np.minimum(np.searchsorted(model.features, code), len(model.features) - 1)
                    hit = model.features[at] == code
                    once = np.unique(rows[hit].astype(np.int64) * len(model.features) + at[hit])
                    total += np.bincount(once // len(model.features), weights=model.weights[once % len(model.features)], minlength=batch.num_rows)
                score = 1 / (1 + np.exp(-np.clip(total, -40, 40)))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(batch.num_columns) if batch.schema.names[i] != "text"), *([batch.column("text")] if name else []), pa.array(score)], names=[*(x for x in batch.schema.names if x != "text"), *(["text"] if name else []), "score"])

    return run


def score(documents: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every whole text."""
    kind = dict(documents.dtypes)[id_col]
    rows = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(_scored(model, ""), f"doc_id {kind}, score double")
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(documents: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """The rows of documents, all columns, whose text isn't predicted to be toxic."""
    others = [c for c in documents.columns if c != text_col]
    safe = documents.select(*(F.col(c).alias(f"c{i}") for i, c in enumerate(others)), F.col(text_col).cast("string").alias("text"))
    schema = ", ".join([*(f"{n} {t}" for n, t in safe.dtypes if n != "text"), "text string", "score double"])
    kept = safe.mapInArrow(_scored(model, "text"), schema).where("score < 0.5")
    names = {c: f"c{i}" for i, c in enumerate(others)} | {text_col: "text"}
    return kept.select(*(F.col(names[c]).alias(c) for c in documents.columns))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return score(documents, fit(documents, table(spark, sf_dir, "labels")))
