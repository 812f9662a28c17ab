import random

import numpy as np
import pytest

from tessera.llm import language_id, toxicity


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(1)
    speech = {"aa": ["kalo", "miru", "tensa", "volo", "pira", "luma"], "bb": ["schtag", "werk", "undt", "heitz", "brog", "falk"]}
    insults = ["grubface", "snotling", "wretchit"]
    rows, labels = [], []
    for i in range(600):
        lang = rng.choice(["aa", "bb"])
        words = [rng.choice(speech[lang]) + rng.choice(["", "s", "n"]) for _ in range(rng.randrange(5, 60))]
        toxic = rng.random() < 0.25
        if toxic:
            for _ in range(rng.randrange(1, 4)):
                words.insert(rng.randrange(len(words)), rng.choice(insults))
        rows.append((i, " ".join(words), lang, "s", 7))
        labels.append((i, 1, int(toxic)))
    rows += [(1000, None, None, "s", 1), (1001, "", "aa", "s", 1), (1002, "123 !!", "bb", "s", 1), (1003, "kalo " * 30_000, "aa", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score int")
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity(corpus):
    docs, labels = corpus
    out = toxicity.score(docs, toxicity.fit(docs, labels))
    joined = out.join(labels, "doc_id").toPandas()
    held = joined[joined.held_out]
    assert (held.predicted == held.toxic).mean() > 0.95
    assert out.count() == docs.count() and out.where("score is null or score < 0 or score > 1 or predicted <> int(score >= 0.5)").count() == 0
    kept = toxicity.without_toxic(docs, toxicity.fit(docs, labels))
    assert kept.columns == docs.columns and kept.count() == out.where("predicted = 0").count()


def test_rare_markers_of_toxic_documents(spark):
    """A word of too few toxic documents to be in the sample is learned from all labelled ones."""
    rng = random.Random(4)
    words = [f"plain{chr(97 + i)}" for i in range(26)]
    rows = []
    for i in range(3000):
        marker = "snotling" if i % 5 == 0 else "qwertzuk" if i % 150 == 1 else ""
        rows.append((i, " ".join([*rng.choices(words, k=12), marker, str(i)]), int(marker != "")))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    out = toxicity.score(docs, toxicity.fit(docs, docs.select("doc_id", "toxic"), sample=100)).join(docs, "doc_id").toPandas()
    rare = out[out.text.str.contains("qwertzuk")]
    assert len(rare) == 20 and (rare.predicted == 1).all() and (out.predicted == out.toxic).mean() > 0.99
    assert toxicity.SAMPLE == 8000 and language_id.PER_LANGUAGE == 400


def test_labels_of_held_out_documents_change_nothing(corpus):
    docs, labels = corpus
    turned = labels.withColumn("toxic", toxicity.F.when(toxicity.held_out(labels.doc_id), 1 - labels.toxic).otherwise(labels.toxic))
    a, b = (dict(toxicity.score(docs, toxicity.fit(docs, x)).select("doc_id", "predicted").collect()) for x in (labels, turned))
    assert a == b


def test_no_labels(spark, corpus):
    docs, labels = corpus
    assert toxicity.fit(docs, labels.limit(0)) is None
    assert toxicity.score(docs, None).where("score <> 0 or predicted <> 0").count() == 0
    assert toxicity.score(docs.limit(0), None).count() == 0


def test_label_model():
    """Accuracies and a correlated pair are recovered from votes alone."""
    rng = np.random.default_rng(0)
    y = rng.random(40_000) < 0.2
    votes = np.stack([np.where(y, rng.random(len(y)) < a, rng.random(len(y)) < 0.01) for a in (0.8, 0.7, 0.6)] + [np.zeros(len(y), bool)] * 2, axis=1)
    votes[:, 3] = np.where(y & (rng.random(len(y)) < 0.9), votes[:, 0], False)
    noise = rng.random(len(y)) < 0.1
    votes[:, 4] = noise
    counts = np.bincount(votes @ (1 << np.arange(5)), minlength=32)
    q = toxicity.label_model(counts, 4, 1)[votes @ (1 << np.arange(5))]
    assert ((q > 0.5) == y).mean() > 0.96
    assert q[(votes[:, :4].sum(axis=1) == 0)].max() < 0.2


def test_posteriors_by_enumeration():
    """The label model of two lexicons and one pattern, against the same rounds written out combination by combination."""
    rng = np.random.default_rng(5)
    counts = rng.integers(1, 400, 8).astype(float)
    combos = [((c >> 0) & 1, (c >> 1) & 1, c >> 2) for c in range(8)]
    q = {c: 0.9 if c[0] + c[1] else 0.05 for c in combos}
    n = dict(zip(combos, counts, strict=True))
    whole = sum(counts)
    for _ in range(7):
        logs = {}
        weight = [{c: n[c] * (1 - q[c]) for c in combos}, {c: n[c] * q[c] for c in combos}]
        shares = [sum(w.values()) + 1 for w in weight]
        for y, (size, rate) in enumerate(((2 * whole, 0.002), (4.0, 0.25))):
            w, total = weight[y], sum(weight[y].values()) + size
            one = [(sum(w[c] for c in combos if c[j]) + size * rate) / total for j in (0, 1)]
            both = (sum(w[c] for c in combos if c[0] and c[1]) + size * rate * rate) / total
            every = [sum(n[c] for c in combos if c[2] == s) + 1e-3 for s in (0, 1)]
            own = [sum(w[c] for c in combos if c[2] == s) + every[s] for s in (0, 1)]
            for c in combos:
                first = one[0] if c[0] else 1 - one[0]
                given = both / one[0] if c[0] else (one[1] - both) / (1 - one[0])
                second = given if c[1] else 1 - given
                logs[c, y] = np.log(shares[y] / sum(shares)) + np.log(own[c[2]] / sum(own)) + np.log(first) + np.log(second)
        q = {c: 1 / (1 + np.exp(logs[c, 0] - logs[c, 1])) for c in combos}
    got = toxicity.label_model(counts, 2, 1, rounds=7)
    assert np.allclose(got, [q[c] for c in combos], atol=1e-9)


def test_regression_is_optimal():
    """At the minimum the gradient of a feature that is used balances the penalty, and no other exceeds it."""
    rng = np.random.default_rng(2)
    x = rng.random((400, 12)) < 0.3
    target = 1 / (1 + np.exp(-(x @ np.array([3.0, -2, 1.5] + [0] * 9) - 0.5)))
    row, column = np.nonzero(x)
    for penalty in (1e-2, 1e-3):
        w, b = toxicity._regression(row, column, 400, 12, target, penalty, rounds=5000)
        error = 1 / (1 + np.exp(-(x @ w + b))) - target
        gradient = x.T @ error / 400
        assert abs(error.mean()) < 1e-6 and (np.abs(gradient) <= penalty + 1e-6).all()
        assert np.allclose(gradient[w != 0], -penalty * np.sign(w[w != 0]), atol=1e-6)
    short, c = toxicity._regression(row, column, 400, 12, target, 1e-3)
    loss = lambda w, b: np.mean(np.logaddexp(0, x @ w + b) - target * (x @ w + b)) + 1e-3 * np.abs(w).sum()
    assert loss(short, c) < loss(w, b) + 1e-4


def test_votes_of_held_out_documents_are_not_counted(corpus):
    """Texts of held-out documents change no score of others."""
    docs, labels = corpus
    other = docs.withColumn("text", toxicity.F.when(toxicity.held_out(docs.doc_id), "grubface snotling " * 3).otherwise(docs.text))
    a, b = (dict(toxicity.score(docs, toxicity.fit(x, labels)).select("doc_id", toxicity.F.round("score", 9)).collect()) for x in (docs, other))
    assert a == b


def test_awkward_rows_of_toxicity(spark, corpus):
    """Null ids and texts, repeated rows, one id with several texts, clashing columns."""
    docs, labels = corpus
    rows = [(None, "grubface snotling wretchit grubface snotling", "x", 1), (None, None, "x", 2), (5, "kalo", "x", 3), (5, "kalo", "x", 3), (5, "grubface snotling wretchit", "x", 4)]
    odd = spark.createDataFrame(rows, "doc_id long, text string, score string, held_out int")
    model = toxicity.fit(docs.select("doc_id", "text").unionByName(odd.select("doc_id", "text")), labels)
    out = toxicity.score(odd, model).collect()
    assert len(out) == 5 and sorted(r["predicted"] for r in out) == [0, 0, 0, 1, 1]
    kept = toxicity.without_toxic(odd, model)
    assert kept.columns == odd.columns and sorted(map(str, kept.collect())) == sorted(str(r) for r in odd.collect() if r["held_out"] in (2, 3))


def test_language(corpus):
    docs, _ = corpus
    out = {r["doc_id"]: r for r in language_id.predict(docs, language_id.fit(docs)).collect()}
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    assert all(out[i]["lang_pred"] == truth[i] for i in range(600))
    for i in (1000, 1001, 1002):
        assert (out[i]["lang_pred"], out[i]["score"]) == ("und", 0.0)
    assert out[1003]["lang_pred"] == "aa" and all(0 <= r["score"] <= 1 for r in out.values())


def test_long_text_behind_a_header(spark, corpus):
    """Few words at the ends don't decide about a long text, whatever the training texts look like."""
    docs, _ = corpus
    field = language_id.fit(docs)
    header, body = "schtag werk undt heitz brog falk werks undtn", "kalo miru tensa volo pira luma " * 1600
    long = spark.createDataFrame([(1, f"{header} {body}"), (2, f"{header} {body} {header}")], "doc_id long, text string")
    for extra in language_id.MIXES:
        field.mix = extra
        assert {r["lang_pred"] for r in language_id.predict(long, field).collect()} == {"aa"}


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "abc", None), (2, None, None)], "doc_id long, text string, lang string")
    assert {r["lang_pred"] for r in language_id.predict(docs, language_id.fit(docs)).collect()} == {"und"}
    assert language_id.predict(docs.limit(0), language_id.fit(docs.limit(0))).count() == 0


def test_forward_backward():
    """Against sums over all label sequences."""
    rng = np.random.default_rng(1)
    lengths = [1, 4, 3]
    off = np.concatenate(([0], np.cumsum(lengths)))
    scores, step, start = rng.normal(size=(8, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    got = language_id.marginals(scores, off, step, start)
    for a, n in zip(off, lengths, strict=False):
        total = np.zeros((n, 3))
        for path in np.ndindex(*[3] * n):
            w = np.exp(start[path[0]] + sum(scores[a + t, path[t]] for t in range(n)) + sum(step[path[t], path[t + 1]] for t in range(n - 1)))
            for t in range(n):
                total[t, path[t]] += w
        assert np.allclose(got[a : a + n], total / total.sum(axis=1, keepdims=True))


def test_words_of_switching_text(corpus):
    docs, _ = corpus
    field = language_id.fit(docs)
    import pyarrow as pa

    words = language_id.Vocabulary(pa.array(["kalo miru tensa volo schtag werk undt heitz brog"]))
    p = language_id.marginals(language_id._scores(*words.features(field), len(words.hashes), field.weights)[words.number], words.words.off, field.transitions, field.start)
    assert p.argmax(axis=1).tolist() == [field.languages.index("aa")] * 4 + [field.languages.index("bb")] * 5


def test_driver_memory_of_the_regression():
    """The driver's arrays besides the features themselves are as long as a piece, a row or a feature, not as all features of the sample."""
    import tracemalloc

    rng = np.random.default_rng(3)
    known = np.unique(rng.integers(0, 1 << 25, 2000))
    codes = rng.choice(known[::2], 2_000_000).astype(np.int32)
    row = np.sort(rng.integers(0, 500, len(codes))).astype(np.int32)
    values, column = np.unique(codes, return_inverse=True)
    tracemalloc.start()
    try:
        toxicity._regression(row, column.astype(np.int32), 500, len(values), rng.random(500), 1e-3, rounds=2)
        assert tracemalloc.get_traced_memory()[1] < 24_000_000  # 8 of them are the columns as given
        tracemalloc.reset_peak()
        found = toxicity._numbered(codes, known)
        assert tracemalloc.get_traced_memory()[1] < 16_000_000
    finally:
        tracemalloc.stop()
    assert (found[0] == values).all() and (found[1] == column).all()
    weights = rng.normal(size=len(values))
    assert (toxicity._summed(row, weights, column, 500) == np.bincount(row, weights=weights[column], minlength=500)).all()
