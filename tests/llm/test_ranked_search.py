import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tessera.llm import ranked_search as module
from tessera.llm.ranked_search import Best, ranked_search

SEP = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms_of(text):
    return SEP.findall((text or "").translate(LOWER))


def expected(docs, items, k):
    own = [(i, Counter(terms_of(t))) for i, t in docs]
    n_docs, n_terms = sum(bool(c) for _, c in own), sum(sum(c.values()) for _, c in own)
    df = Counter(t for _, c in own for t in c)
    wanted, out = defaultdict(set), []
    for i, t in items:
        wanted[i] |= set(terms_of(t))
    for item, terms in wanted.items():
        scored = []
        for doc, c in own:
            m = 10 + 90 * sum(c.values()) * n_docs // n_terms if n_terms else 10
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in terms if c[t])
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        out += [(item, r, None if null else doc, -s) for r, (s, null, doc) in enumerate(sorted(scored)[:k], 1)]
    return sorted(map(str, out))


def tables(spark, docs, items):
    d = spark.createDataFrame([(*x, 1, "t") for x in docs], "doc_id long, text string, score long, terms string").repartition(4)
    return d, spark.createDataFrame([(*x, 2) for x in items], "item_id long, text string, doc_id int")


def rows_of(rng):
    words = ["Alpha", "beta", "été", "ÉTÉ", "x1", "中", "gamma", "delta-x", "o'k", "Z"] + [f"w{i}" for i in range(60)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    docs = [(i, text(rng.randrange(1, 60))) for i in range(120)]
    docs += [(i, "beta gamma") for i in range(500, 540)] + [(None, "beta gamma"), (None, text(9)), (7, text(30)), (7, text(30)), (900, None), (901, ""), (902, " -- "), (903, text(20_000))]
    items = [(i, text(rng.randrange(1, 12))) for i in range(25)] + [(100, None), (101, ""), (102, "beta"), (102, "gamma"), (103, "nowhere"), (None, "alpha"), (None, "Z"), (104, text(400))]
    return docs, items


@pytest.mark.parametrize(("k", "most_items", "width", "docs_in_block"), [(10, 256, 2048, 512), (3, 7, 5, 16), (50, 256, 11, 8)])
def test_against_every_score(spark, monkeypatch, k, most_items, width, docs_in_block):
    docs, items = rows_of(random.Random(k))
    monkeypatch.setattr(module, "WIDTH", width)
    monkeypatch.setattr(module, "DOCS", docs_in_block)
    got = ranked_search(*tables(spark, docs, items), k=k, most_items=most_items).collect()
    assert sorted(str(tuple(r)) for r in got) == expected(docs, items, k)


def test_empty_tables(spark):
    docs, items = [(1, "a b"), (2, None)], [(1, "b c")]
    for d, i in (([], items), (docs, []), ([(2, None)], items), (docs, [(1, "-")])):
        assert ranked_search(*tables(spark, d, i)).collect() == []
    assert [tuple(r) for r in ranked_search(*tables(spark, docs, items)).collect()] == [eval(x) for x in expected(docs, items, 10)]


def test_exact_products():
    """Blocks are so narrow that no partial sum reaches 2**53, however large the weights are."""
    import pyarrow as pa

    weights = np.full(40, 2**31 - 1, np.int64)
    run = module._scored(weights, [np.arange(40), np.arange(1)], 1, 1_000_000, 2)
    batch = pa.RecordBatch.from_arrays([pa.array([5]), pa.array([40]), pa.array([list(range(40))], pa.list_(pa.int32())), pa.array([[1 + 7 * i for i in range(40)]])], names=["doc", "n", "terms", "counts"])
    (out,) = run(iter([batch]))
    each = [(2**31 - 1) * (1_000_000_000 * (1 + 7 * i) // (1000 * (1 + 7 * i) + 80)) for i in range(40)]
    assert out.column("score").to_pylist() == [sum(each), each[0]] and sum(each) > 2**53


def test_ties_across_blocks():
    """Equal scores are decided by id whatever the order of blocks."""
    best, rng = Best(1, 3), np.random.default_rng(1)
    ids = rng.permutation(400)
    for some in np.array_split(ids, 50):
        best.add(np.full((len(some), 1), 9), np.zeros(len(some), np.int64), some)
    best.cut()
    assert best.rows[3].tolist() == [0, 1, 2]
