import re

import numpy as np
import pytest

from tessera.llm.common import components
from tessera.llm.decontamination import decontaminate
from tessera.llm.jaccard_join import bands_for, jaccard_join
from tessera.llm.vector_join import vector_join


def closure(nodes, links):
    least = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(least[a], least[b])
            if least[a] != m or least[b] != m:
                least[a] = least[b] = m
                changed = True
    return least


def test_components(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 101), (103, 101), (200, 200)] + [(300, 300 + i) for i in range(1, 40)]
    got = {tuple(r) for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    nodes = {n for e in chain if e[0] != e[1] for n in e}
    assert got == set(closure(nodes, [e for e in chain if e[0] != e[1]]).items())


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_bands():
    bands, rows = bands_for(0.8, 0.9999)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.9999 and bands * rows <= 128


@pytest.mark.parametrize("block", [300_000, 150])
def test_near_duplicates(documents, texts, block, monkeypatch):
    import tessera.llm.jaccard_join as module

    monkeypatch.setattr(module, "BLOCK_SHINGLES", block)
    sets = {}
    for doc, text in texts:
        ws = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        if doc is not None:
            sets[doc] = {tuple(ws[i : i + 5]) for i in range(max(len(ws) - 4, 1))} if ws else set()
    links = [(a, b) for a in sets for b in sets if a != b and sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9]
    least = closure(sets, links)
    want = {d: (least[d], sum(a == d for a, _ in links), least[d] == d) for d in sets}
    got = {r["doc_id"]: (r["class_id"], r["n_links"], r["kept"]) for r in jaccard_join(documents).where("doc_id is not null").collect()}
    assert got == want
    assert jaccard_join(documents).count() == len(sets) + 1


def test_cosine_links(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 16))
    x = np.concatenate([c + rng.normal(size=(30, 16)) * 0.16 for c in centres] + [np.repeat(centres[:1], 40, axis=0), centres[1:2] * 3])
    rows = [(i, [float(v) for v in r], 0) for i, r in enumerate(x)]
    extra = [(900, None, 1), (901, [0.0] * 16, 1), (902, [float("nan")] * 16, 1), (903, [float("inf")] + [1.0] * 15, 1), (904, [None] + [1.0] * 15, 1), (905, [], 1), (906, [1.0, 0.0], 1), (907, [2.0, 0.0], 1), (0, rows[0][1], 2)]
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in vector_join(spark.createDataFrame(rows + extra, "vec_id long, embedding array<double>, label int")).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    link = unit @ unit.T >= 0.95
    np.fill_diagonal(link, False)
    least = closure(range(len(x)), np.argwhere(link).tolist())
    want = {i: (int(link[i].sum()), least[i], least[i] == i) for i in range(len(x))}
    want |= {i: (0, i, True) for i in range(900, 906)} | {906: (1, 906, True), 907: (1, 906, False)}
    assert got == want


def test_repeated_vector_ids(spark):
    """Of an id with several vectors one counts, the same whatever the order of rows."""
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0])]
    got = [sorted(map(tuple, vector_join(spark.createDataFrame(r, "vec_id long, embedding array<double>").repartition(2)).collect())) for r in (rows, rows[::-1])]
    assert got[0] == got[1] and len(got[0]) == 3 and sum(r[1] for r in got[0]) == 2


def test_blocks_of_groups_are_skipped(spark, monkeypatch):
    """Vectors in separate groups: most pairs of blocks are never joined."""
    import tessera.llm.vector_join as module

    monkeypatch.setattr(module, "BLOCK", 32)
    seen = []
    near = module._near_blocks
    monkeypatch.setattr(module, "_near_blocks", lambda boxes, reach: seen.append((boxes.count(), (out := near(boxes, reach)).count())) or out)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(40, 24))
    x = np.repeat(centres, 50, axis=0) + rng.normal(size=(2000, 24)) * 0.05
    rows = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    got = vector_join(rows).toPandas().set_index("vec_id")
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    assert (got.n_links.sort_index().to_numpy() == (unit @ unit.T >= 0.95).sum(axis=1) - 1).all()
    blocks, pairs = seen[0]
    assert blocks >= 60 and pairs < 0.4 * blocks * (blocks + 1) / 2, (blocks, pairs)
    print("blocks, pairs", blocks, pairs)


def test_no_vectors(spark):
    assert vector_join(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0
    only = spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in vector_join(only).collect()] == [(1, 0, 1, True)]


def test_ids_of_several_texts(spark):
    """Rows of an id with other texts are judged apart, by jaccard_join and decontaminate; odd columns don't matter."""
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text, 0), (1, "other words of this id and no copy at all", 0), (2, text, 0), (None, text, 0), (3, "", 0), (3, None, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, twin long")
    got = jaccard_join(docs)
    assert got.count() == len(rows)
    linked = sorted((str(r["doc_id"]), r["n_links"]) for r in got.collect())
    assert linked == [("1", 0), ("1", 2), ("2", 2), ("3", 0), ("3", 0), ("None", 2)]
    found = decontaminate(docs, spark.createDataFrame([(9, " ".join(f"w{i}" for i in range(5, 25)))], "item_id long, text string"))
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_hit"]) for r in found.collect()) == [("1", 10, 0), ("1", 40, 20), ("2", 40, 20), ("3", 0, 0), ("3", 0, 0), ("None", 40, 20)]


def test_no_documents(spark):
    assert jaccard_join(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def thue_morse(n):
    a = "a"
    while len(a) < n:
        a += a.translate(str.maketrans("ab", "ba"))
    return a


def test_thue_morse_words(spark):
    """Words, and texts of words, on which polynomials modulo a power of two agree, are told apart."""
    from tessera.llm.tokens import Grams, Words, separators

    word = thue_morse(4096)
    other = word.translate(str.maketrans("ab", "ba"))
    for size in (64, 1024, 2048, 4096):
        data = np.frombuffer(f"{word[:size]} {other[:size]}".encode(), np.uint8)
        words = Words(data, np.array([0, len(data)]), separators(b" "))
        assert all(words.hashes(lane)[0] != words.hashes(lane)[1] for lane in (0, 1))
        tokens = np.array([0, 1], dtype=np.uint64)[np.frombuffer((word[:size] + other[:size]).encode(), np.uint8) - 97]
        grams = Grams(tokens, np.array([0, 2 * size]))
        assert len(set(grams.span(np.array([0, size]), np.array([size, 2 * size])).tolist())) == 2
    rest = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(1, f"{word} {rest}"), (2, f"{other} {rest}"), (3, word), (4, other)], "doc_id long, text string")
    from tessera.llm.bytes_dedup import bytes_dedup
    from tessera.llm.substring_dedup import substring_dedup

    assert {r["doc_id"]: r["n_removed"] for r in substring_dedup(docs).collect()} == {1: 60, 2: 60, 3: 0, 4: 0}
    links = {r["doc_id"]: r["n_links"] for r in jaccard_join(docs).collect()}
    assert links == {1: 1, 2: 1, 3: 0, 4: 0}
    found = decontaminate(docs, spark.createDataFrame([(1, word)], "item_id long, text string"))
    assert {r["doc_id"]: r["n_hit"] for r in found.collect()} == {1: 1, 2: 0, 3: 1, 4: 0}
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    first = {}
    for doc, text in rows:
        for i in range(len(text) - 49):
            first.setdefault(text[i : i + 50], doc)
    gone = {doc: len({j for i in range(len(text) - 49) if first[text[i : i + 50]] < doc for j in range(i, i + 50)}) for doc, text in rows}
    assert {r["doc_id"]: r["n_removed"] for r in bytes_dedup(docs).collect()} == gone


def bench_words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


@pytest.mark.parametrize("most_keys", [200_000, 0])
def test_benchmark_passages(spark, documents, texts, most_keys):
    sources = {d: bench_words(t) for d, t in texts if d is not None}
    items = [(1, " ".join(sources[4][10:40])), (2, " ".join(sources[45][500:513]).upper()), (3, "One, two"), (4, None), (5, "..."), (6, " ".join(sources[22][:5])), (10, " ".join(sources[45][600:650]) + " zzz"), (7, "ab " * 20)]
    windows = {i: (len(w), {tuple(w[k : k + min(13, len(w))]) for k in range(max(len(w) - 12, 1))}) for i, t in items if (w := bench_words(t))}
    want = {}
    for doc, ws in sources.items():
        hit, found = set(), set()
        for item, (n, some) in windows.items():
            size = min(13, n)
            for k in range(len(ws) - size + 1):
                if tuple(ws[k : k + size]) in some:
                    hit |= set(range(k, k + size))
                    found.add(str(item))
        want[doc] = (len(ws), len(hit), len(found), len(hit) > 0 and 20 * len(hit) >= len(ws), sorted(found))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate(documents, benchmark, most_keys=most_keys).where("doc_id is not null").collect()
    assert {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"], list(r["items"])) for r in got} == want
    assert len(got) == len([1 for d, _ in texts if d is not None])


def test_no_benchmark(spark, documents):
    out = decontaminate(documents, spark.createDataFrame([], "item_id long, text string"))
    assert out.where("contaminated or n_hit > 0").count() == 0 and out.count() == documents.count()
