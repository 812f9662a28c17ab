import random

import pytest

WORDS = [a + b for a in ("ka", "to", "mi", "ru", "se", "vo") for b in ("n", "la", "rt", "mo", "x", "pe", "")]


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="session")
def texts():
    """(doc_id, text) with nulls, empties, copies, near copies, shared passages, periodic and long texts, repeated rows."""
    rng = random.Random(3)
    passage, line = sentence(rng, 60), sentence(rng, 14)
    base = sentence(rng, 120)
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, base), (5, base), (6, base)]
    for i in range(7, 22):
        words = base.split()
        words[rng.randrange(len(words))] = f"w{i}"
        rows.append((i, " ".join(words)))
    for i in range(22, 40):
        rows.append((i, f"{sentence(rng, rng.randrange(3, 90))}\n{line if i % 2 else line + 'q'}\n{passage if i % 3 == 0 else ''} {sentence(rng, 20)}"))
    rows += [(40, "ab " * 400), (41, "x" * 300), (42, "x" * 120 + "é" * 90), (43, "one two"), (44, "one two"), (45, sentence(rng, 20000)), (46, "a"), (None, sentence(rng, 50))]
    rows += [(4, base), (43, "one two")]
    return rows


@pytest.fixture(scope="session")
def documents(spark, texts):
    """The texts as a table with columns whose names clash with those used inside."""
    rows = [(i, t, "en", f"s{n % 3}", None if t is None else len(t), n, "k") for n, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, removed int, doc string").repartition(3).cache()
