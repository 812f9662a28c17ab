import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from tessera.llm.prefix_trie import prefix_trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string, d long, k1 string, part string"


def expected(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for *_, r, t in sorted(x)] for c, x in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        built = tuple(own.get(base, [])[:h] + turns[h:])
        for d in range(len(built) + 1):
            members[built[:d]].append(c)
        ends[built].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, tokens = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children[node]
        leaves[node] = sum(leaves[x] for x in below) or 1
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        tokens[node] = sum(tokens[x] for x in below) + (len(members[node]) - 1) * words
    sha = lambda ids: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    return sorted(str((min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(children[n]), leaves[n], tokens[n], sha(ends[n]))) for n, m in members.items())


def rows_of(rng):
    turns = [("user", "a b  c"), ("user", "a b  c "), ("assistant", "x"), (None, "x"), ("", None), ("user", ""), ("user", "é 中 z")]
    rows = []
    for c in [*range(60), 83, 85, 99, 120, -3, -20, -41]:
        n = rng.randrange(1, 7)
        rows += [(c, t if rng.random() < 0.9 else None, *rng.choice(turns)) for t in range(n)]
    rows += [(7, 1, "user", "tie b"), (7, 1, "user", "tie a"), (7, 1, "assistant", "tie c"), (8, 0, "user", "same"), (8, 0, "user", "same"), (None, 0, "user", "nobody")]
    long = [(t, "user", f"w{t} " * (t % 4)) for t in range(90)]
    rows += [(c, *x) for c in (200, 201, 202, 215) for x in long[: 90 - c % 7]]
    rows += [(c, 0, "user", "hello there") for c in range(300, 420)]
    return rows


@pytest.mark.parametrize("height", [2, 3, 16])
def test_every_node(spark, height):
    """Against a trie built by hand, with bands of several levels, ties, nulls, repeated turns and clashing columns."""
    rows = rows_of(random.Random(height))
    got = prefix_trie(spark.createDataFrame([(*r, 1, "k", "p") for r in rows], SCHEMA).repartition(5), height).select(COLUMNS).collect()
    assert sorted(str(tuple(r)) for r in got) == expected(rows)


def test_few_rows(spark):
    table = lambda rows: spark.createDataFrame([(*r, 1, "k", "p") for r in rows], SCHEMA)
    assert prefix_trie(table([])).count() == 0
    assert prefix_trie(table([(None, 1, "user", "x")])).count() == 0
    turnless = [(c, 0, "user", "x") for c in range(21, 40)]  # some lose their only turn, and their base is absent
    got = prefix_trie(table(turnless)).select(COLUMNS).collect()
    assert sorted(str(tuple(r)) for r in got) == expected(turnless)
