import gzip
import math
import os
import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera import catalogue, config
from tessera.functions import text
from tessera.operators import adjacency, communities, graph, intervals, pairs, popgen, segments
from tessera.sources import sinks, vcf
from tessera.sources import text as sources
from tessera.streaming import pairs as streaming

SF = "/root/testdata/sf0.001"


def normal(frame, columns):
    cell = lambda v: "null" if v is None or v != v else f"{float(v):.9g}" if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
    return sorted(tuple(map(cell, r)) for r in frame[columns].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_against_sql(spark, name):
    db = duckdb.connect()
    for t in ("supplier", "lineitem", "customer", "part", "embeddings"):
        db.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = db.sql(catalogue.SQL[name]).df()
    got = catalogue.QUERIES[name](spark, SF).toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    assert normal(got, sorted(want.columns)) == normal(want, sorted(want.columns))


def test_numbers(spark):
    given = ["1.5", " 2 ", "1_000", "nan", "-inf", "1e3", "3.5d", "abc", "", "+.5", "5.", "0x1"]
    rows = spark.createDataFrame([(g,) for g in given], "t string").select("t", text.parse_float(F.col("t")).alias("f"), text.parse_count(F.col("t")).alias("c")).collect()
    got = {r["t"]: (r["f"], r["c"]) for r in rows}
    for g in given:
        try:
            value = float(g)
        except ValueError:
            value = None
        assert got[g][0] == value or value != value and got[g][0] != got[g][0]
        try:
            whole = int(g)
        except ValueError:
            whole = None
        assert got[g][1] == whole
    values = [0.1, 1 / 3, 12345678901.5, 1e-7, 5.0, float("nan"), None]
    out = spark.createDataFrame([(v,) for v in values], "v double").select(text.format_general("v").alias("s")).collect()
    assert [r["s"] for r in out] == [format(v, ".10g") if v is not None else None for v in values]
    assert text.threshold_names(5.0)[0] == "number_of_segments_ge_5_cM" and text.threshold_names(2.5)[1] == "total_length_of_segments_ge_2.5_cM"


def test_worked_pairs(spark):
    rows = spark.createDataFrame([("B", "A", 4.0, "1"), ("A", "B", 6.0, "2"), ("A", "C", 5.0, "1")], "id1 string, id2 string, length_cm double, chrom string")
    found = pairs.canonical(rows)
    once = sorted(map(tuple, pairs.summary(pairs.partial(found, 5.0), 5.0).collect()))
    assert once == [("A", "B", 2, 10.0, 52.0, 5.0, 4.0, 6.0, 1.0, 1, 6.0), ("A", "C", 1, 5.0, 25.0, 5.0, 5.0, 5.0, 0.0, 1, 5.0)]
    assert sorted(map(tuple, pairs.summary(pairs.merged(pairs.partial(found, 5.0, "chrom")), 5.0).collect())) == once
    again = pairs.statistics_of(pairs.summary(pairs.partial(found, 5.0), 5.0), 5.0)
    assert sorted(map(tuple, pairs.summary(pairs.merged(pairs.as_printed(again)), 5.0).collect())) == once


def test_segment_files(spark, tmp_path):
    good = "A\t1\tB\t2\t1\t101\t200\t4.5\r\n\nB\t1\tA\t1\t1\t5\t9\t1e1\n"
    (tmp_path / "a.ibd").write_text(good)
    with gzip.open(tmp_path / "b.ibd.gz", "wt") as f:
        f.write(good)
    rows = sources.read_segments(spark, [str(tmp_path / "a.ibd"), str(tmp_path / "b.ibd.gz")])
    assert rows.count() == 4 and rows.agg(F.sum("length_cm")).first()[0] == 29.0
    for i, (line, why) in enumerate({"A\t1\tB": "field_count", "\t1\tB\t2\t1\t1\t2\t3": "empty_id", "A\t1\tA\t2\t1\t1\t2\t3": "self_pair", "A\t1\tB\t2\t1\t1\t2\tx": "not_a_number", "A\t1\tB\t2\t1\t1\t2\tinf": "not_finite", "A\t1\tB\t2\t1\t1\t2\t-1": "negative"}.items()):
        (tmp_path / f"bad{i}.ibd").write_text(line + "\n")
        with pytest.raises(ValueError, match=why):
            sources.read_segments(spark, [str(tmp_path / f"bad{i}.ibd")])


def test_summary_files(spark, tmp_path):
    rows = spark.createDataFrame([("A", "B", 4.25, "1"), ("A", "B", 6.0, "2")], "id1 string, id2 string, length_cm double, chrom string")
    table = pairs.summary(pairs.partial(pairs.canonical(rows), 5.0), 5.0)
    sinks.write_pair_summary(table, str(tmp_path / "out"), compressed=True)
    back = sources.read_summaries(spark, str(tmp_path / "out"), 5.0)
    assert back.first()["total_IBD_length_cM"] == 10.25
    assert sources.read_edges(spark, str(tmp_path / "out"), "total_IBD_length_cM").first()["weight"] == 10.25
    with pytest.raises(ValueError, match="lacks"):
        sources.read_summaries(spark, str(tmp_path / "out"), 7.0)
    sinks.write_pair_summary(table.withColumn("number_of_IBD_segments", F.lit(0).cast("long")), str(tmp_path / "bad"))
    with pytest.raises(ValueError, match="no_segments"):
        sources.read_summaries(spark, str(tmp_path / "bad"), 5.0)


def test_small_files(spark, tmp_path):
    (tmp_path / "s").write_text("b\n\n a \nc\n")
    assert [r["id"] for r in sources.read_samples(spark, str(tmp_path / "s")).orderBy("idx").collect()] == ["b", "a", "c"]
    (tmp_path / "d").write_text("b\nb\n")
    with pytest.raises(ValueError, match="2 times"):
        sources.read_samples(spark, str(tmp_path / "d"))
    (tmp_path / "bed").write_text("chr1\t100\t200\tgap\n6  5 9 x\n")
    assert sources.read_regions(spark, str(tmp_path / "bed"), "chr1").count() == 1
    (tmp_path / "map").write_text("# c\n\n1 rs 0.5 100\n1 . 1.5 300\n")
    assert sources.read_map(spark, str(tmp_path / "map")).count() == 2
    (tmp_path / "m").write_text("name\tlevel_1\nx\tC1\ny\tC1.1\n")
    assert {r["id"] for r in sources.read_membership(spark, str(tmp_path / "m"), "level_1").collect()} == {"x", "y"}
    with pytest.raises(ValueError, match="lacks"):
        sources.read_membership(spark, str(tmp_path / "m"), "level_9")
    (tmp_path / "p").write_text("#IID\tSEX\nx\t1\n")
    assert sources.read_genotyped(spark, str(tmp_path / "p")).first()["id"] == "x"
    (tmp_path / "f").write_text("#POP1\tPOP2\tHUDSON_FST\nA\tB\t0.5\nA\tC\tnone\n")
    values = {r["cluster_2"]: r["hudson_fst"] for r in sources.read_fst(spark, str(tmp_path / "f")).collect()}
    assert values["B"] == 0.5 and math.isnan(values["C"])
    assert sources.per_chromosome("d/{chr}.vcf", ["1"]) == {"1": "d/1.vcf"}
    sources.must_exist(spark, str(tmp_path / "f"))
    with pytest.raises(FileNotFoundError):
        sources.must_exist(spark, str(tmp_path / "none"))


def test_variant_files(spark, tmp_path):
    (tmp_path / "v.vcf").write_text("##x\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\ta\tb\nchr1\t10\t.\tA\tG\t.\t.\t.\tGT:DP\t0|1:3\t1|1:2\nchr1\t20\t.\tA\tG,T\t.\t.\t.\tGT\t0/1\t.|2\n")
    rows = vcf.read_vcf(spark, str(tmp_path / "v.vcf")).orderBy("pos").collect()
    assert [tuple(g) for g in rows[0]["gts"]] == [(0, 1, True), (1, 1, True)] and [tuple(g) for g in rows[1]["gts"]] == [(0, 1, False), (None, 2, True)]
    assert [r["id"] for r in vcf.vcf_samples(spark, str(tmp_path / "v.vcf")).collect()] == ["a", "b"]


def test_touching_regions(spark):
    s = spark.createDataFrame([("chr1", 101, 200), ("chr2", 1, 5)], "chrom string, start long, end long")
    for start, end, left in ((200, 300, 2), (199, 300, 1), (0, 100, 2), (0, 101, 1)):
        r = spark.createDataFrame([("1", start, end)], "chrom string, start long, end long")
        for most in (10, 0):
            assert intervals.overlapping(s, r, most=most).count() == left
            assert intervals.overlapping(s, r, "left_semi", most=most).count() == 2 - left


@pytest.mark.parametrize(("children", "decision", "sizes"), [([45, 30, 10, 15], "split", [45, 30, 25]), ([45, 30, 10], "rejected", [85]), ([10, 15], "rejected", [25]), ([30, 12, 10], "split", [30, 22]), ([100], "unsplit", [100]), ([45, 30], "split", [45, 30]), ([5, 4], "ineligible", [9])])
def test_split_table(spark, children, decision, sizes):
    rows, n = [], 0
    for c, size in enumerate(children):
        rows += [("C1", f"{n + i:04d}", f"k{c}") for i in range(size)]
        n += size
    proposed = spark.createDataFrame(rows, "parent string, id string, child string")
    assert communities.split_decisions(proposed, 20).first()["decision"] == decision
    labels = communities.child_labels(proposed, 20).groupBy("label").count().orderBy("label").collect()
    assert [r["count"] for r in labels] == sizes


@pytest.mark.parametrize("regions", [0, 1, 7, 100_000])
def test_many_regions_on_one_chromosome(spark, regions):
    """The index of merged regions against a search of all of them, and against bins."""
    import bisect

    rng = random.Random(regions)
    size = 3_000_000_000 if regions > 10 else 2_000
    given = [(rng.choice(["1", "chr1"]), a := rng.randrange(size), a + rng.choice([0, 1, 50, 9_000])) for _ in range(regions)] + [("2", 5, 10)]
    rows = [(f"{i}", rng.choice(["chr1", "1", "2", "3"]), a := rng.randrange(1, size), a + rng.choice([0, 30, 20_000])) for i in range(4_000)]
    s = spark.createDataFrame(rows, "name string, chrom string, start long, end long")
    r = spark.createDataFrame(given, "chrom string, start long, end long")
    own = {}
    for c, a, b in given:
        own.setdefault(c.removeprefix("chr"), []).append((a, b))
    want = set()
    for c, regions_ in own.items():
        regions_.sort()
        reach, most = [], -1
        for _, b in regions_:
            most = max(most, b)
            reach.append(most)
        for name, chrom, start, end in rows:
            at = bisect.bisect_left(regions_, (end, -1))
            if chrom.removeprefix("chr") == c and at and reach[at - 1] > start - 1:
                want.add(name)
    got = {x["name"] for x in intervals.overlapping(s, r, "left_semi").collect()}
    assert got == want and {x["name"] for x in intervals.overlapping(s, r).collect()} == {x[0] for x in rows} - want
    if regions <= 10:
        assert {x["name"] for x in intervals.overlapping(s, r, "left_semi", most=0).collect()} == want


def test_graph_faults(spark):
    samples = spark.createDataFrame([("a",), ("b",), ("c",)], "id string")
    edge = lambda *rows: spark.createDataFrame(rows, "src string, dst string, weight double")
    assert graph.build(edge(("b", "a", 1.0), ("a", "b", 0.0)), samples).count() == 1
    for bad in (edge(("a", "x", 1.0)), edge(("a", "b", 1.0), ("b", "a", 2.0)), edge(("a", "b", 0.0))):
        with pytest.raises(ValueError):
            graph.build(bad, samples)


@pytest.mark.parametrize("method", ["louvain", "leiden"])
def test_planted_communities(spark, method):
    """Two groups of four linked cliques of five; one vertex alone."""
    rows = [("C1", f"{i:02d}", f"{j:02d}", 4.0 if i // 5 == j // 5 else 2.0 if i // 10 == j // 10 else 0.1) for i in range(20) for j in range(i + 1, 20)]
    edges = spark.createDataFrame(rows, "parent string, a string, b string, w double")
    vertices = spark.createDataFrame([("C1", f"{i:02d}") for i in range(21)], "parent string, v string")
    found = {r["v"]: r["c"] for r in communities.communities(edges, vertices, method).collect()}
    assert {found[f"{i:02d}"] for i in range(10)} == {"00"} and {found[f"{i:02d}"] for i in range(10, 20)} == {"10"} and found["20"] == "20"


def _partition(spark, edges, vertices, method, in_task, trace=None):
    """Communities of a weighted graph over named vertices, and the number of gainful moves left."""
    rows = spark.createDataFrame([("P", *e) for e in edges], "parent string, a string, b string, w double")
    found = communities.communities(rows, spark.createDataFrame([("P", v) for v in vertices], "parent string, v string"), method, 1.0, in_task, trace)
    labels = found.select("parent", "v", "c")
    return {r["v"]: r["c"] for r in found.collect()}, communities.moves_left(rows, labels, method == "louvain").count()


@pytest.mark.parametrize("in_task", [0, communities.IN_TASK])
def test_ring_of_cliques(spark, in_task):
    """Cliques that single edges join to a ring are its communities, in rounds over tables and in one task."""
    size, cliques = 6, 7
    name = lambda c, i: f"v{c}{i}"
    edges = [(name(c, i), name(c, j), 1.0) for c in range(cliques) for i in range(size) for j in range(i + 1, size)]
    edges += [(name(c, 0), name((c + 1) % cliques, 1), 1.0) for c in range(cliques)]
    trace = []
    found, left = _partition(spark, edges, [name(c, i) for c in range(cliques) for i in range(size)] + ["alone"], "louvain", in_task, trace)
    assert found == {name(c, i): name(c, 0) for c in range(cliques) for i in range(size)} | {"alone": "alone"} and left == 0
    assert len(trace) <= 25 and all(made >= 1 for _, _, made in trace)


def test_path(spark):
    """A path of equal edges, where every vertex can go either way: many move in each round, and none is left that would."""
    n = 90
    edges = [(f"v{i:02d}", f"v{i + 1:02d}", 1.0) for i in range(n - 1)]
    trace = []
    found, left = _partition(spark, edges, [f"v{i:02d}" for i in range(n)], "louvain", 0, trace)
    groups = {}
    for v, c in found.items():
        groups.setdefault(c, []).append(int(v[1:]))
    assert left == 0 and 5 <= len(groups) <= 20 and all(max(g) - min(g) + 1 == len(g) for g in groups.values())
    assert len(trace) <= 40 and trace[0][2] >= n / 6


def test_task_and_rounds_agree(spark):
    """In one task or in rounds, Leiden leaves no gainful move, on a graph whose communities blur."""
    rng = random.Random(8)
    edges = [(f"v{i:02d}", f"v{j:02d}", round(rng.uniform(0.5, 2), 3)) for i in range(40) for j in range(i + 1, 40) if rng.random() < (0.6 if i // 10 == j // 10 else 0.12)]
    total = sum(w for *_, w in edges)
    quality = []
    for in_task in (0, communities.IN_TASK):
        found, left = _partition(spark, edges, [f"v{i:02d}" for i in range(40)], "leiden", in_task)
        assert left == 0 and all(min(v for v in found if found[v] == c) == c for c in found.values())
        strength, inside = {}, 0.0
        for a, b, w in edges:
            inside += w * (found[a] == found[b])
            for v in (a, b):
                strength[found[v]] = strength.get(found[v], 0) + w
        quality.append(inside / total - sum((k / (2 * total)) ** 2 for k in strength.values()))
    assert abs(quality[0] - quality[1]) < 0.01 and min(quality) > 0.3


@pytest.mark.parametrize("held", [None, 150])
def test_blurred_graph_takes_few_rounds(spark, monkeypatch, held):
    """A graph all but without communities, where every move makes others gainful; also when a task holds but a share of it."""
    if held:
        monkeypatch.setattr(communities, "IN_TASK", held)
        monkeypatch.setattr(communities, "TOGETHER", held)
    rng, trace = random.Random(3), []
    edges = [(f"v{i:02d}", f"v{j:02d}", round(rng.uniform(0.5, 2), 3)) for i in range(60) for j in range(i + 1, 60) if rng.random() < 0.5]
    found, left = _partition(spark, edges, [f"v{i:02d}" for i in range(60)], "louvain", 0, trace)
    assert left == 0 and set(found) == {f"v{i:02d}" for i in range(60)} and all(found[c] == c for c in found.values())
    assert all(made >= 1 for _, _, made in trace) and len(trace) <= (30 if held else 8)


@pytest.mark.parametrize("method", ["louvain", "leiden"])
def test_rounds_over_blocks(spark, monkeypatch, method):
    """A graph whose communities blur, in many blocks: no gainful move is left, and two contractions lose none of its strength."""
    monkeypatch.setattr(adjacency, "LINKS", 100)
    rng = random.Random(4)
    edges = [(f"v{i:02d}", f"v{j:02d}", round(rng.uniform(0.5, 2), 3)) for i in range(60) for j in range(i + 1, 60) if rng.random() < (0.6 if i // 15 == j // 15 else 0.15)]
    of = []
    begun = adjacency.Packed.state

    def state(graph):
        out = begun(graph)
        of.append((graph.many, out.first()["m2"]))
        return out

    monkeypatch.setattr(adjacency.Packed, "state", state)
    found, left = _partition(spark, edges, [f"v{i:02d}" for i in range(60)] + ["w"], method, 0)
    assert left == 0 and found["w"] == "w" and all(found[c] == c for c in found.values()) and len(set(found.values())) < 12
    assert of[0][0] >= 8 and len(of) >= 2
    assert all(abs(m2 - 2 * sum(w for *_, w in edges)) < 1e-6 for _, m2 in of)


def test_chosen_vertices_fit_a_task(monkeypatch):
    """A round moves no more vertices of a large graph than a task can hold with the links among them; quality rises until none would move."""
    monkeypatch.setattr(adjacency, "HELD", 300)
    monkeypatch.setattr(adjacency, "WEIGHTS", 100)
    draw, n, of = np.random.default_rng(6), 60, 4
    weights = np.triu(np.where(draw.random((n, n)) < 0.5, draw.integers(1, 50, (n, n)), 0), 1)
    weights = (weights + weights.T).astype(float)
    rows = []
    for block in range(of):
        v, to = np.nonzero(weights[block::of])
        cells = {"at": np.searchsorted(v, np.arange(n // of + 1)).astype(np.int32), "to": to.astype(np.int32), "w": weights[block::of][v, to], "k": weights[block::of].sum(1)}
        rows.append({"parent": "P", "block": block, "of": of} | {x: y.tobytes() for x, y in cells.items()})
    state = adjacency._fresh({"parent": "P", "n": n, "m2": weights.sum(), "k": weights.sum(1).tobytes()}, np.arange(n), None)
    quality = []
    for _ in range(100):
        seen = [adjacency._looked(row | {x: state[x] for x in ("m2", "c", "bound", "tot")}, 1.0) for row in rows]
        state = adjacency._chosen(state, seen, 1.0)
        quality.append(state["quality"])
        if state["done"]:
            break
        met = [x for row in rows for x in adjacency._collected(row | {x: state[x] for x in ("m2", "c", "bound", "tot", "chosen")})]
        assert 0 < sum(len(x["v"]) // 4 for x in met) < n and sum(len(x["x"]) // 4 for x in met) <= 2 * 300
        moved = adjacency._moved(pa.Table.from_pylist(met), 1.0).to_pylist()[0]
        c = np.frombuffer(state["c"], np.int32).copy()
        c[np.frombuffer(moved["v"], np.int32)] = np.frombuffer(moved["c"], np.int32)
        state = adjacency._fresh(state, c, None)
    assert state["done"] and len(quality) > 3 and all(b > a for a, b in zip(quality, quality[1:], strict=False))
    c = np.frombuffer(state["c"], np.int32)
    to, k = weights @ np.eye(c.max() + 1)[c], weights.sum(1)
    gain = to - k[:, None] * (np.bincount(c, k) - np.eye(c.max() + 1)[c] * k[:, None]) / weights.sum()
    assert (gain.max(1) <= gain[np.arange(n), c] + 1e-6).all()


def test_more_vertices_than_go_to_every_task(spark, monkeypatch):
    """Parents with too many vertices to send their state to every task are worked on by joins."""
    monkeypatch.setattr(adjacency, "KNOWN", 10)
    edges = [(f"v{c}{i}", f"v{c}{j}", 1.0) for c in range(3) for i in range(5) for j in range(i + 1, 5)] + [("v00", "v11", 1.0), ("v10", "v21", 1.0)]
    found, left = _partition(spark, edges, [f"v{c}{i}" for c in range(3) for i in range(5)], "louvain", 0)
    assert found == {f"v{c}{i}": f"v{c}0" for c in range(3) for i in range(5)} and left == 0


@pytest.mark.parametrize("leiden", [False, True])
def test_a_task_looks_at_those_that_gain(monkeypatch, leiden):
    """In a graph where a vertex has hundreds of neighbours a move doesn't cost a step for each of them; what is found is a local optimum."""
    steps = []

    class Counted(communities.deque):
        def popleft(self):
            steps.append(1)
            return super().popleft()

    monkeypatch.setattr(communities, "deque", Counted)
    draw, n = np.random.default_rng(5), 1000
    a, b = np.nonzero(np.triu(draw.random((n, n)) < 0.3, 1))
    w = draw.integers(1, 50, len(a)).astype(float)
    graph = communities._Local(a, b, w, n)
    found = graph.solved(np.arange(n), 1.0, leiden)
    assert len(steps) < 20 * n
    weights, labels = np.zeros((n, n)), np.unique(found, return_inverse=True)[1]
    weights[a, b] = weights[b, a] = w
    to, tot = weights @ np.eye(labels.max() + 1)[labels], np.bincount(labels, graph.k)
    gain = to - graph.k[:, None] * (tot - np.eye(len(tot))[labels] * graph.k[:, None]) / graph.total
    assert (gain.max(1) <= gain[np.arange(n), labels] + 1e-9 * graph.total).all()


def test_cut_tables_end(spark):
    """Tables cut on the way are deleted, buckets with their name in the catalogue; what is returned stays readable."""
    from tessera.shared import cut, passing

    where = spark.conf.get("spark.checkpoint.dir").removeprefix("file://")
    before = {x for x in os.listdir(where) if x.startswith("cut-")}
    with passing(spark) as keep:
        cut(spark.range(5))
        with passing(spark) as keep_inner:
            inner = keep_inner(cut(spark.range(7).withColumnRenamed("id", "v"), ["v"]))
        last = keep(cut(inner.where("v > 2")))
    assert last.count() == 4 and len({x for x in os.listdir(where) if x.startswith("cut-")} - before) == 1
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("cut_")]


def test_moves_go_on_until_none_is_left(spark):
    """A path on which one vertex after the other joins the community that came along it."""
    n = 12
    rows = [("C1", f"{i:02d}", f"{i + 1:02d}", 1.0 + (n - i) ** 2) for i in range(n)]
    edges = spark.createDataFrame(rows, "parent string, a string, b string, w double")
    nodes = spark.createDataFrame([("C1", f"{i:02d}", f"{i:02d}", None) for i in range(n + 1)], "parent string, v string, c string, bound string")
    c = {r["v"]: r["c"] for r in communities._move(edges, nodes, 1.0, False).collect()}
    k, total = dict.fromkeys(c, 0.0), {}
    for _, a, b, w in rows:
        k[a], k[b] = k[a] + w, k[b] + w
    for v in c:
        total[c[v]] = total.get(c[v], 0.0) + k[v]
    m2 = sum(k.values())
    gain = lambda v, to: sum(w for _, a, b, w in rows if v in (a, b) and c[b if v == a else a] == to) - k[v] * (total.get(to, 0.0) - (k[v] if c[v] == to else 0)) / m2
    left = [v for v in c for _, a, b, _ in rows if v in (a, b) and gain(v, c[b if v == a else a]) > gain(v, c[v]) + 1e-4]
    assert left == []


def test_pairs_are_dealt_by_their_number(spark, monkeypatch):
    """Tasks of the summary in two steps grow in number with the lines, not in size, and sum up the same."""
    from tessera import catalogue
    from tessera.plans import adapters

    monkeypatch.setattr(adapters, "PART", 500)
    folder = "/root/testdata/sf0.001"
    out = catalogue.pair_summary_two_phase(spark, folder)
    assert out.rdd.getNumPartitions() >= spark.read.parquet(f"{folder}/lineitem.parquet").count() // 500
    key = lambda r: (r["ID1"], r["ID2"], r["number_of_IBD_segments"], round(r["total_IBD_length_cM"], 6), round(r["sd_IBD_length_cM"], 4))
    assert sorted(map(key, out.collect())) == sorted(map(key, catalogue.pair_summary_genome(spark, folder).collect()))


def test_segment_errors_parse_once(spark):
    """The number of a line is parsed at one place of the plan, and every kind of error is still told."""
    lines = ["a 1 b 2 c 1 2 1_0.5", "a 1 b 2 c 1 2", " 1 b 2 c 1 2 3", "a 1 a 2 c 1 2 3", "a 1 b 2 c 1 2 x", "a 1 b 2 c 1 2 inf", "a 1 b 2 c 1 2 NaN", "a 1 b 2 c 1 2 -1", "a 1 b 2 c 1 2 1e999"]
    rows = spark.createDataFrame([(i, x.split(" ")) for i, x in enumerate(lines)], "i int, fields array<string>")
    out = rows.select("i", pairs.segment_errors(F.col("fields")).alias("error"))
    assert [r["error"] for r in out.orderBy("i").collect()] == [None, "field_count", "empty_id", "self_pair", "not_a_number", "not_finite", "not_finite", "negative", "not_finite"]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("try_cast") + out._jdf.queryExecution().optimizedPlan().toString().count("cast(") <= 2


def test_hardy_weinberg(spark):
    rows = spark.createDataFrame([(10, 20, 10), (0, 0, 0), (5, 0, 5), (100, 0, 0)], "a long, b long, c long")
    p = [r["p"] for r in rows.select(popgen.hwe_midp("a", "b", "c").alias("p")).collect()]
    assert p[1] == 1.0 and p[0] > 0.8 and p[2] < 0.01 and p[3] == 0.5


def test_exact_test_of_large_cohorts(spark):
    """Against sums of logarithms, also where the observed outcome all but vanishes beside the likeliest."""
    cases = [(550, 0, 550), (1500, 100, 1500), (500, 0, 500), (300, 200, 100), (1000, 30, 5), (0, 1000, 0), (7000, 2900, 300), (7000, 2901, 301), (1, 1, 1), (3, 0, 0), (20, 5, 0), (0, 3, 40)]
    got = spark.createDataFrame(cases, "a long, b long, c long").select("a", "b", "c", popgen.hwe_midp("a", "b", "c").alias("p")).collect()
    for a, b, c, p in map(tuple, got):
        n, rare = a + b + c, 2 * min(a, c) + b
        logs = {h: h * math.log(2) - math.lgamma(h + 1) - math.lgamma((rare - h) // 2 + 1) - math.lgamma(n - h - (rare - h) // 2 + 1) for h in range(rare % 2, rare + 1, 2)}
        most = max(logs.values())
        each = {h: math.exp(x - most) for h, x in logs.items()}
        less = sum(x / 2 if abs(logs[h] - logs[b]) < 1e-8 else x if logs[h] < logs[b] else 0.0 for h, x in each.items())
        assert p is not None and abs(p - less / sum(each.values())) < 1e-7


def test_fst(spark):
    counts = spark.createDataFrame([("A", "v", 20, 15), ("B", "v", 10, 2), ("C", "v", 10, 2), ("A", "w", 20, 10), ("B", "w", 10, 5), ("C", "w", 10, 5), ("D", "w", 1, 1)], "cluster string, variant string, n long, ac long")

    def closed(x, y):
        over = under = 0
        for (n1, a1), (n2, a2) in zip(x, y, strict=True):
            p, q = a1 / n1, a2 / n2
            over += (p - q) ** 2 - p * (1 - p) / (n1 - 1) - q * (1 - q) / (n2 - 1)
            under += p * (1 - q) + q * (1 - p)
        return over / under

    got = {(r["cluster_1"], r["cluster_2"]): r["hudson_fst"] for r in popgen.hudson(counts).collect()}
    assert got[("A", "B")] == pytest.approx(closed([(20, 15), (20, 10)], [(10, 2), (10, 5)])) and set(got) == {("A", "B"), ("A", "C"), ("B", "C")}
    members = spark.createDataFrame([(f"{c}{i}", c) for c in "ABC" for i in range(5)], "sample string, cluster string")
    final, merges, history = popgen.clump(counts.where("cluster <> 'D'"), members, 0.01, 5)
    assert {r["cluster"]: r["final"] for r in final.collect()} == {"A": "A", "B": "B", "C": "B"}
    assert [tuple(r)[:3] for r in merges.collect()] == [(1, "B", "C")] and history.count() == 4
    one = popgen.hudson(counts.where("cluster <> 'D'").withColumn("cluster", F.when(F.col("cluster") == "C", "B").otherwise(F.col("cluster"))).groupBy("cluster", "variant").agg(F.sum("n").alias("n"), F.sum("ac").alias("ac")))
    assert history.where("iteration = 1").first()["hudson_fst"] == pytest.approx(one.first()["hudson_fst"])


def test_clumping_only_adds(spark, monkeypatch):
    """A merge writes the merged cluster's counts, its pairs with the others and its size, nothing else anew."""
    written = []
    add = popgen.Growing.add
    monkeypatch.setattr(popgen.Growing, "add", lambda self, rows: (written.append(rows.count()), add(self, rows))[1])
    rng = random.Random(1)
    base = [[rng.randrange(3) for _ in range(40)] for _ in range(3)]
    clusters = spark.createDataFrame([(f"s{c}{i}", f"c{c}") for c in range(6) for i in range(5)], "sample string, cluster string")
    dosages = spark.createDataFrame([(f"s{c}{i}", "1", v, f"v{v:02d}", base[c % 3][v] if rng.random() < 0.8 else rng.randrange(3)) for c in range(6) for i in range(5) for v in range(40)], "sample string, chrom string, pos long, variant string, dosage int")
    final, merges, pairs = popgen.clump(popgen.allele_counts(dosages, clusters), clusters, 0.05, 2)
    n = merges.count()
    assert n >= 2 and written[:3] == [6, 6 * 40, 15]
    assert written[3:] == [x for step in range(1, n + 1) for x in (40, 1, 5 - step)]
    assert {(r["iteration"], r["count"]) for r in pairs.groupBy("iteration").count().collect()} == {(i, (6 - i) * (5 - i) // 2) for i in range(n + 1)}
    assert final.select("final").distinct().count() == 6 - n


def test_pruning(spark):
    f = spark.createDataFrame([("1", i, f"v{i}", m) for i, m in enumerate([0.1, 0.4, 0.3, 0.2, 0.5])], "chrom string, pos long, variant string, maf double")
    links = spark.createDataFrame([("1", "v0", "v1", 0.9), ("1", "v1", "v2", 0.9), ("1", "v2", "v3", 0.9)], "chrom string, variant_1 string, variant_2 string, r2 double")
    assert {r["variant"] for r in popgen.pruned(f, links).collect()} == {"v1", "v3", "v4"}


def test_segments(spark):
    """Against a search marker by marker."""
    rng = random.Random(2)
    n, haps = 150, 12
    rows = [[rng.randrange(2) for _ in range(n)] for _ in range(haps)]
    rows[5][20:110] = rows[2][20:110]
    rows[5][60] = 1 - rows[2][60]
    rows[9][100:150] = rows[0][100:150]
    alleles = spark.createDataFrame([("1", 100 * i, f"s{h // 2}", h % 2, rows[h][i]) for h in range(haps) for i in range(n)], "chrom string, pos long, sample string, hap int, allele int")
    positions = spark.createDataFrame([("1", 100 * i, i / 10) for i in range(n)], "chrom string, pos long, cm double")
    rules = config.Detection(min_seed=2.5, min_extend=1.0, min_output=3.0, min_markers=20, min_mac=1, max_gap=300)
    mac = [min(c := sum(r[i] for r in rows), haps - c) for i in range(n)]
    keep = [i for i in range(n) if mac[i] >= 1]
    want = set()
    for a in range(haps):
        for b in range(a + 1, haps):
            if a // 2 == b // 2:
                continue
            runs, cur = [], None
            for k, i in enumerate(keep):
                if rows[a][i] == rows[b][i]:
                    cur = (cur[0], k) if cur else (k, k)
                elif cur:
                    runs.append(cur)
                    cur = None
            runs += [cur] if cur else []
            cm = lambda r: (keep[r[1]] - keep[r[0]]) / 10  # noqa: B023, E731
            runs = [(r, cm(r) >= 2.5 and r[1] - r[0] + 1 >= 20) for r in runs if cm(r) >= 1.0]
            groups = []
            for r, seed in runs:
                if groups and 100 * (keep[r[0]] - keep[groups[-1][0][1]]) <= 300:
                    groups[-1] = ((groups[-1][0][0], r[1]), groups[-1][1] or seed)
                else:
                    groups.append((r, seed))
            want |= {(f"s{a // 2}", a % 2, f"s{b // 2}", b % 2, 100 * keep[r[0]], 100 * keep[r[1]]) for r, seed in groups if seed and cm(r) >= 3.0}
    got = {tuple(r)[:4] + (r["start"], r["end"]) for r in segments.detect(alleles, positions, rules, window=1).collect()}
    assert got == want and len(want) >= 2


@pytest.mark.parametrize("window", [1, 2, 64])
def test_seeds_only(spark, window):
    """Half of the samples carry one haplotype along a stretch too short for a seed, a few pairs share a long one: only
    these are ever paired, once for each window's end, whatever the windows are."""
    rng = random.Random(window)
    n, haps = 400, 60
    rows = [[rng.randrange(2) for _ in range(n)] for _ in range(haps)]
    for h in range(0, haps, 2):
        rows[h][150:190] = rows[0][150:190]
    rows[11][30:330] = rows[4][30:330]
    rows[21][300:400] = rows[40][300:400]
    rows[33][0:90] = rows[2][0:90]
    alleles = spark.createDataFrame([("1", 100 * i, f"s{h:02d}", 0, rows[h][i]) for h in range(haps) for i in range(n)], "chrom string, pos long, sample string, hap int, allele int")
    positions = spark.createDataFrame([("1", 100 * i, i / 10) for i in range(n)], "chrom string, pos long, cm double")
    rules = config.Detection(min_seed=5.0, min_extend=1.0, min_output=5.0, min_markers=20, min_mac=1, max_gap=300)
    markers = positions.selectExpr("chrom", "pos", "cm", "cast(pos / 100 as int) as i")
    ends = markers.groupBy("chrom", F.expr("cast(floor(i / 64) as int)").alias("b")).agg(F.sort_array(F.collect_list(F.struct("pos", "cm"))).alias("at")).selectExpr("chrom", "b", "at.pos as positions", "at.cm as cms")
    found = segments.seeds(segments.packed_blocks(alleles, markers), ends, rules, window).collect()
    want = set()
    for a in range(haps):
        for b in range(a + 1, haps):
            start = 0
            for i in range(n + 1):
                if i == n or rows[a][i] != rows[b][i]:
                    if i - 1 - start >= 50:
                        want.add((a, b, start, i - 1))
                    start = i + 1
    got = {(int(r["sample1"][1:]), int(r["sample2"][1:]), r["last"]): r["first"] for r in found}
    assert len(found) == len(got) == len(want) >= 3
    assert all(start <= got[a, b, last] <= last - 49 for a, b, start, last in want)


def test_seeds_in_pieces(spark):
    """One window's pairs are found by several tasks, each once, and no task holds more of them than a piece and one haplotype's."""
    rng = random.Random(5)
    n, haps = 40, 90
    rows = [[rng.randrange(2) for _ in range(n)] for _ in range(haps)]
    for h in range(0, haps, 2):
        rows[h] = rows[0][:33] + rows[h][33:]
    rules = config.Detection(min_seed=2.0, min_extend=1.0, min_output=2.0, min_markers=20, min_mac=1, max_gap=300)
    bits = np.array([[sum(x << j for j, x in enumerate(r))] for r in rows], np.uint64)
    pieces = [list(zip(a.tolist(), b.tolist(), strict=True)) for a, b, _, _ in segments.prefix_order(bits, np.arange(n) / 10, 0, rules, True, piece=100)]
    assert len(pieces) > 5 and max(map(len, pieces)) <= 100 + 2 * haps and sum(map(len, pieces)) >= 990
    alleles = spark.createDataFrame([("1", 100 * i, f"s{h:02d}", 0, rows[h][i]) for h in range(haps) for i in range(n)], "chrom string, pos long, sample string, hap int, allele int")
    markers = spark.createDataFrame([("1", 100 * i, i) for i in range(n)], "chrom string, pos long, i int")
    ends = spark.createDataFrame([("1", 0, [100 * i for i in range(n)], [i / 10 for i in range(n)])], "chrom string, b int, positions array<long>, cms array<double>")
    blocks = segments.packed_blocks(alleles, markers)
    found = [sorted(map(tuple, segments.seeds(blocks, ends, rules, share=share, piece=50).collect())) for share in (haps, 7)]
    assert found[0] == found[1] and len(found[0]) == len(set(found[0])) == sum(map(len, pieces))
    assert segments.seeds(blocks, ends, rules, share=7).rdd.getNumPartitions() >= math.ceil(haps / 7)


@pytest.mark.parametrize("near", [2, 256])
def test_pairs_of_groups(monkeypatch, near):
    """Pairs that part at a marker, met step by step in small groups and one by one in large ones, are those of a search of all pairs."""
    monkeypatch.setattr(segments, "NEAR", near)
    draw, n, haps = np.random.default_rng(9), 40, 60
    rows = draw.integers(0, 2, (haps, n))
    rows[::2, 5:25] = rows[0, 5:25]
    rows[::3, 12:] = rows[0, 12:]
    bits = np.packbits(np.pad(rows, ((0, 0), (0, 24))).astype(np.uint8), axis=1, bitorder="little").view(np.uint64)
    rules = config.Detection(min_seed=1.0, min_extend=0.5, min_output=1.0, min_markers=10, min_mac=1, max_gap=300)
    for own in (np.ones(haps, bool), np.arange(haps) % 3 == 1):
        got = [(*sorted((i, j)), f, last) for a, b, first, last in segments.prefix_order(bits, np.arange(n) / 10, 0, rules, True, own) for i, j, f in zip(a.tolist(), b.tolist(), first.tolist(), strict=True)]
        want = {(i, j, f, e) for i in range(haps) for j in range(i + 1, haps) for f in range(n) for e in range(f + 10, n)
                if (rows[i, f : e + 1] == rows[j, f : e + 1]).all() and (f == 0 or rows[i, f - 1] != rows[j, f - 1]) and (e == n - 1 or rows[i, e + 1] != rows[j, e + 1])}
        assert len(got) == len(set(got)) and (set(got) == want if own.all() else set(got) < want) and len(got) > 100


def test_segments_end_in_the_task_that_sees_them(spark, monkeypatch):
    """Where a task has all markers of a chromosome, no pair's blocks are joined again."""
    rng = random.Random(12)
    n, haps = 60, 40
    rows = [[rng.randrange(2) for _ in range(n)] for _ in range(haps)]
    for h in range(0, haps, 2):
        rows[h][10:50] = rows[0][10:50]
    alleles = spark.createDataFrame([("1", 100 * i, f"s{h // 2:02d}", h % 2, rows[h][i]) for h in range(haps) for i in range(n)], "chrom string, pos long, sample string, hap int, allele int")
    positions = spark.createDataFrame([("1", 100 * i, i / 10) for i in range(n)], "chrom string, pos long, cm double")
    monkeypatch.delattr(segments, "_compared")
    rules = config.Detection(min_seed=2.5, min_extend=1.0, min_output=3.0, min_markers=20, min_mac=1, max_gap=300)
    found = segments.detect(alleles, positions, rules).collect()
    assert len(found) == len({(r["id1"], r["hap1"], r["id2"], r["hap2"]) for r in found}) == 190 and all(r["start"] <= 1000 and r["end"] >= 4900 for r in found)


def test_stream(spark, tmp_path):
    rows = spark.createDataFrame([("A", "B", float(i)) for i in range(10)], "ID1 string, ID2 string, len double")
    (tmp_path / "in").mkdir()
    rows.limit(6).write.mode("append").parquet(str(tmp_path / "in"))
    stream = lambda: streaming.watch(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "ck"), 5.0).awaitTermination()
    stream()
    rows.subtract(rows.limit(6)).write.mode("append").parquet(str(tmp_path / "in"))
    stream()
    assert tuple(streaming.current(spark, str(tmp_path / "out")).first())[2:5] == (10, 45.0, 285.0)


def test_parameters():
    config.Parameters()
    for bad in (lambda: config.QualityControl(min_maf=0.6), lambda: config.Detection(min_extend=9), lambda: config.Clustering(depth=0), lambda: config.Clumping(r2=1.0), lambda: config.Summary(threshold=float("nan")), lambda: config.parse_boolean("yes")):
        with pytest.raises(ValueError):
            bad()
    assert config.parse_boolean("TRUE")


def test_levels(spark):
    """Two groups of ten split once; a stray vertex makes a residual too small and blocks the split."""
    rows = [(f"{i:02d}", f"{j:02d}", 2.0 if i // 10 == j // 10 else 0.1) for i in range(20) for j in range(i + 1, 20)]
    edges = spark.createDataFrame(rows, "src string, dst string, weight double")
    samples = lambda n: spark.createDataFrame([(f"{i:02d}",) for i in range(n)], "id string")
    members, diagnostics, sizes = communities.recursive(edges, samples(20), "louvain", 1, 1.0, 4)
    assert {r["label"] for r in members.where("level = 1").collect()} == {"C1.1", "C1.2"} and members.count() == 40
    last = diagnostics.where("level = 1").first()
    assert (last["number_of_clusters"], last["eligible"], last["split"], last["carried_forward"], last["stopping_reason"]) == (2, 1, 1, 0, "fixed_depth_completed")
    assert last["modularity_gain"] > 0.3 and sizes.where("level = 1 and size = 10 and terminal_level").count() == 2
    assert communities.wide(members, 1).columns == ["ID", "level_0", "level_1"]
    labels = communities.refine(edges, samples(21).withColumn("label", F.lit("C1")), "louvain", 1.0, 4)
    assert {r["label"] for r in labels[0].collect()} == {"C1"} and labels[1].first()["rejected"] == 1


def test_whole_plan(spark, tmp_path):
    """From haplotypes of two families to all outputs, written and read again."""
    from tessera.config import Clumping, Clustering, Detection, Parameters, QualityControl
    from tessera.plans import pipeline

    rng = random.Random(5)
    founders = {(f, k): [int(rng.random() < (0.2 if f else 0.8) or k == i % 4 and rng.random() < 0.5) for i in range(240)] for f in range(2) for k in range(4)}
    samples = [(i, f"S{9 - i % 10}{i}") for i in range(16)]
    haps = {i: [founders[i % 2, rng.randrange(4)] for _ in range(2)] for i, _ in samples}
    variants = [(f"chr{1 + m // 120}", 1000 * (m % 120 + 1), f"rs{m}", "A", ["G"], [(haps[i][0][m], haps[i][1][m], True) for i, _ in samples]) for m in range(240)]
    variants = spark.createDataFrame(variants, "chrom string, pos long, id string, ref string, alts array<string>, gts array<struct<a1:int,a2:int,phased:boolean>>")
    people = spark.createDataFrame(samples, "idx int, id string")
    maps = spark.createDataFrame([(c, p, p / 10000) for c in ("chr1", "chr2") for p in (1, 200_000)], "chrom string, pos long, cm double")
    rules = Detection(min_seed=2.0, min_extend=1.0, min_output=2.0, min_markers=20, min_mac=1, max_gap=1000)
    p = Parameters(qc=QualityControl(min_maf=0.0, max_variant_missingness=0.0), detection=rules, clustering=Clustering(methods=("louvain",), depth=2, min_cluster_size=3), clumping=Clumping(min_maf=0.05, hwe=1e-12, min_cluster_size=3, threshold=0.01))
    out = pipeline.run(variants, people, maps, None, p)
    assert out.segments.count() > 0 and out.summary.count() > 0
    tables, clumps = out.clusterings["louvain"], out.clumpings["louvain"]
    assert [r["ID"] for r in tables["membership"].collect()] == [i for _, i in samples] == [r["ID"] for r in clumps["final_membership"].collect()]
    assert tables["diagnostics"].columns[-2:] == ["selected", "stopping_reason"] and tables["diagnostics"].where("selected").count() == 1
    assert clumps["fst_clumping_summary"].columns == ["samples", "initial_clusters", "merges", "final_clusters", "fst_threshold", "minimum_cluster_size"]
    row = clumps["fst_clumping_summary"].first()
    assert row["samples"] == 16 and row["initial_clusters"] - row["merges"] == row["final_clusters"] and row["fst_threshold"] == "0.01"
    assert {r["chromosome"]: (r["samples"], r["variants_before_QC"], r["retention_percent"]) for r in out.quality.collect()} == {"chr1": (16, 120, "100.00"), "chr2": (16, 120, "100.00")}
    assert out.preparation.first()["samples"] == 16 and out.preparation.first()["prune_step_variants"] == "1"
    sinks.write_clustering(tables, f"{tmp_path}/a")
    sinks.write_clumping(clumps, f"{tmp_path}/b")
    sinks.write_variants(variants, f"{tmp_path}/v")
    assert spark.read.csv(f"{tmp_path}/a.membership", sep="\t", header=True).columns == ["ID", "level_0", "level_1", "level_2"]
    assert spark.read.csv(f"{tmp_path}/b.pairwise_fst", sep="\t", header=True).columns[-1] == "eligible_for_clumping"
    assert spark.read.parquet(f"{tmp_path}/v").where("chrom = 'chr2'").count() == 120
    with pytest.raises(ValueError, match="no genetic map"):
        pipeline.check(variants, people, maps.where("chrom = 'chr1'"))
    with pytest.raises(ValueError, match="genotypes for 15"):
        pipeline.check(variants, people.where("idx < 15"), maps)
    with pytest.raises(ValueError, match="members have no genotypes"):
        pipeline.same_ids(people, people.where("idx > 0"))
