import json

import pytest
import zstandard
from pyspark.sql import functions as F

from tessera.config import Clumping, Clustering
from tessera.operators import pairs
from tessera.plans import per_pair
from tessera.plans.inputs import from_files
from tessera.plans.publish import manifests, publish, published
from tessera.sources import sinks, text
from tessera.sources.indexed_vcf import write_indexed_vcf


def lines(rows):
    return "".join("\t".join(map(str, r)) + "\n" for r in rows)


@pytest.fixture
def files(tmp_path):
    one = [("B", 1, "A", 2, "1", 10, 90, 4.0), ("A", 1, "C", 1, "1", 5, 50, 6.5)]
    two = [("A", 2, "B", 1, "2", 10, 90, 7.0), ("C", 1, "B", 1, "2", 5, 50, 5.0)]
    (tmp_path / "one.ibd").write_text(lines(one) + "\n")
    (tmp_path / "two.ibd").write_text(lines(two))
    return [str(tmp_path / "one.ibd"), str(tmp_path / "two.ibd")]


def test_one_scan(spark, files):
    """Counts and sums come out of one pass, which equals reading with a check first."""
    out = per_pair.from_segments(spark, files, 5.0)
    want = pairs.summary(pairs.partial(pairs.canonical(text.read_segments(spark, files).select("id1", "id2", "length_cm")), 5.0), 5.0)
    assert sorted(map(tuple, out.table.collect())) == sorted(map(tuple, want.collect()))
    assert out.counts == {"files": 2, "lines": 4, "pairs": 3}
    watched = text.watch_segments(spark, files)
    plan = pairs.partial(pairs.canonical(watched.rows.select("id1", "id2", "length_cm")), 5.0)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan text") == 1 and plan.count("CollectMetrics") == 1


@pytest.mark.parametrize(("line", "fault"), [("A\t1\tB\t1\t1\t5\t6", "field_count"), ("\t1\tB\t1\t1\t5\t6\t1", "empty_id"), ("B\t1\tB\t1\t1\t5\t6\t1", "self_pair"), ("A\t1\tB\t1\t1\t5\t6\tx", "not_a_number"), ("A\t1\tB\t1\t1\t5\t6\tinf", "not_finite"), ("A\t1\tB\t1\t1\t5\t6\t-1", "negative")])
def test_faults_name_their_place(spark, files, line, fault):
    with open(files[1], "a") as f:
        f.write(line + "\n" + line + "\n")
    with pytest.raises(ValueError, match=f"two.ibd.*error {fault} .2 {fault} in 6 rows"):
        per_pair.from_segments(spark, files, 5.0)


def test_summaries_of_summaries(spark, files, tmp_path):
    """Written summaries of two files, summed up, give the summary of both files; a broken relation is named."""
    for i, f in enumerate(files):
        sinks.write_pair_summary(per_pair.from_segments(spark, [f], 5.0).table, str(tmp_path / f"s{i}"))
    paths = [str(tmp_path / f"s{i}") for i in range(2)]
    out = per_pair.from_summaries(spark, paths, 5.0)
    assert sorted(map(tuple, out.table.collect())) == sorted(map(tuple, per_pair.from_segments(spark, files, 5.0).table.collect()))
    assert out.counts["lines"] == 4 and out.counts["pairs"] == 3
    bad = per_pair.from_segments(spark, files, 5.0).table.withColumn("min_IBD_length_cM", F.col("max_IBD_length_cM") + 1)
    sinks.write_pair_summary(bad, str(tmp_path / "bad"))
    with pytest.raises(ValueError, match="min_above_max .3 min_above_max in 3 rows"):
        per_pair.from_summaries(spark, [str(tmp_path / "bad")], 5.0)


def test_published_at_once(spark, tmp_path):
    """A run that fails between two tables leaves the set before it; run again, it goes on with what is not finished."""
    root, made = str(tmp_path / "out"), []

    def table(name, n):
        def make():
            made.append(name)
            return spark.range(n).withColumn("x", F.lit(name))
        return make

    with pytest.raises(FileNotFoundError):
        published(spark, root, "a")
    publish({"a": table("a", 3), "b": table("b", 4)}, root, "first")
    assert published(spark, root, "a", verify=True).count() == 3
    with pytest.raises(ZeroDivisionError):
        publish({"a": table("a", 30), "b": lambda: 1 // 0}, root, "second")
    assert published(spark, root, "a", True).count() == 3 and published(spark, root, "b", True).count() == 4
    publish({"a": table("a", 30), "b": table("b", 40)}, root, "second")
    assert made == ["a", "b", "a", "b"] and published(spark, root, "a", True).count() == 30 and published(spark, root, "b", True).count() == 40
    publish({"a": table("a", 30), "b": table("b", 40)}, root, "second")
    assert made == ["a", "b", "a", "b"] and manifests(spark, root) == [1, 2]
    publish({"a": table("a", 5), "b": table("b", 6)}, root, "third")
    assert sorted(p.name for p in (tmp_path / "out" / "runs").iterdir()) == ["second", "third"]
    spark.range(2).withColumn("x", F.lit("other")).write.mode("overwrite").parquet(f"{root}/runs/third/a")
    with pytest.raises(ValueError, match="not what was published"):
        published(spark, root, "a", verify=True)
    assert json.loads((tmp_path / "out" / "manifest-000003.json").read_text())["tables"]["b"]["rows"] == 6


HEAD = "##fileformat=VCFv4.2\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\t"


def test_inputs_from_files(spark, tmp_path):
    """Files by chromosome are read together; a missing file, another order of samples and another chromosome are errors."""
    for c in ("1", "2", "3", "4"):
        names = "b\ta" if c == "3" else "a\tb"
        (tmp_path / f"v{c}.vcf").write_text(f"{HEAD}{names}\nchr{c}\t10\trs{c}\tA\tG\t.\t.\t.\tGT\t0|1\t1|1\n")
        (tmp_path / f"m.{c}.map").write_text(f"chr{9 if c == '4' else c} . 0.5 1\nchr{9 if c == '4' else c} . 1.5 300\n")
    (tmp_path / "gaps.bed").write_text("chr1\t100\t200\tgap\n")
    read = lambda cs, **k: from_files(spark, f"{tmp_path}/v{{chr}}.vcf", cs, str(tmp_path), "m.", **k)
    got = read(["1", "2"], regions=str(tmp_path / "gaps.bed"))
    assert got.variants.count() == 2 and got.maps.count() == 4 and got.regions.count() == 1
    assert [tuple(r) for r in got.samples.orderBy("idx").collect()] == [(0, "a"), (1, "b")]
    with pytest.raises(ValueError, match="sample 1 is a and b"):
        read(["1", "3"])
    with pytest.raises(ValueError, match="chromosomes differ"):
        read(["4"])
    with pytest.raises(FileNotFoundError):
        read(["1", "7"])
    with pytest.raises(ValueError, match="no {chr}"):
        from_files(spark, "v.vcf", ["1"], str(tmp_path))


def test_indexed_inputs(spark, tmp_path):
    rows = [("chr1", 10 * i, f"rs{i}", "A", ["G"], [(i % 2, 1, True), (0, 1, True)]) for i in range(1, 50)]
    variants = spark.createDataFrame(rows, "chrom string, pos long, id string, ref string, alts array<string>, gts array<struct<a1:int,a2:int,phased:boolean>>")
    write_indexed_vcf(variants, ["a", "b"], str(tmp_path / "v1.vcf.gz"))
    (tmp_path / "1.map").write_text("chr1 . 0.5 1\n")
    got = from_files(spark, f"{tmp_path}/v{{chr}}.vcf.gz", ["1"], str(tmp_path), indexed=True)
    assert sorted(map(str, got.variants.collect())) == sorted(map(str, variants.collect())) and [r["id"] for r in got.samples.collect()] == ["a", "b"]


def test_compressed_pairs(spark, tmp_path):
    """A Zstandard file of several frames; a row that repeats the header is a row."""
    head, body = b"#POP1\tPOP2\tHUDSON_FST\r\n", b"".join(b"A\tB%d\t%f\r\n" % (i, i / 7) for i in range(60_000))
    pack = zstandard.ZstdCompressor()
    (tmp_path / "f.fst.summary.zst").write_bytes(pack.compress(head + body[:500_000]) + pack.compress(body[500_000:] + head))
    (tmp_path / "f.fst.summary").write_bytes(head + body)
    packed, plain = (text.read_fst(spark, str(tmp_path / f"f.fst.summary{x}")) for x in (".zst", ""))
    assert packed.count() == plain.count() + 1 and packed.where("isnan(hudson_fst)").count() == 1
    assert packed.where("not isnan(hudson_fst)").exceptAll(plain).count() == 0


def test_genotype_files(spark, tmp_path):
    rows = [(f"s{s:03d}", f"chr{c}", 10 * p, f"{c}:{10 * p}:A:G", (s + p) % 3) for s in range(40) for c in (2, 10) for p in range(1, 200)]
    dosages = spark.createDataFrame(rows, "sample string, chrom string, pos long, variant string, dosage int")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so few rows end in one file
    sinks.write_genotypes(dosages, f"{tmp_path}/g")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    back = spark.read.parquet(f"{tmp_path}/g").select(dosages.columns)
    assert back.exceptAll(dosages).count() == 0 and back.count() == len(rows)
    assert all(len(list(p.glob("part-*"))) >= 2 for p in (tmp_path / "g").glob("chrom=*"))
    sinks.write_prune_list(dosages, f"{tmp_path}/p")
    names = [line for p in sorted((tmp_path / "p").glob("part-*")) for line in p.read_text().splitlines()]
    assert names == [f"{c}:{10 * p}:A:G" for c in (2, 10) for p in range(1, 200)]


def test_old_parameters():
    with pytest.raises(ValueError, match="min_modularity_gain"):
        Clustering(min_modularity_gain=-1)
    with pytest.raises(ValueError, match="step"):
        Clumping(step=5)
