import gzip
import os
import random

import pytest
from pyspark.sql import functions as F

from tessera.sources import blocks
from tessera.sources.indexed_vcf import index_counts, planned, planned_bytes, read_indexed_vcf, write_indexed_vcf
from tessera.sources.vcf import read_vcf

SCHEMA = "chrom string, pos long, id string, ref string, alts array<string>, gts array<struct<a1:int,a2:int,phased:boolean>>"
SAMPLES = [f"s{i}" for i in range(40)]


@pytest.fixture(scope="module")
def variants(spark):
    rng, rows = random.Random(4), []
    for chrom, n in (("chr2", 3000), ("chr10", 1500), ("chr1", 700), ("chrX", 3)):
        for pos in sorted(rng.sample(range(1, 40_000_000), n)):
            ref = rng.choice(["A", "C", "ACGTACGT", "G" * 200])
            gts = [(rng.choice([0, 1, None]), rng.randrange(2), rng.random() < 0.9) for _ in SAMPLES]
            rows.append((chrom, pos, rng.choice([None, f"rs{pos}"]), ref, rng.choice([["T"], ["T", "TT"], []]), gts))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA).withColumn("id", F.coalesce("id", F.lit("."))).repartition(7).cache()


@pytest.fixture(scope="module")
def path(spark, variants, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("vcf") / "all.vcf.gz")
    write_indexed_vcf(variants, SAMPLES, path)
    return path


def rows(df):
    return sorted(map(str, df.collect()))


def test_written_and_read(spark, variants, path):
    """What was written is read back, with the index and without it, and as ordinary gzip."""
    assert rows(read_indexed_vcf(spark, path, split=20_000)) == rows(variants)
    with gzip.open(path, "rt") as f:
        text = [x for x in f if not x.startswith("#")]
    assert [(x.split("\t")[0], int(x.split("\t")[1])) for x in text] == sorted(((r["chrom"], r["pos"]) for r in variants.select("chrom", "pos").collect()), key=lambda r: ({"chr1": 1, "chr2": 2, "chr10": 10, "chrX": 99}[r[0]], r[1]))
    plain = path.removesuffix(".gz")
    with gzip.open(path, "rb") as f, open(plain, "wb") as out:
        out.write(f.read())
    assert rows(read_vcf(spark, plain)) == rows(variants)
    assert sorted(os.listdir(os.path.dirname(path))) == ["all.vcf", "all.vcf.gz", "all.vcf.gz.tbi"]


@pytest.mark.parametrize(("low", "high"), [(1, 40_000_000), (5_000_000, 5_400_000), (16_384, 16_385), (39_000_000, 39_900_000), (7, 6)])
def test_regions(spark, variants, path, low, high):
    """Regions give the rows that filters give without an index."""
    for chroms in (["chr1"], ["chr2", "chrX"], ["chr7"], None):
        limits = F.col("pos").between(low, high) & (F.lit(True) if chroms is None else F.col("chrom").isin(chroms))
        assert rows(read_indexed_vcf(spark, path, chroms, low, high, split=20_000)) == rows(variants.where(limits))


def test_one_table_twice(spark, variants, path):
    """Filters on one table of the source don't touch other uses of it."""
    found = read_indexed_vcf(spark, path)
    one = found.where("chrom = 'chr1'")
    assert one.count() == 700 and found.count() == variants.count() and one.unionByName(found.where("chrom = 'chrX'")).count() == 703


def test_bytes_read(spark, path):
    """A chromosome's ranges span its own blocks only, a region's fewer."""
    size, index = os.path.getsize(path), path + ".tbi"
    every = {c: planned_bytes(planned(path, index, {c})) for c in ("chr1", "chr2", "chr10")}
    assert every["chr1"] < 0.2 * size and every["chr2"] < 0.7 * size and sum(every.values()) <= size
    assert planned_bytes(planned(path, index, {"chr2"}, 5_000_000, 5_400_000)) < 0.15 * every["chr2"]
    assert planned(path, index, {"chr7"}) == [] and len(planned(path, index, split=20_000)) > 6


def test_partitions(spark, path):
    """As many partitions as the region has ranges."""
    found = read_indexed_vcf(spark, path, ["chr1"], split=20_000)
    assert found.rdd.getNumPartitions() == len(planned(path, path + ".tbi", {"chr1"}, split=20_000)) == 2


def test_counts(variants, path):
    assert index_counts(path + ".tbi") == {r["chrom"]: r["count"] for r in variants.groupBy("chrom").count().collect()}


def test_failed_task(spark, variants, tmp_path):
    """A task that fails leaves no file, and an earlier one as it was."""
    path = str(tmp_path / "out.vcf.gz")
    bad = variants.withColumn("id", F.when(F.col("pos") > 30_000_000, F.raise_error(F.lit("broken")).cast("string")).otherwise(F.col("id")))
    with pytest.raises(Exception, match="broken"):
        write_indexed_vcf(bad, SAMPLES, path)
    assert os.listdir(tmp_path) == []
    write_indexed_vcf(variants.where("chrom = 'chr1'"), SAMPLES, path)
    before = open(path, "rb").read()
    with pytest.raises(Exception, match="broken"):
        write_indexed_vcf(bad, SAMPLES, path)
    assert open(path, "rb").read() == before and sorted(os.listdir(tmp_path)) == ["out.vcf.gz", "out.vcf.gz.tbi"]


def test_bins():
    """Every row's bin is among those looked at for a region that it overlaps."""
    rng = random.Random(2)
    for _ in range(500):
        a = rng.randrange(1 << 28)
        b = a + rng.choice([1, 50, 20_000, 3_000_000])
        lo = rng.randrange(max(0, a - 1000), b)
        assert blocks.bin_of(a, b) in blocks.bins_over(lo, lo + 1 + rng.randrange(5000))


def test_no_rows(spark, variants, tmp_path):
    path = str(tmp_path / "none.vcf.gz")
    write_indexed_vcf(variants.limit(0), SAMPLES, path)
    assert read_indexed_vcf(spark, path).count() == 0 and index_counts(path + ".tbi") == {}
