"""Phased variant files as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.shared import small


def parsed(lines: DataFrame) -> DataFrame:
    """(chrom, pos, id, ref, alts, gts) of lines (value, and chrom and pos where these are known before)."""
    f = F.split(F.regexp_replace("value", "\r$", ""), "\t", -1)
    known = "chrom" in lines.columns
    rows = lines.select(f.alias("f"), *(["chrom", "pos"] if known else []))
    at = F.array_position(F.split(F.col("f")[8], ":"), "GT").cast("int")
    allele = lambda g, i: F.get(F.split(g, r"[|/]"), F.lit(i)).try_cast("int")
    fields = F.transform(F.slice("f", 10, F.greatest(F.size("f") - 9, F.lit(0))), lambda s: F.get(F.split(s, ":"), at - 1))
    gts = F.transform(fields, lambda g: F.struct(allele(g, 0).alias("a1"), allele(g, 1).alias("a2"), (~F.contains(g, F.lit("/"))).alias("phased")))
    alts = F.filter(F.split(F.col("f")[4], ","), lambda a: a != ".")
    place = [F.col("chrom"), F.col("pos")] if known else [F.col("f")[0].alias("chrom"), F.col("f")[1].cast("long").alias("pos")]
    return rows.select(*place, F.col("f")[2].alias("id"), F.col("f")[3].alias("ref"), alts.alias("alts"), gts.alias("gts"))


def read_vcf(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(chrom, pos, id, ref, alts, gts): gts has a struct (a1, a2, phased) for each sample, in order.
    A haploid genotype has no second allele."""
    return parsed(spark.read.text(paths).where("value <> '' and not startswith(value, '#')"))


def vcf_samples(spark: SparkSession, path: str) -> DataFrame:
    """(idx, id) of the header line."""
    header = spark.read.text(path).where("startswith(value, '#CHROM')").limit(1)
    return header.select(F.posexplode(F.slice(F.split(F.regexp_replace("value", "\r$", ""), "\t", -1), 10, 1 << 30)).alias("idx", "id"))


def as_dosages(variants: DataFrame, samples: DataFrame) -> DataFrame:
    """(sample, chrom, pos, variant, dosage) of sites with at most one alternative."""
    rows = variants.where("size(alts) <= 1").select("chrom", "pos", "id", F.posexplode("gts").alias("idx", "g"))
    return rows.join(small(samples.select("idx", F.col("id").alias("sample"))), "idx").select("sample", "chrom", "pos", F.col("id").alias("variant"), (F.col("g.a1") + F.col("g.a2")).alias("dosage"))
