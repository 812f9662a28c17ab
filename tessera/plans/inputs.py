"""The inputs of the whole analysis from files: a variant file and a genetic map for each chromosome, checked against each other."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources import text
from tessera.sources.indexed_vcf import read_indexed_vcf
from tessera.sources.vcf import read_vcf, vcf_samples


@dataclass
class Inputs:
    """What pipeline.run takes."""

    variants: DataFrame
    samples: DataFrame
    maps: DataFrame
    regions: DataFrame | None


def from_files(spark: SparkSession, pattern: str, chromosomes: list[str], map_folder: str, map_prefix: str = "", regions: str | None = None, indexed: bool = False) -> Inputs:
    """Files of a pattern with {chr}, and maps named by prefix and chromosome.  Raises if a file is missing, if a variant file and its
    map name different or several chromosomes, or if the files don't list the same samples in the same order."""
    paths = text.per_chromosome(pattern, chromosomes)
    maps = {c: text.map_path(map_folder, map_prefix, c) for c in chromosomes}
    text.must_exist(spark, *paths.values(), *maps.values(), *([regions] if regions else []))
    variants, positions, first = [], [], None
    for c in chromosomes:
        own = read_indexed_vcf(spark, paths[c]) if indexed else read_vcf(spark, paths[c])
        markers = text.read_map(spark, maps[c])
        text.same_chromosome(own, markers)
        people = vcf_samples(spark, paths[c])
        if first is None:
            first = people
            if first.isEmpty():
                raise ValueError(f"{paths[c]} has no samples")
        else:
            text.same_samples(first, people)
        variants.append(own)
        positions.append(markers.select("chrom", "pos", "cm"))
    union = lambda tables: reduce(DataFrame.unionByName, tables)
    return Inputs(union(variants), first.withColumn("idx", F.col("idx").cast("int")), union(positions), text.read_regions(spark, regions) if regions else None)
