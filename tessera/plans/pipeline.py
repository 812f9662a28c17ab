"""From phased variants to clusters: the whole analysis as one plan."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.config import Parameters
from tessera.operators import communities, graph, intervals, pairs, popgen, segments
from tessera.shared import cut, small
from tessera.sources import sinks


@dataclass
class Results:
    segments: DataFrame
    summary: DataFrame
    members: dict[str, DataFrame] = field(default_factory=dict)
    diagnostics: dict[str, DataFrame] = field(default_factory=dict)
    sizes: dict[str, DataFrame] = field(default_factory=dict)
    clumped: dict[str, DataFrame] = field(default_factory=dict)
    merges: dict[str, DataFrame] = field(default_factory=dict)
    quality: DataFrame | None = None
    preparation: DataFrame | None = None
    pruned: DataFrame | None = None  # variants that F_ST is computed from: chrom, pos, variant
    counts: dict[str, int] = field(default_factory=dict)
    clusterings: dict[str, dict[str, DataFrame]] = field(default_factory=dict)
    clumpings: dict[str, dict[str, DataFrame]] = field(default_factory=dict)


def checked_variants(variants: DataFrame, p: Parameters) -> DataFrame:
    """Variants that pass quality control; any genotype left that is missing or unphased is an error."""
    maf, missing = popgen.array_frequencies(F.col("gts"))
    kept = variants.where((maf >= p.qc.min_maf) & (missing <= p.qc.max_variant_missingness))
    if kept.isEmpty():
        raise ValueError("no variant passes quality control")
    if (row := kept.where(popgen.unphased(F.col("gts"))).first()) is not None:
        raise ValueError(f"{row['chrom']}:{row['pos']} has a genotype that is missing or not phased")
    return kept


def haplotypes(variants: DataFrame, samples: DataFrame) -> DataFrame:
    """(chrom, pos, sample, hap, allele) of sites with one alternative."""
    rows = variants.where("size(alts) <= 1").select("chrom", "pos", F.posexplode("gts").alias("idx", "g"))
    rows = rows.join(small(samples.select("idx", F.col("id").alias("sample"))), "idx")
    return rows.select("chrom", "pos", "sample", F.posexplode(F.array("g.a1", "g.a2")).alias("hap", "allele"))


def summaries(found: DataFrame, p: Parameters) -> DataFrame:
    """Genome-wide pair summary by way of statistics per chromosome."""
    parts = pairs.partial(pairs.canonical(found.select("id1", "id2", "length_cm", "chrom")), p.summary.threshold, "chrom")
    if p.summary.compat_text:
        parts = pairs.as_printed(parts)
    return pairs.summary(pairs.merged(parts), p.summary.threshold, products=True)


def genotypes_for_fst(variants: DataFrame, samples: DataFrame, p: Parameters) -> DataFrame:
    """Dosages of common autosomal SNPs in Hardy-Weinberg proportions, pruned for linkage."""
    f = p.clumping
    sites = variants.where(popgen.is_autosome(F.col("chrom")) & popgen.is_simple_snp(F.col("ref"), F.col("alts")))
    named = sites.withColumn("id", popgen.variant_id(F.col("chrom"), F.col("pos"), F.col("ref"), F.get("alts", F.lit(0))))
    rows = named.select("chrom", "pos", F.col("id").alias("variant"), F.posexplode("gts").alias("idx", "g"))
    dosages = rows.join(small(samples.select("idx", F.col("id").alias("sample"))), "idx").select("sample", "chrom", "pos", "variant", (F.col("g.a1") + F.col("g.a2")).alias("dosage"))
    kept = popgen.passing(popgen.frequencies(dosages), f.min_maf, f.max_missingness).where(popgen.hwe_midp("hom_ref", "het", "hom_alt") >= f.hwe)
    kept = cut(kept)
    dosages = cut(dosages.join(kept.select("variant"), "variant", "left_semi"))
    final = popgen.pruned(kept, popgen.linked_pairs(dosages, f.window_kb * 1000, f.r2))
    if final.isEmpty():
        raise ValueError("no variant is left after pruning")
    return dosages.join(final, "variant", "left_semi")


def check(variants: DataFrame, samples: DataFrame, maps: DataFrame) -> None:
    """Raise if the sample list is empty or repeats an id, if a variant has another number of genotypes
    than it, or if variants lie on a chromosome without a map."""
    n, distinct = samples.agg(F.count("*"), F.countDistinct("id")).first()
    if n == 0 or n != distinct:
        raise ValueError(f"{n} samples with {distinct} different ids")
    if (row := variants.where(F.size("gts") != n).first()) is not None:
        raise ValueError(f"{row['chrom']}:{row['pos']} has {len(row['gts'])} genotypes for {n} samples")
    missing = variants.select("chrom").distinct().join(maps.select("chrom").distinct(), "chrom", "left_anti").first()
    if missing is not None:
        raise ValueError(f"{missing['chrom']} has no genetic map")


def same_ids(members: DataFrame, genotyped: DataFrame) -> None:
    """Raise if one of two tables with ids (id) has some that the other lacks."""
    row = popgen.mismatch(members, genotyped).first()
    if row["only_members"] or row["only_genotyped"]:
        raise ValueError(f"{row['only_members']} members have no genotypes, {row['only_genotyped']} genotyped samples aren't members")


def run(variants: DataFrame, samples: DataFrame, maps: DataFrame, regions: DataFrame | None, p: Parameters) -> Results:
    """variants (chrom, pos, id, ref, alts, gts), samples (idx, id), maps (chrom, pos, cm), regions to leave out."""
    check(variants, samples, maps)
    kept = cut(checked_variants(variants, p))
    before, after = (v.groupBy("chrom").agg(F.count("*").alias(n)) for v, n in ((variants, "before"), (kept, "after")))
    both = before.join(after, "chrom", "left").crossJoin(samples.agg(F.count("*").alias("n")))  # one row
    quality = both.select(*popgen.retention(F.col("chrom"), F.col("n"), F.col("before"), F.coalesce("after", F.lit(0))))
    positions = popgen.genetic_positions(kept.select("chrom", "pos").distinct(), maps)
    found = segments.detect(haplotypes(kept, samples), positions, p.detection)
    if p.remove_gaps and regions is not None:
        found = intervals.overlapping(found, regions)
    out = Results(cut(found), DataFrame)
    out.quality = sinks.quality_report(quality)
    out.summary = cut(summaries(out.segments, p))
    out.counts = {"variants": kept.count(), "segments": out.segments.count(), "pairs": out.summary.count()}
    edges = cut(graph.build(out.summary.select(F.col("ID1").alias("src"), F.col("ID2").alias("dst"), F.col(p.clustering.weight_column).alias("weight")), samples))
    dosages = cut(genotypes_for_fst(kept, samples, p)) if p.clumping.enabled else None
    if dosages is not None:
        f = p.clumping
        out.pruned = dosages.select("chrom", "pos", "variant").distinct()
        out.preparation = sinks.preparation_report(dosages, f.min_maf, f.max_missingness, f.hwe, f.window_kb, f.step, f.r2)
    for method in p.clustering.methods:
        c = p.clustering
        out.members[method], out.diagnostics[method], out.sizes[method] = communities.recursive(edges, samples.select("id"), method, c.depth, c.resolution, c.min_cluster_size)
        out.clusterings[method] = sinks.clustering_tables(out.members[method], out.diagnostics[method], out.sizes[method], samples, c.depth)
        if dosages is None:
            continue
        deepest = out.members[method].where(F.col("level") == c.depth).select(F.col("id").alias("sample"), F.col("label").alias("cluster"))
        same_ids(deepest.select(F.col("sample").alias("id")), dosages.select(F.col("sample").alias("id")))
        final, merges, pairwise = popgen.clump(popgen.allele_counts(dosages, deepest), deepest, p.clumping.threshold, p.clumping.min_cluster_size)
        rows = deepest.join(samples.select(F.col("id").alias("sample"), "idx"), "sample").select("idx", F.col("sample").alias("ID"), "cluster")
        out.clumpings[method] = sinks.clumping_tables(rows, final, merges, pairwise, p.clumping.threshold, p.clumping.min_cluster_size)
        out.clumped[method] = out.clumpings[method]["final_membership"].select(F.col("ID").alias("sample"), "pre_fst_cluster", "final_cluster")
        out.merges[method] = merges
    return out
