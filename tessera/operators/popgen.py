"""Variants and genotypes: frequencies, filters, exact tests, linkage, F_ST and its clumping.

variants: (chrom, pos, id, ref, alts, gts), gts an array of (a1, a2, phased) in sample order.
dosages: (sample, chrom, pos, variant, dosage), dosage 0 to 2 or null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tessera.functions.text import bare_chromosome
from tessera.shared import Growing, cut, numbered, small
from tessera.shared import passing as owning


def frequencies(dosages: DataFrame) -> DataFrame:
    """(chrom, pos, variant, samples, missing, hom_ref, het, hom_alt, f_missing, maf) of each variant."""
    of = lambda d: F.sum((F.col("dosage") == d).cast("long"))
    out = dosages.groupBy("chrom", "pos", "variant").agg(
        F.count("*").alias("samples"), F.sum(F.col("dosage").isNull().cast("long")).alias("missing"),
        F.coalesce(of(0), F.lit(0)).alias("hom_ref"), F.coalesce(of(1), F.lit(0)).alias("het"), F.coalesce(of(2), F.lit(0)).alias("hom_alt"),
    )
    called = F.col("hom_ref") + F.col("het") + F.col("hom_alt")
    alt = F.when(called > 0, (F.col("het") + 2 * F.col("hom_alt")) / (2 * called))
    return out.withColumn("f_missing", F.col("missing") / F.col("samples")).withColumn("maf", F.least(alt, 1 - alt))


def passing(frequencies_: DataFrame, min_maf: float, max_missing: float) -> DataFrame:
    """Variants within both limits, these included."""
    return frequencies_.where((F.col("maf") >= min_maf) & (F.col("f_missing") <= max_missing))


def array_frequencies(gts: Column) -> tuple[Column, Column]:
    """(maf, f_missing) from an array of genotypes; of a site with several alternatives, the frequency
    of its second most common allele."""
    alleles = F.filter(F.flatten(F.transform(gts, lambda g: F.array(g["a1"], g["a2"]))), lambda a: a.isNotNull())
    counts = F.sort_array(F.transform(F.array_distinct(alleles), lambda a: F.size(F.filter(alleles, lambda b: b == a))), False)
    maf = F.when(F.size(alleles) > 0, F.coalesce(F.get(counts, F.lit(1)), F.lit(0)) / F.size(alleles))
    missing = F.size(F.filter(gts, lambda g: g["a1"].isNull() | g["a2"].isNull())) / F.size(gts)
    return maf, missing


def unphased(gts: Column) -> Column:
    """Whether a genotype is missing, in part or whole, or not phased."""
    return F.exists(gts, lambda g: ~g["phased"] | g["a1"].isNull() | g["a2"].isNull())


def is_autosome(chrom: Column) -> Column:
    number = bare_chromosome(chrom).try_cast("int")
    return F.coalesce(number.between(1, 22), F.lit(False))


def is_simple_snp(ref: Column, alts: Column) -> Column:
    """One reference and at most one alternative base, each A, C, G or T in either case."""
    return ref.rlike("^[ACGTacgt]$") & F.forall(alts, lambda a: a.rlike("^[ACGTacgt]$")) & (F.size(alts) <= 1)


def variant_id(chrom: Column, pos: Column, ref: Column, alt: Column, longest: int = 100) -> Column:
    return F.concat_ws(":", bare_chromosome(chrom), pos.cast("string"), F.left(ref, F.lit(longest)), F.left(alt, F.lit(longest)))


def _outwards(common: np.ndarray, rare: np.ndarray, start: np.ndarray, done) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(variants, heterozygotes, probability relative to that of start) of the heterozygote counts from start
    downwards, then upwards, all variants a step at a time; done(variants, heterozygotes, probability, whether it falls) ends some."""
    for up in (False, True):
        h = start.copy()
        x, y, p, live = (rare - h) / 2, (common - h) / 2, np.ones(len(h)), np.arange(len(h))
        while len(live):
            x_, y_, h_ = x[live], y[live], h[live]
            ratio = 4 * x_ * y_ / ((h_ + 2) * (h_ + 1)) if up else h_ * (h_ - 1) / (4 * (x_ + 1) * (y_ + 1))
            step = -1 if up else 1
            x[live], y[live], h[live] = x_ + step, y_ + step, h_ - 2 * step
            p[live] *= ratio
            yield live, h[live], p[live]
            live = live[(p[live] > 0) & ~done(live, h[live], p[live], ratio < 1)]


@F.pandas_udf(DoubleType())
def hwe_midp(hom_ref: pd.Series, het: pd.Series, hom_alt: pd.Series) -> pd.Series:
    """Exact test of Hardy-Weinberg proportions, with half the weight of the observed outcome.

    All variants of a batch advance together over the heterozygote counts that are possible, by the
    ratio of neighbouring probabilities, outwards from about the likeliest count, relative to which none is
    large: an outcome so unlikely that it vanishes beside that one has a p of 0."""
    a, b, c = (x.to_numpy().astype(np.float64) for x in (hom_ref, het, hom_alt))
    n, rare = a + b + c, 2 * np.minimum(a, c) + b
    common = 2 * n - rare
    start = np.floor(rare * common / np.maximum(2 * n, 1))
    start = np.clip(start - (start - rare) % 2, rare % 2, rare)
    own = np.where(start == b, 1.0, 0.0)
    away = b - start
    passed = lambda live, h, p, falls: ((h - start[live]) * away[live] <= 0) | (np.abs(h - start[live]) >= np.abs(away[live]))
    for live, h, p in _outwards(common, rare, start, passed):
        here = h == b[live]
        own[live[here]] = p[here]
    less, same, total = np.where(own < 1 - 1e-9, 0.0, np.where(own > 1 + 1e-9, 1.0, 0.0)), np.where(np.abs(own - 1) <= 1e-9, 1.0, 0.0), np.ones(len(a))
    for live, _, p in _outwards(common, rare, start, lambda live, h, p, falls: falls & (p < 1e-18 * total[live])):
        total[live] += p
        equal = np.abs(p - own[live]) <= 1e-9 * own[live]
        same[live] += np.where(equal, p, 0)
        less[live] += np.where(~equal & (p < own[live]), p, 0)
    return pd.Series(np.where(n == 0, 1.0, np.minimum(1.0, (less + 0.5 * same) / total)))


def packed(dosages: DataFrame) -> DataFrame:
    """(chrom, pos, variant, word, called, some, both): of each 64 samples, one bit for a sample whose
    dosage is known, is 1 or 2, and is 2."""
    samples = numbered(dosages.select("sample").distinct(), [F.col("sample")])
    d = dosages.where("dosage is not null").join(small(samples), "sample").withColumn("bit", F.expr("shiftleft(1L, int(n % 64))"))
    bits = lambda when: F.bit_or(F.when(when, F.col("bit")).otherwise(0))
    return d.groupBy("chrom", "pos", "variant", F.floor(F.col("n") / 64).alias("word")).agg(F.bit_or("bit").alias("called"), bits(F.col("dosage") >= 1).alias("some"), bits(F.col("dosage") == 2).alias("both"))


def linked_pairs(dosages: DataFrame, window: int, r2: float) -> DataFrame:
    """Pairs of variants at most `window` base pairs apart with a squared correlation above r2:
    (chrom, variant_1, variant_2, r2), the lesser position first.  A range join by bins of variants
    packed by 64 samples; sums of dosages (0, 1, 2) and their products are counts of common bits."""
    d = packed(dosages).withColumn("bin", F.floor(F.col("pos") / window))
    side = lambda i, where: d.select("chrom", "word", where.alias("bin"), F.col("pos").alias(f"p{i}"), F.col("variant").alias(f"variant_{i}"), F.col("called").alias(f"c{i}"), F.col("some").alias(f"a{i}"), F.col("both").alias(f"b{i}"))
    near = (F.col("p2") - F.col("p1") <= window) & ((F.col("p1") < F.col("p2")) | ((F.col("p1") == F.col("p2")) & (F.col("variant_1") < F.col("variant_2"))))
    common = lambda x, y: F.bit_count(F.col(x).bitwiseAND(F.col(y)))
    joined = side(1, F.col("bin")).join(side(2, F.explode(F.array("bin", F.col("bin") - 1))), ["chrom", "word", "bin"]).where(near)
    sums = joined.groupBy("chrom", "variant_1", "variant_2").agg(
        F.sum(common("c1", "c2")).alias("n"), F.sum(common("a1", "c2") + common("b1", "c2")).alias("sx"), F.sum(common("c1", "a2") + common("c1", "b2")).alias("sy"),
        F.sum(common("a1", "c2") + 3 * common("b1", "c2")).alias("sxx"), F.sum(common("c1", "a2") + 3 * common("c1", "b2")).alias("syy"),
        F.sum(common("a1", "a2") + common("a1", "b2") + common("b1", "a2") + common("b1", "b2")).alias("sxy"),
    )
    c = lambda n: F.col(n).cast("double")
    cov, vx, vy = c("n") * c("sxy") - c("sx") * c("sy"), c("n") * c("sxx") - c("sx") * c("sx"), c("n") * c("syy") - c("sy") * c("sy")
    return sums.select("chrom", "variant_1", "variant_2", F.when((vx > 0) & (vy > 0), cov * cov / (vx * vy)).alias("r2")).where(F.col("r2") > r2)


def pruned(frequencies_: DataFrame, links: DataFrame) -> DataFrame:
    """Variants left when of each linked pair only the first by frequency (then position, id) may
    stay: greedy by that order, found in rounds.  A variant stays once no undecided or kept variant
    before it is linked to it, and goes once a kept one is."""
    rank = F.struct((-F.col("maf")).alias("m"), F.col("chrom"), F.col("pos"), F.col("variant"))
    todo = cut(frequencies_.select("variant", rank.alias("rank")))
    order = links.join(todo.withColumnsRenamed({"variant": "variant_1", "rank": "r1"}), "variant_1").join(todo.withColumnsRenamed({"variant": "variant_2", "rank": "r2_"}), "variant_2")
    first = F.col("r1") < F.col("r2_")
    order = cut(order.select(F.when(first, F.col("variant_1")).otherwise(F.col("variant_2")).alias("high"), F.when(first, F.col("variant_2")).otherwise(F.col("variant_1")).alias("low")))
    kept = None
    todo = todo.select("variant")
    while True:
        blocked = order.join(todo.withColumnRenamed("variant", "high"), "high", "left_semi").select(F.col("low").alias("variant")).distinct()
        new = cut(todo.join(blocked, "variant", "left_anti"))
        kept = new if kept is None else kept.unionByName(new)
        gone = order.join(new.withColumnRenamed("variant", "high"), "high", "left_semi").select(F.col("low").alias("variant"))
        todo = cut(todo.join(new, "variant", "left_anti").join(gone, "variant", "left_anti"))
        if todo.isEmpty():
            return kept


def allele_counts(dosages: DataFrame, clusters: DataFrame) -> DataFrame:
    """(cluster, variant, n, ac): called alleles and alternative ones.  clusters: (sample, cluster)."""
    joined = dosages.where("dosage is not null").join(clusters, "sample")
    return joined.groupBy("cluster", "variant").agg((2 * F.count("*")).alias("n"), F.sum(F.col("dosage").cast("long")).alias("ac"))


def hudson(counts: DataFrame, against: DataFrame | None = None) -> DataFrame:
    """F_ST of pairs of clusters as a ratio of sums over variants: (cluster_1, cluster_2, hudson_fst).
    Variants with fewer than two alleles in a cluster don't count.  against: only pairs with these."""
    some = counts.where("n >= 2").withColumn("p", F.col("ac") / F.col("n"))
    side = lambda s, rows: rows.select("variant", F.col("cluster").alias(f"cluster_{s}"), F.col("p").alias(f"p{s}"), F.col("n").alias(f"n{s}"))
    if against is None:
        pairs = side(1, some).join(side(2, some), "variant").where("cluster_1 < cluster_2")
    else:
        pairs = side(1, some).join(side(2, some.join(F.broadcast(against), "cluster", "left_semi")), "variant").where("cluster_1 <> cluster_2")
    p1, p2 = F.col("p1"), F.col("p2")
    over = (p1 - p2) * (p1 - p2) - p1 * (1 - p1) / (F.col("n1") - 1) - p2 * (1 - p2) / (F.col("n2") - 1)
    sums = pairs.groupBy(F.least("cluster_1", "cluster_2").alias("cluster_1"), F.greatest("cluster_1", "cluster_2").alias("cluster_2")).agg(F.sum(over).alias("over"), F.sum(p1 * (1 - p2) + p2 * (1 - p1)).alias("under"))
    return sums.select("cluster_1", "cluster_2", F.when(F.col("under") != 0, F.col("over") / F.col("under")).otherwise(float("nan")).alias("hudson_fst"))


def with_eligibility(fst: DataFrame, sizes: DataFrame, min_size: int) -> DataFrame:
    """Pairs with their sizes (0 if unknown) and whether they may merge: both large enough, F_ST finite."""
    a, b = (sizes.select(F.col("cluster").alias(f"cluster_{i}"), F.col("size").alias(f"cluster_{i}_size")) for i in (1, 2))
    out = fst.join(a, "cluster_1", "left").join(b, "cluster_2", "left").fillna(0, ["cluster_1_size", "cluster_2_size"])
    fine = ~F.isnan("hudson_fst") & (F.abs("hudson_fst") < float("inf"))
    return out.withColumn("eligible", (F.col("cluster_1_size") >= min_size) & (F.col("cluster_2_size") >= min_size) & fine).select("cluster_1", "cluster_2", "hudson_fst", "cluster_1_size", "cluster_2_size", "eligible")


def closest(pairs: DataFrame) -> DataFrame:
    """The eligible pair with the least F_ST, ties by labels."""
    return pairs.where("eligible").agg(F.min(F.struct("hudson_fst", "cluster_1", "cluster_2")).alias("m")).where("m is not null").select("m.cluster_1", "m.cluster_2", "m.hudson_fst")


def clump(counts: DataFrame, clusters: DataFrame, threshold: float, min_size: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Merge the closest eligible pair while its F_ST is below the threshold.

    Genotypes are counted once.  Counts, and F_ST of pairs, are kept by cluster and version, the step that made it, in
    tables that only grow: a merge adds the counts of the merged cluster and its pairs with the others.  What is current are
    versions that the log of merges has not ended.  Returns (cluster, final) for every input cluster, the merges and all
    pairs of every iteration, the last one included.
    """
    spark = counts.sparkSession
    kind = dict(counts.dtypes)["cluster"]
    with owning(spark) as keep:
        versions = lambda rows, v: rows.withColumn("version", F.lit(v))
        sizes = Growing(versions(clusters.groupBy("cluster").agg(F.count("*").alias("size")), 0))
        log = Growing(versions(counts.select("cluster", "variant", "n", "ac"), 0))
        ended: list[tuple] = []

        def current(rows: DataFrame, *sides: str) -> DataFrame:
            """Rows whose versions (of these sides of a pair, or of themselves) the log of merges has not ended; it has two rows a step."""
            gone = F.broadcast(spark.createDataFrame([x[:2] for x in ended], f"cluster {kind}, version int"))
            for side in sides or ("",):
                names = gone.withColumnsRenamed({c: c + side for c in gone.columns})
                rows = rows.join(names, names.columns, "left_anti")
            return rows

        def paired(fst: DataFrame) -> DataFrame:
            now = current(sizes.rows())
            out = with_eligibility(fst, now, min_size)
            for side in ("_1", "_2"):
                out = out.join(small(now.select(F.col("cluster").alias(f"cluster{side}"), F.col("version").alias(f"version{side}"))), f"cluster{side}")
            return out

        pairs, merges, step = Growing(paired(hudson(log.rows()))), [], 0
        while True:
            best = current(pairs.rows(), "_1", "_2").where("eligible").agg(F.min(F.struct("hudson_fst", "cluster_1", "cluster_2", "version_1", "version_2", "cluster_1_size", "cluster_2_size")).alias("m")).first()["m"]
            if best is None or best["hudson_fst"] >= threshold:
                break
            step += 1
            one, two = (best["cluster_1"], best["version_1"]), (best["cluster_2"], best["version_2"])
            kept, size = min(one[0], two[0]), best["cluster_1_size"] + best["cluster_2_size"]
            merges.append((step, one[0], two[0], best["hudson_fst"], kept, best["cluster_1_size"], best["cluster_2_size"], size))
            both = F.struct("cluster", "version").isin([F.struct(F.lit(c), F.lit(v)) for c, v in (one, two)])
            merged = log.rows().where(both).groupBy("variant").agg(F.sum("n").alias("n"), F.sum("ac").alias("ac"))
            ended += [(*one, step), (*two, step)]
            log.add(versions(merged.withColumn("cluster", F.lit(kept).cast(kind)), step))
            sizes.add(versions(spark.createDataFrame([(kept, size)], f"cluster {kind}, size long"), step))
            pairs.add(paired(hudson(current(log.rows()), spark.createDataFrame([(kept,)], f"cluster {kind}"))))
        merged = spark.createDataFrame(merges, f"step int, cluster_1 {kind}, cluster_2 {kind}, fst_before_merge double, retained_label {kind}, cluster_1_size long, cluster_2_size long, merged_size long")
        # a pair was current from the step that made it to before the one that ended either side
        history = pairs.rows()
        for side in ("_1", "_2"):
            history = history.join(F.broadcast(spark.createDataFrame(ended, f"cluster{side} {kind}, version{side} int, ended{side} int")), [f"cluster{side}", f"version{side}"], "left")
        to = F.least(F.coalesce("ended_1", F.lit(step + 1)), F.coalesce("ended_2", F.lit(step + 1))) - 1
        history = history.withColumn("iteration", F.explode(F.sequence(F.greatest("version_1", "version_2"), to)))
        history = history.select("cluster_1", "cluster_2", "hudson_fst", "cluster_1_size", "cluster_2_size", "eligible", "iteration")
        # labels that went, with the one that each ended up in
        into: dict = {}
        for _, a, b, _, kept, *_ in merges:
            into = {k: kept if v == max(a, b) else v for k, v in into.items()} | {max(a, b): kept}
        names = spark.createDataFrame(list(into.items()), f"cluster {kind}, final {kind}")
        final = clusters.select("cluster").distinct().join(F.broadcast(names), "cluster", "left").select("cluster", F.coalesce("final", "cluster").alias("final"))
        return keep(cut(final), merged, cut(history))


def final_ranks(sizes: DataFrame) -> DataFrame:
    """(cluster, size, final_cluster): Cluster_1, Cluster_2, ... by size downwards, then label."""
    ranked = numbered(sizes.select("cluster", "size"), [F.desc("size"), F.col("cluster").cast("string")])
    return ranked.select("cluster", "size", F.concat(F.lit("Cluster_"), (F.col("n") + 1).cast("string")).alias("final_cluster"))


def mismatch(members: DataFrame, genotyped: DataFrame) -> DataFrame:
    """(only_members, only_genotyped): how many ids (id) one side has and the other lacks."""
    both = members.select("id").distinct().withColumn("m", F.lit(1)).join(genotyped.select("id").distinct().withColumn("g", F.lit(1)), "id", "full")
    return both.agg(F.sum(F.col("g").isNull().cast("long")).alias("only_members"), F.sum(F.col("m").isNull().cast("long")).alias("only_genotyped"))


def genetic_positions(markers: DataFrame, maps: DataFrame, bin_size: int = 1_000_000) -> DataFrame:
    """Markers (chrom, pos) with their genetic position by linear interpolation in maps (chrom, pos,
    cm); before the first and after the last map row, that row's; null without a map.

    Neighbouring map rows make intervals, which markers meet by bin: only the map is put in order.
    """
    rows = maps.groupBy("chrom", "pos").agg(F.min("cm").alias("cm"))
    own = Window.partitionBy("chrom").orderBy("pos")
    steps = rows.select("chrom", F.col("pos").alias("p0"), F.col("cm").alias("c0"), F.lead("pos").over(own).alias("p1"), F.lead("cm").over(own).alias("c1"))
    last = F.coalesce(F.col("p1"), F.col("p0"))
    steps = steps.withColumn("bin", F.explode(F.sequence(F.floor(F.col("p0") / bin_size), F.floor(last / bin_size))))
    ends = rows.groupBy("chrom").agg(F.min("pos").alias("first"), F.max("pos").alias("last"))
    placed = markers.select("chrom", "pos").join(F.broadcast(ends), "chrom", "left").withColumn("p", F.greatest(F.least("pos", "last"), "first"))
    placed = placed.withColumn("bin", F.floor(F.col("p") / bin_size)).alias("m")
    inside = (F.col("p") >= F.col("p0")) & (F.col("p1").isNull() | (F.col("p") < F.col("p1")))
    met = placed.join(steps.alias("s"), (F.col("m.chrom") == F.col("s.chrom")) & (F.col("m.bin") == F.col("s.bin")) & inside, "left")
    share = (F.col("p") - F.col("p0")) / (F.col("p1") - F.col("p0"))
    return met.select("m.chrom", "m.pos", F.when(F.col("p1").isNull(), F.col("c0")).otherwise(F.col("c0") + (F.col("c1") - F.col("c0")) * share).alias("cm"))


def retention(chrom: Column, samples: Column, before: Column, after: Column) -> list[Column]:
    """Columns of the quality-control report of a chromosome."""
    return [chrom.alias("chromosome"), samples.alias("samples"), before.alias("variants_before_QC"), after.alias("variants_after_QC"), (before - after).alias("variants_removed"), (F.lit(100.0) * after / before).alias("retention")]
