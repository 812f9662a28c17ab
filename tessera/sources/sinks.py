"""Writers of the pipeline's text tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import format_general, format_percent


def printed(table: DataFrame, booleans: str = "capital") -> DataFrame:
    """Columns as text: numbers to ten digits, booleans True/False (capital) or true/false."""
    out = {}
    for name, kind in table.dtypes:
        if kind == "double":
            out[name] = format_general(name)
        elif kind == "boolean":
            out[name] = F.initcap(F.col(name).cast("string")) if booleans == "capital" else F.col(name).cast("string")
    return table.withColumns(out)


def write_tsv(table: DataFrame, path: str, compressed: bool = False, single: bool = False) -> None:
    """Tab-separated, each file with a header; one file only on request.  An earlier output is replaced."""
    rows = table.coalesce(1) if single else table
    rows.write.mode("overwrite").csv(path, sep="\t", header=True, emptyValue="", nullValue="", escape='"', compression="gzip" if compressed else "none")


def write_pair_summary(summary: DataFrame, path: str, compressed: bool = True, single: bool = False) -> None:
    """Sorted by pair, in files that follow each other."""
    write_tsv(printed(summary).orderBy("ID1", "ID2"), path, compressed, single)


def write_genotypes(dosages: DataFrame, path: str) -> None:
    """The genotype matrix as Parquet by chromosome, sorted by position, each chromosome in as many files as its ranges."""
    dosages.repartitionByRange("chrom", "pos", "sample").sortWithinPartitions("chrom", "pos", "sample").write.mode("overwrite").partitionBy("chrom").parquet(path)


def clustering_tables(members: DataFrame, diagnostics: DataFrame, sizes: DataFrame, samples: DataFrame, depth: int) -> dict[str, DataFrame]:
    """The four tables of a clustering, by name: membership of all levels and of the deepest, in the
    order of the sample list (idx, id), diagnostics, and sizes by level and cluster."""
    named = members.join(samples.select("id", "idx"), "id")
    levels = named.groupBy("idx", F.col("id").alias("ID")).pivot("level", list(range(depth + 1))).agg(F.first("label"))
    levels = levels.orderBy("idx").select("ID", *(F.col(str(i)).alias(f"level_{i}") for i in range(depth + 1)))
    deepest = named.where(F.col("level") == depth).orderBy("idx").select(F.col("id").alias("ID"), F.col("label").alias("cluster"))
    counters = {"eligible": "communities_eligible", "split": "communities_split", "carried_forward": "communities_carried_forward", "small_children_merged": "small_child_communities_merged", "rejected": "splits_rejected_small_residual"}
    report = diagnostics.withColumnsRenamed(counters).withColumn("selected", F.col("level") == depth)
    report = report.select("method", "level", "number_of_clusters", "modularity", "modularity_gain", *counters.values(), "selected", "stopping_reason")
    return {"membership": levels, "selected_membership": deepest, "diagnostics": report.orderBy("level"), "cluster_sizes": sizes.orderBy("level", "cluster")}


def clumping_tables(members: DataFrame, final: DataFrame, merges: DataFrame, pairs: DataFrame, threshold: float, min_size: int, cluster: str = "cluster") -> dict[str, DataFrame]:
    """The four tables of a clumping, by name.  members: the membership with all its columns and, if it
    has an order, idx; final: (cluster, final) for every cluster."""
    from tessera.operators.popgen import final_ranks

    cluster_sizes = members.groupBy(F.col(cluster).alias("cluster")).agg(F.count("*").alias("size"))
    merged = cluster_sizes.join(final, "cluster").groupBy(F.col("final").alias("cluster")).agg(F.sum("size").alias("size"))
    ranks = final_ranks(merged).select(F.col("cluster").alias("final"), "final_cluster")
    names = final.join(ranks, "final").select(F.col("cluster").alias("pre_fst_cluster"), "final_cluster")
    kept = [c for c in members.columns if c not in ("pre_fst_cluster", "final_cluster", "idx")]
    rows = members.join(names, members[cluster] == names["pre_fst_cluster"])
    rows = (rows.orderBy("idx") if "idx" in members.columns else rows).select(*(members[c] for c in kept), "pre_fst_cluster", "final_cluster")
    counts = members.agg(F.count("*").alias("samples"), F.countDistinct(cluster).alias("initial_clusters"))
    counts = counts.crossJoin(merges.agg(F.count("*").alias("merges"))).crossJoin(merged.agg(F.count("*").alias("final_clusters")))  # three single rows
    summary = counts.select("*", F.lit(str(threshold)).alias("fst_threshold"), F.lit(min_size).alias("minimum_cluster_size"))
    pairwise = pairs.withColumn("eligible", F.col("eligible").cast("string")).withColumnRenamed("eligible", "eligible_for_clumping")
    pairwise = pairwise.select("iteration", "cluster_1", "cluster_2", "hudson_fst", "cluster_1_size", "cluster_2_size", "eligible_for_clumping").orderBy("iteration", "cluster_1", "cluster_2")
    return {"pairwise_fst": pairwise, "fst_merge_history": merges.orderBy("step"), "final_membership": rows, "fst_clumping_summary": summary}


def write_clustering(tables: dict[str, DataFrame], prefix: str) -> None:
    """The tables of clustering_tables; numbers to ten digits."""
    for name, rows in tables.items():
        write_tsv(printed(rows), f"{prefix}.{name}", "membership" in name)


def write_clumping(tables: dict[str, DataFrame], prefix: str) -> None:
    """The tables of clumping_tables; F_ST in full."""
    for name, rows in tables.items():
        write_tsv(rows, f"{prefix}.{name}", name in ("pairwise_fst", "final_membership"))


def write_variants(variants: DataFrame, path: str) -> None:
    """Variants as Parquet by chromosome, sorted by position; an equal sort key lets readers skip files."""
    variants.repartitionByRange("chrom", "pos").sortWithinPartitions("chrom", "pos").write.mode("overwrite").partitionBy("chrom").parquet(path)


def quality_report(retained: DataFrame) -> DataFrame:
    """The rows of popgen.retention, the share printed with two decimals."""
    return retained.withColumn("retention", format_percent("retention")).withColumnRenamed("retention", "retention_percent")


def preparation_report(dosages: DataFrame, min_maf: float, max_missingness: float, hwe: float, window_kb: int, step: int, r2: float) -> DataFrame:
    """One row about the genotypes that F_ST is computed from, with the limits they passed."""
    counts = dosages.agg(F.countDistinct("sample").alias("samples"), F.countDistinct("variant").alias("variants"))
    limits = {"min_maf": min_maf, "max_variant_missingness": max_missingness, "hwe_pvalue": hwe, "prune_window_kb": window_kb, "prune_step_variants": step, "prune_r2": r2}
    return counts.select("*", *(F.lit(str(v)).alias(k) for k, v in limits.items()))


def write_prune_list(variants: DataFrame, path: str) -> None:
    """The ids (variant) that pruning left, one a line, in the order of chromosomes and positions (chrom, pos)."""
    number = F.coalesce(F.regexp_replace("chrom", "^chr", "").try_cast("int"), F.lit(1 << 30))
    variants.select("chrom", "pos", "variant").distinct().orderBy(number, "chrom", "pos", "variant").select("variant").write.mode("overwrite").text(path)
