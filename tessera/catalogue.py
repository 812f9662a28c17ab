"""Registered queries over the given tables, and the SQL that checks them, by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import bare_chromosome
from tessera.config import Detection
from tessera.operators import communities, graph, intervals, pairs, popgen, segments
from tessera.plans import adapters as of
from tessera.plans.adapters import sql
from tessera.shared import cut

QUERIES, SQL = {}, {}
THRESHOLD, MIN_SIZE = 25.0, 4
STATS = """count(*) AS number_of_IBD_segments, sum(len) AS total_IBD_length_cM, sum(len * len) AS sum_squared_IBD_length_cM, sum(len) / count(*) AS mean_IBD_length_cM,
  min(len) AS min_IBD_length_cM, max(len) AS max_IBD_length_cM, sqrt(greatest(0, sum(len * len) / count(*) - (sum(len) / count(*)) * (sum(len) / count(*)))) AS sd_IBD_length_cM,
  CAST(sum(CAST(len >= 25 AS INT)) AS BIGINT) AS number_of_segments_ge_25_cM, sum(CASE WHEN len >= 25 THEN len ELSE 0 END) AS total_length_of_segments_ge_25_cM"""


def query(oracle: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if oracle:
            SQL[function.__name__] = oracle
        return function

    return register


def _canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.canonical(of.proper(spark, sf_dir).select("id1", "id2", "length_cm", "chrom"))


@query(f"{sql('seg', 'pairs')} SELECT chrom, ID1, ID2, {STATS} FROM pairs GROUP BY chrom, ID1, ID2")
def pair_summary_chrom(spark, sf_dir):
    return pairs.summary(pairs.partial(_canonical(spark, sf_dir), THRESHOLD, "chrom"), THRESHOLD, "chrom")


@query(f"{sql('seg', 'pairs')} SELECT ID1, ID2, {STATS} FROM pairs GROUP BY ID1, ID2")
def pair_summary_genome(spark, sf_dir):
    return pairs.summary(pairs.partial(_canonical(spark, sf_dir), THRESHOLD), THRESHOLD)


@query(SQL["pair_summary_genome"])
def pair_summary_two_phase(spark, sf_dir):
    dealt = of.dealt_by_pair(spark, sf_dir, _canonical(spark, sf_dir))  # both steps then are in one task for each part
    return pairs.summary(pairs.merged(pairs.partial(dealt, THRESHOLD, "chrom")), THRESHOLD)


@query(f"{SQL['pair_summary_genome']} ORDER BY ID1, ID2")
def pair_summary_sorted(spark, sf_dir):
    return pair_summary_genome(spark, sf_dir).orderBy("ID1", "ID2")


@query(f"{sql('seg', 'pairs')} SELECT ID1, ID2, sum(len) * (sum(len) / count(*)) AS total_IBD_length_x_mean_IBD_length_cM2 FROM pairs GROUP BY ID1, ID2")
def pair_weight_products(spark, sf_dir):
    out = pairs.summary(pairs.partial(_canonical(spark, sf_dir), THRESHOLD), THRESHOLD, products=True)
    return out.select("ID1", "ID2", "total_IBD_length_x_mean_IBD_length_cM2")


@query(f"{sql('seg', 'pairs')}, t AS (SELECT ID1, ID2, {STATS} FROM pairs GROUP BY ID1, ID2) SELECT count(*) AS rows_checked, CAST(count(*) FILTER (number_of_IBD_segments % 3 = 0) AS INT) AS faults FROM t")
def pair_summary_faults(spark, sf_dir):
    """Of summaries in which the totals of pairs with a multiple of three segments were made negative."""
    spoilt = F.when(F.col("number_of_IBD_segments") % 3 == 0, -F.col("total_IBD_length_cM")).otherwise(F.col("total_IBD_length_cM"))
    found = pair_summary_genome(spark, sf_dir).withColumn("total_IBD_length_cM", spoilt).withColumn("error", pairs.summary_errors(THRESHOLD))
    return found.agg(F.count("*").alias("rows_checked"), F.count("error").cast("int").alias("faults"))


@query(f"""{sql('seg', 'pairs')}, t AS (SELECT ID1, ID2, {STATS} FROM pairs GROUP BY ID1, ID2),
k AS (SELECT CAST(substr(ID2, 2) AS INT) % 5 AS k FROM t)
SELECT CASE k WHEN 0 THEN 'no_segments' WHEN 1 THEN 'threshold_count' WHEN 2 THEN 'min_above_max' WHEN 3 THEN 'threshold_length' END AS error, count(*) AS n FROM k GROUP BY 1""")
def pair_summary_relations(spark, sf_dir):
    """Of summaries spoilt so that each relation between their columns is broken in some: by the second sample's number."""
    t, kind = pair_summary_genome(spark, sf_dir), F.substring("ID2", 2, 20).cast("int") % 5
    spoilt = lambda k, c, v: F.when(kind == k, v).otherwise(F.col(c))
    t = t.withColumns({
        "number_of_IBD_segments": spoilt(0, "number_of_IBD_segments", F.lit(0)), "number_of_segments_ge_25_cM": spoilt(1, "number_of_segments_ge_25_cM", F.col("number_of_IBD_segments") + 1),
        "min_IBD_length_cM": spoilt(2, "min_IBD_length_cM", F.col("max_IBD_length_cM") + 1), "total_length_of_segments_ge_25_cM": spoilt(3, "total_length_of_segments_ge_25_cM", F.col("total_IBD_length_cM") + 1),
    })
    return t.withColumn("error", pairs.summary_errors(THRESHOLD)).groupBy("error").agg(F.count("*").alias("n"))


_GAPS = "seg.id1 <> seg.id2 AND {} EXISTS (SELECT 1 FROM gap WHERE replace(seg.chrom, 'chr', '') = gap.chrom AND greatest(seg.s - 1, 0) < gap.e AND gap.s < seg.e)"


@query(f"{sql('seg', 'gap')} SELECT id1, id2, chrom, s AS start, e AS \"end\", len AS length_cm, l_orderkey, l_linenumber FROM seg WHERE {_GAPS.format('NOT')}")
def segment_gap_anti_join(spark, sf_dir):
    return intervals.overlapping(of.proper(spark, sf_dir), of.regions(spark, sf_dir))


@query(f"{sql('seg', 'gap')} SELECT id1, id2, chrom, s AS start, e AS \"end\", len AS length_cm, l_orderkey, l_linenumber FROM seg WHERE {_GAPS.format('')}")
def segment_gap_hits(spark, sf_dir):
    return intervals.overlapping(of.proper(spark, sf_dir), of.regions(spark, sf_dir), "left_semi")


@query(f"{sql('seg', 'gap')} SELECT DISTINCT replace(chrom, 'chr', '') AS chrom FROM seg WHERE replace(chrom, 'chr', '') NOT IN (SELECT CAST(CAST(chrom AS INT) % 5 + 1 AS VARCHAR) FROM gap)")
def chromosomes_without_regions(spark, sf_dir):
    """The regions put on five chromosomes, so that others have none."""
    five = of.regions(spark, sf_dir).withColumn("chrom", (F.col("chrom").cast("int") % 5 + 1).cast("string"))
    return intervals.chromosomes_without_regions(of.segments(spark, sf_dir), five)


@query(f"""{sql('seg')} SELECT CASE WHEN l_orderkey % 17 = 0 THEN 'empty_id' WHEN id1 = id2 THEN 'self_pair' WHEN l_orderkey % 11 = 0 THEN 'not_a_number' WHEN l_orderkey % 19 = 0 THEN 'not_finite'
WHEN l_orderkey % 13 = 0 THEN 'negative' END AS error, count(*) AS n FROM seg GROUP BY 1""")
def segment_violations(spark, sf_dir):
    """Of lines some of which were spoilt."""
    every = lambda n: F.col("l_orderkey") % n == 0
    length = F.when(every(11), "x").when(every(19), "inf").when(every(13), "-1").otherwise(F.col("length_cm").cast("string"))
    fields = F.array(F.when(every(17), "").otherwise(F.col("id1")), F.lit("1"), "id2", F.lit("2"), "chrom", F.col("start").cast("string"), F.col("end").cast("string"), length)
    s = of.segments(spark, sf_dir)
    return s.select(pairs.segment_errors(fields).alias("error")).groupBy("error").agg(F.count("*").alias("n"))


@query(f"{sql('seg', 'pairs', 'samples', 'edges')}, x AS (SELECT src AS id FROM edges UNION ALL SELECT dst FROM edges) SELECT id, count(*) AS edges FROM x WHERE id NOT IN (SELECT id FROM samples WHERE label <> 'N7') GROUP BY id")
def edge_endpoints_unknown(spark, sf_dir):
    """Against a sample list that lacks one nation."""
    return graph.unknown_endpoints(of.edges(spark, sf_dir), of.samples(spark, sf_dir).where("label <> 'N7'"))


@query(f"{sql('seg')} SELECT least(id1, id2) AS src, greatest(id1, id2) AS dst, count(*) AS edges FROM seg WHERE len > 0 AND id1 <> id2 GROUP BY ALL HAVING count(*) > 1")
def edge_duplicates(spark, sf_dir):
    return graph.duplicate_edges(of.proper(spark, sf_dir).select(F.col("id1").alias("src"), F.col("id2").alias("dst"), F.col("length_cm").alias("weight")))


@query(f"{sql('seg', 'pairs', 'samples', 'edges', 'strong')}, top AS (SELECT * FROM strong WHERE weight >= 0.75 * (SELECT max(weight) FROM strong)) SELECT id FROM samples WHERE id NOT IN (SELECT src FROM top) AND id NOT IN (SELECT dst FROM top)")
def isolated_vertices(spark, sf_dir):
    """In the graph of the strongest edges."""
    e = of.strong_edges(spark, sf_dir)
    return graph.isolated(e.join(F.broadcast(e.agg(F.max("weight").alias("top")))).where("weight >= 0.75 * top").drop("top"), of.samples(spark, sf_dir))


@query(f"{sql('seg', 'pairs', 'samples', 'edges', 'strong')}, x AS (SELECT src AS id, weight FROM strong UNION ALL SELECT dst, weight FROM strong) SELECT id, count(weight) AS degree, coalesce(sum(weight), 0) AS strength FROM samples LEFT JOIN x USING (id) GROUP BY id")
def vertex_degree(spark, sf_dir):
    return graph.degrees(of.strong_edges(spark, sf_dir), of.samples(spark, sf_dir))


_INDUCED = f"{sql('seg', 'pairs', 'samples', 'edges', 'strong')}, ind AS (SELECT a.label, src, dst, weight FROM strong JOIN samples a ON a.id = src JOIN samples b ON b.id = dst WHERE a.label = b.label)"


@query(f"{_INDUCED} SELECT * FROM ind")
def induced_edges_by_label(spark, sf_dir):
    return graph.induced(of.strong_edges(spark, sf_dir), of.samples(spark, sf_dir))


_TERMS = f"""{_INDUCED}, k AS (SELECT id, sum(weight) AS k FROM (SELECT src AS id, weight FROM strong UNION ALL SELECT dst, weight FROM strong) GROUP BY id),
m AS (SELECT sum(weight) AS m FROM strong),
t AS (SELECT label, coalesce((SELECT sum(weight) FROM ind WHERE ind.label = s.label), 0) AS inside, coalesce(sum(k), 0) AS strength FROM samples s LEFT JOIN k USING (id) GROUP BY label)"""


@query(f"{_TERMS} SELECT label, inside, strength, m AS total FROM t, m")
def modularity_by_label(spark, sf_dir):
    return graph.modularity_terms(of.strong_edges(spark, sf_dir), of.samples(spark, sf_dir))


@query(f"{_TERMS}, q AS (SELECT sum(inside / m - (strength / (2 * m)) * (strength / (2 * m))) AS q FROM t, m) SELECT 0 AS level, 0.0 AS modularity, CAST(NULL AS DOUBLE) AS gain UNION ALL SELECT 1, round(q, 9), round(q, 9) FROM q")
def modularity_gain(spark, sf_dir):
    e, s = cut(of.strong_edges(spark, sf_dir)), of.samples(spark, sf_dir)
    levels = graph.modularity(e, s.withColumn("label", F.lit("C1"))).withColumn("level", F.lit(0)).unionByName(graph.modularity(e, s).withColumn("level", F.lit(1)))
    return graph.with_gain(levels.select("level", (F.round("modularity", 9) + 0.0).alias("modularity")))


_SIZES = f"{sql('samples')}, l AS (SELECT 0 AS level, 'C1' AS cluster, count(*) AS size FROM samples UNION ALL SELECT 1, label, count(*) FROM samples GROUP BY label)"


@query(f"{_SIZES} SELECT level, cluster, size FROM l")
def cluster_sizes(spark, sf_dir):
    return refine_eligibility(spark, sf_dir).select("level", "cluster", "size")


@query(f"{_SIZES} SELECT level, cluster, size, level < 1 AND size >= 4 AS eligible_for_further_refinement, level = 1 AS terminal_level FROM l")
def refine_eligibility(spark, sf_dir):
    s = of.samples(spark, sf_dir)
    members = s.select("id", F.lit(0).alias("level"), F.lit("C1").alias("label")).unionByName(s.select("id", F.lit(1).alias("level"), "label"))
    return graph.sizes(members, 1, MIN_SIZE)


def _proposed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers' nations as parents, market segments and balance bands as proposed children."""
    c = spark.read.parquet(f"{sf_dir}/customer.parquet")
    child = F.concat("c_mktsegment", F.when(F.col("c_acctbal") < -500, "-low").otherwise(""))
    return c.select(F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("parent"), F.lpad(F.col("c_custkey").cast("string"), 9, "0").alias("id"), child.alias("child"))


_SPLIT = """WITH p AS (SELECT 'N' || CAST(c_nationkey AS VARCHAR) AS parent, lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS id, c_mktsegment || CASE WHEN c_acctbal < -500 THEN '-low' ELSE '' END AS child FROM customer),
c AS (SELECT parent, child, count(*) AS n, min(id) AS first FROM p GROUP BY ALL),
d AS (SELECT parent, CAST(sum(n) AS BIGINT) AS size, count(*) AS children, count(*) FILTER (n < 4) AS small, CAST(coalesce(sum(n) FILTER (n < 4), 0) AS BIGINT) AS pooled FROM c GROUP BY parent),
x AS (SELECT *, CASE WHEN size < 4 THEN 'ineligible' WHEN children < 2 THEN 'unsplit' WHEN small = 0 THEN 'split' WHEN pooled < 4 THEN 'rejected' WHEN children - small + 1 < 2 THEN 'rejected' ELSE 'split' END AS decision FROM d)"""


@query(f"{_SPLIT} SELECT * FROM x")
def split_decision(spark, sf_dir):
    return communities.split_decisions(_proposed(spark, sf_dir), MIN_SIZE)


@query(f"""{_SPLIT}, r AS (SELECT c.parent, child, dense_rank() OVER (PARTITION BY c.parent ORDER BY n < 4, CASE WHEN n >= 4 THEN first END) AS k, decision FROM c JOIN x USING (parent))
SELECT id, CASE WHEN decision = 'split' THEN parent || '.' || CAST(k AS VARCHAR) ELSE parent END AS label FROM p JOIN r USING (parent, child)""")
def stable_child_labels(spark, sf_dir):
    return communities.child_labels(_proposed(spark, sf_dir), MIN_SIZE)


@query(f"""{sql('dose')}, f AS (SELECT chrom, pos, variant, count(*) AS samples, count(*) FILTER (dosage IS NULL) AS missing, count(*) FILTER (dosage = 0) AS hom_ref, count(*) FILTER (dosage = 1) AS het, count(*) FILTER (dosage = 2) AS hom_alt FROM dose GROUP BY ALL),
g AS (SELECT *, missing / samples AS f_missing, (het + 2 * hom_alt) / (2 * (hom_ref + het + hom_alt)) AS a FROM f) SELECT chrom, pos, variant, samples, missing, hom_ref, het, hom_alt, f_missing, least(a, 1 - a) AS maf FROM g""")
def allele_frequency(spark, sf_dir):
    return popgen.frequencies(of.dosages(spark, sf_dir))


@query(f"SELECT * FROM ({SQL['allele_frequency']}) WHERE maf >= 0.48 AND f_missing <= 0.02")
def variant_qc(spark, sf_dir):
    return popgen.passing(allele_frequency(spark, sf_dir), 0.48, 0.02)


def _genotypes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as sites: their lines as phased genotypes, some missing or unphased."""
    l = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    gt = F.struct(
        F.when(F.col("l_partkey") % 97 != 0, (F.col("l_partkey") % 2).cast("int")).alias("a1"), (F.col("l_suppkey") % 2).cast("int").alias("a2"), (F.col("l_partkey") % 89 != 0).alias("phased"),
    )
    return l.groupBy("l_orderkey").agg(F.collect_list(gt).alias("gts"))


@query("""WITH g AS (SELECT l_orderkey, CASE WHEN l_partkey % 97 <> 0 THEN l_partkey % 2 END AS a1, l_suppkey % 2 AS a2, l_partkey % 89 <> 0 AS phased FROM lineitem),
a AS (SELECT l_orderkey, a1 AS a FROM g WHERE a1 IS NOT NULL UNION ALL SELECT l_orderkey, a2 FROM g),
c AS (SELECT l_orderkey, count(*) AS n, least(count(*) FILTER (a = 0), count(*) FILTER (a = 1)) AS minor FROM a GROUP BY l_orderkey)
SELECT l_orderkey, bool_or(NOT phased OR a1 IS NULL) AS unphased, any_value(minor / n) AS maf, count(*) FILTER (a1 IS NULL) / count(*) AS f_missing FROM g JOIN c USING (l_orderkey) GROUP BY l_orderkey""")
def phased_check(spark, sf_dir):
    maf, missing = popgen.array_frequencies(F.col("gts"))
    return _genotypes(spark, sf_dir).select("l_orderkey", popgen.unphased(F.col("gts")).alias("unphased"), maf.alias("maf"), missing.alias("f_missing"))


def _sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as sites on chromosomes 1 to 25, their types as alleles."""
    p = spark.read.parquet(f"{sf_dir}/part.parquet")
    base = lambda c: F.substring(F.lit("ACGTN"), (c % 5 + 1).cast("int"), F.lit(1))
    return p.select(
        F.concat(F.lit("chr"), (F.col("p_size") % 25 + 1).cast("string")).alias("chrom"), (F.col("p_partkey") * 7 % 1000003).cast("long").alias("pos"), base(F.col("p_partkey")).alias("ref"),
        F.when(F.col("p_partkey") % 11 == 0, F.array(base(F.col("p_partkey") + 1), F.lit("T"))).otherwise(F.array(F.concat(base(F.col("p_partkey") + 2), F.when(F.col("p_partkey") % 13 == 0, F.repeat(F.lit("A"), 120)).otherwise("")))).alias("alts"),
    )


_SITES = """WITH p AS (SELECT 'chr' || CAST(p_size % 25 + 1 AS VARCHAR) AS chrom, p_partkey * 7 % 1000003 AS pos, substr('ACGTN', CAST(p_partkey % 5 + 1 AS INT), 1) AS ref,
  CASE WHEN p_partkey % 11 = 0 THEN [substr('ACGTN', CAST((p_partkey + 1) % 5 + 1 AS INT), 1), 'T'] ELSE [substr('ACGTN', CAST((p_partkey + 2) % 5 + 1 AS INT), 1) || CASE WHEN p_partkey % 13 = 0 THEN repeat('A', 120) ELSE '' END] END AS alts FROM part)"""


@query(f"{_SITES} SELECT chrom, pos, ref, alts[1] AS alt FROM p WHERE CAST(replace(chrom, 'chr', '') AS INT) BETWEEN 1 AND 22 AND ref IN ('A', 'C', 'G', 'T') AND len(alts) = 1 AND alts[1] IN ('A', 'C', 'G', 'T')")
def autosome_snp_filter(spark, sf_dir):
    s = _sites(spark, sf_dir).where(popgen.is_autosome(F.col("chrom")) & popgen.is_simple_snp(F.col("ref"), F.col("alts")))
    return s.select("chrom", "pos", "ref", F.col("alts")[0].alias("alt"))


@query(f"{_SITES} SELECT chrom, pos, replace(chrom, 'chr', '') || ':' || CAST(pos AS VARCHAR) || ':' || left(ref, 100) || ':' || left(alts[1], 100) AS id FROM p")
def variant_id(spark, sf_dir):
    return _sites(spark, sf_dir).select("chrom", "pos", popgen.variant_id(F.col("chrom"), F.col("pos"), F.col("ref"), F.col("alts")[0]).alias("id"))


@query(f"{_SITES} SELECT chrom, pos, ref FROM p ORDER BY CAST(replace(chrom, 'chr', '') AS INT), pos")
def concat_sorted(spark, sf_dir):
    return _sites(spark, sf_dir).select("chrom", "pos", "ref").orderBy(bare_chromosome(F.col("chrom")).cast("int"), "pos")


@query(f"""WITH f AS (SELECT variant, hom_ref, het, hom_alt, hom_ref + het + hom_alt AS n, least(2 * hom_ref + het, 2 * hom_alt + het) AS rare FROM ({SQL['allele_frequency']})),
h AS (SELECT *, unnest(range(rare % 2, rare + 1, 2)) AS k FROM f), l AS (SELECT *, k * ln(2.0) - lgamma(k + 1.0) - lgamma((rare - k) // 2 + 1.0) - lgamma(n - k - (rare - k) // 2 + 1.0) AS w FROM h),
e AS (SELECT *, exp(w - max(w) OVER (PARTITION BY variant)) AS t FROM l), o AS (SELECT *, max(CASE WHEN k = het THEN t END) OVER (PARTITION BY variant) AS own FROM e)
SELECT variant, hom_ref, het, hom_alt, round(sum(CASE WHEN abs(t - own) <= 1e-9 * own THEN t / 2 WHEN t < own THEN t ELSE 0 END) / sum(t), 7) AS p FROM o GROUP BY ALL""")
def hwe_midp(spark, sf_dir):
    return allele_frequency(spark, sf_dir).select("variant", "hom_ref", "het", "hom_alt", F.round(popgen.hwe_midp("hom_ref", "het", "hom_alt"), 7).alias("p"))


_LINKS = f"""{sql('dose')}, s AS (SELECT a.chrom, a.variant AS variant_1, b.variant AS variant_2, CAST(count(*) AS DOUBLE) AS n, CAST(sum(a.dosage) AS DOUBLE) AS sx, CAST(sum(b.dosage) AS DOUBLE) AS sy,
  CAST(sum(a.dosage * a.dosage) AS DOUBLE) AS sxx, CAST(sum(b.dosage * b.dosage) AS DOUBLE) AS syy, CAST(sum(a.dosage * b.dosage) AS DOUBLE) AS sxy
  FROM dose a JOIN dose b ON a.sample = b.sample AND a.chrom = b.chrom AND a.pos < b.pos AND b.pos - a.pos <= 50000 WHERE a.dosage IS NOT NULL AND b.dosage IS NOT NULL GROUP BY ALL),
l AS (SELECT chrom, variant_1, variant_2, (n * sxy - sx * sy) * (n * sxy - sx * sy) / ((n * sxx - sx * sx) * (n * syy - sy * sy)) AS r2 FROM s)"""


@query(f"{_LINKS} SELECT chrom, variant_1, variant_2, round(r2, 9) AS r2 FROM l WHERE r2 > 0.002")
def ld_pairs(spark, sf_dir):
    return popgen.linked_pairs(of.dosages(spark, sf_dir), 50_000, 0.002).withColumn("r2", F.round("r2", 9))


@query(f"""WITH RECURSIVE freq AS ({SQL['allele_frequency']}), link AS ({_LINKS} SELECT variant_1, variant_2 FROM l WHERE r2 > 0.002),
o AS (SELECT variant, row_number() OVER (ORDER BY -maf, chrom, pos, variant) AS k FROM freq),
g AS (SELECT 0::BIGINT AS k, []::VARCHAR[] AS kept UNION ALL
  SELECT o.k, CASE WHEN EXISTS (SELECT 1 FROM link WHERE (variant_1 = o.variant AND list_contains(kept, variant_2)) OR (variant_2 = o.variant AND list_contains(kept, variant_1))) THEN kept ELSE list_append(kept, o.variant) END FROM g JOIN o ON o.k = g.k + 1)
SELECT unnest(kept) AS variant FROM g WHERE k = (SELECT max(k) FROM g)""")
def ld_prune(spark, sf_dir):
    d = of.dosages(spark, sf_dir)
    return popgen.pruned(popgen.frequencies(d), popgen.linked_pairs(d, 50_000, 0.002))


def _counts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    d = of.dosages(spark, sf_dir)
    clusters = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").cast("string").alias("sample"), F.concat(F.lit("P"), F.col("label").cast("string")).alias("cluster"))
    return popgen.allele_counts(d.drop("cluster"), clusters), clusters


_FST = f"""{sql('dose')}, c AS (SELECT cluster, variant, CAST(2 * count(*) AS DOUBLE) AS n, CAST(sum(dosage) AS DOUBLE) / (2 * count(*)) AS p FROM dose WHERE dosage IS NOT NULL GROUP BY ALL),
f AS (SELECT a.cluster AS cluster_1, b.cluster AS cluster_2, round(sum((a.p - b.p) * (a.p - b.p) - a.p * (1 - a.p) / (a.n - 1) - b.p * (1 - b.p) / (b.n - 1)) / sum(a.p * (1 - b.p) + b.p * (1 - a.p)), 9) AS hudson_fst
  FROM c a JOIN c b USING (variant) WHERE a.cluster < b.cluster GROUP BY ALL),
z AS (SELECT 'P' || CAST(label AS VARCHAR) AS cluster, count(*) AS size FROM embeddings GROUP BY ALL),
e AS (SELECT cluster_1, cluster_2, hudson_fst, x.size AS cluster_1_size, y.size AS cluster_2_size, x.size >= 4 AND y.size >= 4 AS eligible FROM f JOIN z x ON x.cluster = cluster_1 JOIN z y ON y.cluster = cluster_2)"""


@query(f"{_FST} SELECT * FROM f")
def hudson_fst_pairs(spark, sf_dir):
    return popgen.hudson(_counts(spark, sf_dir)[0]).withColumn("hudson_fst", F.round("hudson_fst", 9))


@query(f"{_FST} SELECT * FROM e")
def fst_eligible(spark, sf_dir):
    clusters = _counts(spark, sf_dir)[1]
    return popgen.with_eligibility(hudson_fst_pairs(spark, sf_dir), clusters.groupBy("cluster").agg(F.count("*").alias("size")), MIN_SIZE)


@query(f"{_FST} SELECT cluster_1, cluster_2, hudson_fst FROM e WHERE eligible ORDER BY hudson_fst, cluster_1, cluster_2 LIMIT 1")
def fst_argmin(spark, sf_dir):
    return popgen.closest(fst_eligible(spark, sf_dir))


_CLUMP = f"""{sql('dose').replace('WITH', 'WITH RECURSIVE', 1)}, c AS (SELECT cluster, variant, CAST(2 * count(*) AS DOUBLE) AS n, CAST(sum(dosage) AS DOUBLE) AS ac FROM dose WHERE dosage IS NOT NULL GROUP BY ALL),
z AS (SELECT 'P' || CAST(label AS VARCHAR) AS cluster, count(*) AS size FROM embeddings GROUP BY ALL),
r AS (SELECT 0 AS step, cluster, cluster AS label, '' AS c1, '' AS c2, CAST(0 AS DOUBLE) AS fst, CAST(0 AS BIGINT) AS s1, CAST(0 AS BIGINT) AS s2 FROM z UNION ALL
  SELECT * FROM (WITH k AS (SELECT label, variant, sum(n) AS n, sum(ac) / sum(n) AS p FROM r JOIN c USING (cluster) GROUP BY ALL), y AS (SELECT label, CAST(sum(size) AS BIGINT) AS size FROM r JOIN z USING (cluster) GROUP BY ALL),
    f AS (SELECT a.label AS c1, b.label AS c2, sum((a.p - b.p) * (a.p - b.p) - a.p * (1 - a.p) / (a.n - 1) - b.p * (1 - b.p) / (b.n - 1)) / sum(a.p * (1 - b.p) + b.p * (1 - a.p)) AS fst FROM k a JOIN k b USING (variant) WHERE a.label < b.label GROUP BY ALL),
    b AS (SELECT f.*, u.size AS s1, v.size AS s2 FROM f JOIN y u ON u.label = c1 JOIN y v ON v.label = c2 WHERE u.size >= 4 AND v.size >= 4 ORDER BY fst, c1, c2 LIMIT 1)
    SELECT r.step + 1, r.cluster, CASE WHEN r.label = b.c2 THEN b.c1 ELSE r.label END, b.c1, b.c2, b.fst, b.s1, b.s2 FROM r, b WHERE b.fst < 0.0005))"""


@query(f"{_CLUMP} SELECT cluster, label AS final FROM r WHERE step = (SELECT max(step) FROM r)")
def fst_clump_final(spark, sf_dir):
    return popgen.clump(*_counts(spark, sf_dir), 0.0005, MIN_SIZE)[0]


@query(f"{_CLUMP} SELECT DISTINCT step, c1 AS cluster_1, c2 AS cluster_2, round(fst, 9) AS fst_before_merge, c1 AS retained_label, s1 AS cluster_1_size, s2 AS cluster_2_size, s1 + s2 AS merged_size FROM r WHERE step > 0")
def fst_merge_history(spark, sf_dir):
    return popgen.clump(*_counts(spark, sf_dir), 0.0005, MIN_SIZE)[1].withColumn("fst_before_merge", F.round("fst_before_merge", 9))


@query(f"{sql('samples')}, z AS (SELECT label AS cluster, count(*) AS size FROM samples GROUP BY label) SELECT cluster, size, 'Cluster_' || CAST(row_number() OVER (ORDER BY size DESC, cluster) AS VARCHAR) AS final_cluster FROM z")
def final_cluster_rank(spark, sf_dir):
    return popgen.final_ranks(of.samples(spark, sf_dir).groupBy(F.col("label").alias("cluster")).agg(F.count("*").alias("size")))


@query(f"{sql('seg', 'samples')}, g AS (SELECT id2 AS id FROM seg UNION SELECT id1 FROM seg) SELECT (SELECT count(*) FROM samples WHERE id NOT IN (SELECT id FROM g)) AS only_members, (SELECT count(*) FROM g WHERE id NOT IN (SELECT id FROM samples)) AS only_genotyped")
def membership_genotype_mismatch(spark, sf_dir):
    s = of.segments(spark, sf_dir)
    return popgen.mismatch(of.samples(spark, sf_dir), s.select(F.col("id1").alias("id")).unionByName(s.select(F.col("id2").alias("id"))))


_MAP = """m AS (SELECT 'chr' || CAST(s_suppkey % 7 + 1 AS VARCHAR) AS chrom, s_suppkey * 100000 AS pos, s_suppkey * 0.25 AS cm FROM supplier)"""


@query(f"""WITH x AS (SELECT DISTINCT 'chr' || CAST(l_linenumber AS VARCHAR) AS chrom, CAST(round(l_extendedprice * 100) AS BIGINT) AS pos FROM lineitem), {_MAP},
b AS (SELECT x.chrom, x.pos, m.pos AS bp, m.cm AS bc FROM x ASOF LEFT JOIN m ON x.chrom = m.chrom AND x.pos >= m.pos),
a AS (SELECT b.*, m.pos AS ap, m.cm AS ac FROM b ASOF LEFT JOIN m ON b.chrom = m.chrom AND b.pos <= m.pos)
SELECT chrom, pos, round(CASE WHEN bp IS NULL THEN ac WHEN ap IS NULL OR ap = bp THEN bc ELSE bc + (ac - bc) * ((pos - bp) / (ap - bp)) END, 7) AS cm FROM a""")
def map_interpolate(spark, sf_dir):
    markers = of.segments(spark, sf_dir).select("chrom", F.col("start").alias("pos")).distinct()
    maps = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(F.concat(F.lit("chr"), (F.col("s_suppkey") % 7 + 1).cast("string")).alias("chrom"), (F.col("s_suppkey") * 100000).alias("pos"), (F.col("s_suppkey") * 0.25).alias("cm"))
    return popgen.genetic_positions(markers, maps).withColumn("cm", F.round("cm", 7))


@query("""SELECT 'chr' || CAST(l_linenumber AS VARCHAR) AS chromosome, count(DISTINCT l_suppkey) AS samples, count(*) AS "variants_before_QC", count(*) FILTER (l_quantity >= 5) AS "variants_after_QC",
count(*) - count(*) FILTER (l_quantity >= 5) AS variants_removed, 100.0 * count(*) FILTER (l_quantity >= 5) / count(*) AS retention FROM lineitem GROUP BY 1""")
def qc_retention(spark, sf_dir):
    l = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    counted = l.groupBy("l_linenumber").agg(F.countDistinct("l_suppkey").alias("s"), F.count("*").alias("b"), F.sum((F.col("l_quantity") >= 5).cast("long")).alias("a"))
    return counted.select(*popgen.retention(F.concat(F.lit("chr"), F.col("l_linenumber").cast("string")), F.col("s"), F.col("b"), F.col("a")))


def _communities(e: DataFrame, s: DataFrame, method: str) -> DataFrame:
    rows = e.select(F.lit("C1").alias("parent"), F.col("src").alias("a"), F.col("dst").alias("b"), F.col("weight").alias("w"))
    return communities.communities(rows, s.select(F.lit("C1").alias("parent"), F.col("id").alias("v")), method).select(F.col("v").alias("id"), F.col("c").alias("community"))


@query()
def louvain_membership(spark, sf_dir):
    return _communities(of.strong_edges(spark, sf_dir), of.samples(spark, sf_dir), "louvain")


@query()
def leiden_membership(spark, sf_dir):
    return _communities(of.strong_edges(spark, sf_dir), of.samples(spark, sf_dir), "leiden")


@query()
def recursive_levels(spark, sf_dir):
    return communities.recursive(cut(of.strong_edges(spark, sf_dir)), of.samples(spark, sf_dir).select("id"), "louvain", 2, 1.0, MIN_SIZE)[0]


_MEMBERS = f"{sql('samples')} SELECT count(*) AS samples, count(*) AS members, count(DISTINCT id) AS different, 0 AS unknown, true AS least_is_member, 0 AS gainful FROM samples"


def _checked(spark: SparkSession, sf_dir: str, method: str) -> DataFrame:
    """Whether a partition has every sample once and is called after its least members, and how many gainful moves
    are left: of single samples (Leiden), of whole communities into others (Louvain)."""
    e, s = cut(of.strong_edges(spark, sf_dir)), of.samples(spark, sf_dir)
    found = cut(_communities(e, s, method))
    named = found.groupBy("community").agg(F.min("id").alias("least")).agg(F.min(F.col("least") == F.col("community")).alias("least_is_member"))
    unknown = found.join(s, "id", "left_anti").agg(F.count("*").cast("int").alias("unknown"))
    counts = s.agg(F.count("*").alias("samples")).crossJoin(found.agg(F.count("*").alias("members"), F.countDistinct("id").alias("different")))
    labels = found.select(F.lit("C1").alias("parent"), F.col("id").alias("v"), F.col("community").alias("c"))
    rows = e.select(F.lit("C1").alias("parent"), F.col("src").alias("a"), F.col("dst").alias("b"), F.col("weight").alias("w"))
    return counts.crossJoin(unknown).crossJoin(named).crossJoin(communities.moves_left(rows, labels, method == "louvain").agg(F.count("*").cast("int").alias("gainful")))  # single rows


@query(_MEMBERS)
def louvain_checks(spark, sf_dir):
    return _checked(spark, sf_dir, "louvain")


@query(_MEMBERS)
def leiden_checks(spark, sf_dir):
    return _checked(spark, sf_dir, "leiden")


_DETECT = """WITH a AS (SELECT 'v' || lpad(CAST(vec_id AS VARCHAR), 9, '0') AS s, h, i, CAST(embedding[i] > CASE h WHEN 0 THEN -0.05 ELSE 0.05 END AS INT) AS x FROM embeddings, range(1, 65) r(i), range(0, 2) q(h)),
e AS (SELECT a.s AS id1, a.h AS hap1, b.s AS id2, b.h AS hap2, a.i FROM a JOIN a b ON a.i = b.i AND a.x = b.x AND a.s < b.s),
g AS (SELECT *, i - row_number() OVER (PARTITION BY id1, hap1, id2, hap2 ORDER BY i) AS run FROM e),
r AS (SELECT id1, hap1, id2, hap2, min(i) AS f, max(i) AS l FROM g GROUP BY id1, hap1, id2, hap2, run),
k AS (SELECT *, (l - f) * 0.5 >= 7 AND l - f + 1 >= 15 AS seed FROM r WHERE (l - f) * 0.5 >= 2.5),
j AS (SELECT *, CASE WHEN f * 10000 - lag(l * 10000) OVER (PARTITION BY id1, hap1, id2, hap2 ORDER BY f) <= 25000 THEN 0 ELSE 1 END AS new FROM k),
n AS (SELECT *, sum(new) OVER (PARTITION BY id1, hap1, id2, hap2 ORDER BY f) AS part FROM j),
m AS (SELECT id1, hap1, id2, hap2, min(f) AS f, max(l) AS l FROM n GROUP BY id1, hap1, id2, hap2, part HAVING bool_or(seed))
SELECT id1, CAST(hap1 AS INT) AS hap1, id2, CAST(hap2 AS INT) AS hap2, 'chr1' AS chrom, CAST(f * 10000 AS BIGINT) AS start, CAST(l * 10000 AS BIGINT) AS "end", CAST((l - f) * 0.5 AS DOUBLE) AS length_cm FROM m WHERE (l - f) * 0.5 >= 7"""


@query(_DETECT)
def segment_detection(spark, sf_dir):
    """Signs of vector components as the alleles of two haplotypes of a sample."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.concat(F.lit("v"), F.lpad(F.col("vec_id").cast("string"), 9, "0")).alias("sample"), F.posexplode("embedding").alias("p", "x"))
    rows = rows.select("sample", (F.col("p") + 1).alias("i"), F.posexplode(F.array((F.col("x") > -0.05).cast("int"), (F.col("x") > 0.05).cast("int"))).alias("hap", "allele"))
    alleles = rows.select(F.lit("chr1").alias("chrom"), (F.col("i") * 10000).cast("long").alias("pos"), "sample", "hap", "allele")
    positions = alleles.select("chrom", "pos").distinct().withColumn("cm", F.col("pos") / 20000)
    return segments.detect(alleles, positions, Detection(min_seed=7.0, min_extend=2.5, min_output=7.0, min_markers=15, min_mac=1, max_gap=25000))
