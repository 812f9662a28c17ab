"""Segments, regions, genotypes and samples seen in the given tables, the same in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Lines that one task sums up by pair.
PART = 250_000

SQL = {
    "seg": """seg AS (SELECT 'S' || lpad(CAST(l_suppkey AS VARCHAR), 6, '0') AS id1, 'S' || lpad(CAST(l_partkey % (SELECT count(*) FROM supplier) AS VARCHAR), 6, '0') AS id2,
  'chr' || CAST(l_linenumber AS VARCHAR) AS chrom, CAST(round(l_extendedprice * 100) AS BIGINT) AS s, CAST(round(l_extendedprice * 100) AS BIGINT) + CAST(l_quantity * 1000 AS BIGINT) AS e, l_quantity AS len, l_orderkey, l_linenumber FROM lineitem)""",
    "pairs": "pairs AS (SELECT least(id1, id2) AS ID1, greatest(id1, id2) AS ID2, chrom, len FROM seg WHERE id1 <> id2)",
    "gap": "gap AS (SELECT CAST(s_suppkey % 7 + 1 AS VARCHAR) AS chrom, CAST(floor(abs(s_acctbal) * 1000) AS BIGINT) AS s, CAST(floor(abs(s_acctbal) * 1000) AS BIGINT) + 50000 AS e FROM supplier)",
    "samples": "samples AS (SELECT 'S' || lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS id, 'N' || CAST(s_nationkey AS VARCHAR) AS label FROM supplier)",
    "edges": "edges AS (SELECT ID1 AS src, ID2 AS dst, sum(len) AS weight FROM pairs GROUP BY ALL)",
    "strong": "strong AS (SELECT e.* FROM edges e JOIN samples a ON a.id = src JOIN samples b ON b.id = dst WHERE weight >= (SELECT avg(weight) FROM edges))",
    "dose": """dose AS (SELECT CAST(vec_id AS VARCHAR) AS sample, 'P' || CAST(label AS VARCHAR) AS cluster, 'chr' || CAST((i - 1) // 16 + 1 AS VARCHAR) AS chrom, i * 10000 AS pos, 'v' || lpad(CAST(i AS VARCHAR), 3, '0') AS variant,
  CASE WHEN (vec_id + i) % 50 <> 0 THEN CAST(embedding[i] > -0.05 AS INT) + CAST(embedding[i] > 0.05 AS INT) END AS dosage FROM embeddings, unnest(range(1, len(embedding) + 1)) r(i))""",
}


def sql(*views: str) -> str:
    """A WITH clause of these views, in this order."""
    return "WITH " + ",\n".join(SQL[v] for v in views)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id1, id2, chrom, start, end, length_cm, l_orderkey, l_linenumber): lines of orders as segments.
    The supplier count is one number, sent along with the rows."""
    count = _table(spark, sf_dir, "supplier").agg(F.count("*").alias("n"))
    name = lambda c: F.concat(F.lit("S"), F.lpad(c.cast("string"), 6, "0"))
    start = F.round(F.col("l_extendedprice") * 100).cast("long")
    return _table(spark, sf_dir, "lineitem").join(F.broadcast(count)).select(
        name(F.col("l_suppkey")).alias("id1"), name(F.col("l_partkey") % F.col("n")).alias("id2"), F.concat(F.lit("chr"), F.col("l_linenumber").cast("string")).alias("chrom"),
        start.alias("start"), (start + (F.col("l_quantity") * 1000).cast("long")).alias("end"), F.col("l_quantity").alias("length_cm"), "l_orderkey", "l_linenumber",
    )


def proper(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments(spark, sf_dir).where("id1 <> id2")


def dealt_by_pair(spark: SparkSession, sf_dir: str, pairs: DataFrame) -> DataFrame:
    """Pairs of the lines dealt so that a task has about PART of them, however many there are."""
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-_table(spark, sf_dir, "lineitem").count() // PART))
    return pairs.repartition(parts, "ID1", "ID2")


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.floor(F.abs("s_acctbal") * 1000).cast("long")
    return _table(spark, sf_dir, "supplier").select((F.col("s_suppkey") % 7 + 1).cast("string").alias("chrom"), start.alias("start"), (start + 50000).alias("end"))


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "supplier").select(F.concat(F.lit("S"), F.lpad(F.col("s_suppkey").cast("string"), 6, "0")).alias("id"), F.concat(F.lit("N"), F.col("s_nationkey").cast("string")).alias("label"))


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    pair = proper(spark, sf_dir).groupBy(F.least("id1", "id2").alias("src"), F.greatest("id1", "id2").alias("dst"))
    return pair.agg(F.sum("length_cm").alias("weight"))


def strong_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges between samples with at least the mean weight."""
    e, s = edges(spark, sf_dir), samples(spark, sf_dir).select("id")
    e = e.join(F.broadcast(e.agg(F.avg("weight").alias("mean")))).where("weight >= mean")
    return e.join(s.withColumnRenamed("id", "src"), "src").join(s.withColumnRenamed("id", "dst"), "dst").select("src", "dst", "weight")


def dosages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sample, cluster, chrom, pos, variant, dosage): vector components cut in three; some missing."""
    rows = _table(spark, sf_dir, "embeddings").select("vec_id", "label", F.posexplode("embedding").alias("p", "x")).withColumn("i", F.col("p") + 1)
    dosage = F.when((F.col("vec_id") + F.col("i")) % 50 != 0, (F.col("x") > -0.05).cast("int") + (F.col("x") > 0.05).cast("int"))
    return rows.select(
        F.col("vec_id").cast("string").alias("sample"), F.concat(F.lit("P"), F.col("label").cast("string")).alias("cluster"), F.concat(F.lit("chr"), (F.floor((F.col("i") - 1) / 16) + 1).cast("string")).alias("chrom"),
        (F.col("i") * 10000).cast("long").alias("pos"), F.concat(F.lit("v"), F.lpad(F.col("i").cast("string"), 3, "0")).alias("variant"), dosage.alias("dosage"),
    )
