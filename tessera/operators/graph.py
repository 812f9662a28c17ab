"""The sharing graph as tables: vertices (id, ...), edges (src, dst, weight), labels (id, label)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def unknown_endpoints(edges: DataFrame, samples: DataFrame) -> DataFrame:
    """Ends of edges that aren't samples, and of how many edges: (id, edges)."""
    ends = edges.select(F.explode(F.array("src", "dst")).alias("id"))
    return ends.groupBy("id").agg(F.count("*").alias("edges")).join(samples.select("id"), "id", "left_anti")


def duplicate_edges(edges: DataFrame) -> DataFrame:
    """Unordered pairs with more than one edge of positive weight: (src, dst, edges)."""
    pair = edges.where("weight > 0").groupBy(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"))
    return pair.agg(F.count("*").alias("edges")).where("edges > 1")


def build(edges: DataFrame, samples: DataFrame) -> DataFrame:
    """Edges of positive weight, lesser id first.  Raises if an end is unknown, an edge repeats or none is left."""
    if (row := unknown_endpoints(edges, samples).first()) is not None:
        raise ValueError(f"{row['id']} is not a sample")
    if (row := duplicate_edges(edges).first()) is not None:
        raise ValueError(f"{row['src']} and {row['dst']} have {row['edges']} edges")
    out = edges.where("weight > 0").select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"), "weight")
    if out.isEmpty():
        raise ValueError("no edge has a positive weight")
    return out


def degrees(edges: DataFrame, samples: DataFrame) -> DataFrame:
    """(id, degree, strength) of every sample, those without edges included."""
    ends = edges.select(F.explode(F.array("src", "dst")).alias("id"), "weight").groupBy("id").agg(F.count("*").alias("degree"), F.sum("weight").alias("strength"))
    return samples.select("id").join(ends, "id", "left").select("id", F.coalesce("degree", F.lit(0)).alias("degree"), F.coalesce("strength", F.lit(0.0)).alias("strength"))


def isolated(edges: DataFrame, samples: DataFrame) -> DataFrame:
    """Samples without edges."""
    return samples.select("id").join(edges.select(F.explode(F.array("src", "dst")).alias("id")), "id", "left_anti")


def induced(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """Edges inside a label, of all labels at once: (label, src, dst, weight)."""
    a = labels.select(F.col("id").alias("src"), F.col("label").alias("label"))
    b = labels.select(F.col("id").alias("dst"), F.col("label").alias("label"))
    return edges.join(a, "src").join(b, ["dst", "label"]).select("label", "src", "dst", "weight")


def modularity_terms(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """(label, inside, strength, total): weight inside, summed strength of members, weight of all edges."""
    strength = degrees(edges, labels).join(labels, "id").groupBy("label").agg(F.sum("strength").alias("strength"))
    inside = induced(edges, labels).groupBy("label").agg(F.sum("weight").alias("inside"))
    total = edges.agg(F.sum("weight").alias("total"))
    return strength.join(inside, "label", "left").select("label", F.coalesce("inside", F.lit(0.0)).alias("inside"), "strength").join(F.broadcast(total))


def modularity(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """One row: the modularity of a labelling, at resolution 1."""
    share = F.col("inside") / F.col("total") - F.pow(F.col("strength") / (2 * F.col("total")), 2)
    return modularity_terms(edges, labels).agg(F.sum(share).alias("modularity"))


def with_gain(by_level: DataFrame) -> DataFrame:
    """(level, modularity) with the gain over the level before."""
    before = F.lag("modularity").over(Window.orderBy("level"))
    return by_level.withColumn("gain", F.col("modularity") - before)


def sizes(labels: DataFrame, max_level: int, min_size: int) -> DataFrame:
    """Members (id, level, label) counted by level and label, with what may be refined further."""
    counted = labels.groupBy("level", F.col("label").alias("cluster")).agg(F.count("*").alias("size"))
    return counted.select("level", "cluster", "size", ((F.col("level") < max_level) & (F.col("size") >= min_size)).alias("eligible_for_further_refinement"), (F.col("level") == max_level).alias("terminal_level"))
