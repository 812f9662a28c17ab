"""Segments summed up by unordered pair, in one or two mergeable steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import finite, format_general, parse_float, threshold_names

STATISTICS = ["n", "total", "sumsq", "low", "high", "n_ge", "total_ge"]


def canonical(segments: DataFrame, id1: str = "id1", id2: str = "id2", length: str = "length_cm") -> DataFrame:
    """(ID1, ID2, len, ...): the lesser id by code point first.  Other columns are kept."""
    others = [c for c in segments.columns if c not in (id1, id2, length)]
    return segments.select(F.least(id1, id2).alias("ID1"), F.greatest(id1, id2).alias("ID2"), F.col(length).alias("len"), *others)


def partial(segments: DataFrame, threshold: float, *by: str) -> DataFrame:
    """Sufficient statistics of each pair (within `by`)."""
    length, long = F.col("len"), F.col("len") >= threshold
    return segments.groupBy(*by, "ID1", "ID2").agg(
        F.count("*").alias("n"), F.sum(length).alias("total"), F.sum(length * length).alias("sumsq"), F.min(length).alias("low"), F.max(length).alias("high"),
        F.sum(long.cast("long")).alias("n_ge"), F.sum(F.when(long, length).otherwise(0.0)).alias("total_ge"),
    )


def merged(statistics: DataFrame) -> DataFrame:
    """Statistics of pairs from statistics of their parts."""
    how = {"low": F.min, "high": F.max}
    return statistics.groupBy("ID1", "ID2").agg(*(how.get(c, F.sum)(c).alias(c) for c in STATISTICS))


def summary(statistics: DataFrame, threshold: float, *by: str, products: bool = False) -> DataFrame:
    """The published columns; the deviation is that of the population.  products: also total x mean,
    which some configurations name as an edge weight."""
    mean = F.col("total") / F.col("n")
    n_ge, total_ge = threshold_names(threshold)
    out = statistics.select(
        *by, "ID1", "ID2", F.col("n").alias("number_of_IBD_segments"), F.col("total").alias("total_IBD_length_cM"), F.col("sumsq").alias("sum_squared_IBD_length_cM"),
        mean.alias("mean_IBD_length_cM"), F.col("low").alias("min_IBD_length_cM"), F.col("high").alias("max_IBD_length_cM"),
        F.sqrt(F.greatest(F.lit(0.0), F.col("sumsq") / F.col("n") - mean * mean)).alias("sd_IBD_length_cM"), F.col("n_ge").alias(n_ge), F.col("total_ge").alias(total_ge),
    )
    if products:
        out = out.withColumn("total_IBD_length_x_mean_IBD_length_cM2", F.col("total_IBD_length_cM") * F.col("mean_IBD_length_cM"))
    return out


def as_printed(statistics: DataFrame) -> DataFrame:
    """Statistics as they read after a round through ten printed digits."""
    return statistics.withColumns({c: format_general(c).cast("double") for c in ("total", "sumsq", "low", "high", "total_ge")})


def statistics_of(summaries: DataFrame, threshold: float) -> DataFrame:
    """Statistics back from published columns."""
    n_ge, total_ge = threshold_names(threshold)
    names = dict(zip(STATISTICS, ["number_of_IBD_segments", "total_IBD_length_cM", "sum_squared_IBD_length_cM", "min_IBD_length_cM", "max_IBD_length_cM", n_ge, total_ge], strict=True))
    return summaries.select("ID1", "ID2", *(F.col(v).alias(k) for k, v in names.items()))


def segment_errors(fields: Column) -> Column:
    """What is wrong with a split segment line, null if nothing."""
    error = lambda value: (
        F.when(F.size(fields) != 8, "field_count")
        .when((F.get(fields, F.lit(0)) == "") | (F.get(fields, F.lit(2)) == ""), "empty_id")
        .when(F.get(fields, F.lit(0)) == F.get(fields, F.lit(2)), "self_pair")
        .when(value.isNull(), "not_a_number")
        .when(~finite(value), "not_finite")
        .when(value < 0, "negative")
    )
    # the only item of an array, so that the number is parsed once and not at each of its places
    return F.get(F.transform(F.array(parse_float(F.get(fields, F.lit(7)))), error), F.lit(0))


def summary_errors(threshold: float) -> Column:
    """What is wrong with a row of published columns (already numbers), null if nothing."""
    n_ge, total_ge = threshold_names(threshold)
    counts = [F.col("number_of_IBD_segments"), F.col(n_ge)]
    floats = [F.col(c) for c in ("total_IBD_length_cM", "sum_squared_IBD_length_cM", "min_IBD_length_cM", "max_IBD_length_cM", total_ge)]
    any_of = lambda tests: F.greatest(*(F.coalesce(t, F.lit(False)) for t in tests))
    return (
        F.when(F.coalesce(F.col("ID1"), F.lit("")).isin("") | F.coalesce(F.col("ID2"), F.lit("")).isin(""), "empty_id")
        .when(F.col("ID1") == F.col("ID2"), "self_pair")
        .when(any_of(c.isNull() for c in counts + floats), "not_a_number")
        .when(any_of(~finite(c) for c in floats), "not_finite")
        .when(any_of(c < 0 for c in counts + floats), "negative")
        .when(counts[0] < 1, "no_segments")
        .when(counts[1] > counts[0], "threshold_count")
        .when(floats[2] > floats[3], "min_above_max")
        .when(floats[4] > floats[0] + 1e-8, "threshold_length")
    )


def first_error(rows: DataFrame, error: Column, *place: str) -> None:
    """Raise for the first faulty row in the order of `place` (say file and line), if there is one."""
    found = rows.withColumn("error", error).where("error is not null").agg(F.min(F.struct(*place, "error")).alias("first")).first()["first"]
    if found is not None:
        raise ValueError(", ".join(f"{k} {v}" for k, v in found.asDict().items()))
