"""A corpus pipeline: documents pass five stages, each written as Parquet and read again by the next.

Toxic documents go; then lines that repeat or nearly repeat an earlier line; then all but one of
each group of near-duplicate documents; then documents that hold benchmark passages; what is left
is encoded into pieces.  ORACLE_SQL is None: a trained classifier and a tokenizer aren't SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import discard, identified, one_key, saved, small, table
from tessera.llm.decontamination import decontaminate
from tessera.llm.jaccard_join import jaccard_join
from tessera.llm.line_dedup import line_dedup
from tessera.llm.pieces import with_tokens
from tessera.llm.toxicity import fit, without_toxic


def _without(docs: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of docs that aren't in gone, by the given keys of common.identified; all columns."""
    named = docs.select(F.struct(*docs.columns).alias("_row"), F.col("doc_id").alias("_id"), F.col("text").alias("_text"))
    named = identified(named, "_id", "_text", ["_row"])
    return named.join(small(gone), keys, "left_anti").select("_row.*")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go, repeated rows alike; null and empty texts get the score
    that no words give."""
    return without_toxic(docs, fit(docs, table(spark, sf_dir, "labels")))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go; n_chars follows; a document that had text and keeps none goes with them.
    Null and empty texts stay."""
    kept = line_dedup(docs).where("n_removed = 0 or text rlike '[^ \t\n]'")
    return kept.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, the one with the least id; of rows that repeat id and text,
    one.  Null and empty texts are in no group."""
    rows = docs.select(F.struct(*docs.columns).alias("_row"), F.col("doc_id").alias("_id"), F.col("text").alias("_text"))
    rows = one_key(identified(rows, "_id", "_text", ["_row"]))
    found = jaccard_join(docs)
    out = rows.join(small(saved(found.where("not kept").select("doc"), "copies")), "doc", "left_anti")
    again = docs.groupBy("doc_id").count().where("count > 1")
    return (out if again.isEmpty() else out.dropDuplicates(["doc"])).select("_row.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with benchmark passages in at least one in twenty words go; texts without words stay."""
    found = decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return _without(docs, saved(found.where("contaminated").select("doc", "twin"), "contaminated"), ["doc", "twin"])


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with their tokens; `decoded` is what the tokens give back.  Null and empty texts have none."""
    return with_tokens(docs)


STAGES = [("toxicity", toxicity), ("lines", lines), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("encoding", encoding)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before, docs = docs, saved(stage(spark, docs, sf_dir), name)
        if name != STAGES[0][0]:
            discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
