"""Rows checked and counted while they are used: no job of their own looks for faults first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class Watched:
    """Rows with an error column observed on their way: how many there are, how many faults of each kind, where the first is.

    The counts are there once an action over `rows` has ended; `checked` then raises for faults, so nothing made from
    the rows is handed on before.  Counts are of one action; a stage that is run again may be counted again, faults are
    found all the same.
    """

    def __init__(self, rows: DataFrame, error: Column, kinds: list[str], *place: str):
        self.seen, self.kinds = Observation(), kinds
        marked = rows.withColumn("_error", error)
        first = F.min(F.when(F.col("_error").isNotNull(), F.struct(*place, F.col("_error").alias("error"))))
        of_kind = (F.count_if(F.coalesce(F.col("_error") == k, F.lit(False))).alias(k) for k in kinds)
        self.rows = marked.observe(self.seen, F.count("*").alias("lines"), *of_kind, first.alias("first")).drop("_error")

    def checked(self) -> dict[str, int]:
        """The number of rows, after the action; raises for the first faulty row, with the counts of all kinds of fault."""
        found = self.seen.get
        if found["first"] is not None:
            place = ", ".join(f"{k} {v}" for k, v in found["first"].asDict().items())
            counts = ", ".join(f"{found[k]} {k}" for k in self.kinds if found[k])
            raise ValueError(f"{place} ({counts} in {found['lines']} rows)")
        return {"lines": found["lines"]}
