"""Strict parsing and printing of numbers, chromosome names, dynamic column names."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Decimal numbers as the text formats allow them: digit groups may be joined by underscores.
DECIMAL = r"^[+-]?([0-9](_?[0-9])*(\.([0-9](_?[0-9])*)?)?|\.[0-9](_?[0-9])*)([eE][+-]?[0-9](_?[0-9])*)?$"
SPECIAL = r"(?i)^[+-]?(inf|infinity|nan)$"
INTEGER = r"^[+-]?[0-9](_?[0-9])*$"


def parse_float(text: Column) -> Column:
    """The number a text denotes (also inf and nan), or null if it denotes none."""
    text = F.trim(text)
    special = F.when(text.rlike("(?i)nan"), F.lit(float("nan"))).when(text.startswith("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf")))
    return F.when(text.rlike(DECIMAL), F.replace(text, F.lit("_"), F.lit("")).try_cast("double")).when(text.rlike(SPECIAL), special)


def finite(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))


def parse_count(text: Column) -> Column:
    """A whole number, or null."""
    text = F.trim(text)
    return F.when(text.rlike(INTEGER), F.regexp_replace(text, "_", "").try_cast("bigint"))


@F.pandas_udf(StringType())
def _general(values: pd.Series) -> pd.Series:
    return values.map(lambda v: format(v, ".10g"))


def format_general(column: str | Column) -> Column:
    """Ten significant digits, no trailing zeros; null stays null."""
    column = F.col(column) if isinstance(column, str) else column
    return F.when(column.isNotNull(), _general(column))


@F.pandas_udf(StringType())
def format_percent(values: pd.Series) -> pd.Series:
    """Two decimals, ties to even as binary floating point has them."""
    return values.map(lambda v: None if pd.isna(v) else f"{v:.2f}")


def threshold_names(threshold: float) -> tuple[str, str]:
    """Names of the two columns that depend on the threshold."""
    label = format(threshold, ".10g")
    return f"number_of_segments_ge_{label}_cM", f"total_length_of_segments_ge_{label}_cM"


def bare_chromosome(name: Column) -> Column:
    """A chromosome's name without a leading chr."""
    return F.regexp_replace(name, "^chr", "")


def start_from_zero(start: Column) -> Column:
    """First position of a 1-based interval, counted from 0, never negative."""
    return F.greatest(start - 1, F.lit(0).cast("long"))
