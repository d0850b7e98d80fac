"""Long strings in upper case, order and repeats kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values
SHORTEST_DROPPED = 3


def long_upper(df: DataFrame, column: str, longer_than: int = SHORTEST_DROPPED) -> DataFrame:
    """One string per row."""
    text = F.col(column)
    return df.filter(F.length(text) > longer_than).select(F.upper(text).alias(column))


def long_upper_list(strings: Column, longer_than: int = SHORTEST_DROPPED) -> Column:
    """The same over an array of strings within each row."""
    return F.transform(F.filter(strings, lambda s: F.length(s) > longer_than), F.upper)
