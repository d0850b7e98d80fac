"""Counts and top-k. Each count is added up map-side first, so a key that holds a
third of the rows costs one shuffled row per task like any other."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_count(df: DataFrame, name: str = "n") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def count_where(df: DataFrame, condition: Column, name: str = "n") -> DataFrame:
    """Rows that satisfy a condition. A filter rather than count_if, so that it reaches the scan."""
    return row_count(df.filter(condition), name)


def count_by(df: DataFrame, key: str, name: str = "n") -> DataFrame:
    """Rows per key value; NULL is a group of its own."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(name))


def distinct_count(
    df: DataFrame, column: str, name: str = "n", *, approximate: bool = False
) -> DataFrame:
    """Distinct non-NULL values. Exact unless asked otherwise."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(count(column).alias(name))


def domain_counts(df: DataFrame, column: str, domain: Sequence[str]) -> DataFrame:
    """One row with a count per value of a small fixed domain, zero where none occurs."""
    return df.agg(*[F.count_if(F.col(column) == value).alias(value) for value in domain])


def top_rows(df: DataFrame, k: int, measure: str, *ties: str) -> DataFrame:
    """The k rows with the largest measure; ties go to the smallest tie-break values.

    Planned as a per-task top k and one merge of those, never as a global sort.
    """
    return df.orderBy(
        F.col(measure).desc_nulls_last(), *[F.col(t).asc_nulls_last() for t in ties]
    ).limit(k)


def top_counts(df: DataFrame, key: str, k: int, name: str = "n") -> DataFrame:
    """The k most frequent key values."""
    return top_rows(count_by(df, key, name), k, name, key)


def argmax_group(df: DataFrame, key: str, total: Column, name: str) -> DataFrame:
    """The key with the largest aggregate and that aggregate; no row for empty input."""
    return top_rows(df.groupBy(key).agg(total.alias(name)), 1, name, key)
