"""Sums per key and statistics over those sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators.counts import count_by


def totals_by(df: DataFrame, key: Column, amount: str, key_name: str, name: str) -> DataFrame:
    return df.groupBy(key.alias(key_name)).agg(F.sum(amount).alias(name))


def describe_totals(totals: DataFrame, total: str, suffix: str) -> DataFrame:
    """Minimum, maximum, mean and sample standard deviation of grouped totals.

    The last two are rounded to 2 digits; the deviation of a single total is NULL.
    """
    column = F.col(total)
    return totals.agg(
        F.min(column).alias(f"min_{suffix}"),
        F.max(column).alias(f"max_{suffix}"),
        F.round(F.avg(column), 2).alias(f"mean_{suffix}"),
        F.round(F.stddev(column), 2).alias(f"stddev_{suffix}"),
    )


def mean_and_median(df: DataFrame, column: str, digits: int = 0) -> DataFrame:
    """Exact mean and median of a numeric column, NULL left out, rounded.

    Rows are first counted per value, map-side; the median is then taken over the
    distinct values, which must fit one task. For a measure with very many distinct
    values use `mean_and_median_by_rank`.
    """
    value, n = F.col(column), F.col("n")
    counts = count_by(df.filter(value.isNotNull()), column, "n")
    return counts.agg(
        F.round(F.sum(value * n) / F.sum(n), digits).alias(f"mean_{column}"),
        F.round(F.percentile(value, 0.5, n), digits).alias(f"median_{column}"),
    )


def extreme_total(totals: DataFrame, key: str, total: str, *, largest: bool) -> DataFrame:
    """The group with the largest or smallest total; ties go to the smallest key."""
    order = F.col(total).desc_nulls_last() if largest else F.col(total).asc_nulls_last()
    return totals.orderBy(order, F.col(key).asc_nulls_last()).limit(1)
