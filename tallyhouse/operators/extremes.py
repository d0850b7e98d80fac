"""Smallest and largest record of each group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.operators.counts import top_rows

PLACE = "__place"


def _known(df: DataFrame, group: str, measure: str) -> DataFrame:
    """Rows with a group and a value to compare.

    NaN is none. Spark orders it above infinity, so one comparison drops it along
    with NULL.
    """
    value = F.col(measure)
    if df.schema[measure].dataType in (T.FloatType(), T.DoubleType()):
        comparable = value <= F.lit(float("inf"))
    else:
        comparable = value.isNotNull()
    return df.filter(comparable & F.col(group).isNotNull())


def _reversed(df: DataFrame, measure: str) -> Column:
    """A number that falls as the measure rises; for whole numbers one that cannot overflow."""
    value = F.col(measure)
    if isinstance(df.schema[measure].dataType, T.IntegralType):
        return F.bitwise_not(value)
    return -value


def _rank(measure: Column, ties: Sequence[str]) -> Column:
    """Order by the measure, then by the tie-breaks with NULL last."""
    parts = [measure]
    for tie in ties:
        parts += [F.col(tie).isNull(), F.col(tie)]
    return F.struct(*parts)


def extremes_by_group(df: DataFrame, group: str, measure: str, label: str) -> DataFrame:
    """Per group the smallest and largest measure, each with the label of its record.

    Rows whose measure or group is NULL take no part; among equal measures the
    smallest label wins. Numbers take one aggregate with a map-side part: a task
    sorts the three columns of its rows and sends one row per group it has seen, so
    neither a hot group nor whole rows are shuffled. Dates, timestamps and text have
    no reverse to order by; there the smallest label of each measure is found first.
    """
    value, known = F.col(measure), _known(df, group, measure)
    if isinstance(df.schema[measure].dataType, T.NumericType):
        low = F.min_by(label, _rank(value, [label]))
        high = F.min_by(label, _rank(_reversed(df, measure), [label]))
    else:
        first = F.min_by(label, _rank(F.lit(0), [label])).alias(label)
        known = known.groupBy(group, measure).agg(first)
        low, high = F.min_by(label, value), F.max_by(label, value)
    return known.groupBy(group).agg(
        low.alias(f"min_{label}"),
        F.min(value).alias(f"min_{measure}"),
        high.alias(f"max_{label}"),
        F.max(value).alias(f"max_{measure}"),
    )


def extreme_rows_by_group(
    df: DataFrame, group: str, measure: str, *ties: str, largest: bool = False
) -> DataFrame:
    """The whole record with the smallest (or largest) measure of each group.

    NULL groups and NULL measures take no part. A row number that keeps the first row:
    Spark limits each group in every task before the shuffle, so a hot group sends one
    row per task. Each task sorts its rows. Any ordered type may be the measure.
    """
    value = F.col(measure)
    order = [value.desc() if largest else value.asc(), *[F.col(t).asc_nulls_last() for t in ties]]
    place = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    numbered = _known(df, group, measure).withColumn(PLACE, place)
    return numbered.filter(F.col(PLACE) == 1).drop(PLACE)


def widest_spread(extremes: DataFrame, group: str, measure: str, k: int) -> DataFrame:
    """The k groups with the largest difference between their extremes."""
    name = f"{measure}_difference"
    spread = extremes.withColumn(name, F.col(f"max_{measure}") - F.col(f"min_{measure}"))
    return top_rows(spread, k, name, group)
