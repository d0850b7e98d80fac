"""Filter, choose and sort rows of small staff tables; SQL over a view."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.sources.tables import register_view


def with_value(df: DataFrame, column: str, value: str) -> DataFrame:
    return df.filter(F.col(column) == value)


def at_least(df: DataFrame, column: str, bound) -> DataFrame:
    """Rows with column >= bound; NULL drops out, and the filter reaches the scan."""
    return df.filter(F.col(column) >= bound)


def sorted_descending(df: DataFrame, column: str, *ties: str) -> DataFrame:
    """Sorted by the column, largest first.

    Give a near-unique tie-break: the range partitioner can then also cut between
    rows with the same value, so a value that fills a third of the table is shared
    by many tasks.
    """
    return df.orderBy(F.col(column).desc_nulls_last(), *[F.col(t).asc_nulls_last() for t in ties])


def at_least_by_sql(df: DataFrame, column: str, bound, view: str) -> DataFrame:
    """The same filter as SQL over a registered view."""
    register_view(df, view)
    return df.sparkSession.sql(f"SELECT * FROM {view} WHERE {column} >= :bound", {"bound": bound})
