"""Distinct items of each group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def items_by_group(df: DataFrame, group: str, item: str) -> DataFrame:
    """One row per group and distinct item, whatever the number of items.

    Spread over both, so no group sits in one task and no list has to fit a row.
    """
    return df.select(group, item).distinct()

