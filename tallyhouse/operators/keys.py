"""Rows with new keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.session import stage


def known_keys(
    df: DataFrame, existing: DataFrame, key: str, *, buckets: int | None = None
) -> DataFrame:
    """Keys of df that occur in `existing`, each once.

    The big table is met by the distinct keys of the batch alone, one narrow row each
    however often a key repeats. When it is bucketed by the key, give the number of
    buckets: the batch keys are then laid out to match and the table is not shuffled.
    Without it the table's keys are made distinct in the tasks that read them and
    then shuffled, so a key that fills much of the table is shared by many tasks.
    """
    keys = df.select(key).filter(F.col(key).isNotNull()).distinct()
    stored = existing.select(key)
    if not buckets:
        return stored.distinct().join(keys, key, "left_semi")
    return stored.join(keys.repartition(buckets, key), key, "left_semi").distinct()


def new_rows(
    df: DataFrame, existing: DataFrame, key: str, *, buckets: int | None = None
) -> DataFrame:
    """Rows of df whose key does not occur in `existing`; NULL keys are left out.

    Repeats of a new key stay. The keys found on both sides are written out first,
    so Spark joins the full rows with a table whose size it knows: it broadcasts a
    small one, and beyond that shuffles both sides, where AQE splits a hot key.
    """
    known = stage(known_keys(df, existing, key, buckets=buckets), "known-keys")
    return df.filter(F.col(key).isNotNull()).join(known, key, "left_anti")
