"""Checks on a whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.operators.counts import count_where

GROUP_SIZE = "__group_size"
DIGEST = "__digest_{}"
# Types of fixed width, grouped as they are.
NARROW = (T.NumericType, T.BooleanType, T.DatetimeType, T.DayTimeIntervalType, T.YearMonthIntervalType)
WHOLE_JSON = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def _grouping_key(field: T.StructField) -> Column:
    """The column if its type has a fixed width, else the SHA-256 of its value.

    Text, binary, arrays and structs of every length become digests, so rows shuffle
    at a bounded width; NULL stays NULL. Equal keys mean equal values as far as
    SHA-256 has no known collision.
    """
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, NARROW):
        return column
    if not isinstance(field.dataType, (T.StringType, T.BinaryType)):
        column = F.when(column.isNotNull(), F.to_json(F.struct(column.alias("v")), WHOLE_JSON))
    return F.sha2(column.cast("binary"), 256)


def _keyed(df: DataFrame) -> tuple[list[Column], list[str]]:
    names = [DIGEST.format(i) for i in range(len(df.columns))]
    return [_grouping_key(f).alias(n) for f, n in zip(df.schema, names)], names


def _row_groups(df: DataFrame) -> DataFrame:
    keys, names = _keyed(df)
    return df.select(*keys).groupBy(*names).agg(F.count(F.lit(1)).alias(GROUP_SIZE))


def empty_row_records(df: DataFrame) -> DataFrame:
    """The rows whose first column is NULL."""
    return df.filter(F.col(f"`{df.columns[0]}`").isNull())


def repeated_row_records(df: DataFrame, name: str = "n") -> DataFrame:
    """Each row that occurs more than once, once, and how often it does.

    Repeats are found on the digests; only repeated rows are then looked up whole, one
    for each task that has any.
    """
    keys, names = _keyed(df)
    repeated = _row_groups(df).filter(F.col(GROUP_SIZE) > 1).withColumnsRenamed(
        {n: f"{n}_repeated" for n in names}
    )
    whole = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("__row"), *keys)
    same = [F.col(n).eqNullSafe(F.col(f"{n}_repeated")) for n in names]
    found = whole.join(repeated, same).groupBy(*names)
    once = found.agg(F.first("__row").alias("__row"), F.first(GROUP_SIZE).alias(GROUP_SIZE))
    return once.select("__row.*", F.col(GROUP_SIZE).alias(name))


def empty_rows(df: DataFrame) -> DataFrame:
    """Number of rows whose first column is NULL; only that column is read."""
    return count_where(empty_row_records(df), F.lit(True), "empty_rows")


def duplicate_groups(df: DataFrame) -> DataFrame:
    """Number of groups of identical rows, NULL equal to NULL; groups, not surplus rows."""
    return count_where(_row_groups(df), F.col(GROUP_SIZE) > 1, "duplicate_groups")


def quality_report(df: DataFrame) -> DataFrame:
    """Rows, empty rows and duplicate groups as one row, from one scan."""
    size = F.col(GROUP_SIZE)
    empty = F.col(DIGEST.format(0)).isNull()
    total = F.coalesce(F.sum(size), F.lit(0))
    return _row_groups(df).agg(
        total.alias("rows"),
        F.coalesce(F.sum(F.when(empty, size)), F.lit(0)).alias("empty_rows"),
        F.count_if(size > 1).alias("duplicate_groups"),
    )
