"""Relational tables over JDBC."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str],
    *,
    partition_column: str | None = None,
    lower_bound=None,
    upper_bound=None,
    num_partitions: int | None = None,
    predicates: Sequence[str] | None = None,
    fetch_size: int = 10_000,
) -> DataFrame:
    """A table as a DataFrame; filters and column choice are pushed to the database.

    With a partition column and its bounds the rows arrive over `num_partitions`
    connections; rows outside the bounds still arrive, in the first and last one.
    `predicates` gives one connection per condition instead, for keys that are not
    evenly spread. With neither, Spark uses one connection, and one task.
    """
    properties = {"fetchsize": str(fetch_size), **properties}
    if predicates is not None:
        if partition_column is not None:
            raise ValueError("give either predicates or a partition column, not both")
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=properties)
    if partition_column is None:
        return spark.read.jdbc(url, table, properties=properties)
    if lower_bound is None or upper_bound is None or num_partitions is None:
        raise ValueError("a partition column needs lower_bound, upper_bound and num_partitions")
    return spark.read.jdbc(
        url,
        table,
        column=partition_column,
        lowerBound=lower_bound,
        upperBound=upper_bound,
        numPartitions=num_partitions,
        properties=properties,
    )
