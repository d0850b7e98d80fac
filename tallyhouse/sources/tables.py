"""Named relations: temp views and warehouse tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def read_view(spark: SparkSession, sql: str, **relations: DataFrame) -> DataFrame:
    """Run SQL in which `{name}` stands for a DataFrame passed under that name."""
    return spark.sql(sql, **relations)


def read_warehouse(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)
