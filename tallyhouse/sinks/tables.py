"""The warehouse table and its incremental load."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyhouse.operators.keys import new_rows
from tallyhouse.sources.schemas import HOUSES


def create_houses_table(
    spark: SparkSession, table: str = "houses", *, buckets: int = 64, location: str | None = None
) -> None:
    """Create the table if it is absent, bucketed and sorted by house_id.

    A load then joins against it without shuffling what is already stored. Choose
    the number of buckets so that one bucket's keys fit a task.
    """
    columns = ", ".join(
        f"{f.name} {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in HOUSES
    )
    place = f"LOCATION '{location}'" if location else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet "
        f"CLUSTERED BY (house_id) SORTED BY (house_id) INTO {buckets} BUCKETS {place}"
    )


def append_by_name(df: DataFrame, table: str) -> None:
    """Append rows, matching columns by name (insertInto alone goes by position)."""
    _dealt_by_bucket(df, table).write.insertInto(table)


def _dealt_by_bucket(df: DataFrame, table: str) -> DataFrame:
    """Rows in the table's columns, those of a bucketed table dealt by bucket.

    A rebalance into as many parts as there are buckets sends each bucket to one task,
    so that a load leaves about one file per bucket. AQE cuts a part that one hot key
    has swollen.
    """
    spark = df.sparkSession
    rows = df.select(*[F.col(f.name).cast(f.dataType) for f in spark.table(table).schema])
    details = _described(spark, table)
    buckets, columns = details.get("Num Buckets"), details.get("Bucket Columns")
    if buckets and columns:
        names = [F.col(name) for name in columns.strip("[]").replace("`", "").split(", ")]
        rows = rows.hint("rebalance", int(buckets), *names)
    return rows


def load_new_rows(
    df: DataFrame, table: str, key: str = "house_id", *, repeated_keys: bool = False
) -> int:
    """Append the rows whose key the table does not hold yet; return how many went in.

    Rows with a NULL key are left out, as the table's key is not nullable. Repeats
    of a new key inside the batch all go in, as they do at the source. By default
    the stored keys are read bucket by bucket and not shuffled. A table in which
    one key fills much of its bucket is better read with `repeated_keys`: its files
    are then split freely and its keys made distinct before a shuffle.
    """
    spark = df.sparkSession
    details = _described(spark, table)
    stored, buckets = spark.table(table), int(details.get("Num Buckets", 0)) or None
    if repeated_keys:
        stored, buckets = spark.read.schema(stored.schema).parquet(details["Location"]), None
    loaded = Observation()
    fresh = new_rows(df, stored, key, buckets=buckets)
    counted = _dealt_by_bucket(fresh, table).observe(loaded, F.count(F.lit(1)).alias("n"))
    counted.write.insertInto(table)
    return loaded.get["n"]


def _described(spark: SparkSession, table: str) -> dict[str, str]:
    """Details of a table as DESCRIBE EXTENDED names them."""
    rows = spark.sql(f"DESCRIBE EXTENDED {table}").collect()
    return {row.col_name: row.data_type for row in rows}
