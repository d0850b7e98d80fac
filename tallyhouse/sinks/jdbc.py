from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str],
    *,
    keep_definition: bool = False,
    max_connections: int = 16,
    batch_size: int = 10_000,
) -> None:
    """Replace a database table with the rows of df.

    `keep_definition` empties the existing table instead of dropping it, so that
    its column types and indexes stay. The number of connections is bounded, as
    the database does not grow with the cluster. Each task commits its rows in one
    transaction; a task lost after its commit is run again, so give the table a key
    where a repeated row would matter.
    """
    writer = (
        df.write.mode("overwrite")
        .option("truncate", keep_definition)
        .option("numPartitions", max_connections)
        .option("batchsize", batch_size)
    )
    writer.jdbc(url, table, properties=dict(properties))
