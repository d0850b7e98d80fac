"""Compare a Spark result with SQL run by DuckDB on the same Parquet files."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pyarrow as pa

# The type each Spark type must have on the other side.
SQL_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "float": "FLOAT",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str):
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def _comparable(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def _rows(data: pa.Table) -> list[tuple]:
    columns = [data.column(name).to_pylist() for name in sorted(data.column_names)]
    rows = [tuple(map(_comparable, row)) for row in zip(*columns)]
    return sorted(rows, key=lambda row: [(v is None, str(v)) for v in row])


def differences(df, connection, sql: str) -> list[str]:
    """What differs, empty when names, types, row count and every value agree."""
    found = []
    relation = connection.sql(sql)
    ours = {name: SQL_TYPES.get(kind, kind) for name, kind in df.dtypes}
    theirs = {name: str(kind) for name, kind in zip(relation.columns, relation.types)}
    if ours != theirs:
        found.append(f"schema {ours} / {theirs}")
    table = relation.arrow()
    if not isinstance(table, pa.Table):
        table = table.read_all()
    mine, other = _rows(df.toArrow()), _rows(table)
    if len(mine) != len(other):
        found.append(f"rows {len(mine)} / {len(other)}")
    if mine != other:
        pairs = [(a, b) for a, b in zip(mine, other) if a != b][:2]
        found.append(f"values {pairs}"[:600])
    return found
