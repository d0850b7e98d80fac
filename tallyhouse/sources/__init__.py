from tallyhouse.sources.files import (
    first_rows,
    read_access_log,
    read_csv,
    read_parquet,
    read_utf16_csv,
)
from tallyhouse.sources.jdbc import read_jdbc
from tallyhouse.sources.records import read_split_csv
from tallyhouse.sources.tables import read_view, read_warehouse, register_view

__all__ = [
    "first_rows",
    "read_access_log",
    "read_csv",
    "read_jdbc",
    "read_parquet",
    "read_split_csv",
    "read_utf16_csv",
    "read_view",
    "read_warehouse",
    "register_view",
]
