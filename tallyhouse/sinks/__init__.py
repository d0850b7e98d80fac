from tallyhouse.sinks.files import write_parquet
from tallyhouse.sinks.jdbc import write_jdbc
from tallyhouse.sinks.tables import append_by_name, create_houses_table, load_new_rows
from tallyhouse.sinks.versions import load_version, read_version

__all__ = [
    "append_by_name",
    "create_houses_table",
    "load_new_rows",
    "load_version",
    "read_version",
    "write_jdbc",
    "write_parquet",
]
