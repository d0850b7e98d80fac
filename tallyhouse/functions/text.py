from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Positions of the access-log fields, counted from 1.
CLIENT_FIELD = 1
METHOD_FIELD = 6
URL_FIELD = 7


def _whitespace_parts(line: Column, limit: int) -> Column:
    return F.split(F.trim(line, F.lit(" \t")), r"\s+", limit)


def whitespace_field(line: Column, n: int) -> Column:
    """Field n (from 1) of a whitespace-separated line; NULL when the line is shorter."""
    return F.get(_whitespace_parts(line, n + 1), F.lit(n - 1))


def without_quotes(column: Column) -> Column:
    return F.translate(column, '"', "")


def access_log_fields(lines: DataFrame, line: str = "value") -> DataFrame:
    """client, method and url of each access-log line; NULL where there is none.

    One split serves all three, and it stops after the last field needed.
    """
    parts = lines.select(_whitespace_parts(F.col(line), URL_FIELD + 1).alias("parts"))

    def field(n):
        return F.get("parts", F.lit(n - 1))

    return parts.select(
        F.nullif(field(CLIENT_FIELD), F.lit("")).alias("client"),
        without_quotes(field(METHOD_FIELD)).alias("method"),
        F.nullif(field(URL_FIELD), F.lit("")).alias("url"),
    )
