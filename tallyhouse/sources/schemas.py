"""Declared schemas: no inference pass, and dirty columns always arrive as text."""

from __future__ import annotations

from pyspark.sql import types as T

# Building register as it lies in the file: the four dirty columns stay text
# until cleaning, whatever they happen to contain.
HOUSES_RAW = T.StructType(
    [
        T.StructField("house_id", T.LongType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("maintenance_year", T.StringType()),
        T.StructField("square", T.StringType()),
        T.StructField("population", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("locality_name", T.StringType()),
        T.StructField("address", T.StringType()),
        T.StructField("full_address", T.StringType()),
        T.StructField("communal_service_id", T.StringType()),
        T.StructField("description", T.StringType()),
    ]
)

# The warehouse table. Columns that are unsigned 32-bit at the source are LONG,
# since INT would overflow above 2^31 - 1.
HOUSES = T.StructType(
    [
        T.StructField("house_id", T.LongType(), nullable=False),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("maintenance_year", T.IntegerType()),
        T.StructField("square", T.FloatType()),
        T.StructField("population", T.LongType()),
        T.StructField("region", T.StringType()),
        T.StructField("locality_name", T.StringType()),
        T.StructField("address", T.StringType()),
        T.StructField("full_address", T.StringType()),
        T.StructField("communal_service_id", T.LongType()),
        T.StructField("description", T.StringType()),
    ]
)

WEB_LOGS = T.StructType(
    [
        T.StructField("ip", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("method", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("response_code", T.IntegerType()),
        T.StructField("response_size", T.IntegerType()),
    ]
)

PURCHASES = T.StructType(
    [
        T.StructField("item", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("quantity", T.IntegerType()),
    ]
)

EMPLOYEES = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("position", T.StringType()),
        T.StructField("salary", T.IntegerType()),
        T.StructField("hire_date", T.StringType()),
    ]
)

PEOPLE = T.StructType(
    [
        T.StructField("Name", T.StringType()),
        T.StructField("Age", T.IntegerType()),
        T.StructField("Profession", T.StringType()),
    ]
)
