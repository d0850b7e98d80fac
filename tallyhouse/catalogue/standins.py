"""The shared test tables in the roles the analyses expect.

The tables hold no NULL and no dirty text, so both are derived here, by expressions
the oracle SQL states in the same way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def web_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as a structured web-server log."""
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("10.0.0."), F.col("user_id")).alias("ip"),
        F.col("ts").alias("timestamp"),
        F.when(kind.isin("click", "view"), "GET")
        .when(kind == "signup", "POST")
        .when(kind == "purchase", "PUT")
        .otherwise("DELETE")
        .alias("method"),
        F.concat(
            F.lit("/"), kind, F.lit("/"), F.regexp_extract("props", r"(\d+)", 1)
        ).alias("url"),
        F.when(kind == "error", 404)
        .when(kind == "purchase", 500)
        .when(kind == "signup", 301)
        .otherwise(200)
        .alias("response_code"),
        F.round(F.col("value") * 100).cast("int").alias("response_size"),
    )


def access_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events rendered as raw access-log lines, some of them blank, short or without a url."""
    head = F.concat(
        F.col("ip"), F.lit(" - - ["), F.date_format("timestamp", "dd/MMM/yyyy:HH:mm:ss"), F.lit(" +0000]")
    )
    request = F.concat(head, F.lit(' "'), F.col("method"))
    whole = F.concat(
        request,
        F.lit(" "),
        F.col("url"),
        F.lit(' HTTP/1.1" '),
        F.col("response_code"),
        F.lit(" "),
        F.col("response_size"),
    )
    kind = F.col("response_size") % 40
    return web_logs(spark, sf_dir).select(
        F.when(kind == 0, "")
        .when(kind == 1, F.concat(F.lit("  "), "ip", F.lit(" ")))
        .when(kind == 2, head)
        .when(kind == 3, request)
        .otherwise(whole)
        .alias("value")
    )


def building_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as an uncleaned building register (schema HOUSES_RAW)."""
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    size_text = F.col("o_totalprice").cast("decimal(12,2)").cast("string")
    customer_text = F.col("o_custkey").cast("string")
    region = F.concat(F.lit("R"), customer_text)
    address = F.concat(F.lit("Order "), F.col("o_orderkey"))
    order = F.col("o_orderkey")
    # Built over twelve decades; one order in fifty has a year at a bound or beyond it.
    year = F.year("o_orderdate") - order % 12 * 10
    for remainder, odd in enumerate([205, 1000, 1001, 1999, 2000, 2025]):
        year = F.when(order % 50 == remainder, odd).otherwise(year)
    place = F.concat(F.nullif(priority, F.lit("4-NOT SPECIFIED")), F.lit("/"), F.col("o_custkey") % 4)
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("house_id"),
        (F.col("o_custkey") / 1000).alias("latitude"),
        (F.col("o_orderkey") / 1000).alias("longitude"),
        F.when(status != "P", F.concat(year, F.lit(".0"))).alias(
            "maintenance_year"
        ),
        F.when(priority == "1-URGENT", "—")
        .when(priority == "2-HIGH", F.regexp_replace(size_text, r"(\d)(\d{3}\.)", "$1 $2"))
        .when(priority == "3-MEDIUM", "NaN")
        .otherwise(size_text)
        .alias("square"),
        F.when(priority == "5-LOW", "—")
        .when(priority == "2-HIGH", "1 000")
        .otherwise(customer_text)
        .alias("population"),
        region.alias("region"),
        place.alias("locality_name"),
        address.alias("address"),
        F.concat(region, F.lit(", "), address).alias("full_address"),
        F.when(status == "O", "").otherwise(customer_text).alias("communal_service_id"),
        F.concat(priority, F.lit("\n"), status).alias("description"),
    )


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as purchases, the price as decimal so that sums are exact."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").cast("string").alias("item"),
        F.col("l_returnflag").alias("category"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("price"),
        F.col("l_quantity").cast("int").alias("quantity"),
    )


def part_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part as (item, category)."""
    return table(spark, sf_dir, "part").select(
        F.col("p_name").alias("item"), F.col("p_type").alias("category")
    )


def part_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part as buildings: region, square, address."""
    return table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("region"),
        F.col("p_retailprice").cast("float").alias("square"),
        F.col("p_name").alias("address"),
        F.col("p_partkey").alias("house_id"),
    )
