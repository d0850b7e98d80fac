"""Every operation as a named query over the shared test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.catalogue.standins import (
    access_log_lines,
    building_register,
    part_catalogue,
    part_sizes,
    purchases,
    table,
    web_logs,
)
from tallyhouse.functions.cleaning import text_to_float, text_to_int
from tallyhouse.functions.text import access_log_fields
from tallyhouse.operators.counts import count_where, row_count
from tallyhouse.operators.extremes import extreme_rows_by_group
from tallyhouse.operators.extremes import extremes_by_group as extremes
from tallyhouse.operators.keys import new_rows
from tallyhouse.operators.lists import items_by_group
from tallyhouse.operators.quality import (
    duplicate_groups,
    empty_row_records,
    empty_rows,
    repeated_row_records,
)
from tallyhouse.operators.ranks import mean_and_median_by_rank
from tallyhouse.operators.sketched import top_counts_by_cells
from tallyhouse.operators.totals import mean_and_median
from tallyhouse.plans import accesslog, buildings, staff, strings, weblogs
from tallyhouse.plans import purchases as shop
from tallyhouse.session import fresh_path
from tallyhouse.sinks.files import write_parquet
from tallyhouse.sinks.tables import create_houses_table, load_new_rows
from tallyhouse.sinks.versions import load_version, read_version
from tallyhouse.sources.files import first_rows, read_access_log, read_csv, read_utf16_csv
from tallyhouse.sources.records import read_split_csv
from tallyhouse.sources.schemas import WEB_LOGS
from tallyhouse.sources.tables import read_view, read_warehouse

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

# Bounds the oracle SQL repeats.
CURRENT_YEAR = 2000
FIRST_DECADE = 1900
MIN_PRICE = 60_000
MIN_BALANCE = 5000


def query(function: Query) -> Query:
    """Register under the function's name; a trailing underscore only avoids a clash."""
    QUERIES[function.__name__.rstrip("_")] = function
    return function


# Structured log


@query
def top_clients(spark, sf_dir):
    return weblogs.top_clients(web_logs(spark, sf_dir))


@query
def top_parts_by_cells(spark, sf_dir):
    """Parts of the most order lines: very many values of much the same count."""
    return top_counts_by_cells(table(spark, sf_dir, "lineitem"), "l_partkey", 20, "n_lines")


@query
def top_users_by_cells(spark, sf_dir):
    return top_counts_by_cells(table(spark, sf_dir, "events"), "user_id", 10, "n_events")


@query
def count_by_method(spark, sf_dir):
    return weblogs.method_counts(web_logs(spark, sf_dir))


@query
def error_count(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return count_where(events, F.col("event_type") == "error", "error_count")


@query
def not_found_count(spark, sf_dir):
    return weblogs.not_found_count(web_logs(spark, sf_dir))


@query
def bytes_by_day(spark, sf_dir):
    return weblogs.daily_volume_sorted(web_logs(spark, sf_dir))


@query
def daily_stats(spark, sf_dir):
    return weblogs.daily_statistics(weblogs.daily_volume(web_logs(spark, sf_dir)))


@query
def most_active_day(spark, sf_dir):
    return weblogs.most_active_day(weblogs.daily_volume(web_logs(spark, sf_dir)))


@query
def least_active_day(spark, sf_dir):
    return weblogs.least_active_day(weblogs.daily_volume(web_logs(spark, sf_dir)))


@query
def csv_logs(spark, sf_dir):
    """The log written as CSV, read back under its schema and analysed."""
    path = fresh_path(spark, "web-logs-csv")
    web_logs(spark, sf_dir).write.option("header", True).csv(path)
    return weblogs.method_counts(read_csv(spark, path, WEB_LOGS).filter("response_code = 404"))


@query
def web_log_report(spark, sf_dir):
    """The whole log analysis from one scan."""
    return weblogs.report(web_logs(spark, sf_dir))


# Raw access log


def _requests(spark, sf_dir):
    return access_log_fields(access_log_lines(spark, sf_dir))


@query
def access_log_summary(spark, sf_dir):
    return accesslog.summary(_requests(spark, sf_dir))


@query
def access_log_clients(spark, sf_dir):
    return accesslog.distinct_clients(_requests(spark, sf_dir))


@query
def access_log_methods(spark, sf_dir):
    return accesslog.reported_methods(_requests(spark, sf_dir))


@query
def access_log_top_url(spark, sf_dir):
    return accesslog.top_url(_requests(spark, sf_dir))


@query
def access_log_report(spark, sf_dir):
    """The log as a text file, read back line by line and reported."""
    path = fresh_path(spark, "access-log")
    access_log_lines(spark, sf_dir).write.text(path)
    return accesslog.report(read_access_log(spark, path))


@query
def access_log_no_post(spark, sf_dir):
    """A log in which one of the reported methods never occurs."""
    method = F.col("method")
    return accesslog.reported_methods(
        _requests(spark, sf_dir).filter(method.isNull() | (method != "POST"))
    )


# Building register


@query
def clean_numeric_text(spark, sf_dir):
    register = building_register(spark, sf_dir)
    return register.select(
        "house_id", text_to_float(F.col("square"), strip_spaces=True).alias("square")
    )


@query
def clean_int_text(spark, sf_dir):
    register = building_register(spark, sf_dir)
    return register.select(
        "house_id",
        text_to_int(F.col("maintenance_year")).alias("maintenance_year"),
        text_to_int(F.col("population")).alias("population"),
        text_to_int(F.col("communal_service_id")).alias("communal_service_id"),
    )


@query
def clean_register(spark, sf_dir):
    return buildings.clean_register(building_register(spark, sf_dir))


@query
def empty_rows_(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    users = events.select(F.nullif("event_type", F.lit("signup")).alias("kind"), "user_id")
    return empty_rows(users)


@query
def duplicate_groups_(spark, sf_dir):
    return duplicate_groups(table(spark, sf_dir, "documents").select("text", "lang"))


@query
def empty_row_records_(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    users = events.select(F.nullif("event_type", F.lit("signup")).alias("kind"), "user_id")
    return empty_row_records(users)


@query
def repeated_row_records_(spark, sf_dir):
    return repeated_row_records(table(spark, sf_dir, "documents").select("text", "lang"))


@query
def quality_report(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return buildings.check_register(
        documents.select(F.nullif("lang", F.lit("de")).alias("lang"), "text", "n_chars")
    )


@query
def row_count_(spark, sf_dir):
    return row_count(table(spark, sf_dir, "lineitem"), "rows")


def _cleaned(spark, sf_dir):
    return buildings.clean_register(building_register(spark, sf_dir))


def _realistic(spark, sf_dir):
    return buildings.realistic_years(_cleaned(spark, sf_dir), CURRENT_YEAR)


@query
def realistic_years(spark, sf_dir):
    return _realistic(spark, sf_dir).select("house_id", "maintenance_year", "square")


@query
def year_mean_median(spark, sf_dir):
    return buildings.year_statistics(_cleaned(spark, sf_dir), CURRENT_YEAR)


@query
def top_regions(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    return buildings.top_regions(customers.withColumnRenamed("c_nationkey", "region"))


@query
def top_localities_labelled(spark, sf_dir):
    return buildings.top_localities(_realistic(spark, sf_dir))


@query
def extremes_by_group(spark, sf_dir):
    return buildings.square_extremes(part_sizes(spark, sf_dir))


@query
def order_dates_by_customer(spark, sf_dir):
    """First and last order of each customer: extremes of a date."""
    orders = table(spark, sf_dir, "orders")
    labelled = orders.withColumn("label", F.concat(F.lit("Order "), F.col("o_orderkey")))
    return extremes(labelled, "o_custkey", "o_orderdate", "label")


@query
def quantity_mean_median(spark, sf_dir):
    return mean_and_median(table(spark, sf_dir, "lineitem"), "l_quantity", 2)


@query
def price_mean_median(spark, sf_dir):
    """A measure of very many distinct values."""
    return mean_and_median_by_rank(table(spark, sf_dir, "lineitem"), "l_extendedprice", 2)


@query
def extreme_rows_by_group_(spark, sf_dir):
    return extreme_rows_by_group(
        part_sizes(spark, sf_dir), "region", "square", "address", "house_id"
    )


@query
def largest_rows(spark, sf_dir):
    return extreme_rows_by_group(
        part_sizes(spark, sf_dir), "region", "square", "address", "house_id", largest=True
    )


@query
def spread_top20(spark, sf_dir):
    return buildings.widest_regions(part_sizes(spark, sf_dir))


@query
def register_widest_regions(spark, sf_dir):
    """Clean, keep realistic years, extremes per region, the 20 widest."""
    return buildings.widest_regions(_realistic(spark, sf_dir))


@query
def count_by_decade(spark, sf_dir):
    return buildings.buildings_by_decade(_realistic(spark, sf_dir))


@query
def decades_since(spark, sf_dir):
    return buildings.decades_since(_cleaned(spark, sf_dir), FIRST_DECADE)


@query
def top_by_size(spark, sf_dir):
    return buildings.top_buildings(_cleaned(spark, sf_dir))


@query
def incremental_keys(spark, sf_dir):
    """Orders that are not among the finished ones."""
    orders = table(spark, sf_dir, "orders")
    return new_rows(orders, orders.filter("o_orderstatus = 'F'"), "o_orderkey").select(
        "o_orderkey", "o_orderstatus", "o_totalprice"
    )


def _load_twice(spark, sf_dir):
    """A warehouse table after loading the finished orders and then all orders."""
    name = f"houses_{uuid.uuid4().hex}"
    create_houses_table(spark, name, buckets=16, location=fresh_path(spark, "houses"))
    register = _cleaned(spark, sf_dir)
    finished = F.col("description").endswith("F")
    repeats = register.filter((F.col("house_id") % 89 == 0) & ~finished)
    no_key = register.limit(100).withColumn("house_id", F.lit(None).cast("long"))
    load_new_rows(register.filter(finished), name)
    load_new_rows(register.unionByName(repeats).unionByName(no_key), name)
    houses = read_warehouse(spark, name)
    # The files stay at their place for the result; only the name goes.
    spark.sql(f"DROP TABLE {name}")
    return houses


@query
def incremental_load(spark, sf_dir):
    return _load_twice(spark, sf_dir)


@query
def versioned_load(spark, sf_dir):
    """A versioned table after the finished orders, all orders, and both batches again."""
    root = fresh_path(spark, "houses-versions")
    register = _cleaned(spark, sf_dir)
    finished = F.col("description").endswith("F")
    repeats = register.filter((F.col("house_id") % 89 == 0) & ~finished)
    batches = {"finished": register.filter(finished), "all": register.unionByName(repeats)}
    for batch, rows in [*batches.items(), *batches.items()]:
        load_version(rows, root, batch, "house_id")
    return read_version(spark, root, register.schema)


@query
def load_by_key_index(spark, sf_dir):
    """All orders after two loads of which the second opens only files that may hold one of its keys."""
    root = fresh_path(spark, "orders-versions")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    load_version(orders.filter(F.col("o_totalprice") < MIN_PRICE), root, "small", "o_orderkey")
    load_version(orders, root, "all", "o_orderkey")
    return read_version(spark, root, orders.schema)


@query
def warehouse_top_by_size(spark, sf_dir):
    return buildings.top_buildings(_load_twice(spark, sf_dir))


@query
def register_from_csv(spark, sf_dir):
    """From a UTF-16 CSV file to the widest regions, landed as Parquet on the way."""
    path = fresh_path(spark, "register-csv")
    csv = building_register(spark, sf_dir).write.option("header", True)
    csv.option("encoding", "UTF-16").option("escape", '"').csv(path)
    landed = buildings.land_register(spark, path, fresh_path(spark, "register"))
    cleaned = buildings.clean_register(landed)
    return buildings.widest_regions(buildings.realistic_years(cleaned, CURRENT_YEAR))


@query
def register_from_split_csv(spark, sf_dir):
    """As before, with line ends inside quoted fields and each file read by as many tasks as it has splits."""
    path = fresh_path(spark, "register-split-csv")
    rows = building_register(spark, sf_dir)
    noted = rows.withColumn("description", F.concat("description", F.lit('\n"first", and\nsecond line')))
    csv = noted.write.option("header", True).option("encoding", "UTF-16LE").option("escape", '"')
    csv.csv(path)
    landed = read_split_csv(spark, path, rows.schema, escape='"')
    cleaned = buildings.clean_register(landed)
    return buildings.widest_regions(buildings.realistic_years(cleaned, CURRENT_YEAR))


# Purchases


@query
def total_revenue(spark, sf_dir):
    return shop.total_revenue(purchases(spark, sf_dir))


@query
def items_by_category(spark, sf_dir):
    return shop.items_by_category(part_catalogue(spark, sf_dir))


@query
def distinct_items(spark, sf_dir):
    return items_by_group(purchases(spark, sf_dir), "category", "item")


@query
def expensive_purchases(spark, sf_dir):
    bought = table(spark, sf_dir, "lineitem").withColumnRenamed("l_extendedprice", "price")
    return shop.expensive_purchases(bought, MIN_PRICE).select(
        "l_orderkey", "l_linenumber", "price", "l_quantity"
    )


@query
def avg_price_by_category(spark, sf_dir):
    return shop.average_price_by_category(purchases(spark, sf_dir))


@query
def busiest_category(spark, sf_dir):
    return shop.busiest_category(purchases(spark, sf_dir))


@query
def purchase_report(spark, sf_dir):
    return shop.report(purchases(spark, sf_dir), MIN_PRICE)


# Strings


@query
def long_names_upper(spark, sf_dir):
    return strings.long_upper(table(spark, sf_dir, "part"), "p_name")


@query
def long_words_upper(spark, sf_dir):
    words = strings.long_upper_list(F.split("p_name", " "))
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.array_join(words, " ").alias("words")
    )


# Staff tables and SQL


@query
def select_sorted(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    building = staff.with_value(customers, "c_mktsegment", "BUILDING")
    return staff.sorted_descending(building.select("c_name", "c_acctbal"), "c_acctbal", "c_name")


@query
def balance_at_least(spark, sf_dir):
    return staff.at_least(table(spark, sf_dir, "customer"), "c_acctbal", MIN_BALANCE)


@query
def sql_view_filter(spark, sf_dir):
    return staff.at_least_by_sql(
        table(spark, sf_dir, "customer"), "c_acctbal", MIN_BALANCE, "customer_view"
    )


@query
def sql_count_not_null(spark, sf_dir):
    return read_view(
        spark,
        "SELECT locality_name, count(*) AS n FROM {register} "
        "WHERE locality_name IS NOT NULL GROUP BY locality_name",
        register=building_register(spark, sf_dir),
    )


@query
def known_population(spark, sf_dir):
    """Number of rows with a usable population and a locality."""
    known = _cleaned(spark, sf_dir).filter(F.col("population").isNotNull())
    return count_where(known, F.col("locality_name").isNotNull())


# Round trips


@query
def parquet_roundtrip(spark, sf_dir):
    return write_parquet(table(spark, sf_dir, "supplier"), fresh_path(spark, "supplier"))


@query
def csv_utf16_roundtrip(spark, sf_dir):
    """documents, whose text has newlines and quotes, through a UTF-16 CSV file."""
    documents = table(spark, sf_dir, "documents")
    path = fresh_path(spark, "documents-csv")
    csv = documents.write.option("header", True).option("encoding", "UTF-16")
    csv.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return read_utf16_csv(spark, path, documents.schema)


@query
def preview(spark, sf_dir):
    return first_rows(table(spark, sf_dir, "supplier"), 5, "s_suppkey")
