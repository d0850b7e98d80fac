"""Analysis of a structured web-server log (schema WEB_LOGS)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.years import day_text
from tallyhouse.operators.counts import count_by, count_where, top_counts, top_rows
from tallyhouse.operators.totals import describe_totals, extreme_total, totals_by
from tallyhouse.session import stage

# Fixed values
TOP_CLIENTS = 10
NOT_FOUND = 404


def top_clients(logs: DataFrame, k: int = TOP_CLIENTS) -> DataFrame:
    return top_counts(logs, "ip", k, "request_count")


def method_counts(logs: DataFrame) -> DataFrame:
    counts = count_by(logs, "method", "method_count")
    return counts.orderBy(F.col("method_count").desc(), F.col("method").asc_nulls_last())


def not_found_count(logs: DataFrame) -> DataFrame:
    return count_where(logs, F.col("response_code") == NOT_FOUND, "404_count")


def daily_volume(logs: DataFrame) -> DataFrame:
    """Bytes per day. `run_all` computes it once for all results."""
    day = day_text(F.col("timestamp"))
    return totals_by(logs, day, "response_size", "date", "total_response_size")


def daily_volume_sorted(logs: DataFrame) -> DataFrame:
    return daily_volume(logs).orderBy("date")


def daily_statistics(daily: DataFrame) -> DataFrame:
    return describe_totals(daily, "total_response_size", "response_size")


def most_active_day(daily: DataFrame) -> DataFrame:
    return extreme_total(daily, "date", "total_response_size", largest=True)


def least_active_day(daily: DataFrame) -> DataFrame:
    return extreme_total(daily, "date", "total_response_size", largest=False)


def run_all(logs: DataFrame, k: int = TOP_CLIENTS) -> dict[str, DataFrame]:
    """The whole analysis by name, from one scan of the log.

    Requests and bytes are added up per client, per method, per code and per day in
    one pass and written out; every result reads that narrow table. The scan runs
    when this is called.
    """
    keys = [
        F.col("ip"),
        F.col("method"),
        F.col("response_code"),
        day_text(F.col("timestamp")).alias("date"),
    ]
    rows = logs.select(*keys, "response_size")
    names = ["ip", "method", "response_code", "date"]
    facets = rows.groupingSets([[F.col(n)] for n in names], *names).agg(
        F.grouping_id().alias("facet"),
        F.count(F.lit(1)).alias("requests"),
        F.sum("response_size").alias("bytes"),
    )
    facets = stage(facets, "log-facets")

    def of(name: str) -> DataFrame:
        # The bits of the grouping id mark the columns that are not grouped by.
        bit = 1 << (len(names) - 1 - names.index(name))
        return facets.filter(F.col("facet") == (1 << len(names)) - 1 - bit)

    daily = of("date").select("date", F.col("bytes").alias("total_response_size"))
    methods = of("method").select("method", F.col("requests").alias("method_count"))
    not_found = of("response_code").filter(F.col("response_code") == NOT_FOUND)
    clients = of("ip").select("ip", F.col("requests").alias("request_count"))
    return {
        "top_clients": top_rows(clients, k, "request_count", "ip"),
        "method_counts": methods.orderBy(
            F.col("method_count").desc(), F.col("method").asc_nulls_last()
        ),
        "not_found_count": not_found.agg(
            F.coalesce(F.sum("requests"), F.lit(0)).alias("404_count")
        ),
        "daily_volume": daily.orderBy("date"),
        "daily_statistics": daily_statistics(daily),
        "most_active_day": most_active_day(daily),
        "least_active_day": least_active_day(daily),
    }


def report(logs: DataFrame, k: int = TOP_CLIENTS) -> DataFrame:
    """The results of run_all as tidy rows (metric, key, value)."""
    found = run_all(logs, k)

    def tidy(name: str, metric: str, key: Column, value: Column) -> DataFrame:
        return found[name].select(
            F.lit(metric).alias("metric"), key.alias("key"), value.cast("double").alias("value")
        )

    nothing, total = F.lit(""), F.col("total_response_size")
    parts = [
        tidy("top_clients", "top_client", F.col("ip"), F.col("request_count")),
        tidy("method_counts", "method", F.col("method"), F.col("method_count")),
        tidy("not_found_count", "not_found", nothing, F.col("404_count")),
        tidy("daily_volume", "bytes", F.col("date"), total),
        tidy("most_active_day", "most_active_day", F.col("date"), total),
        tidy("least_active_day", "least_active_day", F.col("date"), total),
    ]
    for name in ("min", "max", "mean", "stddev"):
        value = F.col(f"{name}_response_size")
        parts.append(tidy("daily_statistics", f"{name}_daily_bytes", nothing, value))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole
