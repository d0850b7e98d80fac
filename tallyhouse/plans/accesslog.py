"""Report on a raw access log, parsed to (client, method, url), one row per line."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators.counts import distinct_count, domain_counts, top_rows

# Fixed values
REPORTED_METHODS = ["GET", "POST"]


def distinct_clients(requests: DataFrame, *, approximate: bool = False) -> DataFrame:
    return distinct_count(requests, "client", "clients", approximate=approximate)


def reported_methods(requests: DataFrame) -> DataFrame:
    return domain_counts(requests, "method", REPORTED_METHODS)


def top_url(requests: DataFrame) -> DataFrame:
    """The most requested url and its count; requests without a url do not count.

    They are left out by the count rather than by a filter: a filter would sink below
    the parsing and split every line twice.
    """
    counts = requests.groupBy("url").agg(F.count_if(F.length("url") > 0).alias("n"))
    return top_rows(counts.filter(F.col("n") > 0), 1, "n", "url")


def _facets(requests: DataFrame) -> DataFrame:
    """Requests per client, per method and per url, from one pass over the lines.

    The three kinds of row are told apart by the grouping id: 3 for client, 5 for
    method, 6 for url (the bits mark the columns that are not grouped by).
    """
    columns = [F.col("client"), F.col("method"), F.col("url")]
    return requests.groupingSets([[c] for c in columns], *columns).agg(
        F.grouping_id().alias("facet"), F.count(F.lit(1)).alias("n")
    )


def summary(requests: DataFrame) -> DataFrame:
    """Total, distinct clients, GET and POST counts and the top url, as one row.

    Blank lines are requests without a client, method or url.
    """
    n, url = F.col("n"), F.col("url")
    client_row, method_row, url_row = [F.col("facet") == facet for facet in (3, 5, 6)]
    rank = F.when(url_row & (F.length(url) > 0), F.struct((-n).alias("order"), url.alias("url")))

    def requests_where(condition):
        return F.coalesce(F.sum(F.when(condition, n)), F.lit(0))

    return (
        _facets(requests)
        .agg(
            requests_where(method_row).alias("requests"),
            F.count_if(client_row & F.col("client").isNotNull()).alias("clients"),
            *[
                requests_where(method_row & (F.col("method") == m)).alias(m)
                for m in REPORTED_METHODS
            ],
            F.min(rank).alias("top"),
        )
        .select(
            "requests",
            "clients",
            *REPORTED_METHODS,
            F.col("top.url").alias("top_url"),
            (-F.col("top.order")).alias("top_url_requests"),
        )
    )


def report(requests: DataFrame) -> DataFrame:
    """The summary as tidy rows (metric, key, value)."""
    entries = [
        ("requests", F.lit(""), F.col("requests")),
        ("clients", F.lit(""), F.col("clients")),
        *[("method", F.lit(m), F.col(m)) for m in REPORTED_METHODS],
        ("top_url", F.col("top_url"), F.col("top_url_requests")),
    ]
    rows = F.array(
        *[
            F.struct(F.lit(metric).alias("metric"), key.alias("key"), value.alias("value"))
            for metric, key, value in entries
        ]
    )
    return summary(requests).select(F.inline(rows)).filter(F.col("key").isNotNull())
