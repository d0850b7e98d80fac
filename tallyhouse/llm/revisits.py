"""Not-modified revisits of a web archive, resolved to the response they stand for.

A revisit (status 304) is joined as of its time to the latest strictly earlier full response
(status 200) of the same canonical URL; of several at that time, the largest record_id. Then its
validators are checked: its ETag, compared weakly, if it has one, else its Last-Modified. A
revisit that passes takes the response's payload and headers, the latter updated by those headers of its
own that a 304 may change (`PERMITTED`).

The order (hash of URL, time) is cut into ranges by sampled splitters, and every range finds its own
latest responses with a running maximum. A URL cut by a splitter hands its latest response
on from range to range in a table of at most two rows per range, so a URL with a third of all
records is spread like any other. Payloads take no part until the resolved pairs are known. A
response that many revisits stand for is copied for every `SHARE_ROWS` of them, so they meet it in many tasks.

Outcomes: resolved, no_response (none earlier, or no URL), mismatch (a validator differs or the
response lacks it), no_validator (the revisit has neither). Only resolved ones have a response_id, payload
and headers. Header names are compared in lower case. Records that are neither (other types or
states), or have no time or record_id, are left out; repeated revisits are resolved each, repeated
responses stand once. Columns other than those
named are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.ranges import range_of, splitters_for
from tallyhouse.session import stage

RANGE_ROWS = 50_000
#: Revisits that meet one copy of a response.
SHARE_ROWS = 20_000
# Header fields that a 304 response may update (HTTP semantics, 15.4.5).
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")


def canonical(url: Column) -> Column:
    """Host and path without scheme, default port, www, fragment, end slash and tracking, query sorted."""
    plain = F.regexp_replace(F.trim(url), "#.*$", "")
    start = "^[A-Za-z][A-Za-z0-9+.-]*://"
    host = F.lower(F.regexp_extract(plain, start + "([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, ":(80|443)$", ""), r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(plain, start + "[^/?]*([^?]*)", 1), "/+$", "")
    parameters = F.filter(
        F.split(F.regexp_extract(plain, r"\?(.*)$", 1), "&"),
        lambda p: (p != "") & ~p.startswith("utm_"),
    )
    query = F.array_join(F.array_sort(parameters), "&")
    place = F.when(path == "", "/").otherwise(path)
    full = F.concat(host, place, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))
    return F.when(plain.rlike(start), full).otherwise(plain)


def header(headers: str, name: str) -> Column:
    return F.get(F.map_values(F.map_filter(headers, lambda k, _: F.lower(k) == name)), F.lit(0))


def known_headers() -> Column:
    return F.coalesce("headers", F.create_map().cast("map<string,string>"))


def lower_names(headers: Column) -> Column:
    """Headers with names in lower case; of names that then agree, the first counts."""
    entries = F.transform(
        F.map_entries(headers),
        lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")),
    )
    names = F.array_distinct(F.transform(entries, lambda e: e["key"]))
    return F.map_from_arrays(
        names, F.transform(names, lambda n: F.get(F.filter(entries, lambda e: e["key"] == n), F.lit(0))["value"])
    )


def merged_headers(stored: Column, fresh: Column) -> Column:
    """The stored headers, updated by the permitted ones of the revisit."""
    fresh = F.map_filter(fresh, lambda k, v: k.isin(*PERMITTED) & v.isNotNull())
    kept = F.map_filter(stored, lambda k, _: ~F.array_contains(F.map_keys(fresh), k))
    return F.map_concat(kept, fresh)


def weak(tag: Column) -> Column:
    return F.regexp_replace(tag, "^W/", "")


def resolutions(records: DataFrame) -> DataFrame:
    """record_id, url_key, ts, headers, outcome and response_id of every revisit.

    records: record_id, type, status, url, ts (long), headers (map of strings).
    """
    full = (F.col("type") == "response") & (F.col("status") == 200)
    revisit = (F.col("type") == "revisit") & (F.col("status") == 304)
    rows = (
        records.filter((full | revisit) & F.col("ts").isNotNull() & F.col("record_id").isNotNull())
        .select(
            "record_id",
            "ts",
            full.alias("full"),
            canonical(F.col("url")).alias("url_key"),
            F.when(revisit, lower_names(known_headers())).alias("headers"),
            header("headers", "etag").alias("etag"),
            header("headers", "last-modified").alias("modified"),
        )
        .withColumn("key", F.xxhash64("url_key"))
    )
    rows = stage(rows, "captures")
    keys = rows.select("key", F.col("ts").alias("id"), F.lit(1).cast("long").alias("size"))
    n = keys.count()
    splitters = splitters_for(keys, n, ceil(n / RANGE_ROWS))
    ranged = rows.withColumn("range", range_of(splitters, F.col("key"), F.col("ts")))
    answer = F.struct("ts", "record_id", "etag", "modified")
    answer = F.when(F.col("full"), answer)
    carried = handed_on(ranged.filter("full"), [key for key, _ in splitters], answer)
    earlier = Window.partitionBy("range", "url_key").orderBy("ts").rangeBetween(Window.unboundedPreceding, -1)
    latest = ranged.withColumn("own", F.max(answer).over(earlier)).filter("NOT full")
    joined = latest.join(
        carried,
        (latest["range"] == carried["to"]) & (latest["url_key"] == carried["carried_url"]),
        "left",
    ).withColumn("found", F.coalesce("own", "carried"))
    found = F.col("found")
    same = F.when(F.col("etag").isNotNull(), weak(F.col("etag")) == weak(found["etag"])).otherwise(
        F.col("modified") == found["modified"]
    )
    outcome = (
        F.when(found.isNull() | F.col("url_key").isNull(), "no_response")
        .when(F.col("etag").isNull() & F.col("modified").isNull(), "no_validator")
        .when(F.coalesce(same, F.lit(False)), "resolved")
        .otherwise("mismatch")
    )
    return joined.select(
        "record_id",
        "url_key",
        "ts",
        "headers",
        outcome.alias("outcome"),
        F.when(outcome == "resolved", found["record_id"]).alias("response_id"),
    )


def handed_on(full: DataFrame, cut_keys: list[int], answer: Column) -> DataFrame:
    """to (range), carried_url, carried: the latest response before a range of each URL cut there.

    Every splitter cuts one key, so the table has about as many rows as there are ranges.
    """
    spark = full.sparkSession
    cut = sorted(set(cut_keys))
    places = [(key, to) for to, key in enumerate(cut_keys, start=1)]
    last = (
        full.join(F.broadcast(spark.createDataFrame([(k,) for k in cut], "key long")), "key", "left_semi")
        .groupBy("key", "url_key", "range")
        .agg(F.max(answer).alias("last"))
    )
    to = F.broadcast(spark.createDataFrame(places, "to_key long, to int"))
    return (
        last.join(to, (last["key"] == to["to_key"]) & (last["range"] < to["to"]))
        .groupBy("to", F.col("url_key").alias("carried_url"))
        .agg(F.max("last").alias("carried"))
    )


def shared_out(resolved: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The resolved revisits of a written table with their `share` of a response, and response_id, shares of the hot ones.

    A share is dealt by the row's place in the table, so that equal rows are spread as well and a task run again
    deals the same.
    """
    named = resolved.groupBy("response_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > SHARE_ROWS)
    hot = stage(named.select("response_id", F.ceil(F.col("n") / SHARE_ROWS).alias("shares")), "hot-responses")
    placed = resolved.withColumn("share", F.monotonically_increasing_id()).join(hot, "response_id", "left")
    share = F.coalesce(F.pmod("share", "shares"), F.lit(0).cast("long"))
    return placed.withColumn("share", share).drop("shares"), hot


def resolve(records: DataFrame) -> DataFrame:
    """record_id, url_key, ts, outcome, response_id, payload and headers of every revisit."""
    found = stage(resolutions(records), "resolutions")
    dealt, hot = shared_out(found.filter("response_id IS NOT NULL"))
    stored = records.filter("type = 'response' AND status = 200").select(
        F.col("record_id").alias("response_id"),
        F.struct("ts", header("headers", "etag").alias("etag"), header("headers", "last-modified")).alias("order"),
        F.struct("payload", lower_names(known_headers()).alias("stored")).alias("body"),
    )
    shares = F.sequence(F.lit(0).cast("long"), F.coalesce("shares", F.lit(1).cast("long")) - 1)
    copies = stored.join(hot, "response_id", "left").withColumn("share", F.explode(shares))
    # A response may be stored in many rows: one of them, by the order of the search, stands. Grouped
    # by the keys of the join, so that payloads are dealt once.
    copies = copies.groupBy("response_id", "share").agg(F.max_by("body", "order").alias("body"))
    joined = dealt.join(copies, ["response_id", "share"])
    rows = ["record_id", "url_key", "ts", "outcome", "response_id"]
    answered = joined.select(
        *rows,
        F.col("body")["payload"].alias("payload"),
        merged_headers(F.col("body")["stored"], F.col("headers")).alias("headers"),
    )
    kinds = {field.name: field.dataType for field in answered.schema}
    nothing = [F.lit(None).cast(kinds[name]).alias(name) for name in ("payload", "headers")]
    return answered.unionByName(found.filter("response_id IS NULL").select(*rows, *nothing))
