from __future__ import annotations

import pytest
from conftest import one, rows
from fixtures import ACCESS_LOG, logs
from pyspark.sql import functions as F

from tallyhouse.functions.text import access_log_fields, whitespace_field
from tallyhouse.plans import accesslog, weblogs
from tallyhouse.sources.files import read_access_log, read_csv
from tallyhouse.sources.schemas import WEB_LOGS


def test_clients_methods_and_not_found(spark):
    df = logs(spark)
    assert rows(weblogs.top_clients(df)) == [("1.1.1.1", 2), ("2.2.2.2", 1), ("3.3.3.3", 1)]
    assert rows(weblogs.top_clients(df, 1)) == [("1.1.1.1", 2)]
    assert rows(weblogs.method_counts(df)) == [("GET", 2), ("POST", 1), ("PUT", 1)]
    counted = weblogs.not_found_count(df)
    assert (counted.columns, one(counted)) == (["404_count"], (2,))


def test_daily_volume(spark):
    daily = weblogs.daily_volume_sorted(logs(spark))
    assert rows(daily) == [("2024-10-09", 400), ("2024-10-10", 200), ("2024-10-11", 600)]
    assert dict(daily.dtypes) == {"date": "string", "total_response_size": "bigint"}
    assert one(weblogs.daily_statistics(daily)) == (200, 600, 400.0, 200.0)
    assert one(weblogs.most_active_day(daily)) == ("2024-10-11", 600)
    assert one(weblogs.least_active_day(daily)) == ("2024-10-10", 200)


def test_deviation_of_one_day_is_null(spark):
    daily = weblogs.daily_volume(logs(spark).limit(2))
    assert one(weblogs.daily_statistics(daily)) == (400, 400, 400.0, None)


def test_tied_days_go_to_the_earlier(spark):
    daily = spark.createDataFrame(
        [("2024-01-02", 5), ("2024-01-01", 5)], "date string, total_response_size long"
    )
    assert one(weblogs.most_active_day(daily))[0] == "2024-01-01"
    assert one(weblogs.least_active_day(daily))[0] == "2024-01-01"


def test_csv_with_and_without_schema(spark, tmp_path):
    path = str(tmp_path / "logs.csv")
    logs(spark).write.option("header", True).csv(path)
    declared, inferred = read_csv(spark, path, WEB_LOGS), read_csv(spark, path)
    assert declared.dtypes == inferred.dtypes == logs(spark).dtypes
    assert sorted(rows(declared)) == sorted(rows(inferred)) == sorted(rows(logs(spark)))


def report_of(spark, tmp_path, text):
    path = tmp_path / "access.log"
    path.write_text(text)
    found = rows(accesslog.report(read_access_log(spark, str(path))))
    return {(metric, key): value for metric, key, value in found}


GOLDEN = {
    ("requests", ""): 6,
    ("clients", ""): 4,
    ("method", "GET"): 5,
    ("method", "POST"): 1,
    ("top_url", "/index.html"): 3,
}


@pytest.mark.parametrize(
    ("text", "change"),
    [
        (ACCESS_LOG, {}),
        (ACCESS_LOG.rstrip("\n"), {}),
        (ACCESS_LOG + "\n", {("requests", ""): 7}),
        (ACCESS_LOG.replace("POST", "PUT"), {("method", "POST"): 0}),
        # A client whose text is part of another one's, listed after it.
        ("".join(reversed(ACCESS_LOG.splitlines(keepends=True))), {}),
    ],
)
def test_access_log_report(spark, tmp_path, text, change):
    assert report_of(spark, tmp_path, text) == GOLDEN | change


def test_empty_access_log(spark, tmp_path):
    assert report_of(spark, tmp_path, "") == {
        ("requests", ""): 0,
        ("clients", ""): 0,
        ("method", "GET"): 0,
        ("method", "POST"): 0,
    }


def test_single_figures_agree_with_the_summary(spark, tmp_path):
    path = tmp_path / "access.log"
    path.write_text(ACCESS_LOG)
    requests = read_access_log(spark, str(path))
    assert one(accesslog.distinct_clients(requests)) == (4,)
    assert one(accesslog.distinct_clients(requests, approximate=True)) == (4,)
    assert one(accesslog.reported_methods(requests)) == (5, 1)
    assert one(accesslog.top_url(requests)) == ("/index.html", 3)
    assert one(accesslog.summary(requests)) == (6, 4, 5, 1, "/index.html", 3)


def test_tied_urls_go_to_the_smallest(spark):
    lines = [(f'1.1.1.1 - - [t +0] "GET {url} H" 200 1',) for url in ("/b", "/a")]
    requests = access_log_fields(spark.createDataFrame(lines, "value string"))
    assert one(accesslog.top_url(requests)) == ("/a", 1)
    assert one(accesslog.summary(requests))[4:] == ("/a", 1)


def test_fields_of_short_and_ragged_lines(spark):
    lines = [("a",), ("  a \t b  c ",), ("",), ("   ",)]
    df = spark.createDataFrame(lines, "value string")
    second = df.select(whitespace_field(F.col("value"), 2))
    assert [r[0] for r in second.collect()] == [None, "b", None, None]
    clients = [r.client for r in access_log_fields(df).collect()]
    assert clients == ["a", "a", None, None]
