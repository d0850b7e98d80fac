from __future__ import annotations

import statistics

import pytest
from conftest import one, plan_of, rows
from pyspark.sql import functions as F

from tallyhouse.operators.ranks import mean_and_median_by_rank


def by_rank(df, most_values):
    return one(mean_and_median_by_rank(df, "x", 4, most_values))


@pytest.mark.parametrize("kind", ["int", "long", "float", "double", "decimal(12,2)"])
@pytest.mark.parametrize("n", [1, 2, 7, 1000, 1001])
def test_small_columns_of_any_number(spark, kind, n):
    if n > 7 and kind not in ("long", "double"):
        pytest.skip("one size does for the other types")
    df = spark.range(n).select(F.expr(f"CAST((id * 7919) % {n} - 3 AS {kind})").alias("x"))
    expected = [float(r.x) for r in df.collect()]
    found = by_rank(df, 10)
    assert found == (round(statistics.mean(expected), 4), round(statistics.median(expected), 4))


def test_ten_million_distinct_values_need_no_task_that_sees_them(spark):
    n = 10_000_000
    df = spark.range(0, n, 1, 8).select(((F.col("id") * 7919) % n).alias("x"))
    result = mean_and_median_by_rank(df, "x", 1, 20_000)
    assert one(result) == ((n - 1) / 2, (n - 1) / 2)
    # What the last task sorts is filtered in the scan before.
    assert "Filter" in plan_of(result)
    assert result.count() == 1


@pytest.mark.parametrize(
    "value",
    [
        "CASE WHEN id % 3 > 0 THEN 5 ELSE id END",  # one hot value in the middle
        "CASE WHEN id % 2 = 0 THEN -1 - id % 2 ELSE 900000 END",  # the two middle values far apart
        "CASE WHEN id < 100000 THEN 7 WHEN id < 199999 THEN 9 ELSE id END",
        "CASE WHEN id % 5 = 0 THEN NULL ELSE pow(id, 3) END",
        "ln(id + 1)",
    ],
)
def test_ties_nulls_and_skew(spark, value):
    df = spark.range(200_000).selectExpr(f"CAST({value} AS double) AS x").selectExpr("x")
    expected = one(df.agg(F.round(F.avg("x"), 4), F.round(F.percentile("x", 0.5), 4)))
    found = by_rank(df, 100)
    assert found[1] == expected[1] and found[0] == pytest.approx(expected[0], rel=1e-12)


def test_nothing_and_nan(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (2.0,)], "x double")
    assert by_rank(df, 1)[1] == 2.0
    assert by_rank(df.filter("x > 5 AND NOT isnan(x)"), 1) == (None, None)
    assert rows(mean_and_median_by_rank(df.filter("x IS NULL"), "x")) == [(None, None)]
