from __future__ import annotations

import pytest
from conftest import one, rows
from fixtures import PURCHASED, bought
from pyspark.sql import functions as F

from tallyhouse.operators.lists import items_by_group
from tallyhouse.plans import purchases, strings


def test_revenue(spark):
    assert one(purchases.total_revenue(bought(spark))) == (pytest.approx(23.5),)
    assert one(purchases.total_revenue(bought(spark, []))) == (0.0,)


def test_items_by_category_has_each_item_once(spark):
    df = bought(spark, [*PURCHASED, PURCHASED[0]])
    assert sorted(rows(purchases.items_by_category(df))) == [
        ("bakery", "bread"),
        ("dairy", "milk"),
        ("fruit", "apple"),
        ("fruit", "banana"),
    ]


def test_a_category_of_many_items_has_the_same_form(spark):
    df = spark.range(40_000).selectExpr(
        "CASE WHEN id < 25000 THEN 'big' WHEN id < 39000 THEN concat('c', id % 9) END AS category",
        "concat('i', id % 15000) AS item",
    )
    expected = {(r.category, r.item) for r in df.groupBy("category", "item").count().collect()}
    found = rows(purchases.items_by_category(df))
    assert len(found) == len(expected) and set(found) == expected
    assert sum(category == "big" for category, _ in found) == 15_000


def test_distinct_items(spark):
    df = bought(spark, [*PURCHASED, PURCHASED[0]])
    assert items_by_group(df, "category", "item").count() == 4


def test_minimum_price_is_inclusive(spark):
    items = {r.item for r in purchases.expensive_purchases(bought(spark), 1.2).collect()}
    assert items == {"apple", "milk", "bread"}
    assert purchases.expensive_purchases(bought(spark)).count() == 3


def test_average_price_ignores_quantity(spark):
    found = dict(rows(purchases.average_price_by_category(bought(spark))))
    assert found == pytest.approx({"bakery": 2.0, "dairy": 1.5, "fruit": 0.85})


def test_busiest_category(spark):
    assert one(purchases.busiest_category(bought(spark))) == ("fruit", 15)
    tied = [("a", "y", 1.0, 3), ("b", "x", 1.0, 3)]
    assert one(purchases.busiest_category(bought(spark, tied))) == ("x", 3)
    assert rows(purchases.busiest_category(bought(spark, []))) == []


def test_report(spark):
    found = sorted(rows(purchases.report(bought(spark))))
    assert found == [
        ("average_price", "bakery", 2.0),
        ("average_price", "dairy", 1.5),
        ("average_price", "fruit", pytest.approx(0.85)),
        ("busiest_category", "fruit", 15.0),
        ("expensive_purchase", "apple", 1.2),
        ("expensive_purchase", "bread", 2.0),
        ("expensive_purchase", "milk", 1.5),
        ("item_in_category", "bakery/bread", 3.0),
        ("item_in_category", "dairy/milk", 2.0),
        ("item_in_category", "fruit/apple", 10.0),
        ("item_in_category", "fruit/banana", 5.0),
        ("total_revenue", "", pytest.approx(23.5)),
    ]
    assert rows(purchases.report(bought(spark, []))) == [("total_revenue", "", 0.0)]


# The documented example and its result.
WORDS = ["apple", "cat", "banana", "dog", "elephant"]


def test_long_strings(spark):
    df = spark.createDataFrame([(w,) for w in WORDS], "s string")
    assert [r.s for r in strings.long_upper(df, "s").collect()] == ["APPLE", "BANANA", "ELEPHANT"]


def test_length_bound_repeats_and_code_points(spark):
    texts = ["abc", "abcd", "abcd", "\U0001f600abc", None]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    found = [r.s for r in strings.long_upper(df, "s").collect()]
    assert found == ["ABCD", "ABCD", "\U0001f600ABC"]


def test_long_strings_within_a_row(spark):
    df = spark.createDataFrame([(WORDS,)], "words array<string>")
    assert one(df.select(strings.long_upper_list(F.col("words")))) == (
        ["APPLE", "BANANA", "ELEPHANT"],
    )
