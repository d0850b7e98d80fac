"""Purchase report (schema PURCHASES)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators.counts import argmax_group, top_rows
from tallyhouse.operators.lists import items_by_group
from tallyhouse.session import stage

# Fixed values
DEFAULT_MIN_PRICE = 1.0


def _revenue() -> Column:
    return F.coalesce(F.sum(F.col("price") * F.col("quantity")), F.lit(0))


def _mean_price() -> Column:
    # Sum over count rather than avg, which would cut a decimal price to few digits.
    return F.try_divide(F.sum("price").cast("double"), F.count("price"))


def total_revenue(purchases: DataFrame) -> DataFrame:
    """Sum of price times quantity, 0 for empty input.

    Give the price as decimal for a sum that is exact and so the same in every run.
    """
    return purchases.agg(_revenue().cast("double").alias("revenue"))


def items_by_category(purchases: DataFrame) -> DataFrame:
    """One row per category and item sold in it."""
    return items_by_group(purchases, "category", "item")


def expensive_purchases(purchases: DataFrame, min_price: float = DEFAULT_MIN_PRICE) -> DataFrame:
    """Purchases at or above a price."""
    return purchases.filter(F.col("price") >= min_price)


def average_price_by_category(purchases: DataFrame) -> DataFrame:
    """Mean price of the purchases of each category, whatever their quantity."""
    return purchases.groupBy("category").agg(_mean_price().alias("average_price"))


def busiest_category(purchases: DataFrame) -> DataFrame:
    """The category with the most units; ties go to the smallest name."""
    return argmax_group(purchases, "category", F.sum("quantity"), "units")


def report(purchases: DataFrame, min_price: float = DEFAULT_MIN_PRICE) -> DataFrame:
    """The five results as tidy rows (metric, key, value), every value as a number.

    Items of a category and purchases at or above the price are one row each (key
    'category/item', value the units; key the item, value the price), so the report
    grows by rows and never by the length of one value. What is grouped comes from
    one scan: a table of totals per category and item is written once and read by
    the four results built on it.
    """
    totals = stage(
        purchases.groupBy("category", "item").agg(
            F.sum("quantity").alias("units"),
            F.sum(F.col("price") * F.col("quantity")).alias("revenue"),
            F.sum("price").alias("price_sum"),
            F.count("price").alias("priced"),
        ),
        "purchase-totals",
    )
    by_category = totals.groupBy("category").agg(
        F.sum("units").alias("units"),
        F.try_divide(F.sum("price_sum").cast("double"), F.sum("priced")).alias("average_price"),
    )
    revenue = totals.agg(F.coalesce(F.sum("revenue"), F.lit(0)).alias("revenue"))
    expensive = expensive_purchases(purchases, min_price)
    busiest = top_rows(by_category.select("category", "units"), 1, "units", "category")
    return (
        _tidy(revenue, "total_revenue", F.lit(""), F.col("revenue"))
        .unionByName(_tidy(totals, "item_in_category", _item_key(), F.col("units")))
        .unionByName(_tidy(expensive, "expensive_purchase", F.col("item"), F.col("price")))
        .unionByName(
            _tidy(by_category, "average_price", F.col("category"), F.col("average_price"))
        )
        .unionByName(_tidy(busiest, "busiest_category", F.col("category"), F.col("units")))
    )


def _item_key() -> Column:
    return F.concat_ws("/", "category", "item")


def _tidy(df: DataFrame, metric: str, key: Column, value: Column) -> DataFrame:
    return df.select(
        F.lit(metric).alias("metric"), key.alias("key"), value.cast("double").alias("value")
    )
