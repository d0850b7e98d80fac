"""Exact values by rank in a column of any number of distinct values.

Each pass narrows the range of values that holds the wanted ranks: a quantile summary, merged from all
tasks, proposes bounds, and exact counts below and between them prove that the ranks lie inside, so
the summary's error costs a pass and never a wrong result. When a range holds few enough distinct values they are counted
one by one and the ranks read off. No task ever sees more than its input, a summary and that last range.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Distinct values that one task sorts at the end.
MOST_VALUES = 100_000
#: Quantiles asked of each summary, and its accuracy.
STEPS = 1_000
ACCURACY = 10_000


@dataclass(frozen=True)
class Range:
    """Values from low to high (None: all), how many rows lie below and inside, and what is known of those inside."""

    low: object
    high: object
    below: int
    inside: int
    distinct: int
    quantiles: list
    mean: float | None = None


def _within(value: Column, low: object, high: object, kind: str) -> Column:
    if low is None:
        return value.isNotNull()
    return (value >= F.lit(low).cast(kind)) & (value <= F.lit(high).cast(kind))


def _measured(rows: DataFrame, outer: Range, low: object, high: object) -> Range:
    """The range from low to high inside `outer`, in one pass over the rows of that."""
    kind = rows.schema["value"].dataType.simpleString()
    value = F.col("value")
    inside = F.when(_within(value, low, high, kind), value)
    below = F.count_if(value < F.lit(low).cast(kind)) if low is not None else F.lit(0)
    steps = [i / STEPS for i in range(STEPS + 1)]
    found = (
        rows.filter(_within(value, outer.low, outer.high, kind))
        .agg(
            below.alias("below"),
            F.count(inside).alias("inside"),
            F.approx_count_distinct(inside).alias("n_values"),
            F.percentile_approx(inside, steps, ACCURACY).alias("quantiles"),
            F.avg(inside).cast("double").alias("mean"),
        )
        .first()
    )
    below = outer.below + found["below"]
    return Range(low, high, below, found["inside"], found["n_values"], found["quantiles"], found["mean"])


def _narrowed(rows: DataFrame, current: Range, first: int, last: int) -> Range:
    """A smaller range that is proven to hold ranks first to last, or the same range if none is found."""
    reach = 2
    while reach < STEPS:
        left = int((first - current.below) / current.inside * STEPS) - reach
        right = int((last - current.below) / current.inside * STEPS) + 1 + reach
        low, high = current.quantiles[max(0, left)], current.quantiles[min(STEPS, right)]
        if (low, high) == (current.low, current.high):
            return current
        found = _measured(rows, current, low, high)
        if found.below <= first and last < found.below + found.inside:
            return found
        reach *= 4
    return current


def mean_and_median_by_rank(
    df: DataFrame, column: str, digits: int = 0, most_values: int = MOST_VALUES
) -> DataFrame:
    """Exact mean and median of a numeric column, NULL left out, rounded; NULL where there is no value.

    Runs a pass or more when called: one finds the number of rows and distinct values, and each further
    one leaves a few thousandths of the values.
    """
    rows = df.select(F.col(column).alias("value")).filter(F.col("value").isNotNull())
    names = f"mean_{column}", f"median_{column}"
    kind = rows.schema["value"].dataType.simpleString()
    current = _measured(rows, Range(None, None, 0, 0, 0, []), None, None)
    n, mean = current.inside, current.mean
    first, last = max(0, n - 1) // 2, n // 2
    while current.distinct > most_values:
        smaller = _narrowed(rows, current, first, last)
        if smaller is current:
            break
        current = smaller
    counts = (
        rows.filter(_within(F.col("value"), current.low, current.high, kind))
        .groupBy("value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    upto = counts.withColumn("upto", F.sum("n").over(Window.orderBy("value")))

    def at(rank: int) -> Column:
        return F.min(F.when(F.col("upto") > rank - current.below, F.col("value"))).cast("double")

    return upto.agg(
        F.round(F.lit(mean).cast("double"), digits).alias(names[0]),
        F.round((at(first) + at(last)) / 2, digits).alias(names[1]),
    )
