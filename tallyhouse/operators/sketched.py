"""Top-k of a column with very many values, without shuffling a row for each of them.

Values are hashed into cells. The count of a cell bounds the count of every value in it from above, and
takes one shuffled row per cell and task. The heaviest cells name candidates, which are counted one by one; the
k-th count among them is a floor for the answer. Every cell whose count reaches that floor is counted
value by value as well, so the values left out are proven too rare, by the exact bound of their cell. Where
counts are so even that the bound rules out little, most cells reach the floor and this becomes the full count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators.counts import count_by, top_rows
from tallyhouse.session import stage

CELLS = 2**18


def top_counts_by_cells(
    df: DataFrame, key: str, k: int, name: str = "n", *, cells: int = CELLS
) -> DataFrame:
    """The k most frequent values of `key`, the same rows as `top_counts`; NULL is a value, ties go to the smallest.

    Reads the key column three times and runs two jobs when called. The cells' counts are written to the shared
    folder, so Spark knows their size when it joins rows with them.
    """
    if k < 1:
        return top_rows(count_by(df, key, name), max(k, 0), name, key)
    rows = df.select(F.col(key).alias("key"), F.pmod(F.xxhash64(key), F.lit(cells)).cast("int").alias("cell"))
    counts = stage(count_by(rows, "cell", "n"), "cells")
    floor = _floor(rows, counts, k)
    reaching = counts.filter(F.col("n") >= F.lit(floor)).select("cell")
    found = count_by(rows.join(reaching, "cell", "left_semi"), "key", name)
    return top_rows(found.withColumnRenamed("key", key).select(key, name), k, name, key)


def _floor(rows: DataFrame, counts: DataFrame, k: int) -> int:
    """A count that the k-th most frequent value reaches: that of the k-th value in the k heaviest cells; 0 if they hold fewer.

    A cell holds a value at least, so there are k values in k cells.
    """
    heaviest = top_rows(counts, k, "n", "cell").select("cell")
    kth = top_rows(count_by(rows.join(heaviest, "cell", "left_semi"), "key", "n"), k, "n", "key")
    n, least = kth.agg(F.count(F.lit(1)), F.min("n")).first()
    return least if n == k else 0
