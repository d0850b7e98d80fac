"""Sampled splitters: cut a table into ranges of a two-part key that weigh about the same.

Keys are pairs (key, id) of longs. A record is drawn with probability proportional to its
weight, by a hash, so that a lost task draws the same sample again. The number drawn is
bounded by `SAMPLES_PER_RANGE` and the number of ranges, whatever the size of the table.
As the id is part of the key, a key that holds a third of all rows is cut like any other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLES_PER_RANGE = 16
MAX_RANGES = 16_384
#: A range that weighs more than this many times its share is cut again.
OVERFULL = 2.0
ROUNDS = 3
NO_ID = -(2**63)

Splitters = list[tuple[int, int]]


def drawn(rows: DataFrame, weight_per_sample: float, seed: int = 0) -> list[tuple[int, int, float]]:
    """Size-weighted sample of (key, id), with the weight that each drawn row stands for."""
    uniform = F.pmod(F.xxhash64("key", "id", F.lit(seed)), F.lit(2**53)) / F.lit(float(2**53))
    picked = rows.filter(uniform * F.lit(weight_per_sample) < F.col("size"))
    return sorted(
        (row["key"], row["id"], max(float(row["size"]), weight_per_sample))
        for row in picked.select("key", "id", "size").collect()
    )


def quantiles(sample: list[tuple[int, int, float]], ranges: int) -> Splitters:
    """Boundaries that cut the sample's weight into equal parts; each starts a range."""
    total = sum(weight for *_, weight in sample)
    splitters, before, wanted = [], 0.0, 1
    for key, row_id, weight in sample:
        if wanted < ranges and before >= total * wanted / ranges:
            splitters.append((key, row_id))
            wanted = int(before * ranges / total) + 1
        before += weight
    return sorted(set(splitters))


def range_of(splitters: Splitters, key: Column, row_id: Column) -> Column:
    """Number of splitters that are at or below (key, id)."""
    keys = np.array([k for k, _ in splitters], dtype=np.int64)
    ids = np.array([i for _, i in splitters], dtype=np.int64)

    @F.pandas_udf("int")
    def place(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for key, row_id in batches:
            left = np.searchsorted(keys, key.to_numpy(np.int64), "left")
            right = np.searchsorted(keys, key.to_numpy(np.int64), "right")
            within = row_id.to_numpy(np.int64)
            for first in np.unique(left[left < right]):
                rows = np.flatnonzero((left == first) & (left < right))
                last = right[rows[0]]
                right[rows] = first + np.searchsorted(ids[first:last], within[rows], "right")
            yield pd.Series(right.astype(np.int32))

    return place(key, row_id)


def splitters_for(rows: DataFrame, total: int, ranges: int, seed: int = 0) -> Splitters:
    """Splitters for `rows` (key, id, size; no nulls), overfull ranges cut again."""
    ranges = max(1, min(ranges, MAX_RANGES))
    if ranges == 1 or not total:
        return []
    share = total / ranges
    splitters = quantiles(drawn(rows, share / SAMPLES_PER_RANGE, seed), ranges)
    for round_ in range(1, ROUNDS + 1):
        place = range_of(splitters, F.col("key"), F.col("id"))
        weights = rows.withColumn("range", place).groupBy("range")
        heavy = weights.agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).filter(
            (F.col("size") > OVERFULL * share) & (F.col("n") > 1)
        )
        overfull = [row["range"] for row in heavy.select("range").collect()]
        if not overfull:
            break
        inside = rows.withColumn("range", place).filter(F.col("range").isin(overfull))
        more = []
        sample = drawn(inside, share / SAMPLES_PER_RANGE, seed + round_)
        bounds = [(NO_ID, NO_ID), *splitters, (2**63 - 1, 2**63 - 1)]
        for place_ in overfull:
            low, high = bounds[place_], bounds[place_ + 1]
            part = [x for x in sample if low <= x[:2] < high]
            parts = int(sum(weight for *_, weight in part) / share) + 1
            more += [x for x in quantiles(part, parts) if x != low]
        if not more:
            break
        splitters = sorted(set(splitters + more))
    return splitters
