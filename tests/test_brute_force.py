"""Random small inputs against the same rule in plain Python."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict
from statistics import mean, median, stdev

import pytest
from conftest import one, rows
from pyspark.sql import functions as F

from tallyhouse.functions.cleaning import text_to_int
from tallyhouse.functions.text import access_log_fields
from tallyhouse.operators.quality import quality_report
from tallyhouse.plans import accesslog, buildings, purchases, weblogs

SEEDS = [1, 2, 3]


@pytest.mark.parametrize("seed", SEEDS)
def test_text_to_int(spark, seed):
    draw = random.Random(seed)
    texts = ["".join(draw.choices("0159.-+eE —N", k=draw.randint(0, 6))) for _ in range(4000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")

    def expected(text):
        found = re.fullmatch(r"\s*([+-]?[0-9]+)(\.[0-9]*)?\s*", text)
        return int(found[1]) if found else None

    found = rows(df.select("t", text_to_int(F.col("t"))))
    assert found == [(t, expected(t)) for t in texts]
    assert sum(number is not None for _, number in found) > 300


@pytest.mark.parametrize("seed", SEEDS)
def test_extremes_and_spread(spark, seed):
    draw = random.Random(seed)
    sizes = [None, float("nan"), 1.0, 2.0, 2.0, 3.5, -1.0, float("inf")]
    data = [
        (draw.choice(["A", "A", "B", "C", None]), draw.choice(sizes), draw.choice(["x", "y", "z"]))
        for _ in range(200)
    ]
    groups = defaultdict(list)
    for region, size, address in data:
        if region is not None and size is not None and not math.isnan(size):
            groups[region].append((size, address))
    expected = {}
    for region, found in groups.items():
        low = min(found)
        high = min(found, key=lambda r: (-r[0], r[1]))
        expected[region] = (low[1], low[0], high[1], high[0])
    df = spark.createDataFrame(data, "region string, square float, address string")
    assert {r: tuple(v) for r, *v in rows(buildings.square_extremes(df))} == expected
    widest = rows(buildings.widest_regions(df, 2).select("region", "square_difference"))
    by_spread = sorted(expected, key=lambda r: (expected[r][1] - expected[r][3], r))
    assert widest == [(r, expected[r][3] - expected[r][1]) for r in by_spread[:2]]


@pytest.mark.parametrize("seed", SEEDS)
def test_year_statistics(spark, seed):
    draw = random.Random(seed)
    years = [draw.choice([None, 5, 1000, 2025, 1700 + draw.randint(0, 324)]) for _ in range(301)]
    kept = [y for y in years if y is not None and 1000 < y < 2025]
    df = spark.createDataFrame([(y,) for y in years], "maintenance_year int")

    def half_up(x):
        return float(math.floor(x + 0.5))

    assert one(buildings.year_statistics(df, 2025)) == (half_up(mean(kept)), half_up(median(kept)))


@pytest.mark.parametrize("seed", SEEDS)
def test_access_log_summary(spark, seed):
    draw = random.Random(seed)

    def line():
        fields = [
            draw.choice(["1.1.1.1", "1.1.1.10", "2.2.2.2"]),
            *"- - [t z]".split(),
            draw.choice(['"GET', '"POST', '"PUT', "-"]),
            draw.choice(["/a", "/b", "/c"]),
            "200",
        ]
        return draw.choice(["", "  "]) + "  ".join(fields[: draw.choice([0, 1, 5, 6, 7, 8, 8, 8])])

    lines = [line() for _ in range(300)]
    split = [text.split() for text in lines]
    methods = Counter(f[5].replace('"', "") for f in split if len(f) > 5)
    urls = Counter(f[6] for f in split if len(f) > 6)
    url = min(urls, key=lambda u: (-urls[u], u))
    expected = (
        len(lines),
        len({f[0] for f in split if f}),
        methods["GET"],
        methods["POST"],
        url,
        urls[url],
    )
    requests = access_log_fields(spark.createDataFrame([(t,) for t in lines], "value string"))
    assert one(accesslog.summary(requests)) == expected
    assert one(accesslog.top_url(requests)) == expected[4:]
    assert one(accesslog.distinct_clients(requests)) == expected[1:2]


@pytest.mark.parametrize("seed", SEEDS)
def test_quality_report(spark, seed):
    draw = random.Random(seed)
    long = "t" * 80
    texts = [None, "", "a", long, long + "b"]
    numbers = [None, 1, 2, 3, 4, 5]
    data = [
        (draw.choice(numbers), draw.choice(texts), draw.choice([None, 0.5])) for _ in range(50)
    ]
    df = spark.createDataFrame(data, "x int, y string, z double")
    repeated = sum(n > 1 for n in Counter(data).values())
    assert one(quality_report(df)) == (50, sum(r[0] is None for r in data), repeated)


@pytest.mark.parametrize("seed", SEEDS)
def test_daily_statistics(spark, seed):
    draw = random.Random(seed)
    data = [(f"2024-01-{draw.randint(1, 9):02}", draw.randint(100, 10000)) for _ in range(100)]
    totals = Counter()
    for day, size in data:
        totals[day] += size
    logs = spark.createDataFrame(data, "day string, response_size int").withColumn(
        "timestamp", F.to_timestamp("day")
    )
    daily = weblogs.daily_volume(logs)
    assert dict(rows(daily)) == totals
    low, high, average, deviation = one(weblogs.daily_statistics(daily))
    values = list(totals.values())
    assert (low, high) == (min(values), max(values))
    assert average == pytest.approx(mean(values), abs=0.006)
    assert deviation == pytest.approx(stdev(values), abs=0.006)


@pytest.mark.parametrize("seed", SEEDS)
def test_purchases(spark, seed):
    draw = random.Random(seed)
    data = [
        (draw.choice("abcdef"), draw.choice("xyz"), draw.randint(1, 40) / 4, draw.randint(1, 9))
        for _ in range(120)
    ]
    df = spark.createDataFrame(data, "item string, category string, price double, quantity int")
    units, prices, items = Counter(), defaultdict(list), defaultdict(set)
    for item, category, price, quantity in data:
        units[category] += quantity
        prices[category].append(price)
        items[category].add(item)
    assert one(purchases.total_revenue(df)) == (sum(p * q for _, _, p, q in data),)
    assert dict(rows(purchases.average_price_by_category(df))) == pytest.approx(
        {c: mean(p) for c, p in prices.items()}
    )
    busiest = min(units, key=lambda c: (-units[c], c))
    assert one(purchases.busiest_category(df)) == (busiest, units[busiest])
    found = rows(purchases.items_by_category(df))
    assert sorted(found) == sorted((c, item) for c, own in items.items() for item in set(own))
    assert purchases.expensive_purchases(df, 5.0).count() == sum(p >= 5.0 for _, _, p, _ in data)
