from __future__ import annotations

import random
from pathlib import Path

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from tallyhouse.operators.counts import top_counts
from tallyhouse.operators import sketched
from tallyhouse.operators.sketched import top_counts_by_cells
from tallyhouse.operators.skipping import files_that_may_hold, index_schema, write_key_index
from tallyhouse.sinks import versions
from tallyhouse.sinks.versions import files_to_open, latest, load_version, read_version


@pytest.fixture
def index_of(spark, tmp_path):
    def build(df, key="k"):
        table, index = str(tmp_path / "table"), str(tmp_path / "index")
        df.write.parquet(table)
        written = spark.read.parquet(table)
        write_key_index(written, key, index)
        return written, spark.read.schema(index_schema(df.schema[key].dataType)).parquet(index)

    return build


def files_with(table, keys, key="k"):
    wanted = [r[0] for r in keys.collect()]
    held = table.filter(F.col(key).isin(wanted)).select(F.col("_metadata.file_name").alias("f")).distinct()
    return {r.f for r in held.collect()}


@pytest.mark.parametrize(
    "kind", ["int", "bigint", "string", "double", "decimal(20,3)", "date", "timestamp", "binary", "boolean"]
)
def test_no_file_with_a_key_is_passed_over(spark, index_of, kind):
    def typed(column):
        if kind == "date":
            return F.date_add(F.lit("2020-01-01").cast("date"), column.cast("int"))
        if kind == "timestamp":
            return F.timestamp_seconds(column * 1000.5)
        if kind == "binary":
            return column.cast("string").cast("binary")
        return (column.cast("int") % 2 == 0) if kind == "boolean" else column.cast(kind)

    df = spark.range(0, 3000, 1, 6).select(F.when(F.col("id") % 7 > 0, typed(F.col("id") * 3 - 2000)).alias("k"))
    table, index = index_of(df.union(spark.createDataFrame([], df.schema)))
    for seed in range(2):
        keys = df.sample(0.002, seed).union(df.limit(1).select(F.lit(None).cast(df.schema["k"].dataType)))
        assert files_with(table, keys) <= set(files_that_may_hold(index, keys))


def test_absent_keys_open_few_files_and_old_ranges_none(spark, index_of):
    """25 files over the same range of even numbers, asked for one odd number at a time: the filter alone tells."""
    df = spark.range(0, 200_000).select((F.col("id") * 2).alias("k")).repartition(25, F.xxhash64("k"))
    table, index = index_of(df)
    opened = sum(len(files_that_may_hold(index, spark.createDataFrame([(k,)], "k long"))) for k in range(1, 400_000, 50_000))
    assert opened <= 0.01 * 8 * 25
    assert files_that_may_hold(index, spark.createDataFrame([(400_001,)], "k long")) == []
    assert files_that_may_hold(index, spark.createDataFrame([(None,)], "k long")) == []
    # Whole numbers of other widths are the same keys.
    key = spark.createDataFrame([(2468,)], "k int")
    assert files_with(table, key) <= set(files_that_may_hold(index, key))


def test_a_hot_key_and_files_of_very_different_sizes(spark, index_of):
    big = spark.range(0, 100_000, 1, 2).select(F.when(F.col("id") % 3 == 0, -5).otherwise(F.col("id")).alias("k"))
    small = spark.range(0, 3, 1, 1).select((F.col("id") * 50_000 + 1).alias("k"))
    table, index = index_of(big.union(small))
    assert index.select("level").distinct().count() == 2
    for k in (-5, 50_001, 100_001):
        key = spark.createDataFrame([(k,)], "k long")
        assert files_with(table, key) <= set(files_that_may_hold(index, key))


def batch(spark, low, high):
    return spark.range(low, high).select(F.col("id").alias("k"), F.concat(F.lit("row "), "id").alias("t"))


def test_a_load_of_recent_keys_opens_only_recent_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(versions, "GRACE", 0.0)
    root = str(tmp_path / "table")
    for day in range(4):
        load_version(batch(spark, day * 100, day * 100 + 100), root, f"day {day}", "k")
    sets = dict(latest(spark, root).batches)
    recent = batch(spark, 390, 450)
    paths = files_to_open(recent.select("k"), root, latest(spark, root))
    assert paths and all(sets["day 3"] in path for path in paths)
    plan = plan_of(spark.read.schema(recent.schema).parquet(*paths).select("k"))
    assert "ReadSchema: struct<k:bigint>" in plan
    # The files of older days could not even be read.
    for day in range(3):
        for file in Path(root, "data", sets[f"day {day}"]).glob("*.parquet"):
            file.write_bytes(b"not a table")
    assert load_version(recent, root, "recent", "k") == 50
    assert load_version(batch(spark, 1000, 1010), root, "new", "k") == 10


def test_loads_equal_those_without_an_index(spark, tmp_path):
    draw = random.Random(5)
    root, stored = str(tmp_path / "table"), set()
    schema = "k string, n int"
    for number in range(4):
        made = [(draw.choice(["a", "b", "hot"]) + str(draw.randrange(60) ** 2) if draw.random() < 0.6 else draw.choice(["hot", None, ""]), i)
                for i in range(120)]
        expected = [row for row in made if row[0] is not None and row[0] not in stored]
        assert load_version(spark.createDataFrame(made, schema), root, str(number), "k") == len(expected)
        stored |= {row[0] for row in expected}
    assert {r.k for r in read_version(spark, root, spark.createDataFrame([], schema).schema).collect()} == stored


def test_file_sets_without_an_index_are_opened(spark, tmp_path):
    """By another column, of a type without order, or loaded before there were indexes."""
    root = str(tmp_path / "table")
    df = spark.createDataFrame([(1, "a", [1]), (2, "b", [2])], "k long, t string, a array<int>")
    more = spark.createDataFrame([(3, "b", [2]), (4, "c", [4])], df.schema)
    assert load_version(df, root, "1", "k") == 2
    assert load_version(more, root, "2", "t") == 1
    assert load_version(more, root, "3", "a") == 0
    assert load_version(more, root, "4", "k") == 1


@pytest.mark.parametrize("cells", [1, 16, 2**18])
@pytest.mark.parametrize("k", [1, 3, 40, 5000])
def test_top_by_cells_is_the_top_of_a_full_count(spark, cells, k):
    skewed = spark.range(0, 6000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise((F.col("id") ** 2 % 997).cast("string")).alias("key")
    )
    flat = spark.range(0, 3000, 1, 4).select((F.col("id") % 1500).alias("key"))
    for df in (skewed, flat, flat.limit(0)):
        assert rows(top_counts_by_cells(df, "key", k, cells=cells)) == rows(top_counts(df, "key", k))


def test_few_values_are_counted_one_by_one_when_counts_are_skewed(spark):
    """A million values, of which 20 are frequent: what is shuffled value by value is bounded by the cells that hold those."""
    rare = spark.range(0, 1_000_000, 1, 4).select(F.col("id").alias("user"))
    frequent = spark.range(0, 20 * 2000, 1, 4).select((F.col("id") % 20 * 1000).alias("user"))
    df = rare.union(frequent)
    result = top_counts_by_cells(df, "user", 10, "n_rows", cells=2**14)
    assert rows(result) == [(1000 * i, 2001) for i in range(10)]
    hashed = df.select(F.col("user").alias("key"), F.pmod(F.xxhash64("user"), F.lit(2**14)).cast("int").alias("cell"))
    counts = hashed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    floor = sketched._floor(hashed, counts, 10)
    assert floor == 2001
    reaching = counts.filter(F.col("n") >= floor).select("cell")
    assert hashed.join(reaching, "cell", "left_semi").select("key").distinct().count() < 20 * 200
