from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from samples import AWKWARD, awkward, clashing, empty

from tallyhouse.llm import ranges, sharding


def check(rows, shards=8):
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(slots) <= set(range(shards))
    size = Counter()
    for r in rows:
        size[r.shard] += r.size
    return size


def test_awkward_rows(spark):
    for docs in (awkward(spark), clashing(spark)):
        found = sharding.shard_by_bytes(docs)
        rows = found.collect()
        check(rows)
        assert len(rows) == len(AWKWARD)
        assert sorted(r.size for r in rows) == sorted(len((t or "").encode()) + 1 for _, t, *_ in AWKWARD)
        assert set(docs.columns) <= set(found.columns)
    assert sharding.shard_by_bytes(empty(spark)).count() == 0


@pytest.mark.parametrize("hot", [0, 3])
def test_sizes_are_near_equal_and_groups_stay_together(spark, hot):
    """A text with a third of all rows is cut between records; small groups are not."""
    text = F.when(F.col("id") % 3 < hot // 3, F.lit("the hot text")).otherwise(
        F.repeat(F.concat((F.col("id") / 4).cast("int").cast("string"), F.lit(" ")), (F.col("id") % 17).cast("int"))
    )
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), text.alias("text"))
    rows = sharding.shard_by_bytes(docs, range_bytes=2000).collect()
    size = check(rows)
    mean = sum(size.values()) / 8
    longest = max(r.size for r in rows)
    assert all(abs(s - mean) <= 2 * (sharding.GROUP_SHARE * mean + longest) for s in size.values())
    shards = defaultdict(set)
    for r in rows:
        shards[r.text].add(r.shard)
    split = [t for t, s in shards.items() if len(s) > 1]
    assert split == (["the hot text"] if hot else []) or set(split) <= {"the hot text", ""}


def test_many_ranges_give_the_same_shards(spark):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("x y "), (F.col("id") % 50).cast("int")).alias("text")
    )
    few, many = (
        {r.doc_id: (r.shard, r.slot) for r in sharding.shard_by_bytes(docs, range_bytes=b).collect()}
        for b in (1 << 30, 500)
    )
    assert few == many


def test_overfull_ranges_are_cut_again(spark):
    """One round of a coarse sample leaves a range too heavy; the next rounds cut it."""
    rows = spark.range(5000).select(
        F.when(F.col("id") < 4000, 7).otherwise(F.col("id")).alias("key"),
        F.col("id").alias("id"),
        F.lit(10).cast("long").alias("size"),
    )
    splitters = ranges.splitters_for(rows, 50_000, 40)
    weights = rows.groupBy(ranges.range_of(splitters, F.col("key"), F.col("id")).alias("r")).count()
    assert max(r["count"] for r in weights.collect()) * 10 <= ranges.OVERFULL * 50_000 / 40


def test_text_ids_and_nested_columns(spark):
    """Ids of any type; rows that differ in a null inside a column alone have places of their own."""
    made = [(f"doc-{i % 40}", "same" if i % 3 else f"text {i}", [None, str(i)], {"k": i}) for i in range(120)]
    docs = spark.createDataFrame([*made, (None, None, None, None)], "doc_id string, text string, a array<string>, m map<string,int>")
    found = sharding.shard_by_bytes(docs).collect()
    assert len(found) == 121
    for shard in {r.shard for r in found}:
        slots = sorted(r.slot for r in found if r.shard == shard)
        assert slots == list(range(len(slots)))
    again = sharding.shard_by_bytes(docs.repartition(5)).collect()
    assert sorted(map(str, found)) == sorted(map(str, again))


def test_range_of_agrees_with_comparison(spark):
    splitters = [(-5, 0), (1, -3), (1, 4), (1, 9), (2, 2), (9, 9)]
    points = [(k, i) for k in range(-6, 11) for i in range(-4, 11)]
    df = spark.createDataFrame(points, "key long, id long")
    found = df.withColumn("r", ranges.range_of(splitters, F.col("key"), F.col("id"))).collect()
    assert all(r.r == sum(s <= (r.key, r.id) for s in splitters) for r in found)


def test_crc_is_that_of_utf8(spark):
    import __spark_entry__ as contract

    rows = contract.queries()["op4_sampled_splitters"](spark, "/root/testdata/sf0.001").collect()
    text = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert all(r.text_crc32 == zlib.crc32(text[r.doc_id].encode()) for r in rows)
