"""Larger tables derived from the test tables, with one group holding a third of the rows.

Times each operation beside the form it replaces, and its growth from one size to

SCALE_SF_DIR  folder of the Parquet tables (default /root/testdata/sf0.1)
SCALE_COPIES  copies of lineitem in the larger table (default 64)
SCALE_FOLDER  where to write the derived tables (default a new folder under /tmp)
"""

from __future__ import annotations

import os
import tempfile
import time

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.operators.counts import top_rows
from tallyhouse.operators.extremes import extreme_rows_by_group
from tallyhouse.operators.quality import duplicate_groups
from tallyhouse.plans import buildings, purchases, weblogs
from tallyhouse.session import local_session


def derive(spark, sf_dir: str, folder: str, copies: int) -> tuple[DataFrame, DataFrame]:
    """Buildings from lineitem and texts from documents, each repeated `copies` times."""
    copy = F.explode(F.sequence(F.lit(1), F.lit(copies))).alias("copy")
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").repartition(32).select("*", copy)
    houses = lines.select(
        F.xxhash64("l_orderkey", "l_linenumber", "copy").alias("house_id"),
        F.when(F.col("l_quantity") <= 17, "R0")
        .otherwise(F.concat(F.lit("R"), F.col("l_suppkey") % 85 + 1))
        .alias("region"),
        F.col("l_extendedprice").cast("float").alias("square"),
        F.concat_ws(" ", F.lit("street"), "l_partkey", "l_orderkey", "copy").alias("address"),
        F.year("l_shipdate").alias("maintenance_year"),
        F.col("l_shipdate").alias("timestamp"),
        F.col("l_suppkey").cast("string").alias("ip"),
        F.col("l_quantity").cast("int").alias("response_size"),
        F.col("l_returnflag").alias("category"),
        F.col("l_partkey").cast("string").alias("item"),
    )
    texts = (
        spark.read.parquet(f"{sf_dir}/documents.parquet")
        .repartition(32)
        .select("*", F.explode(F.sequence(F.lit(1), F.lit(max(1, copies // 8)))).alias("copy"))
        .select(
            F.when(F.col("doc_id") % 3 == 0, F.col("text"))
            .otherwise(F.concat("text", F.lit(" "), "copy"))
            .alias("text"),
            "lang",
        )
    )
    houses.write.parquet(f"{folder}/houses-{copies}")
    texts.write.parquet(f"{folder}/texts-{copies}")
    return (
        spark.read.parquet(f"{folder}/houses-{copies}"),
        spark.read.parquet(f"{folder}/texts-{copies}"),
    )


def numbered_extremes(houses: DataFrame) -> DataFrame:
    """A row number from either end, one row per region kept."""
    known = houses.filter("square IS NOT NULL").select("region", "square", "address")
    number = F.row_number()
    low = Window.partitionBy("region").orderBy("square", "address")
    high = Window.partitionBy("region").orderBy(F.desc("square"), "address")
    ends = known.select("*", number.over(low).alias("low"), number.over(high).alias("high"))
    return ends.filter("low = 1 OR high = 1")


def numbered_rows(houses: DataFrame) -> DataFrame:
    window = Window.partitionBy("region").orderBy("square", "address", "house_id")
    return houses.withColumn("rank", F.row_number().over(window)).filter("rank = 1")


def direct_median(houses: DataFrame) -> DataFrame:
    known = buildings.realistic_years(houses, 2002)
    year = F.col("maintenance_year")
    return known.agg(F.round(F.mean(year), 0), F.round(F.median(year), 0))


def whole_row_duplicates(texts: DataFrame) -> DataFrame:
    return texts.groupBy("text", "lang").count().filter("count > 1").agg(F.count("*"))


PAIRS = {
    "extremes by group": (buildings.square_extremes, numbered_extremes, "houses"),
    "extreme rows by group": (
        lambda h: extreme_rows_by_group(h, "region", "square", "address", "house_id"),
        numbered_rows,
        "houses",
    ),
    "year mean and median": (
        lambda h: buildings.year_statistics(h, 2002),
        direct_median,
        "houses",
    ),
    "duplicate groups": (duplicate_groups, whole_row_duplicates, "texts"),
    "top regions": (buildings.top_regions, None, "houses"),
    "top 25 by size": (
        lambda h: top_rows(h.filter("square > 60"), 25, "square", "house_id"),
        None,
        "houses",
    ),
    "decades": (buildings.buildings_by_decade, None, "houses"),
    "bytes per day": (weblogs.daily_volume_sorted, None, "houses"),
    "top clients": (weblogs.top_clients, None, "houses"),
    "items by category": (purchases.items_by_category, None, "houses"),
}


def seconds(query, df) -> float:
    best = []
    for _ in range(2):
        start = time.perf_counter()
        query(df).write.format("noop").mode("overwrite").save()
        best.append(time.perf_counter() - start)
    return min(best)


def main() -> None:
    sf_dir = os.environ.get("SCALE_SF_DIR", "/root/testdata/sf0.1")
    copies = int(os.environ.get("SCALE_COPIES", "64"))
    folder = os.environ.get("SCALE_FOLDER") or tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = local_session(8, **{"spark.sql.shuffle.partitions": "32"})
    spark.sparkContext.setLogLevel("ERROR")
    sizes = {}
    for n in (copies // 4, copies):
        houses, texts = derive(spark, sf_dir, folder, n)
        sizes[n] = {"houses": houses, "texts": texts}
        print(f"copies {n}: {houses.count()} buildings, {texts.count()} texts", flush=True)
    print("| Operation | rows x1 | rows x4 | growth | replaced form, rows x4 |")
    print("| --- | --- | --- | --- | --- |")
    for name, (ours, replaced, table) in PAIRS.items():
        small, large = (seconds(ours, sizes[n][table]) for n in sizes)
        other = f"{seconds(replaced, sizes[copies][table]):.2f} s" if replaced else "—"
        growth = f"x{large / small:.1f}"
        print(f"| {name} | {small:.2f} s | {large:.2f} s | {growth} | {other} |", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
