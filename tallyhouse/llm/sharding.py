"""Shards of near-equal bytes by sampled splitters.

Records are ordered by (digest of the text, id), so that equal texts are neighbours. Sampled
splitters cut this order into ranges, each sorted by one task; overfull ranges are cut again.
The exact bytes before every range turn a record's place in its range into its place in
the whole order, and the shard is the place as a fraction of all bytes. A group of equal texts
goes to one shard as a whole unless it weighs more than `GROUP_SHARE` of a shard: such a
group is cut between records.

So shard sizes differ from the mean by at most `GROUP_SHARE` of a shard or one record, whichever is
larger, and `slot` numbers the records of a shard without gaps in that order.

Defined results: a null text counts as empty (size 1). A null id sorts first, ids that are no whole numbers by their hash. Rows that agree
in text and id are ordered by a hash over all columns; rows equal in every column are
interchangeable. Columns of the input named like one that is added are replaced. An empty table
gives an empty result.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from tallyhouse.llm.ranges import NO_ID, Splitters, range_of, splitters_for
from tallyhouse.llm.rows import row_hash
from tallyhouse.session import stage

SHARDS = 8
RANGES_PER_SHARD = 8
RANGE_BYTES = 256 << 20
GROUP_SHARE = 0.01
# Working columns.
KEY, ID, TIE, RANGE, START, NTH = (f"_shard_{x}" for x in ("key", "id", "tie", "range", "start", "nth"))


def keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """df with its key (60 bits of the text's MD5), id (its hash if it is no whole number), size in bytes and row hash."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    whole = isinstance(df.select(id_col).schema[0].dataType, IntegralType)
    row_id = F.col(id_col).cast("long") if whole else F.when(F.col(id_col).isNotNull(), F.xxhash64(id_col))
    return df.withColumns(
        {
            KEY: F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long"),
            ID: F.coalesce(row_id, F.lit(NO_ID)),
            "size": (F.octet_length(text) + 1).cast("long"),
            TIE: row_hash(df, 0),
        }
    )


def whole_groups(keys: DataFrame, splitters: Splitters, most: float) -> Splitters:
    """Splitters moved to the start of their group of equal texts, if that weighs at most `most`."""
    if not splitters:
        return []
    spark = keys.sparkSession
    cut = spark.createDataFrame([(key,) for key in {k for k, _ in splitters}], "key long")
    weights = keys.join(F.broadcast(cut), "key", "left_semi").groupBy("key")
    weight = dict(map(tuple, weights.agg(F.sum("size")).collect()))
    return sorted({(k, i if weight.get(k, 0) > most else NO_ID) for k, i in splitters})


def shard_by_bytes(
    df: DataFrame,
    shards: int = SHARDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    range_bytes: int = RANGE_BYTES,
    group_share: float = GROUP_SHARE,
) -> DataFrame:
    """df with size (UTF-8 bytes of the text plus 1), shard (0 to shards - 1) and slot.

    Writes the keys and sizes once to the shared folder; the texts are read twice and travel
    only if the result's columns are asked for.
    """
    rows = keyed(df, id_col, text_col)
    narrow = stage(rows.select(KEY, ID, TIE, "size"), "shard-keys")
    keys = narrow.select(F.col(KEY).alias("key"), F.col(ID).alias("id"), "size")
    total = narrow.agg(F.sum("size")).first()[0] or 0
    most = group_share * total / shards
    ranges = max(shards * RANGES_PER_SHARD, ceil(total / range_bytes))
    splitters = whole_groups(keys, splitters_for(keys, total, ranges), most)
    offsets = range_offsets(keys, splitters)
    on_keys = placed(narrow, splitters, offsets, shards, total, most)
    first = dict(map(tuple, on_keys.groupBy("shard").agg(F.min(NTH)).collect()))
    starts = F.create_map(*(F.lit(x) for pair in first.items() for x in pair)) if first else None
    slot = F.col(NTH) - (starts[F.col("shard")] if first else F.lit(0))
    done = placed(rows, splitters, offsets, shards, total, most)
    kept = [name for name in df.columns if name not in ("size", "shard", "slot")]
    return done.select(*kept, "size", "shard", slot.cast("long").alias("slot"))


def range_offsets(keys: DataFrame, splitters: Splitters) -> DataFrame:
    """Bytes and rows before each range: a row per range, whose number `splitters_for` bounds."""
    place = range_of(splitters, F.col("key"), F.col("id"))
    sums = keys.groupBy(place.alias("range")).agg(F.sum("size"), F.count(F.lit(1))).collect()
    out, size, n = [], 0, 0
    for range_, range_size, range_n in sorted(sums):
        out.append((range_, size, n))
        size, n = size + range_size, n + range_n
    return keys.sparkSession.createDataFrame(out, f"{RANGE} int, size_before long, n_before long")


def placed(
    rows: DataFrame, splitters: Splitters, offsets: DataFrame, shards: int, total: int, most: float
) -> DataFrame:
    """rows with shard and nth, the place in the whole order."""
    place = range_of(splitters, F.col(KEY), F.col(ID))
    ranged = rows.withColumn(RANGE, place).join(
        F.broadcast(offsets), RANGE, "left"
    )
    order = Window.partitionBy(RANGE).orderBy(KEY, ID, TIE)
    group = Window.partitionBy(RANGE, KEY)
    earlier = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1))
    small = F.sum("size").over(group) <= F.lit(most)
    start = F.when(small, F.min(START).over(group)).otherwise(F.col(START))
    return (
        ranged.withColumn(START, F.col("size_before") + F.coalesce(earlier, F.lit(0)))
        .withColumn(NTH, F.col("n_before") + F.row_number().over(order) - 1)
        .withColumn(START, start)
        .withColumn("shard", F.expr(f"int({START} * {shards} div {max(total, 1)})"))
    )
