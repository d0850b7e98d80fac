"""Which files may hold a key: the range of each file's keys and a Bloom filter of them, kept as a table.

A row of the index is one 64-bit word of the filter of one file. A key sets four bits of a single word, so
one look at one row tells whether the file may hold it. A filter has 2**level words, by the number of rows
of its file; words without a bit are not stored. The index never denies a key that its file holds.

Keys are compared in the type of the column, whole numbers of any width as bigint. NULL keys
are in no file. Columns of arrays, structs, maps and the like have no index (`indexable`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    IntegerType,
    IntegralType,
    LongType,
    MapType,
    NullType,
    StringType,
    StructField,
    StructType,
    UserDefinedType,
    VariantType,
)

from tallyhouse.session import remove, stage

#: Bits of a filter for each row of its file; with four of them set by a key, under 1 in 100 absent keys is taken for present.
BITS_PER_KEY = 16
WORD = 64


def compared_type(kind: DataType) -> DataType:
    """The type in which keys of a column are compared."""
    return LongType() if isinstance(kind, IntegralType) else kind


def indexable(kind: DataType) -> bool:
    return not isinstance(kind, (ArrayType, StructType, MapType, VariantType, NullType, UserDefinedType))


def index_schema(kind: DataType) -> StructType:
    kind = compared_type(kind)
    return StructType(
        [
            StructField("file", StringType()),
            StructField("level", IntegerType()),
            StructField("low", kind),
            StructField("high", kind),
            StructField("word", LongType()),
            StructField("bits", LongType()),
        ]
    )


def _word(key: Column, level: Column) -> Column:
    words = F.call_function("shiftleft", F.lit(1).cast("long"), level)
    return F.xxhash64(key).bitwiseAND(words - F.lit(1))


def _mask(key: Column) -> Column:
    """Four bits of a word, from a hash of its own."""
    pattern = F.xxhash64(F.lit(1), key)
    mask = F.lit(0).cast("long")
    for place in range(4):
        bit = F.shiftright(pattern, 6 * place).bitwiseAND(F.lit(WORD - 1)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit))
    return mask


def write_key_index(table: DataFrame, key: str, path: str, prefix: str = "") -> None:
    """Write the index of the files that `table` reads, which lie in one folder; `prefix` goes before their names.

    Reads the key column twice; words are put together map-side before they are shuffled, so neither a file
    with most rows nor a key with most rows meets one task.
    """
    kind = compared_type(table.select(key).schema[0].dataType)
    file = F.concat(F.lit(prefix), F.col("_metadata.file_name"))
    keys = table.select(file.alias("file"), F.col(key).cast(kind).alias("key"))
    keys = keys.filter(F.col("key").isNotNull())
    files = keys.groupBy("file").agg(
        F.count(F.lit(1)).alias("n"), F.min("key").alias("low"), F.max("key").alias("high")
    )
    level = F.ceil(F.log2(F.col("n") * F.lit(BITS_PER_KEY / WORD)))
    # Written, so that Spark knows its size when it joins the keys with it.
    files = stage(files.withColumn("level", F.greatest(level, F.lit(0)).cast("int")).drop("n"), "key-files")
    words = (
        keys.join(files, "file")
        .groupBy("file", "level", "low", "high", _word(F.col("key"), F.col("level")).alias("word"))
        .agg(F.bit_or(_mask(F.col("key"))).alias("bits"))
    )
    # By file, so that the range of its keys passes over whole row groups when the index is read.
    words.sortWithinPartitions("file").write.parquet(path)
    remove(table.sparkSession, files.staged_at)


def files_that_may_hold(index: DataFrame, keys: DataFrame) -> list[str]:
    """Files of the index that may hold one of the keys (a table of one column), in order of their names.

    The names come to the driver, which lists the files of a table in any case. A word of the index is done with
    at the first key that hits it, so many keys cost little more than few.
    """
    kind = index.schema["low"].dataType
    keys = keys.select(F.col(f"`{keys.columns[0]}`").cast(kind).alias("key")).filter(F.col("key").isNotNull())
    low, high = keys.agg(F.min("key"), F.max("key")).first()
    if low is None:
        return []
    near = index.filter((F.col("low") <= F.lit(high).cast(kind)) & (F.col("high") >= F.lit(low).cast(kind)))
    levels = [row["level"] for row in near.select("level").distinct().collect()]
    if not levels:
        return []
    probes = keys.withColumn("probed", F.explode(F.array(*[F.lit(level) for level in sorted(levels)])))
    probes = probes.select(
        "key", "probed", _word(F.col("key"), F.col("probed")).alias("place"), _mask(F.col("key")).alias("mask")
    )
    held = near.join(
        probes,
        (F.col("level") == F.col("probed"))
        & (F.col("word") == F.col("place"))
        & (F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"))
        & F.col("key").between(F.col("low"), F.col("high")),
        "left_semi",
    )
    return sorted(row["file"] for row in held.select("file").distinct().collect())
