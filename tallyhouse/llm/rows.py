"""Identity of whole rows, for tables whose ids may be null or repeated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

ROW = ["_row_a", "_row_b"]


def hash_parts(value: Column, kind: DataType, seed: int) -> list[Column]:
    """What to hash for a value: Spark's hash skips nulls, so each has a flag beside it, inside arrays and structs too.

    The entries of a map are taken in the order of their hashes, as a map has none of its own.
    """

    def inner(part: Column, part_kind: DataType) -> Column:
        return F.xxhash64(F.lit(seed), *hash_parts(part, part_kind, seed))

    if isinstance(kind, ArrayType):
        value = F.transform(value, lambda e: inner(e, kind.elementType))
    elif isinstance(kind, MapType):
        entry = StructType().add("key", kind.keyType).add("value", kind.valueType)
        value = F.array_sort(F.transform(F.map_entries(value), lambda e: inner(e, entry)))
    elif isinstance(kind, StructType):
        fields = [inner(value.getField(field.name), field.dataType) for field in kind]
        return [value.isNull(), *fields]
    elif isinstance(kind, VariantType):
        value = F.to_json(value)
    return [value.isNull(), value]


def row_hash(df: DataFrame, seed: int) -> Column:
    parts = [part for f in df.schema for part in hash_parts(F.col(f"`{f.name}`"), f.dataType, seed)]
    return F.xxhash64(F.lit(seed), *parts)


def with_row(df: DataFrame) -> DataFrame:
    """df with ROW, 128 bits of hash over all columns: equal rows, and only they, agree."""
    return df.withColumns({name: row_hash(df, seed) for seed, name in enumerate(ROW)})


def absent(df: DataFrame, label: str) -> str:
    """A column name that df has not, in any case of its letters."""
    return "_" * (1 + max((len(name) for name in df.columns), default=0)) + label
