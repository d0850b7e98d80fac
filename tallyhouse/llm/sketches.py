"""Bottom-k sketches: the smallest hashes of a text's distinct five-word shingles.

A sketch of fewer than K hashes holds all of them and its answers are exact; otherwise K hashes
estimate resemblance, containment and the number of distinct shingles. The sketch of several parts
is the K smallest hashes of their sketches, so parts merge in any order; a text of fewer words than a
shingle has one shingle, all its words.

As a string, a sketch is eight characters (48 bits in base 64) per hash, ascending.

Defined results: a null text counts as empty, whose sketch is empty. Two empty sketches are alike
(1), an empty and another are not (0). Null or repeated ids and repeated rows are sketched like
others; the next document follows in the order (id, null first; hash over id and text). Only the
columns named are read. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.ranges import NO_ID, range_of, splitters_for
from tallyhouse.llm.words import encoded, words_of
from tallyhouse.session import stage

K = 256
SHINGLE = 5
BITS = 48
RANGE_BYTES = 16 << 20
FACTOR = np.uint64(0x9E3779B97F4A7C15)
KEYS_HELD = 10_000

EMPTY = np.zeros(0, dtype=np.uint64)


def scattered(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which every bit depends on every other."""
    x = (x ^ (x >> np.uint64(32))) * FACTOR
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingle_hashes(text: str | None) -> np.ndarray:
    words = words_of(encoded(text))
    if not words:
        return EMPTY
    hash_of = xxhash.xxh64_intdigest
    own = np.array([hash_of(word) for word in words], dtype=np.uint64)
    width = min(SHINGLE, len(own))
    n = len(own) - width + 1
    mixed = np.full(n, width, dtype=np.uint64)
    for i in range(width):
        mixed = scattered(mixed) + own[i : i + n]
    return scattered(mixed) >> np.uint64(64 - BITS)


def smallest(hashes: np.ndarray) -> np.ndarray:
    """The K smallest distinct hashes, ascending."""
    if len(hashes) > 8 * K:
        # Almost surely enough; otherwise all of them are sorted.
        few = np.unique(hashes[hashes <= np.partition(hashes, 4 * K)[4 * K]])
        if len(few) >= K:
            return few[:K]
    return np.unique(hashes)[:K]


def sketch(text: str | None) -> np.ndarray:
    return smallest(shingle_hashes(text))


def merged(*sketches: np.ndarray) -> np.ndarray:
    """Sketch of the parts together."""
    return smallest(np.concatenate(sketches)) if sketches else EMPTY


def distinct(a: np.ndarray) -> float:
    """Distinct shingles."""
    return float(len(a)) if len(a) < K else (K - 1) * 2.0**BITS / (float(a[K - 1]) + 1)


def resemblance(a: np.ndarray, b: np.ndarray) -> float:
    """Shared shingles over all shingles of both, by the smallest hashes of their union."""
    if not len(a) and not len(b):
        return 1.0
    both = merged(a, b)
    return float(len(np.intersect1d(np.intersect1d(both, a, True), b, True)) / len(both))


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Part of a's shingles that b has."""
    if not len(a):
        return 1.0
    return min(1.0, resemblance(a, b) * distinct(merged(a, b)) / distinct(a))


def to_text(a: np.ndarray) -> str:
    return base64.b64encode(a.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()).decode()


def from_text(text: str) -> np.ndarray:
    raw = np.frombuffer(base64.b64decode(text), dtype=np.uint8).reshape(-1, BITS // 8)
    whole = np.zeros((len(raw), 8), dtype=np.uint8)
    whole[:, 2:] = raw
    return whole.view(">u8").astype(np.uint64).ravel()


@F.pandas_udf(T.StructType([T.StructField("sketch", T.StringType()), T.StructField("n_distinct", T.DoubleType())]))
def sketched(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for texts in batches:
        found = [sketch(text) for text in texts]
        yield pd.DataFrame({"sketch": map(to_text, found), "n_distinct": map(distinct, found)})


def sketch_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, sketch and the (estimated) number of distinct shingles."""
    rows = docs.select(F.col(id_col).alias("doc_id"), sketched(F.col(text_col)).alias("s"))
    return rows.select("doc_id", "s.*")


def merge_sketches(rows: DataFrame, key: str, sketch_col: str = "sketch") -> DataFrame:
    """key, sketch: one merged sketch per key, however many parts it has.

    Every task first merges what it has of a key, so a key with very many parts sends one
    sketch per task and flush; after the shuffle a key's sketches are merged one by one.
    """
    narrow = rows.select(F.col(key).cast("string").alias("key"), F.col(sketch_col).alias("sketch"))

    def combine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str | None, np.ndarray] = {}
        for batch in batches:
            for name, text in zip(batch["key"], batch["sketch"]):
                held[name] = merged(held.get(name, EMPTY), from_text(text or ""))
                if len(held) > KEYS_HELD:
                    last = held.pop(name)
                    yield frame(held)
                    held = {name: last}
        if held:
            yield frame(held)

    def frame(held: dict) -> pd.DataFrame:
        return pd.DataFrame({"key": list(held), "sketch": map(to_text, held.values())})

    schema = "key string, sketch string"
    parts = narrow.mapInPandas(combine, schema)
    return parts.repartition("key").sortWithinPartitions("key").mapInPandas(combine, schema)


def in_order(docs: DataFrame, id_col: str, text_col: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Ranges of documents in id order; the last row of each (guest) starts the next range.

    The range after the last is the first. Splitters come from a size-weighted sample.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        text.alias("text"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("key"),
        F.xxhash64(F.col(id_col), text).alias("id"),
    )
    size = (F.octet_length("text") + 1).cast("long").alias("size")
    keys = stage(rows.select("key", "id", size), "order")
    total = keys.agg(F.sum("size")).first()[0] or 0
    splitters = splitters_for(keys, total, ceil(total / range_bytes))
    ranged = rows.withColumn("range", range_of(splitters, F.col("key"), F.col("id")))
    place = range_of(splitters, F.col("key"), F.col("id")).alias("range")
    least = F.min(F.struct("key", "id")).alias("first")
    firsts = sorted((row["range"], *row["first"]) for row in keys.groupBy(place).agg(least).collect())
    moves = [(firsts[i - 1][0], key, id_) for i, (_, key, id_) in enumerate(firsts)]
    spark = docs.sparkSession
    starts = F.broadcast(spark.createDataFrame(moves, "to int, key long, id long"))
    guests = rows.join(starts, ["key", "id"]).dropDuplicates(["to"])
    columns = ["range", "guest", "key", "id", "doc_id", "text"]
    return (
        ranged.withColumn("guest", F.lit(False)).select(columns)
        .union(guests.withColumn("guest", F.lit(True)).withColumn("range", F.col("to")).select(columns))
        .repartition("range")
        .sortWithinPartitions("range", "guest", "key", "id")
    )


def edited_text(text: str, following: str) -> str:
    """text with its last half replaced by as much of the start of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compare_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's sketch against that of its edited text and of the next document.

    Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next, n_distinct, edited_containment.
    """
    ordered = in_order(docs, id_col, text_col)
    kind = ordered.schema["doc_id"].dataType.simpleString()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            out: list[tuple] = []
            for range_, id_, text in zip(
                batch.column("range").to_pylist(), batch.column("doc_id").to_pylist(), batch.column("text")
            ):
                text = text.as_py()
                new = (range_, id_, text, sketch(text))
                if held and held[0] == range_:
                    out.append(row_of(held, new))
                held = new
            if out:
                yield pa.RecordBatch.from_pydict(
                    dict(zip(names, map(list, zip(*out)))), schema=arrow
                )

    def row_of(held, new) -> tuple:
        _, id_, text, own = held
        edited = edited_text(text, new[2])
        changed = sketch(edited)
        return (
            id_,
            len(text),
            hashlib.sha256(encoded(edited)).hexdigest(),
            to_text(own),
            to_text(changed),
            resemblance(own, changed),
            resemblance(own, new[3]),
            distinct(own),
            containment(changed, own),
        )

    schema = (
        f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double, n_distinct double, edited_containment double"
    )
    names = [part.split()[0] for part in schema.split(", ")]
    types = {"long": pa.int64(), "string": pa.string(), "double": pa.float64(), "bigint": pa.int64(), "int": pa.int32()}
    arrow = pa.schema([(part.split()[0], types[part.split()[1]]) for part in schema.split(", ")])
    return ordered.select("range", "doc_id", "text").mapInArrow(compare, schema)
