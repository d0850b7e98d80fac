"""Awkward documents every operator has to take, and the given ones."""

from __future__ import annotations

import pandas as pd

SF_DIR = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

LONG = " ".join(f"word{i % 5000} a.b{i}@mail.example.com" for i in range(20_000))
AWKWARD = [
    (1, "one two three four five six seven eight nine ten eleven", "en", "a", 55),
    (2, None, None, None, None),
    (3, "", "en", "a", 0),
    (3, "", "en", "a", 0),
    (None, "no id here, but +44 20 7946 0958 to call", "en", "b", 40),
    (None, None, None, None, None),
    (5, " \t\n\x0b\x0c\r ", None, "a", 7),
    (6, "x" * 100_000, "de", "b", 100_000),
    (7, LONG, "en", "a", len(LONG)),
    (8, "é ß 𝔘 日本語 \x1c\x85 İ ﬁ", "fr", "c", 20),
    (9, "one two three four five six seven eight nine ten eleven", "en", "c", 55),
    (10, "123 456 . , ;", "en", "a", 13),
    (2**62, "the last of them", "en", "a", 16),
]


def awkward(spark):
    return spark.createDataFrame(AWKWARD, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def clashing(spark):
    """The awkward rows with extra columns named like those that operators add or work with."""
    names = """size shard slot range start key id tie guest fp root component_id fingerprint epoch
    block place n_tokens weight spans kind end n_words kept fail_bits measured found score
    lang_pred piece length sequence_id offset ids_crc32 sketch n_distinct label bucket""".split()
    return awkward(spark).selectExpr("*", *(f"'clash' AS `{name}`" for name in names))


def given():
    return pd.read_parquet(f"{SF_DIR}/documents.parquet")


def pairs(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=str)
