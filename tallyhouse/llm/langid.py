"""Language by multinomial naive Bayes over hashed character n-grams.

A text's features are its lower-cased n-grams of one to four characters, hashed into BUCKETS.
Learning counts them per language on a sample of at most about `rows_per_language` rows of
each, drawn by id and text so that copies of a text are thinned like other rows, and for LANGUAGES_AT_ONCE languages at a time. The
matrix of log probabilities, BUCKETS numbers for each language that occurs, is broadcast: 256 KB a language. Scoring counts the buckets of the texts of a
batch as one sparse matrix and multiplies it with that matrix; very long texts are counted piece by piece, and every
character counts.

The best language is that of all n-grams and the prior. Its score is its posterior with the evidence of
EVIDENCE n-grams at most, as overlapping n-grams repeat each other.

Defined results: a null text, or one without a letter, is `und` with score 0. A null id
is not held out. Rows without a language are scored and never learnt from. Without any learnt
language every text is `und`. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 1 << 16
ORDERS = (1, 2, 3, 4)
ROWS_PER_LANGUAGE = 5_000
#: Languages whose counts reach the driver in one go.
LANGUAGES_AT_ONCE = 64
#: Numbers that one product of a batch may gather.
GATHERED = 1 << 22
SMOOTHING = 0.5
EVIDENCE = 60
PIECE = 1 << 18
UNKNOWN = "und"


@dataclass(frozen=True)
class Model:
    languages: list[str]
    #: BUCKETS rows of one log probability per language.
    matrix: np.ndarray
    prior: np.ndarray


def remainder(id_col: str, parts: int) -> Column:
    """crc32 of the id as text, modulo parts; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % parts


def buckets_of(text: str) -> Iterator[np.ndarray]:
    """Bucket of every n-gram of a text, in pieces of bounded length."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    longest = max(ORDERS)
    for start in range(0, len(codes), PIECE):
        piece = codes[start : start + PIECE + longest - 1].astype(np.uint64)
        found = []
        for order in ORDERS:
            n = min(PIECE, len(piece) - order + 1)
            if n <= 0:
                continue
            mixed = np.full(n, order, dtype=np.uint64)
            for i in range(order):
                mixed = (mixed + piece[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
                mixed ^= mixed >> np.uint64(29)
            found.append((mixed >> np.uint64(17)) % np.uint64(BUCKETS))
        yield np.concatenate(found).astype(np.int64)


def fit(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    rows_per_language: int = ROWS_PER_LANGUAGE,
    id_col: str = "doc_id",
) -> Model:
    """Model learnt from the rows of docs that have a text and a language, of any number of languages."""
    named = {id_col: "id", text_col: "text", lang_col: "lang"}
    known = docs.select(*(F.col(name).alias(to) for name, to in named.items())).dropna(subset=["text", "lang"])
    sizes = known.groupBy("lang").agg(F.count(F.lit(1)).alias("size"))
    collected = dict(map(tuple, sizes.collect()))
    languages = sorted(collected)
    if not languages:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0, np.float32))
    parts = []
    for first in range(0, len(languages), LANGUAGES_AT_ONCE):
        block = languages[first : first + LANGUAGES_AT_ONCE]
        share = F.lit(1.0)
        for language in block:
            part = min(1.0, rows_per_language / collected[language])
            share = F.when(F.col("lang") == language, F.lit(part)).otherwise(share)
        uniform = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 53)) / F.lit(float(1 << 53))
        parts.append(counted(known.filter(F.col("lang").isin(block) & (uniform < share)), block))
    table = np.concatenate(parts, axis=1) + SMOOTHING
    matrix = np.log(table / table.sum(axis=0)).astype(np.float32)
    weights = np.array([collected[language] for language in languages], dtype=float)
    return Model(languages, matrix, np.log(weights / weights.sum()))


def counted(sample: DataFrame, languages: list[str]) -> np.ndarray:
    """How often the texts of each language have each bucket; BUCKETS rows of one number per language."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch["text"], batch["lang"]):
                own = totals.setdefault(lang, np.zeros(BUCKETS, dtype=np.int64))
                for found in buckets_of(text):
                    own += np.bincount(found, minlength=BUCKETS)
        for lang, own in totals.items():
            used = np.flatnonzero(own)
            yield pd.DataFrame({"lang": lang, "bucket": used, "n": own[used]})

    counts = sample.select("text", "lang").mapInPandas(count, "lang string, bucket long, n long")
    # At most LANGUAGES_AT_ONCE * BUCKETS rows.
    found = counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    table = np.zeros((BUCKETS, len(languages)))
    place = {language: i for i, language in enumerate(languages)}
    table[found["bucket"].to_numpy(int), found["lang"].map(place).to_numpy(int)] = found["n"].to_numpy(float)
    return table


def classify_all(texts: list[str | None], model: Model) -> list[tuple[str, float]]:
    """Language and score of each text of a batch."""
    out = [(UNKNOWN, 0.0)] * len(texts)
    if not model.languages:
        return out
    held, buckets, counts, lengths = [], [], [], []

    def multiply() -> None:
        n = np.concatenate(counts).astype(np.float64)
        starts = np.cumsum([0, *map(len, counts)])[:-1]
        totals = np.add.reduceat(n[:, None] * model.matrix[np.concatenate(buckets)], starts, axis=0)
        # The evidence of a long text is tempered for its score alone.
        tempered = totals * (np.minimum(lengths, EVIDENCE) / lengths)[:, None] + model.prior
        best = (totals + model.prior).argmax(axis=1)
        for i, row, own in zip(held, best, tempered):
            out[i] = model.languages[row], float(1 / np.exp(own - own[row]).sum())
        for part in (held, buckets, counts, lengths):
            part.clear()

    gathered = 0
    for i, text in enumerate(texts):
        if not text or not any(map(str.isalpha, text)):
            continue
        own = sum(np.bincount(found, minlength=BUCKETS) for found in buckets_of(text))
        used = np.flatnonzero(own)
        held.append(i)
        buckets.append(used)
        counts.append(own[used])
        lengths.append(own.sum())
        gathered += len(used) * len(model.languages)
        if gathered >= GATHERED:
            multiply()
            gathered = 0
    if held:
        multiply()
    return out


def classify(text: str | None, model: Model) -> tuple[str, float]:
    return classify_all([text], model)[0]


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred and score of every row."""
    spark: SparkSession = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def label(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            found = classify_all(texts.tolist(), shared.value)
            yield pd.DataFrame(found, columns=["lang_pred", "score"])

    rows = docs.select(F.col(id_col).alias("doc_id"), label(F.col(text_col)).alias("found"))
    return rows.select("doc_id", "found.*")
