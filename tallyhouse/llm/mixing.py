"""Mixing sources by temperature: flatter shares, realised as budgeted block permutations.

A source's weight is its share of all tokens to the power of an exponent between 0 (all sources
alike) and 1 (as they are), normalised. The exponent is bisected until the weights reach a
target entropy, or until the most repeated source is repeated no more than a limit times the least
repeated one. Every source then gets its weight's part of the token budget. By default the budget
is the smallest with which every document is used at least once; the others repeat.

Realisation: in each epoch a source's documents are put in an order given by a hash, and their
tokens added up; the copies whose first token lies within the source's part are kept. The
stream is cut into blocks by the fraction of its source's part at which a copy starts, so that each
block has all sources in their weights, to within a document. Inside a block another
hash gives the order. The same seed gives the same mix again.

No source is ever in one task: a source's order is cut into buckets of about `BUCKET_ROWS`
documents by the hash itself, tokens are added up inside buckets and over the bucket totals. Weights are
computed by aggregates over the table of sources, which is not collected.

Defined results: a null source is a source of its own. A null or empty text has one token, the
closing id. Null or repeated ids and repeated rows are mixed like others, each row once per
epoch. Columns of the input named like one that is added are replaced. An empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import log

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.rows import ROW, with_row
from tallyhouse.llm.tokens import ID_BYTES, document_ids, word_ids
from tallyhouse.session import stage

BUCKET_ROWS = 5_000
PROBES = 15
PASSES = 6
ADDED = ["n_tokens", "epoch", "block", "place"]


@dataclass(frozen=True)
class Target:
    """What the exponent has to meet; with both, the larger exponent counts.

    entropy: fraction of the way from the shares' own entropy to that of equal weights, as
    the least to reach. repetition: most times the most repeated source may be repeated for
    one time of the least repeated.
    """

    entropy: float | None = None
    repetition: float | None = 2.0


@dataclass(frozen=True)
class Mix:
    target: Target = Target()
    budget: int | None = None
    block_tokens: int = 1 << 20
    seed: int = 17


@F.pandas_udf(T.LongType())
def token_counts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    known = word_ids()
    for texts in batches:
        counts = [len(document_ids(text, known)) // ID_BYTES for text in texts]
        yield pd.Series(counts, dtype="int64")


def share_statistics(sources: DataFrame, exponents: list[float]) -> list[tuple[float, float]]:
    """(entropy of the weights, most over least repetition) for each exponent, in one pass."""
    columns: list[Column] = []
    for exponent in exponents:
        power = F.pow("share", F.lit(exponent))
        columns += [F.sum(power), F.sum(power * F.log("share"))]
    found = sources.agg(F.min("share"), F.max("share"), *columns).first()
    spread = log(found[1] / found[0])
    sums = zip(found[2::2], found[3::2])
    return [
        (log(total) - exponent * logs / total, spread * (1 - exponent))
        for exponent, (total, logs) in zip(exponents, sums)
    ]


def fit_exponent(sources: DataFrame, target: Target) -> float:
    """Exponent for the table of sources (share: its part of all tokens).

    Entropy falls and repetition falls as the exponent rises, so a section search finds the
    edge of both: the largest exponent that reaches the entropy, the smallest within the
    repetition limit. Each pass tries PROBES exponents in one aggregate.
    """
    (natural, _), (equal, _) = share_statistics(sources, [1.0, 0.0])

    def edge(holds) -> tuple[float, float]:
        """Neighbouring exponents, of which the first holds and the second does not."""
        low, high = 0.0, 1.0
        for _ in range(PASSES):
            tried = [low + (high - low) * k / (PROBES + 1) for k in range(PROBES + 2)]
            flags = [holds(x) for x in share_statistics(sources, tried)]
            if not flags[0]:
                return low, low
            if flags[-1]:
                return high, high
            last = flags.index(False) - 1
            low, high = tried[last], tried[last + 1]
        return low, high

    found = []
    if target.entropy is not None:
        wanted = natural + target.entropy * (equal - natural)
        found.append(edge(lambda x: x[0] >= wanted - 1e-12)[0])
    if target.repetition is not None:
        limit = log(target.repetition)
        found.append(edge(lambda x: x[1] > limit + 1e-12)[1])
    return max(found, default=1.0)


def weigh_sources(rows: DataFrame, mix: Mix) -> tuple[DataFrame, float]:
    """source, rows, tokens, share, weight, quota (tokens) of every source; and the budget."""
    totals = rows.groupBy("source").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("n_tokens").alias("tokens")
    )
    totals = stage(totals, "sources")
    tokens = totals.agg(F.sum("tokens")).first()[0] or 0
    shares = totals.withColumn("share", F.col("tokens") / F.lit(float(max(tokens, 1))))
    exponent = fit_exponent(shares, mix.target) if tokens else 1.0
    power = F.pow("share", F.lit(exponent))
    total, least = shares.agg(F.sum(power), F.max(F.col("share") / power)).first()
    # share / weight is largest for the least repeated source; it is used once.
    budget = float(mix.budget or tokens * (total or 0.0) * (least or 0.0))
    weighed = shares.withColumn("weight", power / F.lit(total or 1.0)).withColumn(
        "quota", F.greatest(F.col("weight") * F.lit(budget), F.lit(1.0))
    )
    return weighed, budget


def plan(rows: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """ROW, source, n_tokens, epoch, block and place of every copy in the mix.

    rows: ROW, source and n_tokens of every document, a table that is cheap to read twice.
    """
    weighed, budget = weigh_sources(rows, mix)
    blocks = max(1, round(budget / mix.block_tokens))
    epochs = F.sequence(F.lit(0), (F.ceil(F.col("quota") / F.col("tokens")) - 1).cast("int"))
    buckets_of_source = F.ceil(F.col("rows") / BUCKET_ROWS)
    weighed = weighed.withColumnRenamed("source", "_source")
    copies = (
        rows.join(weighed, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("epoch", F.explode(epochs))
        .withColumn("draw", F.pmod(F.xxhash64(F.lit(mix.seed), "epoch", *ROW), F.lit(1 << 53)))
        .withColumn("bucket", F.floor(F.col("draw") / F.lit(float(1 << 53)) * buckets_of_source))
        .select(*ROW, "source", "n_tokens", "tokens", "quota", "epoch", "draw", "bucket")
    )
    stream = ["source", "epoch"]
    before = Window.partitionBy(*stream).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = copies.groupBy(*stream, "bucket").agg(F.sum("n_tokens").alias("sum"))
    buckets = buckets.select(
        F.col("source").alias("_source"),
        F.col("epoch").alias("_epoch"),
        F.col("bucket").alias("_bucket"),
        F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("before"),
    )
    inside = (
        Window.partitionBy(*stream, "bucket")
        .orderBy("draw", *ROW)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    here = (
        F.col("source").eqNullSafe(F.col("_source"))
        & (F.col("epoch") == F.col("_epoch"))
        & (F.col("bucket") == F.col("_bucket"))
    )
    start = F.col("epoch") * F.col("tokens") + F.col("before") + F.coalesce(F.col("inside"), F.lit(0))
    kept = (
        copies.withColumn("inside", F.sum("n_tokens").over(inside))
        .join(buckets, here)
        .withColumn("start", start)
        .filter(F.col("start") < F.col("quota"))
        .withColumn("block", F.floor(F.col("start") * blocks / F.col("quota")).cast("long"))
    )
    order = Window.partitionBy("block").orderBy(
        F.xxhash64(F.lit(mix.seed + 1), "epoch", *ROW), "epoch", *ROW
    )
    return kept.withColumn("place", F.row_number().over(order).cast("long") - 1).select(
        *ROW, "source", *ADDED
    )


def counted(docs: DataFrame, text_col: str, source_col: str) -> DataFrame:
    rows = with_row(docs).select(
        *ROW, F.col(source_col).alias("source"), token_counts(F.col(text_col)).alias("n_tokens")
    )
    return stage(rows, "token-counts")


def mix_plan(
    docs: DataFrame,
    mix: Mix = Mix(),
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """doc_id, source, n_tokens, epoch, block and place: the mix without its texts."""
    narrow = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(text_col).alias("text"),
        F.col(source_col).alias("source"),
    )
    rows = with_row(narrow).select(*ROW, "doc_id", "source", token_counts("text").alias("n_tokens"))
    rows = stage(rows, "token-counts")
    ids = rows.select(*ROW, "doc_id").dropDuplicates(ROW)
    return plan(rows.drop("doc_id"), mix).join(ids, ROW).drop(*ROW).select("doc_id", "source", *ADDED)


def mixed(
    docs: DataFrame,
    mix: Mix = Mix(),
    text_col: str = "text",
    source_col: str = "source",
    prefix: str = "",
) -> DataFrame:
    """Rows of docs as often as the mix has them, with n_tokens, epoch, block and place.

    The names of these four are prefixed as asked for.
    """
    named = {name: prefix + name for name in ADDED}
    docs = docs.drop(*named.values())
    copies = plan(counted(docs, text_col, source_col), mix).drop("source").withColumnsRenamed(named)
    return with_row(docs).dropDuplicates(ROW).join(copies, ROW).drop(*ROW)
