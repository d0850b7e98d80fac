"""Quality rules as a bitmask ledger.

Each text is measured once and each rule evaluated once; the ledger keeps the measurements
and one bit per failed rule. Policies are named sets of rules: applying one, or comparing
many, is a bitwise test on the ledger and never reads a text again. Ablations group the
ledger by its bits first, so they work on at most one row per distinct set of failures.

Defined results: a null text is an empty one (all measurements 0). A null or repeated
doc_id is a row like any other. Only the id and text columns of the input are read, so
further columns, whatever their names, have no effect. An empty table gives an empty ledger.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import eq

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.words import WHITE_SPACE, encoded, words_of

MEASURES = [
    "n_words",
    "word_chars",
    "n_symbols",
    "n_lines",
    "n_dup_lines",
    "n_repeat_words",
    "n_stutters",
    "n_letters",
    "n_capitals",
]
WINDOW = 5
SYMBOLS = b"#*$%&|<>"
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
LETTERS = CAPITALS + CAPITALS.lower()


@dataclass(frozen=True)
class Rule:
    """A failure condition over the measurements, and the bit that records it."""

    name: str
    bit: int
    fails: str


@dataclass(frozen=True)
class Policy:
    """A version of the rule set: a text is kept if it fails none of these rules."""

    version: str
    rules: tuple[str, ...]


RULES = (
    Rule("few_words", 0, "n_words < 10"),
    Rule("repeated_windows", 1, "100 * n_repeat_words > 20 * n_words"),
    Rule("symbols", 2, "10 * n_symbols > n_words"),
    Rule("duplicate_lines", 3, "2 * n_dup_lines > n_lines"),
    Rule("word_length", 4, "word_chars < 3 * n_words OR word_chars > 10 * n_words"),
    Rule("stutter", 5, "3 * n_stutters > n_words"),
    Rule("capitals", 6, "10 * n_capitals > 8 * n_letters"),
)
BASE = Policy("base", ("few_words", "repeated_windows"))
PRODUCTION = Policy(
    "2", ("few_words", "repeated_windows", "symbols", "duplicate_lines", "word_length", "stutter")
)
STRICT = Policy("strict", tuple(rule.name for rule in RULES))
POLICIES = (BASE, PRODUCTION, STRICT)


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window found twice or more, first occurrences included."""
    grams = list(zip(*(words[i:] for i in range(window))))
    if len(set(grams)) == len(grams):
        return 0
    times = Counter(grams)
    covered, end = 0, 0
    for start, gram in enumerate(grams):
        if times[gram] > 1:
            covered += start + window - max(start, end)
            end = start + window
    return covered


def measure(text: str | None) -> tuple[int, ...]:
    """The MEASURES of one text."""
    raw = encoded(text)
    words = words_of(raw)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return (
        len(words),
        len(text or "") - sum(map((text or "").count, WHITE_SPACE)),
        len(raw) - len(raw.translate(None, SYMBOLS)),
        len(lines),
        len(lines) - len(set(lines)),
        repeated_words(words),
        sum(map(eq, words, words[1:])),
        len(raw) - len(raw.translate(None, LETTERS)),
        len(raw) - len(raw.translate(None, CAPITALS)),
    )


@F.pandas_udf(T.StructType([T.StructField(name, T.LongType()) for name in MEASURES]))
def measurements(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for texts in batches:
        yield pd.DataFrame([measure(text) for text in texts], columns=MEASURES, dtype="int64")


def build_ledger(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Sequence[Rule] = RULES
) -> DataFrame:
    """doc_id, the measurements, and fail_bits with the bit of every rule the text fails."""
    measured = docs.select(
        F.col(id_col).alias("doc_id"), measurements(F.col(text_col)).alias("measured")
    ).select("doc_id", "measured.*")
    return measured.withColumn("fail_bits", fail_bits(rules))


def fail_bits(rules: Sequence[Rule] = RULES) -> Column:
    """The bits of the rules that a row of measurements fails."""
    failed = (F.when(F.expr(rule.fails), 1 << rule.bit).otherwise(0) for rule in rules)
    return reduce(Column.bitwiseOR, failed).cast("long")


def mask(policy: Policy, rules: Sequence[Rule] = RULES) -> int:
    bits = {rule.name: 1 << rule.bit for rule in rules}
    return sum(bits[name] for name in policy.rules)


def passes(policy: Policy, rules: Sequence[Rule] = RULES) -> Column:
    """Verdict of a policy on a ledger row."""
    return F.col("fail_bits").bitwiseAND(mask(policy, rules)) == 0


def apply_policies(
    ledger: DataFrame, policies: Sequence[Policy] = POLICIES, rules: Sequence[Rule] = RULES
) -> DataFrame:
    """The ledger with one verdict column `kept_<version>` per policy."""
    return ledger.withColumns(
        {f"kept_{policy.version}": passes(policy, rules) for policy in policies}
    )


def keep_passing(
    docs: DataFrame,
    policy: Policy = PRODUCTION,
    text_col: str = "text",
    rules: Sequence[Rule] = RULES,
) -> DataFrame:
    """Rows of docs, unchanged, whose text passes the policy.

    No shuffle: the ledger row is made beside its text.
    """
    measured = docs.select(
        F.struct(*docs.columns).alias("_doc"), measurements(F.col(text_col)).alias("_m")
    )
    ledger = measured.select("_doc", "_m.*").withColumn("fail_bits", fail_bits(rules))
    return ledger.filter(passes(policy, rules)).select("_doc.*")


def ablations(
    ledger: DataFrame, policies: Sequence[Policy] = POLICIES, rules: Sequence[Rule] = RULES
) -> DataFrame:
    """What each rule does in each policy.

    Per policy version and rule: texts and words it rejects, those it alone rejects (what
    dropping the rule would win back), and the other rules of the policy that ever fail
    together with it, as bits. Rows are counted per distinct fail_bits before anything else.
    """
    seen = ledger.groupBy("fail_bits").agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_words").alias("words")
    )
    cases = F.explode(
        F.array(
            *(
                F.struct(
                    F.lit(policy.version).alias("version"),
                    F.lit(rule.name).alias("rule"),
                    F.lit(1 << rule.bit).cast("long").alias("bit"),
                    F.lit(mask(policy, rules)).cast("long").alias("mask"),
                )
                for policy in policies
                for rule in rules
                if rule.name in policy.rules
            )
        )
    )
    case = seen.select("fail_bits", "n", "words", cases.alias("case")).select(
        "fail_bits", "n", "words", "case.*"
    )
    bits = F.col("fail_bits").bitwiseAND(F.col("mask"))
    fails = bits.bitwiseAND(F.col("bit")) != 0
    alone = bits == F.col("bit")

    def total(condition: Column, value: str) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col(value))), F.lit(0))

    others = bits.bitwiseAND(F.bitwise_not("bit"))
    return case.groupBy("version", "rule").agg(
        total(fails, "n").alias("rejected"),
        total(fails, "words").alias("rejected_words"),
        total(alone, "n").alias("rejected_alone"),
        total(alone, "words").alias("rejected_alone_words"),
        F.coalesce(F.bit_or(F.when(fails, others)), F.lit(0)).cast("long").alias("fails_with"),
    )
