"""Documents to packed training sequences, stage by stage.

Every stage reads all that its predecessor kept and returns the columns of documents, the last
one the pieces of the packed sequences. A stage's result is written to Parquet and read again
before the next. Columns beyond those of documents travel along.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyhouse.llm import mixing, packing, pii, rules, simhash
from tallyhouse.session import stage


def quality_rules(spark, docs, sf_dir):
    """Documents that fail no rule of the production policy."""
    return rules.keep_passing(docs, rules.PRODUCTION)


def near_dedup(spark, docs, sf_dir):
    """One document of each group of near copies: the smallest doc_id."""
    return simhash.drop_near_copies(docs)


def personal_data(spark, docs, sf_dir):
    """Spans of personal data replaced by their kind; n_chars follows the new text."""
    # Written before the texts are cut, so that no span is looked for twice.
    found = stage(pii.find_spans(docs, pii.fit(docs), spans_col="_spans"), "spans")
    redacted = pii.redact(found, spans_col="_spans")
    return redacted.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def mix_sources(spark, docs, sf_dir):
    """Every document at least once, documents of small sources up to twice."""
    return mixing.mixed(docs, prefix="_mix_").select(docs.columns)


def pack(spark, docs, sf_dir):
    """Pieces of the documents with their sequence and offset."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("personal_data", personal_data),
    ("mix_sources", mix_sources),
    ("pack", pack),
]
# Hashing, tokens and packing have no SQL form; tests/llm holds the brute-force check.
ORACLE_SQL = None


def run(spark, sf_dir):
    """STAGES applied to documents, one after the other."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
