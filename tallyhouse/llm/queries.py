"""The dealt operators as named queries over the shared test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import (
    gam,
    langid,
    linedup,
    mixing,
    packing,
    periodic,
    pii,
    repair,
    revisits,
    rules,
    sharding,
    simhash,
    sketches,
)

# Captures of each page: a response, revisits under other spellings of its URL (before it, by weak
# ETag, by date, with a wrong ETag, without any), and for a third a changed response in between.
CAPTURES = """
  SELECT page_id * 8 AS record_id, 'revisit' AS type, 304 AS status, url, seen - 50 AS ts,
         NULL AS payload, tag AS etag, day AS last_modified, 'max-age=1' AS cache_control, 'skip' AS content_type
  FROM crawled WHERE page_id % 7 = 0
  UNION ALL
  SELECT page_id * 8 + 1, 'response', 200, url, seen, html, tag, day, 'max-age=2', 'text/html' FROM crawled
  UNION ALL
  SELECT page_id * 8 + 2, 'revisit', 304, url || '#part', seen + 100, NULL, 'W/' || tag, NULL, NULL, 'skip' FROM crawled
  UNION ALL
  SELECT page_id * 8 + 3, 'response', 200, url, seen + 200, html || '<!-- changed -->', changed, day, NULL, 'text/html'
  FROM crawled WHERE page_id % 3 = 0
  UNION ALL
  SELECT page_id * 8 + 4, 'revisit', 304, url || (CASE WHEN url LIKE '%?%' THEN '&' ELSE '?' END) || 'utm_source=x',
         seen + 300, NULL, NULL, day, 'max-age=3', NULL FROM crawled WHERE page_id % 3 <> 0
  UNION ALL
  SELECT page_id * 8 + 5, 'revisit', 304, url, seen + 400, NULL,
         CASE WHEN page_id % 5 = 0 THEN '"stale"' WHEN page_id % 3 = 0 THEN changed ELSE tag END, day, 'no-cache', NULL
  FROM crawled
  UNION ALL
  SELECT page_id * 8 + 6, 'revisit', 304, url, seen + 500, NULL, NULL, NULL, 'no-store', NULL
  FROM crawled WHERE page_id % 11 = 0
"""
CRAWLED = """
  SELECT page_id, url, html, 1700000000 + page_id * 7919 % 1000000 AS seen, '"' || substr(md5(html), 1, 16) || '"' AS tag,
         '"' || substr(md5(html || '<!-- changed -->'), 1, 16) || '"' AS changed,
         'day ' || CAST(page_id % 28 AS STRING) AS day
  FROM pages
"""

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_rule_ledger(spark, sf_dir):
    """Ledger of all documents with the verdict of the production policy."""
    ledger = rules.build_ledger(table(spark, sf_dir, "documents"))
    return ledger.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (~rules.passes(rules.BASE)).alias("base_failed"),
        rules.passes(rules.PRODUCTION).alias("kept"),
        "fail_bits",
    )


@query
def op4_sampled_splitters(spark, sf_dir):
    """All documents in eight shards of near-equal bytes."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    return sharding.shard_by_bytes(docs.withColumn("text_crc32", crc)).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op5_simhash_trie(spark, sf_dir):
    """Fingerprint and near-copy component of every document."""
    return simhash.near_copies(table(spark, sf_dir, "documents"))


@query
def op6_swap_packing(spark, sf_dir):
    """Every piece of every document, packed into sequences of 4096 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@query
def op3_temperature_mix(spark, sf_dir):
    """Every copy of every document in the mix: sources at most twice as often as the largest."""
    return mixing.mix_plan(table(spark, sf_dir, "documents"))


@query
def op10_boosted_pii(spark, sf_dir):
    """Base spans and the spans that the trees add, for every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find_spans(docs, pii.fit(docs)).select("doc_id", "spans")
    base = F.filter("spans", lambda s: s["base"])

    def number(kind: str):
        own = F.filter(base, lambda s: s["kind"] == pii.KINDS.index(kind))
        return F.size(own).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(number, pii.KINDS),
        F.sha2(pii.written(base), 256).alias("base_sha256"),
        pii.written(F.col("spans")).alias("spans"),
    )


@query
def op9_bottom_k(spark, sf_dir):
    """Sketch of every document, of its edited text, and their likeness."""
    return sketches.compare_edited(table(spark, sf_dir, "documents"))


@query
def op2_pairwise_gam(spark, sf_dir):
    """Quality score of every document, learnt from the labels that are not held out."""
    held_out = langid.remainder("doc_id", 3) == 1
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = gam.fit(docs, table(spark, sf_dir, "labels").filter(~held_out))
    return gam.score(docs, model).select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


@query
def op8_ngram_bayes(spark, sf_dir):
    """Language of every document, learnt from those that are not held out."""
    held_out = langid.remainder("doc_id", 4) == 2
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs.filter(~held_out))
    return langid.predict(docs, model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score"
    )


def captures(spark, sf_dir) -> DataFrame:
    """Archive records derived from pages."""
    sql = CAPTURES.replace("crawled", f"({CRAWLED.replace('pages', '{pages}')})")
    rows = spark.sql(sql, pages=table(spark, sf_dir, "pages"))
    names = ["etag", "last_modified", "cache_control", "content_type"]
    headers = F.create_map(
        *(x for name in names for x in (F.lit(name.replace("_", "-").title()), F.col(name)))
    )
    return rows.withColumn("headers", F.map_filter(headers, lambda _, value: value.isNotNull()))


@query
def op7_revisits(spark, sf_dir):
    """Every not-modified revisit in the captures of all pages, resolved."""
    headers = F.array_sort(
        F.transform(F.map_entries("headers"), lambda e: F.concat_ws(": ", e["key"], e["value"]))
    )
    return revisits.resolve(captures(spark, sf_dir)).select(
        "record_id",
        "url_key",
        "ts",
        "outcome",
        "response_id",
        F.md5(F.col("payload").cast("binary")).alias("payload_md5"),
        F.array_join(headers, "; ").alias("headers"),
    )


def made_periodic(docs: DataFrame) -> DataFrame:
    """docs with the words of every tenth text, by hash of its id, made periodic from some word on."""
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    docs = docs.select("doc_id", "text", (h % 10 == 0).alias("chosen"), F.floor(h / 10).alias("g"))
    chosen = docs.withColumn("words", F.when(F.col("chosen"), words)).withColumn("n", F.size("words"))
    start = (F.col("g") % F.col("n")).cast("int")
    period = (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int")
    chosen = chosen.withColumn("a", F.when(F.col("n") > 0, start)).withColumn("p", F.when(F.col("n") > 0, period))
    places = F.sequence(F.lit(0), F.col("n") - 1)
    a, p = F.col("a"), F.col("p")
    changed = F.transform(places, lambda i: F.get(F.col("words"), F.when(i < a, i).otherwise(a + (i - a) % p)))
    text = F.when(F.col("chosen") & (F.col("n") > 0), F.array_join(changed, " ")).otherwise(F.col("text"))
    return chosen.select("doc_id", text.alias("text"))


@query
def op12_suffix_runs(spark, sf_dir):
    """Periodic runs of every text, some made periodic, and what is left without the repeats."""
    docs = made_periodic(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periodic.find_runs(docs)
    runs = F.col("runs")
    # Greatest exact length / period; ties to the smallest start, then period.
    best = F.reduce(
        F.slice(runs, 2, F.greatest(F.size(runs) - 1, F.lit(0))),
        F.get(runs, F.lit(0)),
        lambda a, b: F.when(b["length"] * a["period"] > a["length"] * b["period"], b).otherwise(a),
    )
    lines = F.transform(runs, lambda r: F.concat_ws(",", *(r[name].cast("string") for name in ("start", "length", "period"))))
    found = found.withColumn("best", best)
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda line: F.concat(line, F.lit("\n"))), "").cast("binary"), 256).alias(
            "runs_sha256"
        ),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


@query
def op13_line_runs(spark, sf_dir):
    """Every document without the lines that five documents share, but for the last that holds them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return linedup.dedup_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256")
    )


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with a fifth of their rows harmed, by hash of conversation and turn."""
    space = F.lit(" ")
    part = [F.coalesce(F.col(name).cast("string"), space) for name in ("conv_id", "turn")]
    harm = F.crc32(F.concat_ws(":", *part).cast("binary")) % 20
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    text = F.when(harm == 1, "").when(harm == 2, F.translate(text, ".!?", "")).otherwise(text)
    rows = rows.select(
        "conv_id", "turn", F.when(harm == 4, "user").otherwise(role).alias("role"), text.alias("text"), harm.alias("harm")
    ).filter("harm <> 0")
    times = F.array_repeat(F.lit(0), F.when(F.col("harm") == 3, 2).otherwise(1))
    return rows.withColumn("copy", F.explode(times)).drop("harm", "copy")


@query
def op11_glr_repair(spark, sf_dir):
    """Faults and cheapest repair of every conversation, after damage."""
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    repaired = repair.repair(damaged(given))
    faults = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    rows = given.select(F.col("conv_id").alias("conv")).distinct()
    for found in (repaired.report, repair.digests(repaired.turns)):
        rows = rows.unionByName(found, allowMissingColumns=True)
    firsts = [F.first(name, ignorenulls=True).alias(name) for name in (*faults, "audit", "repaired_sha256")]
    return rows.groupBy("conv").agg(*firsts).select(
        F.col("conv").alias("conv_id"),
        *(F.coalesce(name, F.lit(0)).cast("long").alias(name) for name in faults),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )
