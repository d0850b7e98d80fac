"""Lines repeated across documents: levelled sorted runs of line hashes, added to batch by batch.

A line's key is the line without white space at either end, A-Z in lower case. A key of at least `least_chars`
code points that `least_docs` documents hold loses all its lines except those of the largest id that holds it.

Every batch of documents brings one record (hash, documents, largest id) per key. It is merge-joined
with every stored run and keeps only what these do not settle: a key that a run already counts in enough
documents up to an id as large needs no further record. The rest is written as a new run of the lowest
level, bucketed and sorted by hash, so neither the join nor a later one shuffles a run. `FANOUT` runs of one level are merged
into one of the next, which sums counts and settles more; a record is thus rewritten once a level.
Batches go from the largest ids to the smallest, where a run settles most; any other order gives the
same result. At the end the runs are merged once more, and the lines of frequent keys are looked up.

Everything is DataFrame functions. Counts are combined before each shuffle, so a line that a third of all documents
hold is one record per task; the join of lines with frequent keys is one of two plain shuffles, which Spark splits
where a key is hot. Texts move once, when they meet the numbers of their dropped lines.

Documents are told apart by id: rows of one id, null among them, count as one document, and all rows of the largest
id keep the line. A null id is smaller than any other. Defined results: a null or empty text is one empty line. Repeated rows stay and
are treated alike. Very long texts are one row's work, linear in their lines. Columns of the input stay; one
named like an output column is replaced. An empty table gives an empty result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.rows import absent
from tallyhouse.llm.words import WHITE_SPACE
from tallyhouse.session import fresh_path, remove, stage

LEAST_CHARS = 40
LEAST_DOCS = 5
BATCHES = 8
#: Runs of a level before they are merged.
FANOUT = 4
#: Ids drawn to cut batches; they decide the order of work, not the result.
DRAWN = 4_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HASH = ["h1", "h2"]


class LineRuns:
    """Sorted runs of (h1, h2, n, last) in levels, as bucketed tables whose files lie in the shared folder.

    A run has as many buckets as the session has shuffle partitions when the store is made.
    """

    def __init__(self, spark: SparkSession, least_docs: int = LEAST_DOCS, fanout: int = FANOUT):
        self.spark = spark
        self.least_docs = least_docs
        self.fanout = fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self.paths: dict[str, str] = {}

    def runs(self) -> list[str]:
        return [run for level in self.levels for run in level]

    def unsettled(self, own: DataFrame) -> DataFrame:
        """Records of a batch that no run settles."""
        for run in self.runs():
            known = self.spark.table(run).filter(F.col("n") >= self.least_docs)
            known = known.select(*HASH, F.col("last").alias("known_last")).hint("merge")
            same = [own[name] == known[name] for name in HASH]
            own = own.join(known, [*same, known["known_last"] >= own["last"]], "left_anti")
        return own

    def add(self, own: DataFrame) -> None:
        """Add a batch's records, one per hash."""
        if not self.levels:
            self.levels.append([])
        self.levels[0].append(self.written(self.unsettled(own)))
        level = 0
        while len(self.levels[level]) >= self.fanout:
            if level + 1 == len(self.levels):
                self.levels.append([])
            merged = self.levels[level]
            self.levels[level + 1].append(self.written(self.merged(merged)))
            self.levels[level] = []
            self.drop(merged)
            level += 1

    def written(self, records: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        self.paths[name] = fresh_path(self.spark, "line_run")
        writer = records.write.bucketBy(self.buckets, *HASH).sortBy(*HASH)
        writer.option("path", self.paths[name]).saveAsTable(name)
        return name

    def merged(self, runs: list[str]) -> DataFrame:
        """One record per hash of these runs, read as one table of files."""
        schema = self.spark.table(runs[0]).schema
        records = self.spark.read.schema(schema).parquet(*(self.paths[run] for run in runs))
        return records.groupBy(*HASH).agg(F.sum("n").alias("n"), F.max("last").alias("last"))

    def frequent(self) -> DataFrame:
        """Hashes of keys in enough documents, with the largest id."""
        return self.merged(self.runs()).filter(F.col("n") >= self.least_docs).select(*HASH, "last")

    def drop(self, runs: list[str]) -> None:
        for run in runs:
            self.spark.sql(f"DROP TABLE {run}")
            remove(self.spark, self.paths.pop(run))

    def close(self) -> None:
        self.drop(self.runs())
        self.levels = []


def row_hash(id_col: str, text_col: str) -> list:
    """128 bits that tell rows of different id or text apart."""
    parts = [part for name in (id_col, text_col) for part in (F.col(name).isNull(), F.col(name))]
    return [F.xxhash64(F.lit(seed), *parts) for seed in (1, 2)]


def lines_of(docs: DataFrame, id_col: str, text_col: str, least_chars: int) -> DataFrame:
    """r1, r2, doc, pos, h1, h2 of every line whose key is long enough."""
    r1, r2 = row_hash(id_col, text_col)
    split = F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1)
    # The text is hashed below the explode, once a row and not once a line.
    rows = docs.select(r1.alias("r1"), r2.alias("r2"), F.col(id_col).alias("doc"), split.alias("lines"))
    lines = rows.select("r1", "r2", "doc", F.posexplode("lines").alias("pos", "line"))
    bare = lines.withColumn("line", F.btrim("line", F.lit(WHITE_SPACE))).filter(F.length("line") >= least_chars)
    # Only where a line has other characters would lower() change more than A-Z.
    ascii = F.octet_length("line") == F.length("line")
    key = F.when(ascii, F.lower("line")).otherwise(F.translate("line", UPPER, LOWER))
    return bare.select("r1", "r2", "doc", "pos", key.alias("key")).select(
        "r1", "r2", "doc", "pos", *(F.xxhash64(F.lit(seed), "key").alias(name) for seed, name in enumerate(HASH))
    )


def bounds_of(ids: DataFrame, batches: int) -> list:
    """Ids that cut the ids into about equal batches, descending."""
    n = ids.count()
    if batches < 2 or not n:
        return []
    uniform = F.pmod(F.xxhash64("id"), F.lit(1 << 53)) / F.lit(float(1 << 53))
    drawn = ids.filter(F.col("id").isNotNull() & (uniform < F.lit(DRAWN / n)))
    # An id is drawn once, however many rows have it: about DRAWN values at most.
    drawn = sorted(row["id"] for row in drawn.distinct().collect())
    cuts = {drawn[len(drawn) * k // batches] for k in range(1, batches)} if drawn else set()
    return sorted(cuts, reverse=True)


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lines_col: str = "n_lines",
    dropped_col: str = "n_dropped",
    least_chars: int = LEAST_CHARS,
    least_docs: int = LEAST_DOCS,
    batches: int = BATCHES,
) -> DataFrame:
    """docs with text_col cut down to the lines that stay, lines_col lines before and dropped_col fewer after.

    Writes the lines' hashes and the runs on the way, and so runs jobs when called.
    """
    spark = docs.sparkSession
    bounds = bounds_of(docs.select(F.col(id_col).alias("id")), batches)
    # Batch 0 has the ids from the largest bound on, the last one those below all, and null.
    batch = F.lit(len(bounds))
    for number, bound in reversed(list(enumerate(bounds))):
        batch = F.when(F.col("doc") >= F.lit(bound), number).otherwise(batch)
    lines = lines_of(docs, id_col, text_col, least_chars).withColumn("batch", batch)
    lines = stage(lines, "lines", "batch")
    store = LineRuns(spark, least_docs)
    for number in range(len(bounds) + 1):
        pairs = lines.filter(F.col("batch") == number).select(*HASH, "doc").distinct()
        own = pairs.groupBy(*HASH).agg(F.count(F.lit(1)).alias("n"), F.max("doc").alias("last"))
        store.add(own)
    frequent = stage(store.frequent(), "frequent_lines")
    store.close()
    later = F.col("doc").isNull() | (F.col("doc") < F.col("last"))
    dropped = lines.join(frequent, HASH).filter(later).groupBy("r1", "r2").agg(F.collect_set("pos").alias("gone"))

    r1, r2, all_, gone = (absent(docs, name) for name in ("r1", "r2", "lines", "gone"))
    for name, value in zip((r1, r2), row_hash(id_col, text_col)):
        docs = docs.withColumn(name, value)
    dropped = dropped.select(F.col("r1").alias(r1), F.col("r2").alias(r2), F.col("gone").alias(gone))
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = docs.join(dropped, [r1, r2], "left").withColumn(all_, F.split(text, "\n", -1))
    numbers = F.array_except(F.sequence(F.lit(0), F.size(all_) - 1), F.col(gone))
    kept = F.array_join(F.transform(numbers, lambda i: F.get(F.col(all_), i)), "\n")
    names = [name for name in docs.columns if name not in (r1, r2, lines_col, dropped_col)]
    return found.select(
        *(
            F.when(F.col(gone).isNull(), F.col(name)).otherwise(kept).alias(name) if name == text_col else F.col(f"`{name}`")
            for name in names
        ),
        F.size(all_).cast("long").alias(lines_col),
        F.when(F.col(gone).isNull(), 0).otherwise(F.size(gone)).cast("long").alias(dropped_col),
    )
