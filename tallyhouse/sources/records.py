"""CSV whose quoted fields hold newlines, read by many tasks from one file.

A line starts a record if an even number of quotes stands before it in its file. Chunks of the lines of a split count
their quotes and record starts, for either parity of what came before; running totals over the chunks of a split and
over the splits of a file then tell every chunk its parity and its first record's number. Lines of one record, also
across splits, are joined again and parsed by Spark's own CSV parser.

Lines are shuffled by chunk and then by record, over a number of tasks that follows the number of tasks that read the
file, whatever the session's: what a task sorts is bounded by the size of a split, and windows hold one chunk. The
table of chunks has one row each. Texts are shuffled twice, so land such a file once as Parquet.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyhouse.session import stage
from tallyhouse.sources.schemas import HOUSES_RAW

# A chunk has 2 ** CHUNK_BITS lines, half of what a window keeps without a buffer on disk; a line takes
# more room in a sort than in its file, so each task that reads gets several that shuffle.
CHUNK_BITS = 11
TASKS_PER_READER = 4

SPLIT = ["file", "block"]
CHUNK = [*SPLIT, "chunk"]

CUT_LINE = "a line ends inside a character; read the file with read_utf16_csv: "


def quotes_in(line: Column, escape: str) -> Column:
    """Quotes of a line that open or close a field; an escaped one is text, a doubled one counts twice."""
    plain = line
    if escape != '"':
        pattern = re.escape(escape) + "."
        plain = F.when(F.contains(line, F.lit(escape)), F.regexp_replace(line, pattern, "")).otherwise(line)
    return F.length(plain) - F.length(F.replace(plain, F.lit('"'), F.lit("")))


def lines_of(spark: SparkSession, path, encoding: str, escape: str) -> DataFrame:
    """file, block (where the split starts), chunk and id (order in the split), line and its quotes."""
    text = spark.read.option("encoding", encoding).option("lineSep", "\n").text(path)
    raw = F.col("value").cast("binary")
    line = F.decode(raw, encoding)
    if encoding.upper().startswith("UTF-16"):
        # Bytes of a line end can occur across two characters, from U+0A00 to U+0AFF and one whose low byte is zero.
        odd = F.octet_length(raw) % 2 == 1
        broken = F.raise_error(F.concat(F.lit(CUT_LINE), F.col("file"))).cast("string")
        line = F.when(odd, broken).otherwise(line)
    lines = text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"),
        "value",
    )
    chunk = F.shiftright("id", CHUNK_BITS).alias("chunk")
    lines = lines.select("file", "block", chunk, "id", F.regexp_replace(line, "\r$", "").alias("line"))
    return lines.withColumn("quotes", quotes_in(F.col("line"), escape))


def parted(units: DataFrame, group: list[str], order: str) -> tuple[DataFrame, Window]:
    """Units with flip (quotes before the unit in its group are odd in number) and the record starts of the unit, for
    either parity of the quotes before the group; the window of the units before."""
    before = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    flips = units.withColumn("flip", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2)
    even = F.col("flip") == 0
    starts = {"if_even": F.when(even, F.col("if_even")).otherwise(F.col("if_odd"))}
    starts["if_odd"] = F.when(even, F.col("if_odd")).otherwise(F.col("if_even"))
    return flips.withColumns(starts), before


def totals(units: DataFrame, group: list[str], order: str) -> DataFrame:
    """Each group's quotes and record starts, for either parity of the quotes before it."""
    return parted(units, group, order)[0].groupBy(*group).agg(*[F.sum(c).alias(c) for c in ("quotes", "if_even", "if_odd")])


def chunks_of(lines: DataFrame, tasks: int) -> DataFrame:
    """Totals of each chunk: file, block, chunk, quotes, if_even, if_odd."""
    counts = lines.select(*CHUNK, "id", "quotes", F.lit(1).alias("if_even"), F.lit(0).alias("if_odd"))
    return totals(counts.repartition(tasks, *CHUNK), CHUNK, "id")


def starts_of(chunks: DataFrame) -> DataFrame:
    """file, block, chunk, odd (quotes before the chunk are odd in number) and records that start before it."""
    splits, before = parted(totals(chunks, SPLIT, "chunk"), ["file"], "block")
    earlier = F.coalesce(F.sum("if_even").over(before), F.lit(0))
    splits = splits.select(*SPLIT, F.col("flip").alias("odd"), earlier.alias("records"))
    inside, before = parted(chunks, SPLIT, "chunk")
    even, odd = (F.coalesce(F.sum(c).over(before), F.lit(0)) for c in ("if_even", "if_odd"))
    inside = inside.select(*CHUNK, "flip", even.alias("even"), odd.alias("uneven"))
    earlier = F.when(F.col("odd") == 0, F.col("even")).otherwise(F.col("uneven"))
    return inside.join(splits, SPLIT).select(
        *CHUNK, ((F.col("odd") + F.col("flip")) % 2).alias("odd"), (F.col("records") + earlier).alias("records")
    )


def numbered(lines: DataFrame, starts: DataFrame, tasks: int) -> DataFrame:
    """Lines with the number of their record in their file, from 1.

    What stands before a chunk comes as a line before its first, so that no join orders the lines anew.
    """
    heads = starts.select(*CHUNK, F.lit(-1).alias("id"), F.lit(None).alias("line"), F.col("odd").alias("quotes"), "records")
    rows = lines.withColumn("records", F.lit(0)).unionByName(heads).repartition(tasks, *CHUNK)
    within = Window.partitionBy(*CHUNK).orderBy("id")
    so_far = F.sum("quotes").over(within.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("start", F.when(F.col("id") < 0, F.col("records")).otherwise((so_far + 1) % 2))
    number = F.sum("start").over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return rows.withColumn("record", number).filter(F.col("id") >= 0).select("file", "record", "block", "id", "line")


def read_split_csv(
    spark: SparkSession,
    path,
    schema: StructType = HOUSES_RAW,
    *,
    encoding: str = "UTF-16LE",
    escape: str = "\\",
) -> DataFrame:
    """CSV with a header record in each file, by as many tasks as the files have splits.

    The result is that of read_utf16_csv (of Spark's multi-line reader, for other encodings). Lines
    end in LF or CRLF, also those inside fields, which come out with LF. Quotes inside a quoted field follow
    `escape`, which is '"' for doubled ones, and do not occur in other fields. Without its closing quote the rest of a file is one record.
    Runs a job when called, to count quotes.
    """
    lines = lines_of(spark, path, encoding, escape)
    tasks = TASKS_PER_READER * max(1, lines.rdd.getNumPartitions())
    chunks = stage(chunks_of(lines, tasks), "csv-chunks")
    placed = numbered(lines, starts_of(chunks), tasks).repartition(tasks, "file", "record")
    parts = F.array_sort(F.collect_list(F.struct("block", "id", "line")))
    records = placed.groupBy("file", "record").agg(F.array_join(F.transform(parts, lambda p: p["line"]), "\n").alias("text"))
    # The header is a file's first record; blank lines are none.
    rows = records.filter((F.col("record") > 1) & (F.length(F.trim("text")) > 0))
    fields = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)
    return rows.select(F.from_csv("text", fields, {"mode": "PERMISSIVE", "escape": escape}).alias("row")).select("row.*")
