"""File sources. Every reader takes a path (or paths) on any file system Spark knows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tallyhouse.functions.text import access_log_fields
from tallyhouse.sources.schemas import HOUSES_RAW

BAD_LINE = "__bad_line"
BROKEN = "not one value per column; read the file with newlines_in_fields=True: "


def read_csv(spark: SparkSession, path, schema: StructType | None = None) -> DataFrame:
    """CSV with a header line.

    With a schema the file is scanned once, only when an action needs it. Without
    one Spark infers the types, at the price of a whole extra pass.
    """
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return reader.csv(path)


def read_utf16_csv(
    spark: SparkSession,
    path,
    schema: StructType = HOUSES_RAW,
    *,
    newlines_in_fields: bool = True,
    little_endian: bool = True,
) -> DataFrame:
    """UTF-16 CSV with a header line.

    A file whose quoted fields hold newlines cannot be split, so each such file is
    one task: give the data as many files and land it once as Parquet. For files
    known to hold no newline inside a field, `newlines_in_fields=False` reads line
    by line, and one large file is then shared by many tasks. Lines may end in LF or
    CRLF. Reading stops with an error at a line that has not one value per column:
    in text with characters from U+0A00 to U+0AFF the bytes of a line end can
    occur across two characters, and a line cut there must not pass for data.
    """
    if newlines_in_fields:
        reader = spark.read.schema(schema).option("header", True)
        return reader.option("encoding", "UTF-16").option("multiLine", True).csv(path)
    # The splitting reader looks for the encoded line end, so the byte order must be
    # named; the mark at the file start stays in the header line, which is skipped
    # because the schema is declared. Values are read as text, as the last one of a
    # line may still hold the carriage return.
    texts = StructType([StructField(f.name, StringType()) for f in schema])
    lines = (
        spark.read.schema(texts.add(BAD_LINE, StringType()))
        .option("header", True)
        .option("encoding", "UTF-16LE" if little_endian else "UTF-16BE")
        .option("lineSep", "\n")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", BAD_LINE)
        .csv(path)
    )
    last = schema[-1].name
    whole = F.when(F.col(BAD_LINE).isNull(), F.lit(False)).otherwise(
        F.raise_error(F.concat(F.lit(BROKEN), F.left(BAD_LINE, F.lit(80)))).cast("boolean")
    )
    ends = F.nullif(F.regexp_replace(F.col(f"`{last}`"), r"\r$", ""), F.lit(""))
    lines = lines.withColumn(last, ends).filter(~whole).drop(BAD_LINE)
    return lines.select(*[_typed(field) for field in schema])


def _typed(field: StructField) -> Column:
    """Text as the field's type, NULL where it is none, as the CSV reader has it."""
    text = F.col(f"`{field.name}`")
    if isinstance(field.dataType, StringType):
        return text
    # The reader takes no number with spaces around it.
    value = F.when(F.trim(text) == text, text.try_cast(field.dataType))
    return value.alias(field.name)


def read_parquet(spark: SparkSession, path, schema: StructType | None = None) -> DataFrame:
    """Parquet directory or file; Spark raises PATH_NOT_FOUND when it is missing."""
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def read_access_log(spark: SparkSession, path) -> DataFrame:
    """Raw access-log text as (client, method, url), one row per line, blank lines too."""
    return access_log_fields(spark.read.text(path))


def first_rows(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """First n rows in a named order, so that a preview shows the same rows each time."""
    return df.orderBy(*order).limit(n)
