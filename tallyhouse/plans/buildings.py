"""Analysis of a building register (schema HOUSES_RAW).

Cleaning gives whole numbers as int; the warehouse table (schema HOUSES) widens population and
communal_service_id to bigint on loading.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions.cleaning import label_missing, text_to_float, text_to_int
from tallyhouse.functions.years import decade, realistic_year
from tallyhouse.operators.counts import count_by, row_count, top_counts, top_rows
from tallyhouse.operators.extremes import extremes_by_group, widest_spread
from tallyhouse.operators.quality import quality_report
from tallyhouse.operators.totals import mean_and_median
from tallyhouse.sinks.files import write_parquet
from tallyhouse.sinks.tables import create_houses_table, load_new_rows
from tallyhouse.sources.files import read_utf16_csv

# Fixed values
TOP_PLACES = 10
TOP_SPREADS = 20
TOP_BUILDINGS = 25
LARGE_SQUARE = 60
FIRST_SHOWN_DECADE = 1900


def land_register(spark: SparkSession, csv_path, parquet_path: str, **reading) -> DataFrame:
    """Read the CSV once and keep it as Parquet; return the Parquet table.

    A file that cannot be split arrives as one partition. Writing it as it comes
    keeps that task streaming; the Parquet it leaves is splittable for all that follows.
    """
    return write_parquet(read_utf16_csv(spark, csv_path, **reading), parquet_path)


def register_rows(register: DataFrame) -> DataFrame:
    """Row count; on Parquet it comes from the file footers."""
    return row_count(register, "rows")


def check_register(register: DataFrame) -> DataFrame:
    return quality_report(register)


def clean_register(register: DataFrame) -> DataFrame:
    """Dirty text columns to numbers, in one projection.

    Thousands separators are removed from the size only.
    """
    return register.withColumns(
        {
            "maintenance_year": text_to_int(F.col("maintenance_year")),
            "square": text_to_float(F.col("square"), strip_spaces=True),
            "population": text_to_int(F.col("population")),
            "communal_service_id": text_to_int(F.col("communal_service_id")),
        }
    )


def realistic_years(buildings: DataFrame, current_year: int) -> DataFrame:
    return buildings.filter(realistic_year(F.col("maintenance_year"), current_year))


def year_statistics(buildings: DataFrame, current_year: int) -> DataFrame:
    """Exact mean and median year of the realistic years, both rounded to 0 digits.

    The median works on counts per year, and the year filter bounds those at
    current_year - 1001 rows whatever the size of the table.
    """
    return mean_and_median(realistic_years(buildings, current_year), "maintenance_year")


def top_regions(buildings: DataFrame, k: int = TOP_PLACES) -> DataFrame:
    return top_counts(buildings, "region", k, "count")


def top_localities(buildings: DataFrame, k: int = TOP_PLACES) -> DataFrame:
    """Ranked first, labelled after: NULL is one group, apart from any literal label."""
    top = top_counts(buildings, "locality_name", k, "count")
    return top.withColumn("locality_name", label_missing(F.col("locality_name")))


def square_extremes(buildings: DataFrame) -> DataFrame:
    """Smallest and largest building of each region with its address."""
    return extremes_by_group(buildings, "region", "square", "address")


def widest_regions(buildings: DataFrame, k: int = TOP_SPREADS) -> DataFrame:
    return widest_spread(square_extremes(buildings), "region", "square", k)


def _decade_counts(buildings: DataFrame) -> DataFrame:
    known = buildings.filter(F.col("maintenance_year").isNotNull())
    by_decade = known.select(decade(F.col("maintenance_year")).alias("decade"))
    return count_by(by_decade, "decade", "building_count")


def buildings_by_decade(buildings: DataFrame) -> DataFrame:
    return _decade_counts(buildings).orderBy(F.col("decade").desc())


def decades_since(buildings: DataFrame, first: int = FIRST_SHOWN_DECADE) -> DataFrame:
    """Oldest first, from one decade on."""
    return _decade_counts(buildings).filter(F.col("decade") >= first).orderBy("decade")


def top_buildings(
    houses: DataFrame, larger_than: float = LARGE_SQUARE, k: int = TOP_BUILDINGS
) -> DataFrame:
    """The k largest buildings above a size; NaN is no size."""
    square = F.col("square")
    large = houses.filter((square > larger_than) & ~F.isnan(square)).select(
        "house_id",
        "latitude",
        "longitude",
        "square",
        "population",
        "region",
        "locality_name",
    )
    return top_rows(large, k, "square", "house_id")


def run_all(
    spark: SparkSession,
    csv_path,
    work_folder: str,
    current_year: int,
    *,
    table: str = "houses",
    buckets: int = 64,
    location: str | None = None,
    **reading,
) -> dict[str, DataFrame]:
    """The whole analysis, from CSV file to warehouse table, every result by name.

    Parquet is written only where several results share it: the landed file, the
    cleaned register and its realistic years. The warehouse gets the cleaned
    register, years unfiltered.
    """
    landed = land_register(spark, csv_path, f"{work_folder}/landed", **reading)
    cleaned = write_parquet(clean_register(landed), f"{work_folder}/cleaned")
    realistic = write_parquet(realistic_years(cleaned, current_year), f"{work_folder}/realistic")
    create_houses_table(spark, table, buckets=buckets, location=location)
    load_new_rows(cleaned, table)
    return {
        "rows": register_rows(landed),
        "quality": check_register(landed),
        "cleaned": cleaned,
        "realistic": realistic,
        "year_statistics": year_statistics(realistic, current_year),
        "top_regions": top_regions(realistic),
        "top_localities": top_localities(realistic),
        "square_extremes": square_extremes(realistic),
        "widest_regions": widest_regions(realistic),
        "buildings_by_decade": buildings_by_decade(realistic),
        "decades_since": decades_since(realistic),
        "top_buildings": top_buildings(spark.table(table)),
    }
