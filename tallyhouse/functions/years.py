from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values
EARLIEST_YEAR = 1000
DAY_FORMAT = "yyyy-MM-dd"


def realistic_year(year: Column, current_year: int) -> Column:
    """EARLIEST_YEAR < year < current_year for a whole year, both strict; NULL is not.

    The current year comes from the caller, so a query gives the same rows next year.
    """
    return year.between(EARLIEST_YEAR + 1, current_year - 1)


def decade(year: Column) -> Column:
    return (F.floor(year / 10) * 10).cast("int")


def day_text(timestamp: Column) -> Column:
    return F.date_format(timestamp, DAY_FORMAT)
