"""Dirty numeric text to numbers. Built for ANSI mode: nothing here can raise on bad text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values
MISSING_MARK = "—"
UNKNOWN_LABEL = "Неизвестно"
WHOLE_NUMBER = r"^\s*[+-]?\d+(\.\d*)?\s*$"

# try_cast gives NULL for bad text by throwing and catching an exception per value,
# which takes longer than all else here, and missing values are common: both functions
# therefore look at the text first. They name their column few times, because a filter
# on the result, once pushed below the cleaning, repeats the whole expression.


def text_to_float(column: Column, *, strip_spaces: bool = False) -> Column:
    """32-bit float; text that is no number, and the text NaN, become NULL."""
    text = _without_spaces(column) if strip_spaces else column
    number = F.when(~column.isin(MISSING_MARK, ""), text.try_cast("float"))
    return F.nullif(number, F.lit(float("nan")))


def text_to_int(column: Column, *, strip_spaces: bool = False) -> Column:
    """32-bit int, dropping a fraction ('1953.0' is 1953).

    Inner spaces are kept unless asked otherwise, so '1 000' is no number; nor is
    text with an exponent.
    """
    text = _without_spaces(column) if strip_spaces else column
    return F.when(text.rlike(WHOLE_NUMBER), F.substring_index(text, ".", 1).try_cast("int"))


def _without_spaces(column: Column) -> Column:
    return F.replace(column, F.lit(" "), F.lit(""))


def label_missing(column: Column, label: str = UNKNOWN_LABEL) -> Column:
    return F.coalesce(column, F.lit(label))
