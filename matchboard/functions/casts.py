"""Casts that give null, not an error, on text that is no number or time."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def to_number(column: str | Column) -> Column:
    """Any type to double by way of its text."""
    return _col(column).cast("string").try_cast("double")


def to_int(column: str | Column) -> Column:
    """Text to int through double, so "3.0" is 3 and "3.7" truncates to 3."""
    return _col(column).try_cast("double").try_cast("int")


def to_time(column: str | Column, time: str = "timestamp") -> Column:
    return _col(column).try_cast(time)


def time_type(df: DataFrame, column: str) -> str:
    """Timestamp type of a column; text columns count as plain ``timestamp``."""
    kind = df.schema[column].dataType.simpleString()
    return kind if kind.startswith("timestamp") else "timestamp"


def at(moment: datetime | Column, time: str = "timestamp") -> Column:
    """A wall-clock moment as a literal of the given timestamp type.

    Goes through text: a Python datetime literal would shift with the time zone
    of the driver process.
    """
    if isinstance(moment, Column):
        return moment
    return F.lit(moment.isoformat(sep=" ")).cast(time)


def _col(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column
