"""Number, time and rate expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .fixed_values import TIME_PATTERN


def to_number(value: Column) -> Column:
    """Number or null; text that is no number (or says NaN) becomes null instead of failing the job."""
    number = value.try_cast("double")
    return F.when(~F.isnan(number), number)


def to_count(value: Column) -> Column:
    return F.coalesce(to_number(value).try_cast("bigint"), F.lit(0).cast("bigint"))


def parse_time(value: Column) -> Column:
    """Timestamp without zone, or null. One declared layout; anything else is unparseable."""
    return F.when(value.rlike(TIME_PATTERN), value.try_cast("timestamp_ntz"))


def floor_hour(ts: Column) -> Column:
    """Start of the hour, computed on fields so that the session time zone plays no part."""
    return F.make_timestamp_ntz(
        F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.lit(0), F.lit(0)
    )


def time_text(ts: Column) -> Column:
    """``YYYY-MM-DD HH:MM:SS``; null stays null."""
    return F.substring(ts.cast("string"), 1, 19)


def flag(value: Column) -> Column:
    """Flag with unknown counted as false."""
    return F.coalesce(value, F.lit(False))


def rate(value: Column) -> Column:
    """Share of rows whose flag is true."""
    return F.avg(flag(value).cast("int"))


def zero_if_null(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def optional(df: DataFrame, name: str, dtype: str) -> Column:
    """The column, or a typed null when the table has none of that name."""
    return F.col(name) if name in df.columns else F.lit(None).cast(dtype).alias(name)


def existing(df: DataFrame, names: list[str]) -> list[str]:
    return [n for n in names if n in df.columns]
