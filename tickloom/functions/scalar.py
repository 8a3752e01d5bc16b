"""Column helpers: clamping, defaults, rounding, dates, formats."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F


def clamp(value: Column, low: float, high: float) -> Column:
    """Limits a value to [low, high]; null and NaN give null (`greatest` alone
    would turn a null into `low`)."""
    return F.when(~is_missing(value), F.least(F.greatest(value, F.lit(low)), F.lit(high)))


def is_missing(value: Column) -> Column:
    """True for null and for NaN."""
    return value.isNull() | F.isnan(value.cast("double"))


def or_default(value: Column, default: float) -> Column:
    """The value, or a default where it is null or NaN."""
    return F.when(is_missing(value), F.lit(default)).otherwise(value)


def iso_date(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM-dd")


def short_date(date: Column) -> Column:
    """Month and day, such as `Jan 05`."""
    return F.date_format(date, "MMM dd")


def add_days(date: Column, days: Column) -> Column:
    """Calendar days later, weekends included."""
    return F.date_add(date, days)


def money(value: Column) -> Column:
    return F.format_string("$%.2f", F.round(value, 2))


def percent_text(value: Column, decimals: int = 2) -> Column:
    return F.format_string(f"%.{decimals}f%%", F.round(value, decimals))


def fixed(value: Column, decimals: int) -> Column:
    return F.format_string(f"%.{decimals}f", F.round(value, decimals))


def thousands(value: Column) -> Column:
    """A whole number with thousands separators."""
    return F.format_number(value, 0)


def confidence_map(probability: Column, classes) -> Column:
    """Class probabilities (ML vector) as a map of class to percent, rounded
    to one decimal."""
    names = F.array(*[F.lit(c) for c in classes])
    return F.map_from_arrays(names, F.transform(vector_to_array(probability), lambda p: F.round(p * 100, 1)))
