"""Date and time expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tramline import fixed_values as fv


def compact_timestamp(text: Column) -> Column:
    """`20240131T235900` as a timestamp; NULL for anything else."""
    return F.try_to_timestamp(text, F.lit(fv.COMPACT_TIMESTAMP))


def day_name(day_number: Column) -> Column:
    """English name of a `dayofweek` number (1 = Sunday); NULL outside 1 to 7."""
    names = F.array(*[F.lit(name) for name in fv.WEEKDAYS])
    return F.get(names, day_number - 1)


def weekday_name(day: Column) -> Column:
    return day_name(F.dayofweek(day))


def hours_between(begin: Column, end: Column) -> Column:
    """Hours from `begin` to `end`, from whole seconds."""
    return (F.unix_timestamp(end) - F.unix_timestamp(begin)) / 3600


def is_weekend(day_number: Column) -> Column:
    return F.coalesce(day_number.isin(*fv.WEEKEND_DAYS), F.lit(False)).cast("int")
