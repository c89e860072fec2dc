"""Expressions over a message's cause."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tramline import fixed_values as fv


def severity(cause: Column) -> Column:
    """Severity 1 to 4 of an exact cause name; unknown and NULL causes get the default."""
    levels = [F.when(cause == name, value) for name, value in fv.SEVERITY.items()]
    return F.coalesce(*levels, F.lit(fv.DEFAULT_SEVERITY))


def is_urgent(severity_level: Column, hours: Column) -> Column:
    """1 for a severe message shown for a short time; 0 otherwise or if unknown."""
    urgent = (severity_level >= fv.URGENT_SEVERITY) & (hours <= fv.URGENT_HOURS)
    return F.coalesce(urgent, F.lit(False)).cast("int")
