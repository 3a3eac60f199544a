"""0/1 indicator expressions that never yield null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def later_than(value: Column, limit: Column) -> Column:
    """1 when value > limit; an unknown side counts as not later."""
    return F.coalesce((value > limit).cast("int"), F.lit(0))


def present(value: Column) -> Column:
    """1 when the value is known."""
    return value.isNotNull().cast("int")


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as a double, null when whole is 0."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def ratio_or_zero(part: Column, whole: Column) -> Column:
    """part / whole as a double, 0 when whole is 0."""
    return F.coalesce(ratio(part, whole), F.lit(0.0))
