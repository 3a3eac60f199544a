"""Time arithmetic on zone-less timestamps.

Every expression works on TIMESTAMP_NTZ values directly, so results do not
depend on the session time zone (``timestampdiff`` does, around DST changes).
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86400.0


def ts_or_null(text: Column) -> Column:
    """The timestamp a text says; text that is no timestamp becomes null."""
    return text.try_cast("timestamp_ntz")


def coerce_ts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Parse timestamps; text that is no timestamp becomes null."""
    return df.withColumns({c: ts_or_null(F.col(c)) for c in columns})


def strict_ts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Parse timestamps; text that is no timestamp fails the job."""

    def parse(name: str) -> Column:
        problem = F.concat(F.lit(f"{name}: not a timestamp: "), F.col(name).cast("string"))
        parsed = F.col(name).try_cast("timestamp_ntz")
        return F.when(parsed.isNull() & F.col(name).isNotNull(), F.raise_error(problem)).otherwise(parsed)

    return df.withColumns({c: parse(c) for c in columns})


def ts_literal(value: datetime | None) -> Column:
    """A zone-less timestamp constant."""
    return F.lit(None if value is None else value.isoformat(" ")).cast("timestamp_ntz")


def elapsed_days(start: Column, end: Column) -> Column:
    """Days from start to end with their fraction, to the microsecond."""
    seconds = (end - start).cast("decimal(18,6)")
    return seconds.cast("double") / F.lit(SECONDS_PER_DAY)


def whole_days(start: Column, end: Column) -> Column:
    """Elapsed 24-hour periods, rounded down (two hours back is day -1).

    The calendar distance is right except when the clock time of ``end`` is
    earlier than that of ``start``; then the last period is incomplete.
    """
    calendar = F.datediff(end.cast("date"), start.cast("date"))
    incomplete = end < start + F.make_dt_interval(calendar)
    return calendar - incomplete.cast("int")


def within_days(days: Column, horizon: int) -> Column:
    """1 when the day count lies in 0..horizon, else 0 (also for null)."""
    return F.coalesce(days.between(0, horizon).cast("int"), F.lit(0))
