"""Date and time expressions. Instants are UTC; a zone is always an argument."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom.functions.text import _c


def instant(value) -> Column:
    """Timestamp column of a column, a literal timestamp text or a datetime."""
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp")


def hours(n) -> Column:
    return F.make_dt_interval(F.lit(0), n if isinstance(n, Column) else F.lit(n))


def days(n) -> Column:
    return F.make_dt_interval(n if isinstance(n, Column) else F.lit(n))


def parse_instant(value: Column | str) -> Column:
    """ISO text to timestamp; text that is no instant gives NULL."""
    return F.try_to_timestamp(_c(value))


def iso_text(value: Column | str) -> Column:
    return F.date_format(_c(value), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def day_start(value: Column, tz: str = "UTC") -> Column:
    """Instant at which the local day of ``value`` began."""
    return F.to_utc_timestamp(F.date_trunc("day", F.from_utc_timestamp(value, tz)), tz)


def cycle_floor(value: Column, cycle_hours: int) -> Column:
    """Last completed UTC cycle boundary (cycles restart at midnight)."""
    midnight = F.date_trunc("day", value)
    done = F.floor(F.hour(value) / F.lit(cycle_hours)).cast("int")
    return midnight + hours(done * F.lit(cycle_hours))


def run_window(
    as_of,
    cycle_hours: int = 24,
    lookback_days: int = 2,
    days_ago: int = 0,
    tz: str = "UTC",
    local_date=None,
) -> Column:
    """Struct ``run_id, window_from, window_to`` of the run that ``as_of`` belongs to.

    An explicit local date is one day; a 4 or 6 hour cycle looks back two cycles; the
    daily cycle ends at local midnight and looks back ``lookback_days``.
    """
    if local_date is not None:
        day = local_date if isinstance(local_date, Column) else F.lit(local_date)
        start = day.cast("date").cast("timestamp")
        begin = F.to_utc_timestamp(start, tz)
        end = F.to_utc_timestamp(start + days(1), tz)
    elif cycle_hours < 24:
        end = cycle_floor(instant(as_of), cycle_hours)
        begin = end - hours(2 * cycle_hours)
    else:
        end = day_start(instant(as_of), tz) - days(days_ago)
        begin = end - days(lookback_days)
    return F.struct(end.alias("run_id"), begin.alias("window_from"), end.alias("window_to"))


def day_windows(spark: SparkSession, start: str, end: str, tz: str = "UTC") -> DataFrame:
    """One row per local day from ``start`` to ``end`` inclusive with its UTC window."""
    listed = spark.range(1).select(
        F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("local_date")
    )
    w = run_window(None, tz=tz, local_date=F.col("local_date"))
    return listed.select(
        "local_date", w["window_from"].alias("window_from"), w["window_to"].alias("window_to")
    )
