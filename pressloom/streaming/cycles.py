"""Collection cycles over event time, for batch and streaming DataFrames."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressloom.functions.times import hours


def assign_cycles(df: DataFrame, ts: str, cycle_hours: int, lookback_hours: int, offset_hours: int = 0,
                  out: str = "run_id") -> DataFrame:
    """Each row once per run whose ``[to - lookback, to)`` covers it; undated rows drop out.

    ``offset_hours`` shifts the grid: 10 puts daily windows on Honolulu midnight.
    """
    w = F.window(F.col(ts), f"{lookback_hours} hours", f"{cycle_hours} hours", f"{offset_hours} hours")
    return df.withColumn("_w", w).withColumns({
        "window_from": F.col("_w.start"), "window_to": F.col("_w.end"), out: F.col("_w.end"),
    }).drop("_w")


def own_cycle(ts: str, cycle_hours: int, offset_hours: int = 0) -> Column:
    """End of the cycle a row belongs to by its own time, on the grid of ``assign_cycles``."""
    seconds, shift = cycle_hours * 3600, offset_hours * 3600
    return F.timestamp_seconds((F.floor((F.unix_seconds(F.col(ts)) - shift) / seconds) + 1) * seconds + shift)


def late_articles(sightings: DataFrame, ts: str, seen_at: str, cycle_hours: int, lookback_hours: int,
                  key: str = "uri", offset_hours: int = 0) -> DataFrame:
    """Rows first caught by a later run than their own cycle, with their delay in cycles.

    The first run is the first cycle boundary after the row became visible; a row that
    became visible after its last covering run was missed altogether.
    """
    per_key = sightings.groupBy(key).agg(F.min(ts).alias(ts), F.min(seen_at).alias(seen_at))
    return _lateness(per_key, ts, seen_at, cycle_hours, lookback_hours, offset_hours)


def _lateness(per_key: DataFrame, ts: str, seen_at: str, cycle_hours: int, lookback_hours: int, offset_hours: int) -> DataFrame:
    own, first = (own_cycle(c, cycle_hours, offset_hours) for c in (ts, seen_at))
    first = F.greatest(own, first)
    late = (F.unix_seconds(first) - F.unix_seconds(own)) / F.lit(cycle_hours * 3600)
    caught = F.col(ts) >= first - hours(lookback_hours)
    return per_key.withColumns({
        "own_run": own, "first_run": first, "cycles_late": late.cast("bigint"), "caught": caught,
    }).where("cycles_late > 0")


def late_sightings(stream: DataFrame, ts: str, seen_at: str, cycle_hours: int, lookback_hours: int,
                   delay: str, key: str = "uri", offset_hours: int = 0) -> DataFrame:
    """``late_articles`` of a stream: a row per key once no run looks back to its sightings any more.

    Sightings of a key that follow on one another within the lookback are one session, of which
    the first counts. Its state goes when the watermark (the newest sighting less ``delay``) has
    passed its last sighting by the lookback, so only keys of that time are held. Sightings that come later
    than ``delay`` are not counted. Append mode.
    """
    sessions = F.session_window(seen_at, f"{lookback_hours} hours")
    first = stream.withWatermark(seen_at, delay).groupBy(key, sessions.alias("_s")).agg(F.min(ts).alias(ts), F.min(seen_at).alias("_seen"))
    return _lateness(first.select(key, ts, F.col("_seen").alias(seen_at)), ts, seen_at, cycle_hours, lookback_hours, offset_hours)


def latest_of_batch(key: str, ts: str) -> Callable[[DataFrame], DataFrame]:
    """Batch step for ``foreachBatch``: latest time per key of the batch. The written batches are folded by
    their maximum, so the stream itself holds no state."""
    return lambda batch: batch.groupBy(key).agg(F.max(ts).alias("last_collected_at"))


def stale_alerts(stream: DataFrame, key: str, ts: str, stale_after_hours: int, delay: str) -> DataFrame:
    """(key, last_collected_at, stale_at): a row when a key has not been collected for the given hours.

    Collections that follow on one another within these hours are one session window; when the
    watermark (the newest collection of any key less ``delay``) has passed its end, the key is stale
    and its state goes. So state is held for keys of the stale window only, however many
    keys there ever were. A key that is collected again and goes stale again is reported again;
    collections that come later than ``delay`` are not counted. Append mode.
    """
    sessions = F.session_window(ts, f"{stale_after_hours} hours")
    seen = stream.withWatermark(ts, delay).groupBy(key, sessions.alias("_s")).agg(F.max(ts).alias("last_collected_at"))
    return seen.select(key, "last_collected_at", F.col("_s.end").alias("stale_at"))
