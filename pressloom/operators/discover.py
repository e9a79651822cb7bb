"""Which events to fetch: discovery scopes and freshness."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressloom import contracts as C
from pressloom.functions.times import hours, instant
from pressloom.operators.casts import by_run


def discover_events(articles: DataFrame, scope: str = "parent_run", run: dict | None = None,
                    time_column: str = "ingested_at", start=None, end=None,
                    cap: int | None = None, sources: list[str] | None = None) -> DataFrame:
    """Distinct filled event uris of a run, a time window or the whole corpus.

    All are returned. ``cap`` is a limit a caller may want on requests; the smallest uris are
    taken so that it is repeatable.
    ``sources`` is an opt-in filter; the scopes themselves never filter by source.
    """
    if scope not in C.DISCOVERY_SCOPES:
        raise ValueError(f"unknown scope {scope}")
    rows = articles
    if scope == "parent_run":
        if run is None:
            raise ValueError("parent_run scope needs a run")
        rows = by_run(rows, run)
    elif scope == "time_window":
        if time_column not in C.DISCOVERY_TIME_COLUMNS:
            raise ValueError(f"unknown time column {time_column}")
        if start is None or end is None:
            raise ValueError("time_window scope needs start and end")
        ts = F.col(time_column)
        rows = rows.where((ts >= instant(start)) & (ts < instant(end)))
    if sources is not None:
        rows = rows.where(F.col("source_uri").isin(sources))
    found = rows.select("event_uri").where((F.col("event_uri") != "") & F.col("event_uri").isNotNull()).distinct()
    return found if cap is None else found.orderBy("event_uri").limit(cap)


def freshness_filter(candidates: DataFrame, events: DataFrame, as_of, only_missing: bool = False,
                     include_stale: bool = True, stale_after_hours: int = C.STALE_AFTER_HOURS) -> DataFrame:
    """Candidates to fetch. Unknown events always; with ``include_stale`` also those last
    collected more than the given hours ago; with neither flag all of them."""
    known = events.select(F.col("uri").alias("event_uri"), "last_collected_at", F.lit(True).alias("_known"))
    keep = F.col("_known").isNull()
    if include_stale:
        old = F.col("last_collected_at") < instant(as_of) - hours(stale_after_hours)
        keep = keep | F.coalesce(old, F.lit(False))
    elif not only_missing:
        keep = F.lit(True)
    return candidates.join(known, "event_uri", "left").where(keep).select("event_uri")


def stale_events(events: DataFrame, as_of, stale_after_hours: int = C.STALE_AFTER_HOURS) -> DataFrame:
    return events.where(F.col("last_collected_at") < instant(as_of) - hours(stale_after_hours))


def without(requested: DataFrame, found: DataFrame, uri: str = "uri") -> DataFrame:
    """Rows whose uri was not found."""
    return requested.join(found.select(uri).distinct(), uri, "left_anti")


def missing_uris(requested: DataFrame, found: DataFrame, uri: str = "uri") -> DataFrame:
    """Requested uris that were not found, in request order (``position``)."""
    return without(requested, found, uri).orderBy("position")


def fetch_batches(selected: DataFrame, numbered: DataFrame | None = None, size: int = C.EVENT_BATCH_SIZE) -> DataFrame:
    """Request batches of at most ``size`` uris, as arrays, one per row."""
    from pressloom.operators.ranking import worklist

    rows = numbered if numbered is not None else worklist(selected, "event_uri")
    return (
        rows.withColumn("batch", F.floor((F.col("rn") - 1) / size).cast("bigint"))
        .groupBy("batch").agg(F.sort_array(F.collect_list("event_uri")).alias("event_uris"))
    )
