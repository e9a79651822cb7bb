"""Upkeep of the denormalised story table: only the stories that a change reaches are written again.

A refresh reads what was published since the version it last covered. Stories whose own rows changed
(article, validation, assignment, assessment, scope) are joined again, by their keys alone. A changed topic
or outlet does not move the joins of its stories, so their stored rows only take the new names and
counts. Both kinds are appended as one folder of the table and published with the version they cover.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressloom.functions.times import instant
from pressloom.operators.coverage import enriched_headlines
from pressloom.plans.store import TableStore
from pressloom.schemas import TABLE_KEYS
from pressloom.session import materialize

VIEW = "enriched"
#: Tables with one row per story, and those that many stories share.
STORY_TABLES = ("articles", "validation", "assignments", "assessments", "scope")
SHARED_TABLES = ("topics", "sources")

Read = Callable[[str, DataFrame], DataFrame]


def _keys(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.select(F.col(column).alias(name)).where(F.col(name).isNotNull())


def touched_stories(deltas: dict[str, DataFrame]) -> DataFrame | None:
    """Distinct ids of the stories of which a row of their own is among the deltas; None without such a delta."""
    found = [_keys(deltas[name], TABLE_KEYS[name][0], "story_id") for name in STORY_TABLES if name in deltas]
    return reduce(DataFrame.unionAll, found).distinct() if found else None


def joined_again(read: Read, touched: DataFrame, enriched_at) -> DataFrame:
    """Current story rows of the touched stories; one whose article is gone has no row."""
    rows = {name: read(name, _keys(touched, "story_id", TABLE_KEYS[name][0])) for name in STORY_TABLES}
    topics = read("topics", _keys(rows["assignments"], "topic_id", "topic_id").distinct())
    sources = read("sources", _keys(rows["articles"], "source_uri", "uri").distinct())
    return enriched_headlines(rows["articles"], sources, rows["validation"], rows["assignments"], topics,
                              rows["assessments"], rows["scope"], enriched_at, keep=("source_uri",))


def patched(read: Read, view: DataFrame, deltas: dict[str, DataFrame], enriched_at) -> DataFrame:
    """Stored rows whose topic or outlet changed, with its new values; rows that stay as they are are left out.

    A topic or outlet that is among the deltas but has no current row any more leaves NULLs.
    """
    values = {
        "topics": ("topic_id", {"topic_label": "label", "cluster_size": "story_count", "dominant_category": "dominant_category"}),
        "sources": ("source_uri", {"source_name": "title"}),
    }
    rows, differs = view, F.lit(False)
    for name in SHARED_TABLES:
        if name not in deltas:
            continue
        key, columns = values[name]
        stored = TABLE_KEYS[name][0]
        changed = _keys(deltas[name], stored, stored).distinct()
        now = changed.join(read(name, changed), stored, "left").select(
            F.col(stored).alias(key), F.struct(*[F.col(new).alias(old) for old, new in columns.items()]).alias(f"_{name}"))
        rows = rows.join(now, key, "left")
        hit = F.col(f"_{name}").isNotNull()
        for old in columns:
            differs = differs | (hit & ~F.col(old).eqNullSafe(F.col(f"_{name}.{old}")))
    rows = rows.where(differs)
    for name in SHARED_TABLES:
        if name in deltas:
            value = F.col(f"_{name}")
            rows = rows.withColumns({old: F.when(value.isNotNull(), value[old]).otherwise(F.col(old)) for old in values[name][1]})
    return rows.withColumn("enriched_at", instant(enriched_at)).select(*view.columns)


def enriched_changes(read: Read, view: DataFrame, deltas: dict[str, DataFrame], enriched_at) -> DataFrame:
    """Rows to write over the stored ones by ``story_id``; ``deleted`` marks those to take out.

    ``read(name, keys)`` gives the current rows of the keys, ``deltas`` holds at least the keys of the
    rows that changed, per table; tables without a change are left out of it. ``view`` holds the stored rows.
    The touched ids are stored first, so that Spark knows how many there are when it joins them.
    """
    parts = []
    touched = touched_stories(deltas)
    rest = view
    if touched is not None:
        touched = materialize(touched, "touched-stories")
        fresh = joined_again(read, touched, enriched_at)
        parts.append(fresh.withColumn("deleted", F.lit(False)))
        known = read("articles", touched.select(F.col("story_id").alias("uri"))).select(F.col("uri").alias("story_id"))
        gone = view.join(touched, "story_id", "left_semi").join(known, "story_id", "left_anti")
        parts.append(gone.withColumn("deleted", F.lit(True)))
        rest = view.join(touched, "story_id", "left_anti")
    if any(name in deltas for name in SHARED_TABLES):
        parts.append(patched(read, rest, deltas, enriched_at).withColumn("deleted", F.lit(False)))
    if not parts:
        return view.withColumn("deleted", F.lit(False)).limit(0)
    return reduce(lambda a, b: a.unionByName(b), parts)


def refresh_enriched(store: TableStore, as_of) -> int:
    """Bring the story table up to the current version; returns the version it covers now.

    The version is read and published on as by a load, so a load in between makes the refresh fail and it
    can be run again. Without any change nothing is published. The first refresh covers everything.
    """
    store = store.pinned()
    version = store.version()
    covered = store.read("view_log").where(F.col("view") == VIEW).agg(F.max("version")).first()[0] or 0
    deltas = {name: rows for name in (*STORY_TABLES, *SHARED_TABLES) if (rows := store.changes(name, covered)) is not None}
    if not deltas:
        return covered
    changes = enriched_changes(store.read, store.read(VIEW), deltas, as_of)
    log = store.spark.range(1).select(F.lit(VIEW).alias("view"), F.lit(version).cast("bigint").alias("version"), instant(as_of).alias("at"))
    store.publish({VIEW: changes, "view_log": log})
    return version
