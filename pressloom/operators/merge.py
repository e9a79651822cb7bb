"""Merges: upserts with change detection, dimension merges, link replacement.

Shape of every merge: ``target LEFT JOIN incoming`` gives the rows that stay or change,
and an anti join of the incoming rows against the target's *matching* keys gives the
inserts. With a small batch both joins can broadcast the batch, so the target is read
but never shuffled; a batch beyond the broadcast threshold becomes a sort-merge join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressloom.contracts import ARTICLE_TRACKED, EVENT_TRACKED, HEADLINE_TRACKED, METRIC_KEY
from pressloom.functions.times import instant
from pressloom.session import materialize

INSERTED, UPDATED, UNCHANGED, KEPT = "inserted", "updated", "unchanged", "kept"


def changed(cols: list[str], old: str = "t", new: str = "s") -> Column:
    """True when any column differs, NULLs being comparable values."""
    tests = [~F.col(f"{old}.{c}").eqNullSafe(F.col(f"{new}.{c}")) for c in cols]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def require_unique(df: DataFrame, key: list[str]) -> DataFrame:
    """The same rows; the job fails when two of them share a key.

    The check reads only the key columns and counts with map-side combine, so one key
    that holds most of the rows cannot overload a task.
    """
    worst = df.groupBy(*key).count().agg(F.max("count"))
    message = f"duplicate staged key ({', '.join(key)})"
    ok = F.when(worst.scalar() > 1, F.raise_error(F.lit(message)).cast("boolean")).otherwise(F.lit(True))
    return df.where(ok)


def dedupe_last(df: DataFrame, key: list[str], order: list[str], place: list[str] | None = None) -> DataFrame:
    """Last write per key in ``order`` (end it with a unique column).

    ``place`` names columns that tell every row of ``df`` apart, such as the file and the row of a scan. With them
    wide rows stay where they are: keys, order and places alone are compared, and the rows that lose, of
    keys written more than once, are taken out by an anti join. Their places are stored first, so that Spark
    knows their size and broadcasts them if they are few. Rows that tie in ``order`` go by their place.
    """
    if place is None:
        return _one_per_key(df, key, order, F.max_by)
    rank = F.struct(*order, *[p for p in place if p not in order])
    narrow = df.select(*dict.fromkeys([*key, *order, *place]))
    best = narrow.groupBy(*key).agg(F.max(rank).alias("_best"), F.count("*").alias("_n")).where("_n > 1")
    same = reduce(lambda a, b: a & b, [F.col(f"r.{k}").eqNullSafe(F.col(f"b.{k}")) for k in key])
    lost = narrow.withColumn("_rank", rank).alias("r").join(best.alias("b"), same).where(~F.col("_rank").eqNullSafe(F.col("_best")))
    gone = materialize(lost.select(*[F.col(f"r.{p}") for p in place]), "replaced-rows")
    return df.join(gone, place, "left_anti").select(*df.columns)


def dedupe_first(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    return _one_per_key(df, key, order, F.min_by)


def _one_per_key(df: DataFrame, key: list[str], order: list[str], pick) -> DataFrame:
    winner = pick(F.struct(*df.columns), F.struct(*order)).alias("_w")
    return df.groupBy(*key).agg(winner).select("_w.*")


def _join_on(key: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in key])


def merge_rows(target: DataFrame, incoming: DataFrame, key: list[str], matched: dict[str, Column],
               inserted: dict[str, Column], action: Column) -> DataFrame:
    """Generic merge. ``matched`` gives new values of target columns for rows with a
    partner, ``inserted`` values of new rows; other columns stay, or are taken from the
    incoming row of the same name, or are NULL.

    Expressions see the old row as ``t``, the incoming one as ``s`` and the row's action as
    ``_action``, which is a column of its own so that it is computed once per row.
    """
    hit = F.col("s._hit").isNotNull()
    joined = target.alias("t").join(incoming.withColumn("_hit", F.lit(True)).alias("s"), _join_on(key), "left")
    decided = joined.withColumn("_action", F.when(hit, action).otherwise(F.lit(KEPT)))
    partner = F.col("_action") != KEPT
    stay = decided.select(
        *[
            (F.when(partner, matched[c]).otherwise(F.col(f"t.{c}")) if c in matched else F.col(f"t.{c}")).alias(c)
            for c in target.columns
        ],
        "_action",
    )
    known = target.select(*key).join(incoming.select(*key), key, "left_semi")
    fresh = incoming.join(known, key, "left_anti")

    def value(c: str) -> Column:
        if c in inserted:
            return inserted[c]
        return F.col(c) if c in incoming.columns else F.lit(None)

    types = dict(target.dtypes)
    new = fresh.select(*[value(c).cast(types[c]).alias(c) for c in target.columns], F.lit(INSERTED).alias("_action"))
    return stay.unionByName(new)


def merge_changed(target: DataFrame, staged: DataFrame, key: list[str], tracked: list[str], *,
                  on_insert: dict[str, Column] | None = None, on_change: dict[str, Column] | None = None,
                  touch_unchanged: dict[str, Column] | None = None, on_duplicate: str = "error",
                  order: list[str] | None = None) -> DataFrame:
    """Insert new keys, update rows of which a tracked column differs, leave the rest.

    Adds ``_action``: inserted, updated, unchanged (staged but equal) or kept (not staged).
    ``on_insert``/``on_change`` set audit columns, ``touch_unchanged`` sets columns even when
    nothing changed. Duplicate staged keys fail, or the last in ``order`` wins.
    """
    if on_duplicate == "last":
        if not order:
            raise ValueError("on_duplicate='last' needs an order that tells the rows of a key apart")
        staged = dedupe_last(staged, key, order)
    elif on_duplicate == "error":
        staged = require_unique(staged, key)
    else:
        raise ValueError(f"unknown on_duplicate {on_duplicate}")
    differs = F.col("_action") == UPDATED
    matched = {c: F.when(differs, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")) for c in tracked}
    for c, v in (on_change or {}).items():
        matched[c] = F.when(differs, v).otherwise(F.col(f"t.{c}"))
    for c, v in (touch_unchanged or {}).items():
        matched[c] = v
    action = F.when(changed(tracked), F.lit(UPDATED)).otherwise(F.lit(UNCHANGED))
    return merge_rows(target, staged, key, matched, on_insert or {}, action)


def upsert_articles(target: DataFrame, staged: DataFrame, as_of, **options) -> DataFrame:
    """Lineage is part of change detection: re-collected articles count as updated."""
    now = instant(as_of)
    return merge_changed(
        target, staged, ["uri"], ARTICLE_TRACKED,
        on_insert={"ingested_at": now, "created_at": now, "updated_at": now},
        on_change={"updated_at": now}, **options,
    )


def upsert_events(target: DataFrame, staged: DataFrame, as_of, touch_unchanged: bool = False, **options) -> DataFrame:
    """``last_collected_at`` moves when the payload changed; with ``touch_unchanged`` always."""
    now = instant(as_of)
    return merge_changed(
        target, staged, ["uri"], EVENT_TRACKED,
        on_insert={c: now for c in ("first_collected_at", "last_collected_at", "created_at", "updated_at")},
        on_change={"last_collected_at": now, "updated_at": now},
        touch_unchanged={"last_collected_at": now} if touch_unchanged else None, **options,
    )


def upsert_headlines(target: DataFrame, staged: DataFrame, as_of, **options) -> DataFrame:
    now = instant(as_of)
    return merge_changed(
        target, staged, ["url"], HEADLINE_TRACKED,
        on_insert={"ingested_at": now, "created_at": now, "updated_at": now},
        on_change={"updated_at": now}, **options,
    )


def merge_counts(merged: DataFrame) -> DataFrame:
    """Attempted, loaded, inserted, updated, unchanged of a merge, in one pass."""
    act = F.col("_action")
    return merged.agg(
        F.count_if(act != KEPT).alias("rows_attempted"),
        F.count_if(act.isin(INSERTED, UPDATED)).alias("rows_loaded"),
        F.count_if(act == INSERTED).alias("db_rows_inserted"),
        F.count_if(act == UPDATED).alias("db_rows_updated"),
        F.count_if(act == UNCHANGED).alias("db_rows_unchanged"),
    )


def insert_if_absent(target: DataFrame, rows: DataFrame, key: list[str]) -> DataFrame:
    """Add rows of unknown key; of several such rows with one key any one is kept
    (here: the smallest), and the target's own rows never change."""
    known = target.select(*key).join(rows.select(*key), key, "left_semi")
    fresh = rows.join(known, key, "left_anti")
    first = dedupe_first(fresh, key, fresh.columns)
    return target.unionByName(first, allowMissingColumns=True)


def merge_dimension(target: DataFrame, best: DataFrame, key: str = "uri", as_of=None) -> DataFrame:
    """COALESCE(new, old) per column; every matched row is touched."""
    columns = [c for c in best.columns if c != key]
    matched = {c: F.coalesce(F.col(f"s.{c}"), F.col(f"t.{c}")) for c in columns}
    audit = {}
    if as_of is not None:
        matched["updated_at"] = instant(as_of)
        audit = {"created_at": instant(as_of), "updated_at": instant(as_of)}
    return merge_rows(target, best, [key], matched, audit, F.lit(UPDATED))


def seed_outlets(target: DataFrame, seed: DataFrame, as_of, key: str = "id") -> DataFrame:
    """Unconditional overwrite by id; columns the seed lacks stay, every hit is touched."""
    now = instant(as_of)
    matched = {c: F.col(f"s.{c}") for c in seed.columns if c != key}
    matched["updated_at"] = now
    return merge_rows(target, require_unique(seed, [key]), [key], matched,
                      {"created_at": now, "updated_at": now, "active": F.lit(True)}, F.lit(UPDATED))


def sync_outlets(target: DataFrame, sheet: DataFrame, as_of, key: str = "id") -> DataFrame:
    """Rows absent from the source of truth become inactive, present ones active."""
    present = sheet.select(key).distinct().withColumn("_present", F.lit(True))
    active = F.col("_present").isNotNull()
    return (
        target.join(present, key, "left")
        .withColumn("updated_at", F.when(active != F.col("active"), instant(as_of)).otherwise(F.col("updated_at")))
        .withColumn("active", active)
        .select(*target.columns)
    )


def replace_links(bridge: DataFrame, staged_uris: DataFrame, links: DataFrame, key: str = "article_uri") -> DataFrame:
    """Drop all links of the staged articles, then add their new distinct links; an
    article whose new list is empty ends with none."""
    kept = links_to_keep(bridge, staged_uris, key)
    return kept.unionByName(links.select(*bridge.columns).distinct())


def links_to_replace(bridge: DataFrame, staged_uris: DataFrame, key: str = "article_uri") -> DataFrame:
    return bridge.join(staged_uris.select(key).distinct(), key, "left_semi")


def links_to_keep(bridge: DataFrame, staged_uris: DataFrame, key: str = "article_uri") -> DataFrame:
    return bridge.join(staged_uris.select(key).distinct(), key, "left_anti")


def merge_metrics(target: DataFrame, rows: DataFrame, as_of) -> DataFrame:
    """Upsert by run key, stage and name; value and stage times replaced, created_at kept."""
    replaced = ["metric_value", "stage_started_at", "stage_completed_at"]
    return merge_rows(
        target, require_unique(rows, METRIC_KEY), METRIC_KEY, {c: F.col(f"s.{c}") for c in replaced},
        {"created_at": instant(as_of)}, F.lit(UPDATED),
    )


def touch_updated_at(df: DataFrame, changed_rows: Column, as_of) -> DataFrame:
    """What the update trigger does: ``updated_at`` follows every changed row."""
    return df.withColumn("updated_at", F.when(changed_rows, instant(as_of)).otherwise(F.col("updated_at")))


def backfill_defaults(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Fill NULLs of each column by its rule; filled values never change."""
    return df.withColumns({c: F.coalesce(F.col(c), rule) for c, rule in rules.items()})


def rollback_runs(df: DataFrame, run_type: str, start, end, time_column: str = "date_time_published",
                  sources: list[str] | None = None) -> DataFrame:
    """Delete rows of one run type in ``[start, end)``, optionally only of some sources."""
    ts = F.col(time_column)
    doomed = (F.col("run_type") == run_type) & (ts >= instant(start)) & (ts < instant(end))
    if sources is not None:
        doomed = doomed & F.col("source_uri").isin(sources)
    return df.where(~F.coalesce(doomed, F.lit(False)))


def add_columns_default(df: DataFrame, spec: dict[str, Column]) -> DataFrame:
    """Add the missing columns with their default; existing columns stay as they are."""
    return df.withColumns({c: v for c, v in spec.items() if c not in df.columns})
