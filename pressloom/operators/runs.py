"""Run ledger: an append-only log of run events, folded to one row per run key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressloom.contracts import RUN_KEY, SEED_RUN_ID
from pressloom.operators.merge import backfill_defaults
from pressloom.operators.ranking import number_rows

LOG_COLUMNS = {
    "run_id": "timestamp", "ingestion_source": "string", "run_type": "string", "nth_run": "int", "kind": "string",
    "at": "timestamp", "window_from": "timestamp", "window_to": "timestamp", "articles_fetched": "bigint",
    "articles_deduped": "bigint", "rows_loaded": "bigint", "db_rows_inserted": "bigint", "db_rows_updated": "bigint",
    "error_code": "string", "error_message": "string",
}
LOG_SCHEMA = ", ".join(f"{name} {kind}" for name, kind in LOG_COLUMNS.items())

# Event kind -> status it sets. ``load_started`` sets none.
_STATUS = {
    "started": "started", "restarted": "started", "collected": "collected", "loaded": "loaded",
    "failed": "failed",
}


def log_rows(rows: DataFrame, kind: str, fields: list[str]) -> DataFrame:
    """Rows of (run key, at, fields...) as log events of one kind."""
    given = set(RUN_KEY) | {"at"} | set(fields)
    return rows.select(*[
        (F.lit(kind) if name == "kind" else F.col(name) if name in given else F.lit(None)).cast(type_).alias(name)
        for name, type_ in LOG_COLUMNS.items()
    ])


def next_runs(ledger: DataFrame, requests: DataFrame, order: list[Column]) -> DataFrame:
    """Requests with their ``nth_run``: the ledger's maximum for the run plus their rank.

    Several requests for one run get consecutive numbers in ``order`` (end it with a
    unique column). ``ledger`` needs run_id, ingestion_source, run_type and nth_run.
    """
    by = ["run_id", "ingestion_source", "run_type"]
    used = ledger.groupBy(*by).agg(F.max("nth_run").alias("_used"))
    numbered = number_rows(requests, by, order, "_rank")
    nth = (F.coalesce(F.col("_used"), F.lit(0)) + F.col("_rank")).cast("int")
    return numbered.join(used, by, "left").withColumn("nth_run", nth).drop("_used", "_rank")


def reserve_runs(log: DataFrame, requests: DataFrame, order: list[Column]) -> DataFrame:
    """Append a ``started`` event per request (columns run_id, ingestion_source, run_type,
    at, window_from, window_to)."""
    reserved = next_runs(log.where("kind = 'started'"), requests, order)
    return log.unionByName(log_rows(reserved, "started", ["window_from", "window_to"]))


def restart_run(log: DataFrame, rows: DataFrame) -> DataFrame:
    """Re-start under the same key: window, status and errors are set anew."""
    return log.unionByName(log_rows(rows, "restarted", ["window_from", "window_to"]))


def mark_collected(log: DataFrame, rows: DataFrame) -> DataFrame:
    return log.unionByName(log_rows(rows, "collected", ["articles_fetched", "articles_deduped"]))


def mark_load_started(log: DataFrame, rows: DataFrame) -> DataFrame:
    return log.unionByName(log_rows(rows, "load_started", []))


def mark_loaded(log: DataFrame, rows: DataFrame) -> DataFrame:
    return log.unionByName(log_rows(rows, "loaded", ["rows_loaded", "db_rows_inserted", "db_rows_updated"]))


def mark_failed(log: DataFrame, rows: DataFrame) -> DataFrame:
    return log.unionByName(log_rows(rows, "failed", ["error_code", "error_message"]))


def fold_run_ledger(log: DataFrame, require_reserved: bool = True) -> DataFrame:
    """Current row per run key.

    Each column is the value set by the latest event that sets it; the first load start
    is kept; an error lives until the next status. Events of a key that was never reserved
    change nothing, as an UPDATE without a matching row does. All aggregates combine on
    the map side.
    """
    kind, at = F.col("kind"), F.col("at")
    # At one instant the later stage of a run wins.
    stage = F.array_position(
        F.array(*[F.lit(k) for k in ("started", "restarted", "collected", "load_started", "loaded", "failed")]), kind
    )
    seq = F.struct(at, stage)

    def last(value: Column, *kinds: str) -> Column:
        return F.max_by(value, F.when(kind.isin(*kinds), seq))

    status = F.coalesce(*[F.when(kind == k, F.lit(s)) for k, s in _STATUS.items()])
    begun = kind.isin("started", "restarted")
    folded = log.groupBy(*RUN_KEY).agg(
        last(F.col("window_from"), "started", "restarted").alias("window_from"),
        last(F.col("window_to"), "started", "restarted").alias("window_to"),
        last(at, "collected").alias("collected_at"),
        F.min(F.when(kind == "load_started", at)).alias("load_started_at"),
        last(at, "loaded").alias("load_completed_at"),
        F.coalesce(last(F.col("articles_fetched"), "collected"), F.lit(0)).alias("articles_fetched"),
        F.coalesce(last(F.col("articles_deduped"), "collected"), F.lit(0)).alias("articles_deduped"),
        F.coalesce(last(F.col("rows_loaded"), "loaded"), F.lit(0)).alias("rows_loaded"),
        F.coalesce(last(F.col("db_rows_inserted"), "loaded"), F.lit(0)).alias("db_rows_inserted"),
        F.coalesce(last(F.col("db_rows_updated"), "loaded"), F.lit(0)).alias("db_rows_updated"),
        last(status, *_STATUS).alias("status"),
        last(F.col("error_code"), *_STATUS).alias("error_code"),
        last(F.col("error_message"), *_STATUS).alias("error_message"),
        F.min(at).alias("created_at"),
        F.max(at).alias("updated_at"),
        F.bool_or(begun).alias("_reserved"),
    )
    if require_reserved:
        folded = folded.where("_reserved")
    return folded.drop("_reserved")


def skip_already_loaded(manifests: DataFrame, runs: DataFrame) -> DataFrame:
    """Manifests still to load: their run is not both ``loaded`` and completed."""
    done = runs.where((F.col("status") == "loaded") & F.col("load_completed_at").isNotNull())
    return manifests.join(done.select(*RUN_KEY), RUN_KEY, "left_anti")


def default_run_type(run_id: str = "run_id") -> Column:
    """``seed`` for the sentinel run id, else ``scheduled``."""
    return F.when(F.col(run_id) == F.lit(SEED_RUN_ID).cast("timestamp"), "seed").otherwise("scheduled")


def assign_nth_run(runs: DataFrame, tie: str) -> DataFrame:
    """Number the runs of one (run_id, source, type) by their timestamps, NULLs last;
    an ``nth_run`` that is already set stays."""
    stamps = ["created_at", "collected_at", "load_started_at", "load_completed_at", "updated_at"]
    order = [F.col(c).asc_nulls_last() for c in stamps if c in runs.columns] + [F.col(tie).asc()]
    numbered = number_rows(runs, ["run_id", "ingestion_source", "run_type"], order, "_rn")
    if "nth_run" in runs.columns:
        return numbered.withColumn("nth_run", F.coalesce("nth_run", F.col("_rn").cast("int"))).drop("_rn")
    return numbered.withColumn("nth_run", F.col("_rn").cast("int")).drop("_rn")


PREFERRED_RUN_TYPES = ["seed", "scheduled", "backfill"]


def run_priority(column: str = "run_type") -> Column:
    """Place in the order of preference; unknown types come last."""
    place = F.array_position(F.array(*[F.lit(t) for t in PREFERRED_RUN_TYPES]), F.col(column))
    return F.when(place > 0, place).otherwise(len(PREFERRED_RUN_TYPES) + 1)


def pick_run(runs: DataFrame) -> DataFrame:
    """One run per (run_id, source): seed before scheduled before backfill before others,
    then the smallest ``nth_run``."""
    rank = F.struct(run_priority(), F.col("nth_run"), F.col("run_type"))
    return runs.groupBy("run_id", "ingestion_source").agg(
        F.min_by(F.struct("run_type", "nth_run"), rank).alias("_w")
    ).select("run_id", "ingestion_source", "_w.*")


def backfill_run_lineage(articles: DataFrame, runs: DataFrame) -> DataFrame:
    """Fill missing run_type/nth_run from the run picked for (run_id, source), then by
    default. A row that lacks either takes both from the run."""
    picked = pick_run(runs).select(
        "run_id", "ingestion_source", F.col("run_type").alias("_type"), F.col("nth_run").alias("_nth")
    )
    # One row per (run_id, source); a hot run is handled by the broadcast of this small
    # side, or by the skew join of adaptive execution where it is too large for that.
    hit = F.col("_type").isNotNull() & (F.col("run_type").isNull() | F.col("nth_run").isNull())
    joined = articles.join(picked, ["run_id", "ingestion_source"], "left")
    filled = joined.withColumns({
        "run_type": F.when(hit, F.col("_type")).otherwise(F.col("run_type")),
        "nth_run": F.when(hit, F.col("_nth")).otherwise(F.col("nth_run")),
    })
    return backfill_defaults(filled, {"run_type": default_run_type(), "nth_run": F.lit(1)}).select(*articles.columns)
