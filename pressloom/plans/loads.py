"""Artifact loads: scan, check, cast, merge, normalise, measure, publish, report."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom import contracts as C
from pressloom.functions.times import instant
from pressloom.operators import casts, dims, discover, merge, metrics, runs
from pressloom.operators.ranking import sample_uris
from pressloom.plans.store import TableStore
from pressloom.sinks.artifacts import write_row_json
from pressloom.sources.files import scan_articles_jsonl, scan_csv


METRIC_COLUMNS = [*C.METRIC_KEY, "metric_value", "stage_started_at", "stage_completed_at", "created_at"]


def run_of(manifest: dict) -> dict:
    return {k: manifest[k] for k in (*C.RUN_KEY, "collected_at")}


def _log_row(spark: SparkSession, run: dict, at, **fields) -> DataFrame:
    values = {**{k: run[k] for k in C.RUN_KEY}, **fields}
    return spark.range(1).select(
        instant(at).alias("at"),
        *[(instant(v) if k in ("run_id", "window_from", "window_to") else F.lit(v)).alias(k) for k, v in values.items()],
    )


def _empty_log(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], runs.LOG_SCHEMA)


def _small(df: DataFrame) -> DataFrame:
    """A summary of a fixed, small number of rows, computed once and kept as a local table."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


def _loaded(store: TableStore, run: dict) -> bool:
    """One run key is looked up: at most one row."""
    log = casts.by_run(store.read("run_log"), {**run, "run_id": instant(run["run_id"])})
    ledger = runs.fold_run_ledger(log, require_reserved=False)
    return not ledger.where((F.col("status") == "loaded") & F.col("load_completed_at").isNotNull()).isEmpty()


SKIPPED = "skipped_duplicate"


def _staged_articles(spark: SparkSession, run_dir: str, data: str) -> DataFrame:
    if data == "jsonl":
        return scan_articles_jsonl(spark, f"{run_dir}/{C.ARTICLES.name}.jsonl").select(*C.ARTICLES.columns)
    if data != "csv":
        raise ValueError(f"unknown data format {data}")
    return scan_csv(spark, f"{run_dir}/{C.ARTICLES.data_file}", C.ARTICLES)


def _skipped(store: TableStore, run: dict, manifest: dict, run_dir: str, as_of) -> bool:
    """Whether the run is loaded already; then a report of the skip is left in its folder."""
    if not _loaded(store, run):
        return False
    write_row_json(_skip_row(store.spark, manifest, run_dir, as_of), f"{run_dir}/load_report_skipped.json", True)
    return True


def last_in_file_order(staged: DataFrame, key: list[str]) -> DataFrame:
    """The last row per key, by file name and place in the file. A file with line breaks in its
    cells is read by one task, so the row ids of a scan rise along it."""
    placed = staged.withColumns({"_path": F.col("_metadata.file_path"), "_place": F.monotonically_increasing_id()})
    return merge.dedupe_last(placed, key, ["_path", "_place"]).drop("_path", "_place")


def _changes(merged: DataFrame) -> DataFrame:
    return merged.where(F.col("_action").isin(merge.INSERTED, merge.UPDATED))


def _bridge_delta(staged: DataFrame, links: DataFrame, value: str) -> DataFrame:
    """New links of the staged articles, and a NULL link for an article without any."""
    return dims.staged_uris(staged).join(links, "article_uri", "left").select("article_uri", value)


def load_articles(store: TableStore, run_dir: str, manifest: dict, as_of, on_duplicate: str = "error", data: str = "csv") -> str:
    """Load one article artifact; a run that is already loaded is skipped.

    A uri that is staged more than once fails the load, or with ``on_duplicate="last"`` its last
    row in the files counts, for everything that follows. ``data="jsonl"`` reads the JSONL twin
    of the artifact, which can be split, instead of the CSV. Only rows of staged keys are read back from the large tables and only changed rows are
    written. Returns the status.
    """
    spark, run, store = store.spark, run_of(manifest), store.pinned()
    if _skipped(store, run, manifest, run_dir, as_of):
        return SKIPPED
    staged = None
    try:
        staged = _staged_articles(spark, run_dir, data)
        if on_duplicate == "last":
            staged = last_in_file_order(staged, ["uri"])
        staged = staged.persist(StorageLevel.MEMORY_AND_DISK)
        typed = casts.cast_articles(staged, run)
        keys = typed.select("uri")
        merged = merge.upsert_articles(store.read("articles", keys), typed, as_of)
        synced = dims.sync_source_uri(merged, staged, as_of)
        synced = synced.persist(StorageLevel.MEMORY_AND_DISK)
        counts = _small(merge.merge_counts(synced))
        concept_links, category_links = dims.concept_links(staged), dims.category_links(staged)

        def dimension(name: str, best: DataFrame) -> DataFrame:
            old = store.read(name, best)
            return merge.merge_dimension(old, best, as_of=as_of).drop("_action")

        scope = casts.by_run(synced, {**run, "run_id": instant(run["run_id"])})
        measured = _small(metrics.article_load_metrics(scope, concept_links, category_links))
        stamped = metrics.stamp_metrics(measured, "article_load", as_of, as_of, run)
        stamped = stamped.withColumn("created_at", instant(as_of))
        log = _loaded_log(spark, run, as_of, counts.first().asDict())
        store.publish({
            "articles": synced.where(
                F.col("_action").isin(merge.INSERTED, merge.UPDATED) | (F.col("updated_at") == instant(as_of))
            ).drop("_action"),
            "sources": dimension("sources", dims.best_sources(staged)),
            "concepts": dimension("concepts", dims.best_concepts(staged)),
            "categories": dimension("categories", dims.best_categories(staged)),
            "article_concepts": _bridge_delta(staged, concept_links, "concept_uri"),
            "article_categories": _bridge_delta(staged, category_links, "category_uri"),
            "run_metrics": stamped.select(*METRIC_COLUMNS),
            "run_log": log,
        })
        report = metrics.load_report(
            {k: manifest[k] for k in ("artifact_contract_version", *C.RUN_KEY)}, counts,
            metrics.article_diagnostics(staged), sample_uris(staged), measured, as_of, as_of, artifacts_dir=run_dir,
        )
        write_row_json(report, f"{run_dir}/{C.ARTICLES.report_file}", True)
        synced.unpersist()
        return "loaded"
    except Exception as error:
        _publish_failure(store, run, as_of, error)
        raise
    finally:
        if staged is not None:
            staged.unpersist()


def _publish_failure(store: TableStore, run: dict, as_of, error: Exception) -> None:
    """Record the failure in the ledger; nothing else of the load becomes visible. The row follows on
    whatever version is current by now."""
    row = _log_row(store.spark, run, as_of, error_code="loader_error", error_message=str(error))
    TableStore(store.spark, store.root).publish({"run_log": runs.mark_failed(_empty_log(store.spark), row)})


def _loaded_log(spark: SparkSession, run: dict, as_of, counts: dict) -> DataFrame:
    log = runs.mark_load_started(_empty_log(spark), _log_row(spark, run, as_of))
    fields = ("rows_loaded", "db_rows_inserted", "db_rows_updated")
    return runs.mark_loaded(log, _log_row(spark, run, as_of, **{k: counts[k] for k in fields}))


def _skip_row(spark: SparkSession, manifest: dict, run_dir: str, as_of) -> DataFrame:
    values = {k: manifest.get(k) for k in ("artifact_contract_version", *C.RUN_KEY)}
    return spark.range(1).select(
        *[(F.lit(None).cast("string") if v is None else F.lit(v)).alias(k) for k, v in values.items()],
        F.lit(run_dir).alias("artifacts_dir"), instant(as_of).alias("load_completed_at"),
        F.lit("skipped_duplicate").alias("pipeline_status"),
        F.lit("pipeline_run_already_loaded").alias("skip_reason"),
    )


def load_events(store: TableStore, run_dir: str, manifest: dict, as_of, touch_unchanged: bool = False) -> str:
    """Load one event artifact; a run that is already loaded is skipped, and a manifest that
    reports no events has nothing to load."""
    spark = store.spark
    if not manifest.get("events_fetched"):
        return "loaded_zero_events"
    run, store = run_of(manifest), store.pinned()
    if _skipped(store, run, manifest, run_dir, as_of):
        return SKIPPED
    staged = None
    try:
        staged = scan_csv(spark, f"{run_dir}/{C.EVENTS.data_file}", C.EVENTS).persist(StorageLevel.MEMORY_AND_DISK)
        typed = casts.cast_events(staged)
        merged = merge.upsert_events(store.read("events", typed), typed, as_of, touch_unchanged)
        merged = merged.persist(StorageLevel.MEMORY_AND_DISK)
        counts = _small(merge.merge_counts(merged))
        measured = metrics.event_load_metrics(counts)
        stamped = metrics.stamp_metrics(measured, "event_load", as_of, as_of, run).withColumn("created_at", instant(as_of))
        changes = merged if touch_unchanged else _changes(merged)
        store.publish({
            "events": changes.drop("_action"),
            "run_log": _loaded_log(spark, run, as_of, counts.first().asDict()),
            "run_metrics": stamped.select(*METRIC_COLUMNS),
        })
        renamed = counts.withColumnsRenamed({"db_rows_inserted": "events_inserted", "db_rows_updated": "events_updated"})
        report = metrics.load_report(
            {k: manifest[k] for k in ("artifact_contract_version", *C.RUN_KEY)}, renamed,
            metrics.event_diagnostics(staged), sample_uris(staged), measured, as_of, as_of, artifacts_dir=run_dir,
        )
        write_row_json(report, f"{run_dir}/{C.EVENTS.report_file}", True)
        merged.unpersist()
        return "loaded"
    except Exception as error:
        _publish_failure(store, run, as_of, error)
        raise
    finally:
        if staged is not None:
            staged.unpersist()


def load_headlines(store: TableStore, run_dir: str, manifest: dict, as_of) -> dict:
    """Load one headline artifact; returns its status and the merge counts.

    A run that is already loaded is skipped and counts nothing. As for the other artifacts, a
    report is left in the run's folder and a failure is recorded in the ledger.
    """
    spark = store.spark
    key = {**manifest, "run_type": manifest.get("run_type") or "scheduled", "nth_run": manifest.get("nth_run") or 1}
    run, store = run_of(key), store.pinned()
    if _skipped(store, run, key, run_dir, as_of):
        return {"status": SKIPPED}
    staged = None
    try:
        staged = scan_csv(spark, f"{run_dir}/{C.HEADLINES.data_file}", C.HEADLINES).persist(StorageLevel.MEMORY_AND_DISK)
        typed = casts.cast_headlines(staged, {k: key[k] for k in ("ingestion_source", "run_id", "collected_at")})
        merged = merge.upsert_headlines(store.read("headlines", typed), typed, as_of).persist(StorageLevel.MEMORY_AND_DISK)
        counts = _small(merge.merge_counts(merged))
        values = counts.first().asDict()
        store.publish({"headlines": _changes(merged).drop("_action"), "run_log": _loaded_log(spark, run, as_of, values)})
        write_row_json(_headline_report(counts, key, run_dir, as_of), f"{run_dir}/{C.HEADLINES.report_file}", True)
        merged.unpersist()
        return {"status": "loaded", **values}
    except Exception as error:
        _publish_failure(store, run, as_of, error)
        raise
    finally:
        if staged is not None:
            staged.unpersist()


def _headline_report(counts: DataFrame, run: dict, run_dir: str, as_of) -> DataFrame:
    """One row: the run, its merge counts and times."""
    return counts.select(
        *[F.lit(run[k]).alias(k) for k in C.RUN_KEY], "*", F.lit(run_dir).alias("artifacts_dir"),
        instant(as_of).alias("load_started_at"), instant(as_of).alias("load_completed_at"), F.lit("loaded").alias("pipeline_status"))


def collect_events(store: TableStore, parent: dict, as_of, **flags) -> DataFrame:
    """Discover the events of a parent run that need fetching and queue them.

    The four event_collect metrics are filed under the parent run. Fetching itself is
    outside; it reads ``event_requests`` and lands raw payloads.
    """
    store = store.pinned()
    run = {**{k: parent[k] for k in C.RUN_KEY}, "run_id": instant(parent["run_id"])}
    # The run is looked for among all versions by narrow, pushed-down columns; only articles that have
    # been in it are folded to their current rows.
    touched = casts.by_run(store.versions("articles"), run).select("uri")
    articles = store.read("articles", touched)
    found = discover.discover_events(articles, "parent_run", run)
    events = store.read("events", found.select(F.col("event_uri").alias("uri")))
    wanted = discover.freshness_filter(found, events, as_of, **flags)
    measured = metrics.event_collect_metrics(metrics.candidate_articles(articles, run), found, wanted, wanted)
    stamped = metrics.stamp_metrics(measured, "event_collect", as_of, as_of, parent).withColumn("created_at", instant(as_of))
    keyed = wanted.select(*[(instant(parent[k]) if k == "run_id" else F.lit(parent[k])).alias(k) for k in C.RUN_KEY], "event_uri")
    store.publish({
        "event_requests": keyed,
        "run_metrics": stamped.select(*METRIC_COLUMNS),
    })
    return keyed
