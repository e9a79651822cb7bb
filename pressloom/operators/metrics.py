"""Run metrics, artifact diagnostics and load reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressloom.contracts import ARTICLE_JSON_COLUMNS, EVENT_JSON_COLUMNS, RUN_KEY
from pressloom.functions.text import blank_to_null, is_populated
from pressloom.functions.times import instant
from pressloom.operators.casts import by_run


def _long(wide: DataFrame, keep: list[str], names: list[str]) -> DataFrame:
    """Metric columns to (metric_name, metric_value) rows."""
    pairs = F.array(*[
        F.struct(F.lit(n).alias("metric_name"), F.col(n).cast("bigint").alias("metric_value")) for n in names
    ])
    return wide.select(*keep, F.explode(pairs).alias("_m")).select(*keep, "_m.*")


def union_metrics(*parts: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def run_links(bridge: DataFrame, articles: DataFrame, run: dict) -> DataFrame:
    """Links of one run's articles."""
    scope = by_run(articles, run).select(F.col("uri").alias("article_uri"))
    return bridge.join(scope, "article_uri", "inner")


def article_load_metrics(articles: DataFrame, concept_links: DataFrame, category_links: DataFrame,
                         by: list[str] | None = None) -> DataFrame:
    """The seven article_load metrics, for all runs at once when ``by`` is the run key.

    One aggregate per input table; distinct counts are by a first de-duplicating
    aggregate, so a run that holds most rows is still spread over all tasks.
    """
    by = by or []
    own = articles.groupBy(*by).agg(
        F.count("*").alias("articles_upserted"),
        F.count("source_uri").alias("articles_with_source_uri"),
        F.count_distinct("source_uri").alias("distinct_sources_in_articles"),
    )
    scope = articles.select(*by, F.col("uri").alias("article_uri"))

    def links(bridge: DataFrame, column: str, total: str, distinct: str) -> DataFrame:
        joined = bridge.join(scope, "article_uri", "inner")
        per_value = joined.groupBy(*by, column).agg(F.count("*").alias("_n"))
        return per_value.groupBy(*by).agg(F.sum("_n").alias(total), F.count(column).alias(distinct))

    names = ["articles_upserted", "articles_with_source_uri", "distinct_sources_in_articles"]
    parts = [_long(own, by, names)]
    for bridge, column, total, distinct in (
        (concept_links, "concept_uri", "article_concept_links", "distinct_concepts_linked"),
        (category_links, "category_uri", "article_category_links", "distinct_categories_linked"),
    ):
        found = links(bridge, column, total, distinct)
        if by:
            found = articles.select(*by).distinct().join(found, by, "left")
        counts = found.select(*by, *[F.coalesce(F.col(n), F.lit(0)).alias(n) for n in (total, distinct)])
        parts.append(_long(counts, by, [total, distinct]))
    return union_metrics(*parts)


def stamp_metrics(metrics: DataFrame, stage: str, started_at, completed_at, run: dict | None = None) -> DataFrame:
    """Add stage, stage times and (for one run) the run key."""
    out = metrics
    for k, v in (run or {}).items():
        if k in RUN_KEY:
            out = out.withColumn(k, F.lit(v).cast("timestamp") if k == "run_id" else F.lit(v))
    return out.withColumns({
        "stage": F.lit(stage),
        "stage_started_at": instant(started_at),
        "stage_completed_at": instant(completed_at),
    })


def artifact_counts(staged: DataFrame, key: str = "uri") -> DataFrame:
    return staged.agg(
        F.count("*").alias("rows_in_artifact"),
        F.count_if(blank_to_null(key).isNotNull()).alias("rows_attempted"),
    )


def _populated(cols: list[str]) -> list[Column]:
    return [F.count_if(is_populated(c)).alias(f"{c}_count") for c in cols]


def article_diagnostics(staged: DataFrame) -> DataFrame:
    ts = blank_to_null("date_time_published").cast("timestamp")
    return staged.agg(
        F.count("*").alias("rows_in_artifact"),
        F.min(ts).alias("min_date_time_published"),
        F.max(ts).alias("max_date_time_published"),
        *_populated(ARTICLE_JSON_COLUMNS),
    )


def event_diagnostics(staged: DataFrame) -> DataFrame:
    day = blank_to_null("event_date").cast("date")
    return staged.agg(
        F.count("*").alias("rows_in_artifact"),
        F.min(day).alias("min_event_date"),
        F.max(day).alias("max_event_date"),
        *_populated(EVENT_JSON_COLUMNS),
    )


def event_collect_metrics(candidates: DataFrame, discovered: DataFrame, selected: DataFrame,
                          fetched: DataFrame) -> DataFrame:
    """Four metrics of one discovery; each input is counted where it lies."""
    named = [
        ("candidate_articles_scanned", candidates.agg(F.max("candidate_articles_scanned").alias("n"))),
        ("distinct_event_uris_discovered", discovered.agg(F.count("*").alias("n"))),
        ("distinct_event_uris_selected", selected.agg(F.count("*").alias("n"))),
        ("events_fetched", fetched.agg(F.count("*").alias("n"))),
    ]
    return union_metrics(*[
        df.select(F.lit(name).alias("metric_name"), F.col("n").cast("bigint").alias("metric_value"))
        for name, df in named
    ])


def event_load_metrics(counts: DataFrame) -> DataFrame:
    renamed = counts.select(
        F.col("rows_loaded").alias("events_upserted"), F.col("db_rows_inserted").alias("events_inserted"),
        F.col("db_rows_updated").alias("events_updated"),
    )
    return _long(renamed, [], renamed.columns)


def candidate_articles(articles: DataFrame, run: dict | None = None, time_column: str | None = None,
                       start=None, end=None) -> DataFrame:
    """Articles a discovery looks at: of one run, of a time window, or all."""
    if run is not None:
        rows = by_run(articles, run)
    elif time_column is not None:
        ts = F.col(time_column)
        rows = articles.where((ts >= instant(start)) & (ts < instant(end)))
    else:
        rows = articles
    return rows.agg(F.count("*").alias("candidate_articles_scanned"))


def stage_durations(metrics: DataFrame) -> DataFrame:
    """Elapsed seconds per run and stage."""
    start, end = F.min("stage_started_at"), F.max("stage_completed_at")
    seconds = F.unix_micros(end) - F.unix_micros(start)
    return metrics.groupBy(*RUN_KEY, "stage").agg(
        start.alias("started_at"), end.alias("completed_at"), (seconds / F.lit(1e6)).alias("seconds")
    )


def runs_with_metrics(runs: DataFrame, metrics: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Run rows with their metrics, long, or one column per name when ``names`` is given."""
    if names is None:
        return runs.join(metrics, RUN_KEY, "left")
    wide = metrics.groupBy(*RUN_KEY).agg(
        *[F.max(F.when(F.col("metric_name") == n, F.col("metric_value"))).alias(n) for n in names]
    )
    return runs.join(wide, RUN_KEY, "left")


def load_report(run: dict, counts: DataFrame, diagnostics: DataFrame, samples: DataFrame, metrics: DataFrame,
                started_at, completed_at, **fields) -> DataFrame:
    """One-row outcome of a load; every input is a one-row or few-row summary."""
    populated = [c for c in diagnostics.columns if c.endswith("_count")]
    extent = [c for c in diagnostics.columns if c not in populated and c != "rows_in_artifact"]
    facts = diagnostics.select(
        "rows_in_artifact", *extent,
        F.struct(*[F.col(c).alias(c.removesuffix("_count")) for c in populated]).alias("populated_counts"),
    )
    listed = samples.agg(F.sort_array(F.collect_list(samples.columns[0])).alias("sample_uris"))
    named = metrics.select("metric_name", "metric_value")
    measured = named.agg(
        F.sort_array(F.collect_list(F.struct("metric_name", "metric_value"))).alias("pipeline_run_metrics")
    )
    start, end = instant(started_at), instant(completed_at)
    one = F.lit(1).alias("_one")
    row = facts.select("*", one)
    for part in (counts, listed, measured):
        extra = [c for c in part.columns if c not in row.columns]
        row = row.join(part.select(*extra, one), "_one")
    return row.drop("_one").select(
        *[F.lit(v).alias(k) for k, v in {**run, **fields}.items()],
        "*",
        start.alias("load_started_at"), end.alias("load_completed_at"),
        (F.unix_millis(end) - F.unix_millis(start)).alias("duration_ms"),
        F.lit("loaded").alias("pipeline_status"),
    )


def skip_report(manifests: DataFrame, runs: DataFrame, as_of) -> DataFrame:
    """Reports of the manifests a load skips because their run is already loaded."""
    done = runs.where((F.col("status") == "loaded") & F.col("load_completed_at").isNotNull())
    state = F.struct("status", "load_started_at", "load_completed_at").alias("existing_pipeline_run_state")
    return manifests.join(done.select(*RUN_KEY, state), RUN_KEY, "inner").withColumns({
        "pipeline_status": F.lit("skipped_duplicate"),
        "skip_reason": F.lit("pipeline_run_already_loaded"),
        "load_completed_at": instant(as_of),
    })


def missing_uri_report(requested: DataFrame, found: DataFrame, by: list[str], uri: str = "uri") -> DataFrame:
    """Per request: number of requested and of missing uris, and the missing ones in
    request order (``position``). A request is one JSON list, so its list fits a row."""
    marked = requested.join(found.select(*by, uri).distinct().withColumn("_found", F.lit(True)), [*by, uri], "left")
    lost = F.col("_found").isNull()
    ordered = F.sort_array(F.collect_list(F.when(lost, F.struct("position", uri))))
    return marked.groupBy(*by).agg(
        F.count("*").alias("requested_article_uri_count"),
        F.count_if(lost).alias("missing_article_uri_count"),
        F.transform(ordered, lambda x: x[uri]).alias("missing_article_uris"),
    )
