"""Queries over merges, dimensions, the run ledger, discovery and run metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressloom import contracts as C
from pressloom.catalog.base import Tables, query, sql_items, sql_ts, ts_text, with_fx
from pressloom.catalog.intake import headline_payloads, staged_articles, staged_events
from pressloom.functions.times import days, instant
from pressloom.operators import casts, dims, discover, merge, metrics, quality, ranking, runs
from pressloom.session import work_path
from pressloom.sinks import rows

AS_OF = "2026-03-01 00:00:00"
_TRACKED = ["status", "price", "label"]

_MERGE = with_fx("target", "staged", more="""
m AS (SELECT coalesce(t.uri, s.uri) AS uri, t.uri IS NULL AS is_new, s.uri IS NULL AS is_kept,
  t.status IS DISTINCT FROM s.status OR t.price IS DISTINCT FROM s.price OR t.label IS DISTINCT FROM s.label AS differs,
  CASE WHEN s.uri IS NULL THEN t.status ELSE s.status END AS status, CASE WHEN s.uri IS NULL THEN t.price ELSE s.price END AS price,
  CASE WHEN s.uri IS NULL THEN t.label ELSE s.label END AS label, t.updated_at AS old_updated
  FROM fx_target t FULL OUTER JOIN fx_staged s ON t.uri = s.uri),
merged AS (SELECT *, CASE WHEN is_new THEN 'inserted' WHEN is_kept THEN 'kept' WHEN differs THEN 'updated' ELSE 'unchanged' END AS act FROM m)""")
_MERGE_ROWS = f"""SELECT uri, status, price, label, act AS action,
  CASE WHEN act IN ('inserted', 'updated') THEN '{AS_OF}' ELSE {sql_ts('old_updated')} END AS updated_at"""


def _merged(t: Tables, **options) -> DataFrame:
    now = instant(AS_OF)
    return merge.merge_changed(
        t.fx("target"), t.fx("staged"), ["uri"], _TRACKED,
        on_insert={"created_at": now, "updated_at": now}, on_change={"updated_at": now}, **options)


@query("merge_changed", _MERGE + _MERGE_ROWS + " FROM merged")
def merge_changed(t: Tables) -> DataFrame:
    return _merged(t).select("uri", "status", "price", "label", F.col("_action").alias("action"),
                             ts_text("updated_at").alias("updated_at"))


@query("merge_counts", _MERGE + """
SELECT count(*) FILTER (WHERE act <> 'kept') AS rows_attempted, count(*) FILTER (WHERE act IN ('inserted', 'updated')) AS rows_loaded,
  count(*) FILTER (WHERE act = 'inserted') AS db_rows_inserted, count(*) FILTER (WHERE act = 'updated') AS db_rows_updated,
  count(*) FILTER (WHERE act = 'unchanged') AS db_rows_unchanged FROM merged""")
def merge_counts(t: Tables) -> DataFrame:
    return merge.merge_counts(_merged(t))


def _article_target(t: Tables, staged: DataFrame) -> DataFrame:
    """Stored articles: English ones as they were collected before, French ones by the
    same run but with another title; other languages are unknown."""
    english = F.col("lang") == "en"
    run = {
        "ingestion_source": C.ARTICLE_INGESTION_SOURCE, "run_type": "scheduled", "nth_run": 1,
        "run_id": F.when(english, "2026-03-13T00:00:00Z").otherwise("2026-03-14T00:00:00Z"),
        "collected_at": F.when(english, "2026-03-13T00:05:00Z").otherwise("2026-03-14T00:05:00Z"),
    }
    now = F.lit("2026-01-01").cast("timestamp")
    stored = casts.cast_articles(staged.where("lang IN ('en', 'fr', 'de')"), run)
    return stored.withColumns({
        "title": F.when(F.col("lang") == "fr", "other").otherwise(F.col("title")),
        **{c: now for c in ("ingested_at", "created_at", "updated_at")},
    })


@query("upsert_articles", with_fx("articles") + f"""
SELECT uri, title, CASE lang WHEN 'en' THEN 'updated' WHEN 'fr' THEN 'updated' WHEN 'de' THEN 'unchanged' ELSE 'inserted' END AS action,
  '2026-03-14 00:00:00' AS run_id,
  CASE lang WHEN 'de' THEN '2026-01-01 00:00:00' ELSE '{AS_OF}' END AS updated_at,
  CASE WHEN lang IN ('en', 'fr', 'de') THEN '2026-01-01 00:00:00' ELSE '{AS_OF}' END AS ingested_at,
  NULLIF(source, '') AS source
FROM fx_articles""")
def upsert_articles(t: Tables) -> DataFrame:
    staged = staged_articles(t)
    run = {"ingestion_source": C.ARTICLE_INGESTION_SOURCE, "run_id": "2026-03-14T00:00:00Z", "run_type": "scheduled",
           "nth_run": 1, "collected_at": "2026-03-14T00:05:00Z"}
    merged = merge.upsert_articles(_article_target(t, staged), casts.cast_articles(staged, run), AS_OF)
    return merged.select("uri", "title", F.col("_action").alias("action"), ts_text("run_id").alias("run_id"),
                         ts_text("updated_at").alias("updated_at"), ts_text("ingested_at").alias("ingested_at"), "source")


_EVENT_CTE = with_fx("articles", more="""
ev AS (SELECT event_uri AS uri, CAST(count(*) AS INT) AS n, min(lang) AS first_lang FROM fx_articles WHERE event_uri <> '' GROUP BY event_uri)""")


@query("upsert_events", _EVENT_CTE + f"""
SELECT uri, CASE WHEN first_lang = 'en' THEN n WHEN first_lang = 'de' THEN n ELSE n END AS total_article_count,
  CASE first_lang WHEN 'en' THEN 'unchanged' WHEN 'de' THEN 'updated' ELSE 'inserted' END AS action,
  CASE first_lang WHEN 'en' THEN '2026-01-01 00:00:00' ELSE '{AS_OF}' END AS last_collected_at,
  CASE WHEN first_lang IN ('en', 'de') THEN '2026-01-01 00:00:00' ELSE '{AS_OF}' END AS first_collected_at
FROM ev""")
def upsert_events(t: Tables) -> DataFrame:
    typed = casts.cast_events(staged_events(t))
    lang = t.fx("articles").where("event_uri <> ''").groupBy(F.col("event_uri").alias("uri")).agg(F.min("lang").alias("l"))
    old = typed.join(lang, "uri").where("l IN ('en', 'de')")
    old = old.withColumn("total_article_count", F.when(F.col("l") == "de", 0).otherwise(F.col("total_article_count"))).drop("l")
    then = F.lit("2026-01-01").cast("timestamp")
    audit = ("first_collected_at", "last_collected_at", "created_at", "updated_at")
    merged = merge.upsert_events(old.withColumns({c: then for c in audit}), typed, AS_OF)
    return merged.select("uri", "total_article_count", F.col("_action").alias("action"),
                         ts_text("last_collected_at").alias("last_collected_at"),
                         ts_text("first_collected_at").alias("first_collected_at"))


@query("upsert_headlines", f"""
SELECT 'http://h/' || doc_id AS url, text AS content,
  CASE lang WHEN 'en' THEN 'unchanged' WHEN 'fr' THEN 'updated' ELSE 'inserted' END AS action,
  CASE lang WHEN 'en' THEN '2026-01-01 00:00:00' ELSE '{AS_OF}' END AS updated_at
FROM documents""")
def upsert_headlines(t: Tables) -> DataFrame:
    run = {"ingestion_source": C.HEADLINE_INGESTION_SOURCES[0], "run_id": "2026-03-14T10:00:00Z", "collected_at": "2026-03-14T10:05:00Z"}
    raw = rows.to_headline_row(headline_payloads(t))
    typed = casts.cast_headlines(raw, run)
    lang = t.raw("documents").select(F.concat(F.lit("http://h/"), "doc_id").alias("url"), "lang")
    old = typed.join(lang, "url").where("lang IN ('en', 'fr')")
    old = old.withColumn("content", F.when(F.col("lang") == "fr", F.lit("old")).otherwise(F.col("content"))).drop("lang")
    then = F.lit("2026-01-01").cast("timestamp")
    old = old.withColumns({c: then for c in ("ingested_at", "created_at", "updated_at")})
    merged = merge.upsert_headlines(old, typed, AS_OF)
    return merged.select("url", "content", F.col("_action").alias("action"), ts_text("updated_at").alias("updated_at"))


@query("insert_if_absent", with_fx("target", "staged") + """
SELECT uri, status, price, label FROM fx_target
UNION ALL SELECT uri, status, price, label FROM fx_staged WHERE uri NOT IN (SELECT uri FROM fx_target)""")
def insert_if_absent(t: Tables) -> DataFrame:
    cols = ["uri", "status", "price", "label"]
    return merge.insert_if_absent(t.fx("target").select(*cols), t.fx("staged"), ["uri"])


@query("merge_dimension", with_fx("target", "staged") + f"""
SELECT coalesce(t.uri, s.uri) AS uri, coalesce(s.status, t.status) AS status, coalesce(s.price, t.price) AS price,
  coalesce(s.label, t.label) AS label,
  CASE WHEN s.uri IS NULL THEN {sql_ts('t.updated_at')} ELSE '{AS_OF}' END AS updated_at
FROM fx_target t FULL OUTER JOIN fx_staged s ON t.uri = s.uri""")
def merge_dimension(t: Tables) -> DataFrame:
    merged = merge.merge_dimension(t.fx("target"), t.fx("staged"), as_of=AS_OF)
    return merged.select("uri", "status", "price", "label", ts_text("updated_at").alias("updated_at"))


@query("seed_outlets", with_fx("outlets") + """
SELECT source_name AS id, CASE WHEN geo_group = 'US' THEN 'old ' || source_name ELSE source_uri END AS name,
  CASE WHEN allsides_bias_score IS NULL THEN 'kept' END AS note, geo_group <> 'US' AS touched FROM fx_outlets""")
def seed_outlets(t: Tables) -> DataFrame:
    o = t.fx("outlets")
    old = F.lit("2026-01-01").cast("timestamp")
    target = o.where("geo_group = 'US' OR allsides_bias_score IS NULL").select(
        F.col("source_name").alias("id"), F.concat(F.lit("old "), "source_name").alias("name"),
        F.when(F.col("allsides_bias_score").isNull(), "kept").alias("note"), F.lit(False).alias("active"),
        old.alias("created_at"), old.alias("updated_at"))
    seed = o.where("geo_group <> 'US'").select(F.col("source_name").alias("id"), F.col("source_uri").alias("name"))
    merged = merge.seed_outlets(target, seed, AS_OF)
    return merged.select("id", "name", "note", (F.col("updated_at") == instant(AS_OF)).alias("touched"))


@query("sync_outlets", with_fx("outlets") + f"""
SELECT source_name AS id, geo_group = 'US' AS active,
  CASE WHEN (geo_group = 'US') <> (mbfc_bias_score IS NULL) THEN '{AS_OF}' ELSE '2026-01-01 00:00:00' END AS updated_at FROM fx_outlets""")
def sync_outlets(t: Tables) -> DataFrame:
    o = t.fx("outlets").select(F.col("source_name").alias("id"), "geo_group", F.col("mbfc_bias_score").isNull().alias("active"),
                               F.lit("2026-01-01").cast("timestamp").alias("updated_at"))
    synced = merge.sync_outlets(o.drop("geo_group"), o.where("geo_group = 'US'"), AS_OF)
    return synced.select("id", "active", ts_text("updated_at").alias("updated_at"))


_STAGED_STORIES = "st AS (SELECT uri AS article_uri FROM fx_stories WHERE run_type = 'backfill')"


def _staged_stories(t: Tables) -> DataFrame:
    return t.fx("stories").where("run_type = 'backfill'").select(F.col("uri").alias("article_uri"))


def _new_links(t: Tables) -> DataFrame:
    """New concept lists of the staged stories: their suppliers in place of their parts."""
    return t.fx("supply_links").join(_staged_stories(t), "article_uri", "left_semi").select(
        "article_uri", F.col("category_uri").alias("concept_uri"))


@query("replace_links", with_fx("stories", "links", "supply_links", more=_STAGED_STORIES) + """
SELECT article_uri, concept_uri FROM fx_links WHERE article_uri NOT IN (SELECT article_uri FROM st)
UNION ALL SELECT article_uri, category_uri FROM fx_supply_links WHERE article_uri IN (SELECT article_uri FROM st)""")
def replace_links(t: Tables) -> DataFrame:
    return merge.replace_links(t.fx("links"), _staged_stories(t), _new_links(t))


@query("links_to_replace", with_fx("stories", "links", more=_STAGED_STORIES) + """
SELECT article_uri, concept_uri FROM fx_links WHERE article_uri IN (SELECT article_uri FROM st)""")
def links_to_replace(t: Tables) -> DataFrame:
    return merge.links_to_replace(t.fx("links"), _staged_stories(t))


def _metric_rows(t: Tables) -> DataFrame:
    """One metric per run and event type."""
    return t.fx("runs").groupBy("run_id", "ingestion_source", "run_type", F.lit(1).alias("nth_run"),
                                F.lit("article_load").alias("stage"), F.col("event_type").alias("metric_name")).agg(
        F.count("*").alias("metric_value"), F.min("created_at").alias("stage_started_at"),
        F.max("created_at").alias("stage_completed_at"))


_METRICS_CTE = """
mr AS (SELECT run_id, ingestion_source, run_type, 1 AS nth_run, 'article_load' AS stage, event_type AS metric_name,
  count(*) AS metric_value, min(created_at) AS stage_started_at, max(created_at) AS stage_completed_at FROM fx_runs GROUP BY ALL)"""


@query("merge_metrics", with_fx("runs", more=_METRICS_CTE) + f"""
SELECT {sql_ts('run_id')} AS run_id, ingestion_source, run_type, metric_name, CASE WHEN run_type = 'seed' THEN -1 ELSE metric_value END AS metric_value,
  CASE WHEN run_type = 'scheduled' THEN '{AS_OF}' ELSE '2026-01-01 00:00:00' END AS created_at FROM mr""")
def merge_metrics(t: Tables) -> DataFrame:
    rows_ = _metric_rows(t)
    target = rows_.where("run_type <> 'scheduled'").withColumns({
        "metric_value": F.lit(-1).cast("bigint"), "created_at": F.lit("2026-01-01").cast("timestamp")})
    merged = merge.merge_metrics(target, rows_.where("run_type <> 'seed'"), AS_OF)
    return merged.select(ts_text("run_id").alias("run_id"), "ingestion_source", "run_type", "metric_name", "metric_value",
                         ts_text("created_at").alias("created_at"))


@query("touch_updated_at", with_fx("target") + f"""
SELECT uri, CASE WHEN status = 'F' THEN '{AS_OF}' ELSE {sql_ts('updated_at')} END AS updated_at FROM fx_target""")
def touch_updated_at(t: Tables) -> DataFrame:
    touched = merge.touch_updated_at(t.fx("target"), F.col("status") == "F", AS_OF)
    return touched.select("uri", ts_text("updated_at").alias("updated_at"))


@query("backfill_defaults", with_fx("runs") + """
SELECT event_id, CASE WHEN event_type = 'error' THEN CASE WHEN value > 20 THEN 'seed' ELSE 'scheduled' END ELSE run_type END AS run_type,
  1 AS nth_run FROM fx_runs""")
def backfill_defaults(t: Tables) -> DataFrame:
    sentinel = F.lit(C.SEED_RUN_ID).cast("timestamp")
    r = t.fx("runs").withColumns({
        "run_id": F.when(F.col("value") > 20, sentinel).otherwise(F.col("run_id")),
        "run_type": F.when(F.col("event_type") != "error", F.col("run_type")), "nth_run": F.lit(None).cast("int")})
    filled = merge.backfill_defaults(r, {"run_type": runs.default_run_type(), "nth_run": F.lit(1)})
    return filled.select("event_id", "run_type", "nth_run")


@query("rollback_runs", with_fx("articles") + """
SELECT uri, run_type FROM fx_articles WHERE NOT coalesce(run_type = 'backfill' AND date_time_published >= TIMESTAMP '2026-02-14 10:00:00'
  AND date_time_published < TIMESTAMP '2026-03-01 10:00:00' AND source_uri IN ('src1.example.com', 'src2.example.com', 'src3.example.com', 'src4.example.com', 'src5.example.com'), false)""")
def rollback_runs(t: Tables) -> DataFrame:
    sources = [f"src{i}.example.com" for i in range(1, 6)]
    return merge.rollback_runs(t.fx("articles"), "backfill", "2026-02-14 10:00:00", "2026-03-01 10:00:00", sources=sources).select("uri", "run_type")


@query("add_columns_default", with_fx("target") + """
SELECT uri, status, 'Pending' AS access, CAST(NULL AS VARCHAR) AS topic_id FROM fx_target""")
def add_columns_default(t: Tables) -> DataFrame:
    spec = {"status": F.lit("lost"), "access": F.lit("Pending"), "topic_id": F.lit(None).cast("string")}
    return merge.add_columns_default(t.fx("target"), spec).select("uri", "status", "access", "topic_id")


# --- dimensions -------------------------------------------------------------------------

_SRC = """
src AS (SELECT NULLIF(source->>'uri', '') AS uri, NULLIF(source->>'title', '') AS title, NULLIF(source->>'description', '') AS description,
  CAST(source->'ranking' AS VARCHAR) AS ranking, NULLIF(source->>'image', '') AS image
  FROM (SELECT CAST(source AS JSON) AS source FROM fx_articles WHERE source NOT IN ('', 'null') AND json_type(source) = 'OBJECT')),
best_src AS (SELECT * FROM src WHERE uri IS NOT NULL QUALIFY row_number() OVER (PARTITION BY uri ORDER BY description IS NOT NULL DESC,
  image IS NOT NULL DESC, ranking IS NOT NULL DESC, title DESC NULLS LAST, description DESC NULLS LAST, ranking DESC NULLS LAST, image DESC NULLS LAST) = 1)"""
_CON = f"""
ce AS (SELECT uri AS article_uri, {sql_items('concepts')} AS c FROM fx_articles),
con AS (SELECT article_uri, NULLIF(c->>'uri', '') AS uri, NULLIF(c->>'type', '') AS type, NULLIF(c->>'image', '') AS image,
  CAST(c->'label' AS VARCHAR) AS label FROM ce WHERE NULLIF(c->>'uri', '') IS NOT NULL),
best_con AS (SELECT uri, type, image, label FROM con QUALIFY row_number() OVER (PARTITION BY uri ORDER BY type IS NOT NULL DESC,
  image IS NOT NULL DESC, label IS NOT NULL DESC, type DESC NULLS LAST, image DESC NULLS LAST, label DESC NULLS LAST) = 1)"""
_CAT = f"""
ge AS (SELECT uri AS article_uri, {sql_items('categories')} AS c FROM fx_articles),
cat AS (SELECT article_uri, NULLIF(c->>'uri', '') AS uri, NULLIF(c->>'parentUri', '') AS parent_uri, NULLIF(c->>'label', '') AS label
  FROM ge WHERE NULLIF(c->>'uri', '') IS NOT NULL),
best_cat AS (SELECT uri, parent_uri, label FROM cat QUALIFY row_number() OVER (PARTITION BY uri ORDER BY parent_uri IS NOT NULL DESC,
  label IS NOT NULL DESC, parent_uri DESC NULLS LAST, label DESC NULLS LAST) = 1)"""


def dims_cte(*parts: str) -> str:
    return with_fx("articles", more=",".join(parts))


@query("best_sources", dims_cte(_SRC) + "SELECT uri, title, description, ranking, image FROM best_src")
def best_sources(t: Tables) -> DataFrame:
    return dims.best_sources(t.fx("articles")).select("uri", "title", "description", "ranking", "image")


@query("best_concepts", dims_cte(_CON) + "SELECT uri, type, image, label FROM best_con")
def best_concepts(t: Tables) -> DataFrame:
    return dims.best_concepts(t.fx("articles")).select("uri", "type", "image", "label")


@query("best_categories", dims_cte(_CAT) + "SELECT uri, parent_uri, label FROM best_cat")
def best_categories(t: Tables) -> DataFrame:
    return dims.best_categories(t.fx("articles"))


@query("explode_concepts", dims_cte(_CON) + "SELECT article_uri, uri, type, image, label FROM con")
def explode_concepts(t: Tables) -> DataFrame:
    return dims.explode_concepts(t.fx("articles")).select("article_uri", "uri", "type", "image", "label")


@query("explode_categories", dims_cte(_CAT) + "SELECT article_uri, uri, parent_uri, label FROM cat")
def explode_categories(t: Tables) -> DataFrame:
    return dims.explode_categories(t.fx("articles"))


@query("distinct_links", dims_cte(_CON, _CAT) + """
SELECT DISTINCT article_uri, uri, 'concept' AS kind FROM con UNION ALL SELECT DISTINCT article_uri, uri, 'category' FROM cat""")
def distinct_links(t: Tables) -> DataFrame:
    a = t.fx("articles")
    con = dims.concept_links(a).select("article_uri", F.col("concept_uri").alias("uri"), F.lit("concept").alias("kind"))
    cat = dims.category_links(a).select("article_uri", F.col("category_uri").alias("uri"), F.lit("category").alias("kind"))
    return con.unionByName(cat)


_NEW_SOURCE = "CASE WHEN source NOT IN ('', 'null') AND json_type(source) = 'OBJECT' THEN NULLIF(source->>'uri', '') END"


@query("sync_source_uri", with_fx("articles") + f"""
SELECT uri, CASE WHEN lang = 'en' THEN {_NEW_SOURCE} ELSE 'old' END AS source_uri,
  CASE WHEN lang = 'en' THEN '{AS_OF}' ELSE '2026-01-01 00:00:00' END AS updated_at FROM fx_articles""")
def sync_source_uri(t: Tables) -> DataFrame:
    a = t.fx("articles")
    stored = a.select("uri", F.lit("old").alias("source_uri"), F.lit("2026-01-01").cast("timestamp").alias("updated_at"))
    synced = dims.sync_source_uri(stored, a.where("lang = 'en'"), AS_OF)
    return synced.select("uri", "source_uri", ts_text("updated_at").alias("updated_at"))


@query("normalize_articles", dims_cte(_SRC, _CON, _CAT) + """
SELECT 'source' AS kind, uri AS a, coalesce(description, 'old') AS b FROM best_src
UNION ALL SELECT 'concept', uri, coalesce(type, 'old') FROM best_con
UNION ALL SELECT 'category', uri, coalesce(parent_uri, 'none') FROM best_cat
UNION ALL SELECT 'article_concept', article_uri, uri FROM (SELECT DISTINCT article_uri, uri FROM con)
UNION ALL SELECT 'article_category', article_uri, uri FROM (SELECT DISTINCT article_uri, uri FROM cat)
UNION ALL SELECT 'article', uri, coalesce(""" + _NEW_SOURCE + """, 'none') FROM fx_articles""")
def normalize_articles(t: Tables) -> DataFrame:
    """Whole sync over tables that already hold older rows and links."""
    a = t.fx("articles").persist()
    then = F.lit("2026-01-01").cast("timestamp")
    aged = {"created_at": then, "updated_at": then}
    null = F.lit(None).cast("string")
    old_sources = dims.best_sources(a).select(
        "uri", *[null.alias(c) for c in ("title",)], F.lit("old").alias("description"),
        *[null.alias(c) for c in ("social_media", "ranking", "location", "image", "thumb_image")])
    old_concepts = dims.best_concepts(a).select(
        "uri", F.lit("old").alias("type"), *[null.alias(c) for c in ("image", "label", "location", "synonyms")])
    old_categories = dims.best_categories(a).where(F.lit(False))
    tables = {
        "articles": a.select("uri", F.lit("stale").alias("source_uri"), then.alias("updated_at")),
        "sources": old_sources.withColumns(aged), "concepts": old_concepts.withColumns(aged),
        "categories": old_categories.withColumns(aged),
        "article_concepts": a.select(F.col("uri").alias("article_uri"), F.lit("stale").alias("concept_uri")),
        "article_categories": a.select(F.col("uri").alias("article_uri"), F.lit("stale").alias("category_uri")),
    }
    new = dims.normalize_articles(a, tables, AS_OF)

    def pick(kind: str, name: str, x: str, y: str, absent: str = "none") -> DataFrame:
        return new[name].select(F.lit(kind).alias("kind"), F.col(x).alias("a"), F.coalesce(F.col(y), F.lit(absent)).alias("b"))

    return metrics.union_metrics(
        pick("source", "sources", "uri", "description"), pick("concept", "concepts", "uri", "type"),
        pick("category", "categories", "uri", "parent_uri"),
        pick("article_concept", "article_concepts", "article_uri", "concept_uri"),
        pick("article_category", "article_categories", "article_uri", "category_uri"),
        pick("article", "articles", "uri", "source_uri"))


# --- run ledger -------------------------------------------------------------------------

_KEY3 = "run_id, ingestion_source, run_type"


@query("assign_nth_run", with_fx("runs") + f"""
SELECT event_id, CAST(row_number() OVER (PARTITION BY {_KEY3} ORDER BY created_at, event_id) AS INT) AS nth_run FROM fx_runs""")
def assign_nth_run(t: Tables) -> DataFrame:
    return runs.assign_nth_run(t.fx("runs"), "event_id").select("event_id", "nth_run")


@query("reserve_runs", with_fx("runs") + f"""
SELECT event_id, CAST(coalesce(used, 0) + row_number() OVER (PARTITION BY {_KEY3} ORDER BY created_at, event_id) AS INT) AS nth_run
FROM fx_runs LEFT JOIN (SELECT {_KEY3}, count(*) AS used FROM fx_runs WHERE value > 20 GROUP BY ALL) USING ({_KEY3})
WHERE value <= 20""")
def reserve_runs(t: Tables) -> DataFrame:
    r = t.fx("runs")
    ledger = r.where("value > 20").groupBy("run_id", "ingestion_source", "run_type").agg(F.count("*").alias("nth_run"))
    numbered = runs.next_runs(ledger, r.where("value <= 20"), [F.col("created_at"), F.col("event_id")])
    return numbered.select("event_id", "nth_run")


def _run_log(t: Tables) -> DataFrame:
    """The event table as a run log: one run per (day, user), its stages by event type.

    Users of the third group never start a run, so their other events must not count.
    """
    e = t.raw("events").withColumns({
        "run_id": F.date_trunc("day", "ts"), "ingestion_source": F.concat(F.lit("src-"), "user_id"),
        "run_type": F.lit("scheduled"), "nth_run": F.lit(1), "at": F.col("ts")})
    started = F.col("user_id") % 3 != 2
    window = {"window_from": F.col("run_id") - days(2), "window_to": F.col("run_id")}
    log = e.sparkSession.createDataFrame([], runs.LOG_SCHEMA)
    signups = e.where((F.col("event_type") == "signup") & started).withColumns(window)
    log = log.unionByName(runs.log_rows(signups, "started", list(window)))
    again = e.where((F.col("event_type") == "click") & started & (F.col("value") > 30)).withColumns(window)
    log = runs.restart_run(log, again)
    log = runs.mark_collected(log, e.where("event_type = 'view'").withColumns({
        "articles_fetched": F.col("event_id"), "articles_deduped": F.col("event_id") - 1}))
    log = runs.mark_load_started(log, e.where("event_type = 'click'"))
    log = runs.mark_loaded(log, e.where("event_type = 'purchase'").withColumns({
        "rows_loaded": F.col("event_id"), "db_rows_inserted": F.col("event_id"), "db_rows_updated": F.lit(0)}))
    return runs.mark_failed(log, e.where("event_type = 'error'").withColumns({
        "error_code": F.lit("loader_error"), "error_message": F.repeat(F.col("props"), 300)}))


_LEDGER = """
WITH ev AS (SELECT *, date_trunc('day', ts) AS run_id, 'src-' || user_id AS ingestion_source, user_id % 3 <> 2 AS ok FROM events),
lg AS (
  SELECT run_id, ingestion_source, ts, 'started' AS kind, event_id, props FROM ev WHERE event_type = 'signup' AND ok
  UNION ALL SELECT run_id, ingestion_source, ts, 'restarted', event_id, props FROM ev WHERE event_type = 'click' AND ok AND value > 30
  UNION ALL SELECT run_id, ingestion_source, ts, 'collected', event_id, props FROM ev WHERE event_type = 'view'
  UNION ALL SELECT run_id, ingestion_source, ts, 'load_started', event_id, props FROM ev WHERE event_type = 'click'
  UNION ALL SELECT run_id, ingestion_source, ts, 'loaded', event_id, props FROM ev WHERE event_type = 'purchase'
  UNION ALL SELECT run_id, ingestion_source, ts, 'failed', event_id, props FROM ev WHERE event_type = 'error'),
folded AS (SELECT run_id, ingestion_source, arg_max(kind, ts) FILTER (WHERE kind <> 'load_started') AS last_kind,
  max(ts) FILTER (WHERE kind = 'collected') AS collected_at, min(ts) FILTER (WHERE kind = 'load_started') AS load_started_at,
  max(ts) FILTER (WHERE kind = 'loaded') AS load_completed_at,
  coalesce(arg_max(event_id, ts) FILTER (WHERE kind = 'collected'), 0) AS articles_fetched,
  coalesce(arg_max(event_id, ts) FILTER (WHERE kind = 'loaded'), 0) AS rows_loaded,
  arg_max(CASE WHEN kind = 'failed' THEN length(repeat(props, 300)) ELSE -1 END, ts) FILTER (WHERE kind <> 'load_started') AS message_chars,
  bool_or(kind IN ('started', 'restarted')) AS reserved FROM lg GROUP BY run_id, ingestion_source),
ledger AS (SELECT *, CASE last_kind WHEN 'restarted' THEN 'started' ELSE last_kind END AS status FROM folded WHERE reserved)
"""


@query("fold_run_ledger", _LEDGER + f"""
SELECT {sql_ts('run_id')} AS run_id, ingestion_source, status, {sql_ts('collected_at')} AS collected_at, {sql_ts('load_started_at')} AS load_started_at,
  {sql_ts('load_completed_at')} AS load_completed_at, articles_fetched, rows_loaded,
  CASE WHEN message_chars >= 0 THEN message_chars END AS message_chars FROM ledger""")
def fold_run_ledger(t: Tables) -> DataFrame:
    folded = runs.fold_run_ledger(_run_log(t))
    return folded.select(
        ts_text("run_id").alias("run_id"), "ingestion_source", "status", ts_text("collected_at").alias("collected_at"),
        ts_text("load_started_at").alias("load_started_at"), ts_text("load_completed_at").alias("load_completed_at"),
        "articles_fetched", "rows_loaded", F.length("error_message").cast("bigint").alias("message_chars"))


def _status_query(name: str, status: str, columns: str, pick):
    @query(name, _LEDGER + f"SELECT {sql_ts('run_id')} AS run_id, ingestion_source, {columns} FROM ledger WHERE status = '{status}'")
    def build(t: Tables) -> DataFrame:
        folded = runs.fold_run_ledger(_run_log(t)).where(F.col("status") == status)
        return folded.select(ts_text("run_id").alias("run_id"), "ingestion_source", *pick())


_status_query("mark_collected", "collected", f"articles_fetched, {sql_ts('collected_at')} AS collected_at",
              lambda: ["articles_fetched", ts_text("collected_at").alias("collected_at")])
_status_query("mark_loaded", "loaded", f"rows_loaded, {sql_ts('load_completed_at')} AS load_completed_at",
              lambda: ["rows_loaded", ts_text("load_completed_at").alias("load_completed_at")])
_status_query("mark_failed", "failed", "message_chars",
              lambda: [F.length("error_message").cast("bigint").alias("message_chars")])
_status_query("restart_run", "started", "articles_fetched", lambda: ["articles_fetched"])


@query("mark_load_started", _LEDGER + f"""
SELECT {sql_ts('run_id')} AS run_id, ingestion_source, {sql_ts('load_started_at')} AS load_started_at FROM ledger WHERE load_started_at IS NOT NULL""")
def mark_load_started(t: Tables) -> DataFrame:
    folded = runs.fold_run_ledger(_run_log(t)).where("load_started_at IS NOT NULL")
    return folded.select(ts_text("run_id").alias("run_id"), "ingestion_source", ts_text("load_started_at").alias("load_started_at"))


@query("skip_already_loaded", _LEDGER + f"""
SELECT {sql_ts('run_id')} AS run_id, ingestion_source FROM (SELECT DISTINCT run_id, ingestion_source FROM ev)
WHERE (run_id, ingestion_source) NOT IN (SELECT (run_id, ingestion_source) FROM ledger WHERE status = 'loaded' AND load_completed_at IS NOT NULL)""")
def skip_already_loaded(t: Tables) -> DataFrame:
    log = _run_log(t)
    manifests = t.raw("events").select(
        F.date_trunc("day", "ts").alias("run_id"), F.concat(F.lit("src-"), "user_id").alias("ingestion_source"),
        F.lit("scheduled").alias("run_type"), F.lit(1).alias("nth_run")).distinct()
    todo = runs.skip_already_loaded(manifests, runs.fold_run_ledger(log))
    return todo.select(ts_text("run_id").alias("run_id"), "ingestion_source")


_PICK = f"""
pick AS (SELECT run_id, ingestion_source, run_type, nth_run FROM (SELECT {_KEY3}, CAST(count(*) AS INT) AS nth_run FROM fx_runs GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY run_id, ingestion_source
  ORDER BY CASE run_type WHEN 'seed' THEN 1 WHEN 'scheduled' THEN 2 WHEN 'backfill' THEN 3 ELSE 99 END, nth_run) = 1)"""


def _grouped_runs(t: Tables) -> DataFrame:
    return t.fx("runs").groupBy("run_id", "ingestion_source", "run_type").agg(F.count("*").cast("int").alias("nth_run"))


@query("pick_run", with_fx("runs", more=_PICK) + f"SELECT {sql_ts('run_id')} AS run_id, ingestion_source, run_type, nth_run FROM pick")
def pick_run(t: Tables) -> DataFrame:
    return runs.pick_run(_grouped_runs(t)).withColumn("run_id", ts_text("run_id"))


@query("backfill_run_lineage", with_fx("runs", more=_PICK) + """
SELECT r.event_id, CASE WHEN r.event_type IN ('click', 'view') THEN r.run_type ELSE coalesce(p.run_type, 'scheduled') END AS run_type,
  CASE WHEN r.event_type IN ('click', 'view') THEN 7 ELSE coalesce(p.nth_run, 1) END AS nth_run
FROM fx_runs r LEFT JOIN (SELECT * FROM pick WHERE nth_run > 5) p ON r.run_id = p.run_id AND r.ingestion_source = p.ingestion_source""")
def backfill_run_lineage(t: Tables) -> DataFrame:
    known = F.col("event_type").isin("click", "view")
    articles = t.fx("runs").withColumns({
        "run_type": F.when(known, F.col("run_type")), "nth_run": F.when(known, F.lit(7))})
    ledger = runs.pick_run(_grouped_runs(t)).where("nth_run > 5")
    return runs.backfill_run_lineage(articles, ledger).select("event_id", "run_type", "nth_run")


# --- discovery --------------------------------------------------------------------------


@query("discover_events", with_fx("articles") + """
SELECT DISTINCT 'parent_run' AS scope, event_uri FROM fx_articles WHERE run_type = 'scheduled' AND run_id = TIMESTAMP '2026-02-20 00:00:00' AND event_uri <> ''
UNION ALL SELECT DISTINCT 'time_window', event_uri FROM fx_articles
  WHERE date_time_published >= TIMESTAMP '2026-02-16 00:00:00' AND date_time_published < TIMESTAMP '2026-02-26 12:00:00' AND event_uri <> ''
UNION ALL SELECT DISTINCT 'full_corpus', event_uri FROM fx_articles WHERE event_uri <> ''""")
def discover_events(t: Tables) -> DataFrame:
    a = t.fx("articles")
    run = {"run_id": instant("2026-02-20 00:00:00"), "ingestion_source": C.ARTICLE_INGESTION_SOURCE, "run_type": "scheduled", "nth_run": 1}
    parts = {
        "parent_run": discover.discover_events(a, "parent_run", run),
        "time_window": discover.discover_events(a, "time_window", time_column="date_time_published",
                                                start="2026-02-16 00:00:00", end="2026-02-26 12:00:00"),
        "full_corpus": discover.discover_events(a, "full_corpus"),
    }
    return metrics.union_metrics(*[df.select(F.lit(k).alias("scope"), "event_uri") for k, df in parts.items()])


@query("candidate_articles", with_fx("articles") + """
SELECT 'run' AS scope, count(*) AS n FROM fx_articles WHERE run_type = 'scheduled' AND run_id = TIMESTAMP '2026-02-20 00:00:00'
UNION ALL SELECT 'window', count(*) FROM fx_articles WHERE date_time_published >= TIMESTAMP '2026-02-16 00:00:00' AND date_time_published < TIMESTAMP '2026-02-26 12:00:00'
UNION ALL SELECT 'all', count(*) FROM fx_articles""")
def candidate_articles(t: Tables) -> DataFrame:
    a = t.fx("articles")
    run = {"run_id": instant("2026-02-20 00:00:00"), "run_type": "scheduled"}
    parts = {
        "run": metrics.candidate_articles(a, run),
        "window": metrics.candidate_articles(a, time_column="date_time_published", start="2026-02-16 00:00:00", end="2026-02-26 12:00:00"),
        "all": metrics.candidate_articles(a),
    }
    return metrics.union_metrics(*[df.select(F.lit(k).alias("scope"), F.col("candidate_articles_scanned").alias("n")) for k, df in parts.items()])


def _event_table(t: Tables) -> DataFrame:
    """Known events, one per supplier nation group: last collected by purchase time."""
    return t.raw("events").where("event_type = 'purchase'").groupBy(F.concat(F.lit("ev-"), "user_id").alias("uri")).agg(
        F.min("ts").alias("last_collected_at"))


@query("freshness_filter", """
WITH cand AS (SELECT DISTINCT 'ev-' || o_custkey AS event_uri FROM orders),
known AS (SELECT 'ev-' || user_id AS uri, min(ts) AS last_collected_at FROM events WHERE event_type = 'purchase' GROUP BY user_id),
j AS (SELECT event_uri, uri, last_collected_at FROM cand LEFT JOIN known ON uri = event_uri)
SELECT 'F,F' AS flags, event_uri FROM j
UNION ALL SELECT 'T,F', event_uri FROM j WHERE uri IS NULL
UNION ALL SELECT 'F,T', event_uri FROM j WHERE uri IS NULL OR last_collected_at < TIMESTAMP '2024-01-03 00:00:00'
UNION ALL SELECT 'T,T', event_uri FROM j WHERE uri IS NULL OR last_collected_at < TIMESTAMP '2024-01-03 00:00:00'""")
def freshness_filter(t: Tables) -> DataFrame:
    candidates = t.raw("orders").select(F.concat(F.lit("ev-"), "o_custkey").alias("event_uri")).distinct()
    events = _event_table(t)
    parts = [
        discover.freshness_filter(candidates, events, "2024-01-04 00:00:00", missing, stale, 24).select(
            F.lit(f"{str(missing)[0]},{str(stale)[0]}").alias("flags"), "event_uri")
        for missing in (False, True) for stale in (False, True)
    ]
    return metrics.union_metrics(*parts)


@query("stale_events", f"""
SELECT 'ev-' || user_id AS uri, {sql_ts('min(ts)')} AS last_collected_at FROM events WHERE event_type = 'purchase'
GROUP BY user_id HAVING min(ts) < TIMESTAMP '2024-01-03 00:00:00'""")
def stale_events(t: Tables) -> DataFrame:
    return discover.stale_events(_event_table(t), "2024-01-04 00:00:00", 24).select("uri", ts_text("last_collected_at").alias("last_collected_at"))


# --- metrics ----------------------------------------------------------------------------

_LOAD_METRICS = with_fx("stories", "links", "supply_links") + """,
own AS (SELECT run_type, count(*) AS a, count(source_uri) AS b, count(DISTINCT source_uri) AS c FROM fx_stories GROUP BY run_type),
con AS (SELECT run_type, count(*) AS a, count(DISTINCT concept_uri) AS b FROM fx_links JOIN fx_stories ON uri = article_uri GROUP BY run_type),
cat AS (SELECT run_type, count(*) AS a, count(DISTINCT category_uri) AS b FROM fx_supply_links JOIN fx_stories ON uri = article_uri GROUP BY run_type)
SELECT run_type, 'articles_upserted' AS metric_name, a AS metric_value FROM own
UNION ALL SELECT run_type, 'articles_with_source_uri', b FROM own
UNION ALL SELECT run_type, 'distinct_sources_in_articles', c FROM own
UNION ALL SELECT run_type, 'article_concept_links', a FROM con
UNION ALL SELECT run_type, 'distinct_concepts_linked', b FROM con
UNION ALL SELECT run_type, 'article_category_links', a FROM cat
UNION ALL SELECT run_type, 'distinct_categories_linked', b FROM cat"""


@query("article_load_metrics", _LOAD_METRICS)
def article_load_metrics(t: Tables) -> DataFrame:
    return metrics.article_load_metrics(t.fx("stories"), t.fx("links"), t.fx("supply_links"), ["run_type"])


@query("union_metrics", with_fx("runs", more=_METRICS_CTE) + """
SELECT 'a' AS part, metric_name, sum(metric_value)::BIGINT AS metric_value FROM mr GROUP BY metric_name
UNION ALL SELECT 'b', run_type, sum(metric_value)::BIGINT FROM mr GROUP BY run_type""")
def union_metrics(t: Tables) -> DataFrame:
    m = _metric_rows(t)
    one = m.groupBy("metric_name").agg(F.sum("metric_value").alias("metric_value")).withColumn("part", F.lit("a"))
    two = m.groupBy(F.col("run_type").alias("metric_name")).agg(F.sum("metric_value").alias("metric_value")).withColumn("part", F.lit("b"))
    return metrics.union_metrics(one, two)


@query("run_links", with_fx("stories", "links") + """
SELECT article_uri, concept_uri FROM fx_links JOIN fx_stories ON uri = article_uri WHERE run_type = 'scheduled' AND nth_run = 1""")
def run_links(t: Tables) -> DataFrame:
    return metrics.run_links(t.fx("links"), t.fx("stories"), {"run_type": "scheduled", "nth_run": 1}).select("article_uri", "concept_uri")


@query("event_collect_metrics", with_fx("articles") + """
SELECT 'candidate_articles_scanned' AS metric_name, count(*) AS metric_value FROM fx_articles
UNION ALL SELECT 'distinct_event_uris_discovered', count(DISTINCT event_uri) FROM fx_articles WHERE event_uri <> ''
UNION ALL SELECT 'distinct_event_uris_selected', count(DISTINCT event_uri) FROM fx_articles WHERE event_uri <> '' AND event_uri NOT IN (SELECT 'eng-' || user_id FROM events WHERE event_type = 'purchase')
UNION ALL SELECT 'events_fetched', count(DISTINCT event_uri) FROM fx_articles WHERE event_uri <> '' AND event_uri NOT IN (SELECT 'eng-' || user_id FROM events WHERE event_type = 'purchase')""")
def event_collect_metrics(t: Tables) -> DataFrame:
    a = t.fx("articles")
    events = t.raw("events").where("event_type = 'purchase'").groupBy(F.concat(F.lit("eng-"), "user_id").alias("uri")).agg(
        F.max("ts").alias("last_collected_at"))
    found = discover.discover_events(a, "full_corpus")
    wanted = discover.freshness_filter(found, events, "2024-02-01 00:00:00", only_missing=True, include_stale=False)
    return metrics.event_collect_metrics(metrics.candidate_articles(a), found, wanted, wanted)


@query("event_load_metrics", _EVENT_CTE + """
SELECT 'events_upserted' AS metric_name, count(*) AS metric_value FROM ev WHERE first_lang <> 'en'
UNION ALL SELECT 'events_inserted', count(*) FROM ev WHERE first_lang NOT IN ('en', 'de')
UNION ALL SELECT 'events_updated', count(*) FROM ev WHERE first_lang = 'de'""")
def event_load_metrics(t: Tables) -> DataFrame:
    done = upsert_events(t).withColumnRenamed("action", "_action")
    return metrics.event_load_metrics(merge.merge_counts(done))


@query("runs_with_metrics", with_fx("runs", more=_METRICS_CTE) + f"""
SELECT {sql_ts('r.run_id')} AS run_id, r.ingestion_source, r.run_type, max(metric_value) FILTER (WHERE metric_name = 'click') AS click,
  max(metric_value) FILTER (WHERE metric_name = 'view') AS view
FROM (SELECT DISTINCT {_KEY3} FROM fx_runs) r LEFT JOIN mr USING ({_KEY3}) GROUP BY ALL""")
def runs_with_metrics(t: Tables) -> DataFrame:
    ledger = _grouped_runs(t).withColumn("nth_run", F.lit(1))
    joined = metrics.runs_with_metrics(ledger, _metric_rows(t), ["click", "view"])
    return joined.select(ts_text("run_id").alias("run_id"), "ingestion_source", "run_type", "click", "view")


@query("stage_durations", with_fx("runs", more=_METRICS_CTE) + f"""
SELECT {sql_ts('run_id')} AS run_id, ingestion_source, run_type, stage,
  round((epoch_us(max(stage_completed_at)) - epoch_us(min(stage_started_at))) / 1000000, 6) AS seconds FROM mr GROUP BY ALL""")
def stage_durations(t: Tables) -> DataFrame:
    d = metrics.stage_durations(_metric_rows(t))
    return d.select(ts_text("run_id").alias("run_id"), "ingestion_source", "run_type", "stage", F.round("seconds", 6).alias("seconds"))


@query("articles_per_run", with_fx("articles") + f"""
SELECT {sql_ts('run_id')} AS run_id, run_type, nth_run, count(*) AS articles FROM fx_articles GROUP BY ALL""")
def articles_per_run(t: Tables) -> DataFrame:
    from pressloom.operators.coverage import articles_per_run as per_run

    return per_run(t.fx("articles")).withColumn("run_id", ts_text("run_id"))


# --- numbering, ordering, pages ---------------------------------------------------------


@query("worklist", "SELECT 'o-' || o_orderkey AS uri, row_number() OVER (ORDER BY 'o-' || o_orderkey) AS rn FROM orders")
def worklist(t: Tables) -> DataFrame:
    return ranking.worklist(t.raw("orders").select(F.concat(F.lit("o-"), "o_orderkey").alias("uri")))


@query("worklist_batches", """
WITH n AS (SELECT row_number() OVER (ORDER BY 'o-' || o_orderkey) AS rn FROM orders)
SELECT (rn - 1) // 500 AS batch, count(*) AS n, min(rn) AS first FROM n GROUP BY ALL""")
def worklist_batches(t: Tables) -> DataFrame:
    numbered = ranking.worklist_batches(t.raw("orders").select(F.concat(F.lit("o-"), "o_orderkey").alias("uri")), 500)
    return numbered.groupBy("batch").agg(F.count("*").alias("n"), F.min("rn").alias("first"))


@query("dedupe_last", """
SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(props, (ts, event_id)) AS props FROM events GROUP BY user_id""")
def dedupe_last(t: Tables) -> DataFrame:
    e = t.raw("events").select("user_id", "ts", "event_id", "props")
    placed = e.select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    return merge.dedupe_last(placed, ["user_id"], ["ts", "event_id"], ["file", "row"]).select("user_id", "event_id", "props")


_PAGES = """
WITH RECURSIVE art AS (
  SELECT page_id // 5000 AS run, page_id % 5000 // 10 + 1 AS page, page_id % 10 AS pos,
    CASE WHEN (page_id % 5000 // 10) % 9 IN (3, 4) THEN 'u-' || (page_id % 10) ELSE 'u-' || page_id END AS uri,
    TIMESTAMP '2026-02-20 00:00:00' - to_minutes(CAST(page_id % 5000 * 5 AS INT)) AS ts FROM pages),
pg AS (SELECT run, page, count(*) AS articles, string_agg(uri, '|' ORDER BY pos) AS fp, min(ts) AS oldest FROM art GROUP BY ALL),
fs AS (SELECT run, page, count(*) AS new_uris FROM (SELECT run, uri, min(page) AS page FROM art GROUP BY ALL) GROUP BY ALL),
p AS (SELECT pg.*, coalesce(new_uris, 0) AS new_uris, row_number() OVER (PARTITION BY run, fp ORDER BY page) > 1 AS seen
  FROM pg LEFT JOIN fs USING (run, page)),
q AS (SELECT *, oldest < TIMESTAMP '2026-02-19 12:00:00' AND NOT seen AND new_uris > 0 AS trusted FROM p),
walk AS (
  SELECT run, page, articles, CAST(seen AS INT) AS s, CAST(trusted AS INT) AS g, false AS stopped FROM q WHERE page = 1
  UNION ALL
  SELECT q.run, q.page, q.articles, CASE WHEN q.seen THEN w.s + 1 ELSE 0 END, CASE WHEN q.trusted THEN w.g + 1 ELSE 0 END,
    w.stopped OR w.s >= 3 OR w.articles < 10 OR w.g >= 2
  FROM q JOIN walk w ON q.run = w.run AND q.page = w.page + 1)
SELECT run, page, w.articles, new_uris, strftime(oldest, '%Y-%m-%d %H:%M:%S') AS oldest, seen AS seen_before, trusted AS trusted_stop,
  s AS seen_before_streak, g AS trusted_stop_streak,
  CASE WHEN stopped THEN 'not_reached' WHEN s >= 3 THEN 'abort' WHEN w.articles < 10 THEN 'last_page' WHEN g >= 2 THEN 'early_stop' ELSE 'continue' END AS verdict
FROM walk w JOIN q USING (run, page)"""


@query("page_audit", _PAGES)
def page_audit(t: Tables) -> DataFrame:
    """Result pages of ten uris; a run holds 500 pages, and some pages repeat."""
    index = F.col("page_id") % 5000
    page = F.floor(index / 10).cast("bigint")
    repeated = (page % 9).isin(3, 4)
    a = t.raw("pages").select(
        F.floor(F.col("page_id") / 5000).cast("bigint").alias("run"), (page + 1).alias("page"), (F.col("page_id") % 10).alias("pos"),
        F.concat(F.lit("u-"), F.when(repeated, F.col("page_id") % 10).otherwise(F.col("page_id"))).alias("uri"),
        (instant("2026-02-20 00:00:00") - F.make_dt_interval(mins=(index * 5).cast("int"))).alias("ts"))
    return quality.page_audit(a, "2026-02-19 12:00:00", ["run"], page_size=10).withColumn("oldest", ts_text("oldest"))


@query("order_articles", with_fx("articles") + """
SELECT uri, row_number() OVER (ORDER BY coalesce(date_time_published, TIMESTAMP '1970-01-01 00:00:00') DESC, uri) AS place FROM fx_articles""")
def order_articles(t: Tables) -> DataFrame:
    """The order itself is checked: the sorted rows are written and numbered where they lie."""
    a = t.fx("articles").withColumn("date_time", F.lit(None).cast("timestamp"))
    return ranking.written_places(ranking.order_articles(a).select("uri")).select("uri", "place")


@query("sample_uris", with_fx("articles") + "SELECT uri FROM fx_articles ORDER BY uri LIMIT 3")
def sample_uris(t: Tables) -> DataFrame:
    return ranking.sample_uris(t.fx("articles"))


@query("top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50")
def top_k(t: Tables) -> DataFrame:
    return ranking.top_k(t.raw("orders").select("o_orderkey", "o_totalprice"), "o_totalprice", ["o_orderkey"], 50)


@query("order_nulls_last", with_fx("articles") + f"""
SELECT uri, {sql_ts('date_time_published')} AS ts, row_number() OVER (ORDER BY date_time_published ASC NULLS LAST, uri) AS place FROM fx_articles""")
def order_nulls_last(t: Tables) -> DataFrame:
    ordered = ranking.order_nulls_last(t.fx("articles"), ["date_time_published", "uri"])
    return ranking.written_places(ordered.select("uri", ts_text("date_time_published").alias("ts")))


@query("capped_distinct", with_fx("articles") + """
SELECT DISTINCT event_uri FROM fx_articles WHERE event_uri <> ''""")
def capped_distinct(t: Tables) -> DataFrame:
    return ranking.capped_distinct(t.fx("articles"), "event_uri")


@query("latest", with_fx("articles") + f"""
SELECT uri, {sql_ts('date_time_published')} AS ts FROM fx_articles ORDER BY date_time_published DESC NULLS LAST, uri LIMIT 10""")
def latest(t: Tables) -> DataFrame:
    return ranking.latest(t.fx("articles"), "date_time_published", "uri", 10).select("uri", ts_text("date_time_published").alias("ts"))


@query("fetch_batches", """
WITH n AS (SELECT user_id, row_number() OVER (ORDER BY 'ev-' || user_id) AS rn FROM (SELECT DISTINCT user_id FROM events))
SELECT (rn - 1) // 50 AS batch, count(*) AS n, string_agg('ev-' || user_id, ',' ORDER BY 'ev-' || user_id) AS event_uris FROM n GROUP BY ALL""")
def fetch_batches(t: Tables) -> DataFrame:
    selected = t.raw("events").select(F.concat(F.lit("ev-"), "user_id").alias("event_uri")).distinct()
    return discover.fetch_batches(selected).select("batch", F.size("event_uris").cast("bigint").alias("n"), F.array_join("event_uris", ",").alias("event_uris"))
