"""Queries over scans, payloads, sinks, casts and filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressloom import contracts as C
from pressloom.catalog.base import Tables, query, sql_items, sql_ts, ts_text, with_fx
from pressloom.functions import jsonx, text, times, vectors
from pressloom.operators import casts, discover, merge, metrics, quality
from pressloom.session import work_path
from pressloom.sinks import artifacts, rows
from pressloom.sources import files, manifests, payloads
from pressloom.streaming.arrivals import run_available, stream_manifests

# One run that holds the whole document table.
RUN = {
    "artifact_contract_version": C.ARTICLE_CONTRACT_VERSION, "ingestion_source": C.ARTICLE_INGESTION_SOURCE,
    "run_id": "2026-03-14T00:00:00.000Z", "run_type": "backfill", "nth_run": 1,
    "window_from": "2026-02-14T00:00:00.000Z", "window_to": "2026-03-14T00:00:00.000Z",
    "collected_at": "2026-03-14T00:05:00.000Z",
}


def staged_articles(t: Tables) -> DataFrame:
    """The articles as the all-text table an artifact holds."""
    a = t.fx("articles")
    given = {
        "uri": F.col("uri"), "url": F.col("url"), "title": F.col("title"), "body": F.col("body"),
        "lang": F.col("lang"), "event_uri": F.coalesce("event_uri", F.lit("")),
        "date_time_published": F.coalesce(times.iso_text("date_time_published"), F.lit("")),
        "date": F.coalesce(F.date_format("date_time_published", "yyyy-MM-dd"), F.lit("")),
        "time": F.coalesce(F.date_format("date_time_published", "HH:mm:ss"), F.lit("")),
        "is_duplicate": F.when(F.col("lang") == "en", "TRUE").when(F.col("lang") == "fr", "false").otherwise("yes"),
        "sentiment": (F.length("body") / 1000.0).cast("string"), "relevance": F.length("title").cast("string"),
        "wgt": (F.lit(3_000_000_000) + F.col("doc_id")).cast("string"), "data_type": F.lit("news"),
        "source": F.col("source"), "concepts": F.col("concepts"), "categories": F.col("categories"),
        "location": F.col("location"), "authors": F.lit("[]"), "run_type": F.col("run_type"),
        "nth_run": F.col("nth_run").cast("string"),
    }
    blank = {c: F.lit("null") if c in C.ARTICLE_JSON_COLUMNS else F.lit("") for c in C.ARTICLE_COLUMNS}
    return a.select(*[{**blank, **given}[c].alias(c) for c in C.ARTICLE_COLUMNS])


def api_articles(t: Tables) -> DataFrame:
    """The articles as VARIANT rows with the API's field names."""
    a = t.fx("articles").select(
        "uri", "url", "title", "body", "lang", F.col("event_uri").alias("eventUri"),
        times.iso_text("date_time_published").alias("dateTimePub"),
        F.parse_json(F.nullif("source", F.lit(""))).alias("source"),
        F.parse_json(F.nullif("concepts", F.lit(""))).alias("concepts"),
        F.parse_json("categories").alias("categories"),
        F.when(F.col("lang") == "de", F.length("title")).alias("shares"),
        F.length("body").alias("socialScore"),
    )
    return a.select(F.parse_json(F.to_json(F.struct("*"))).alias("article"))


def headline_payloads(t: Tables) -> DataFrame:
    d = t.raw("documents")
    record = F.struct(
        F.struct(F.when(F.col("lang") != "en", F.col("source")).alias("id"), F.upper("source").alias("name")).alias("source"),
        F.concat(F.lit("http://h/"), F.col("doc_id")).alias("url"), F.substring("text", 1, 80).alias("title"),
        F.col("text").alias("content"), F.lit("2026-03-14T00:00:00Z").alias("publishedAt"),
    )
    return d.select(F.parse_json(F.to_json(record)).alias("article"))


_CSV_SQL = with_fx("articles") + f"""
SELECT uri, url, title, body, lang, NULLIF(event_uri, '') AS event_uri, NULLIF(source, '') AS source,
  NULLIF(concepts, '') AS concepts, NULLIF(categories, '') AS categories, run_type,
  strftime(date_time_published, '%Y-%m-%dT%H:%M:%S.000Z') AS date_time_published
FROM fx_articles"""
_CSV_COLS = ["uri", "url", "title", "body", "lang", "event_uri", "source", "concepts", "categories", "run_type",
             "date_time_published"]


@query("scan_article_csv", _CSV_SQL)
def scan_article_csv(t: Tables) -> DataFrame:
    run = artifacts.write_run_artifact(staged_articles(t), work_path(t.spark, "articles"), RUN)
    scanned = files.scan_article_csv(t.spark, f"{run}/{C.ARTICLES.data_file}")
    return casts.blanks_to_null(scanned.select(*_CSV_COLS))


def staged_events(t: Tables) -> DataFrame:
    """Events of the articles as the all-text table of an event artifact."""
    e = t.fx("articles").where("event_uri <> ''").groupBy("event_uri").agg(
        F.count("*").alias("n"), F.min("date_time_published").alias("first")
    )
    given = {
        "uri": F.col("event_uri"), "run_type": F.lit("scheduled"), "nth_run": F.lit("1"),
        "total_article_count": F.col("n").cast("string"),
        "event_date": F.coalesce(F.date_format("first", "yyyy-MM-dd"), F.lit("")),
        "title": F.concat(F.lit('{"eng":"Event, '), F.col("event_uri"), F.lit('"}')),
        "sentiment": (F.col("n") / 8).cast("string"), "wgt": F.lit("5"),
    }
    blank = {c: F.lit("null") if c in C.EVENT_JSON_COLUMNS else F.lit("") for c in C.EVENT_COLUMNS}
    return e.select(*[{**blank, **given}[c].alias(c) for c in C.EVENT_COLUMNS])


_EVENT_SQL = with_fx("articles") + """
SELECT event_uri AS uri, CAST(count(*) AS VARCHAR) AS total_article_count,
  strftime(min(date_time_published), '%Y-%m-%d') AS event_date, '{"eng":"Event, ' || event_uri || '"}' AS title,
  CAST(NULL AS VARCHAR) AS social_score, 'null' AS concepts
FROM fx_articles WHERE event_uri <> '' GROUP BY event_uri"""


@query("scan_event_csv", _EVENT_SQL)
def scan_event_csv(t: Tables) -> DataFrame:
    run = artifacts.write_run_artifact(staged_events(t), work_path(t.spark, "events"), RUN, C.EVENTS)
    scanned = files.scan_event_csv(t.spark, f"{run}/{C.EVENTS.data_file}")
    return casts.blanks_to_null(scanned.select("uri", "total_article_count", "event_date", "title", "social_score", "concepts"))


_HEADLINE_SQL = r"""
SELECT CASE WHEN lang <> 'en' THEN source END AS source_id, upper(source) AS source_name,
  'http://h/' || doc_id AS url, regexp_replace(substr(text, 1, 80), '\r\n|\r|\n', ' ', 'g') AS title,
  regexp_replace(text, '\r\n|\r|\n', ' ', 'g') AS content, '2026-03-14T00:00:00Z' AS published_at,
  CAST(NULL AS VARCHAR) AS author, CAST(NULL AS VARCHAR) AS description, CAST(NULL AS VARCHAR) AS url_to_image
FROM documents"""


@query("scan_headline_csv", _HEADLINE_SQL)
def scan_headline_csv(t: Tables) -> DataFrame:
    staged = rows.to_headline_row(headline_payloads(t))
    run = artifacts.write_run_artifact(staged, work_path(t.spark, "headlines"), RUN, C.HEADLINES)
    return casts.blanks_to_null(files.scan_headline_csv(t.spark, f"{run}/{C.HEADLINES.data_file}"))


@query("to_headline_row", r"""
SELECT CASE WHEN lang <> 'en' THEN source ELSE '' END AS source_id, upper(source) AS source_name,
  'http://h/' || doc_id AS url, substr(text, 1, 80) AS title, text AS content, '2026-03-14T00:00:00Z' AS published_at,
  '' AS author, '' AS description, '' AS url_to_image
FROM documents""")
def to_headline_row(t: Tables) -> DataFrame:
    return rows.to_headline_row(headline_payloads(t))


@query("scan_articles_jsonl", with_fx("articles") + """
SELECT uri, url, title, body, lang, event_uri, strftime(date_time_published, '%Y-%m-%dT%H:%M:%S.000Z') AS date_time_published,
  CASE WHEN source <> 'null' THEN source END AS raw_source, '[]' AS authors,
  CAST(CASE WHEN lang = 'de' THEN length(title) ELSE length(body) END AS VARCHAR) AS shares, '2026-03-14T00:00:00.000Z' AS run_id
FROM fx_articles""")
def scan_articles_jsonl(t: Tables) -> DataFrame:
    path = work_path(t.spark, "jsonl")
    rows.to_article_json_record(api_articles(t), RUN).write.text(path)
    scanned = files.scan_articles_jsonl(t.spark, path)
    # A JSON text value loses its quotes in a text column; canonical form restores objects.
    source = F.when(F.col("source").startswith("{"), jsonx.canonical_json("source")).otherwise(
        F.concat(F.lit('"'), F.col("source"), F.lit('"')))
    return scanned.select(*[c for c in _CSV_COLS if c not in ("source", "concepts", "categories", "run_type")],
                          source.alias("raw_source"), "authors", "shares", "run_id")


def _manifest(t: Tables) -> DataFrame:
    return artifacts.build_manifest(
        staged_articles(t), **{k: v for k, v in RUN.items() if k != "artifact_contract_version"},
        collector_mode="date_window", cycle_hours=24, page_size=C.PAGE_SIZE, max_pages=C.MAX_PAGES, lang="eng",
    )


def _manifest_file(t: Tables) -> str:
    root = work_path(t.spark, "manifests")
    folder = artifacts.run_dir(root, RUN)
    artifacts.write_row_json(_manifest(t), f"{folder}/{C.ARTICLES.manifest_file}")
    artifacts.write_text_file(t.spark, f"{folder}/old-manifest.json", "{}")
    return root


_MANIFEST_SQL = f"""
SELECT '{C.ARTICLE_CONTRACT_VERSION}' AS artifact_contract_version, '{C.ARTICLE_INGESTION_SOURCE}' AS ingestion_source,
  '{RUN["run_id"]}' AS run_id, 'backfill' AS run_type, 1 AS nth_run, count(*) AS articles_fetched,
  count(DISTINCT doc_id) AS articles_deduped, 500 AS max_pages FROM documents"""
_MANIFEST_COLS = ["artifact_contract_version", "ingestion_source", "run_id", "run_type", "nth_run",
                  "articles_fetched", "articles_deduped", "max_pages"]


@query("scan_manifest", _MANIFEST_SQL)
def scan_manifest(t: Tables) -> DataFrame:
    found = manifests.scan_manifests(t.spark, _manifest_file(t))
    return manifests.validate_manifest(found).select(*_MANIFEST_COLS)


@query("stream_manifests", _MANIFEST_SQL)
def stream_manifest_files(t: Tables) -> DataFrame:
    out = work_path(t.spark, "arrived")
    run_available(
        stream_manifests(t.spark, _manifest_file(t)), work_path(t.spark, "stream"),
        lambda batch, i: batch.select(*_MANIFEST_COLS).write.mode("overwrite").parquet(f"{out}/batch={i}"),
    )
    return t.spark.read.parquet(out).select(*_MANIFEST_COLS)


@query("build_manifest", with_fx("articles") + f"""
SELECT '{C.ARTICLE_CONTRACT_VERSION}' AS artifact_contract_version, ingestion_source, {sql_ts('run_id')} AS run_id, run_type, nth_run,
  count(*) AS articles_fetched, count(DISTINCT uri) AS articles_deduped
FROM fx_articles GROUP BY ALL""")
def build_manifest(t: Tables) -> DataFrame:
    return artifacts.build_manifest(t.fx("articles"), by=C.RUN_KEY).withColumn("run_id", ts_text("run_id"))


@query("latest_run", with_fx("articles") + f"""
SELECT ingestion_source, {sql_ts('run_id')} AS run_id, run_type, nth_run, count(*) AS articles_fetched
FROM fx_articles GROUP BY ALL ORDER BY run_id DESC, ingestion_source DESC, run_type DESC LIMIT 1""")
def latest_run(t: Tables) -> DataFrame:
    every = artifacts.build_manifest(t.fx("articles"), by=C.RUN_KEY)
    return manifests.latest_run(every, by="run_id").select(
        "ingestion_source", ts_text("run_id").alias("run_id"), "run_type", "nth_run", "articles_fetched")


@query("resolve_parent_run", with_fx("runs") + f"""
SELECT {sql_ts('run_id')} AS run_id, ingestion_source, run_type, CAST(count(*) AS INT) AS nth_run
FROM fx_runs GROUP BY run_id, ingestion_source, run_type ORDER BY max(created_at) DESC LIMIT 1""")
def resolve_parent_run(t: Tables) -> DataFrame:
    reports = t.fx("runs").groupBy("run_id", "ingestion_source", "run_type").agg(
        F.count("*").cast("int").alias("nth_run"), F.max("created_at").alias("modified_at"),
        F.lit("loaded").alias("pipeline_status"),
    )
    return manifests.resolve_parent_run(reports).withColumn("run_id", ts_text("run_id"))


def _body(uri: Column) -> Column:
    return F.to_json(F.struct(uri.alias("uri"), F.col("text").alias("body")))


@query("flatten_article_payload", """
WITH shaped AS (SELECT doc_id, text, doc_id % 5 AS shape FROM documents)
SELECT doc_id, 'doc-' || doc_id AS uri, text AS body, 0 AS position FROM shaped WHERE shape < 4
UNION ALL SELECT doc_id, 'copy-' || doc_id, text, 1 FROM shaped WHERE shape IN (1, 3)""")
def flatten_article_payload(t: Tables) -> DataFrame:
    d = t.raw("documents")
    a = _body(F.concat(F.lit("doc-"), "doc_id"))
    b = _body(F.concat(F.lit("copy-"), "doc_id"))
    two = F.concat(F.lit("["), a, F.lit(","), b, F.lit("]"))
    shape = F.col("doc_id") % 5
    payload = (
        F.when(shape == 0, F.concat(F.lit('{"results":[],"article":'), a, F.lit("}")))
        .when(shape == 1, F.concat(F.lit('{"article":null,"articles":'), two, F.lit("}")))
        .when(shape == 2, F.concat(F.lit('{"articles":{"pages":1,"results":['), a, F.lit("]}}")))
        .when(shape == 3, F.concat(F.lit('{"results":'), two, F.lit("}")))
        .otherwise(F.lit('{"error":"no articles"}'))
    )
    flat = payloads.flatten_article_payload(d.select("doc_id", payload.alias("payload")))
    return flat.select("doc_id", jsonx.text_at(F.col("article"), "uri").alias("uri"),
                       jsonx.text_at(F.col("article"), "body").alias("body"), "position")


@query("split_get_article_response", """
SELECT 'doc-' || doc_id AS requested_uri, 'article' AS kind, text AS detail FROM documents
UNION ALL SELECT 'gone-' || doc_id, 'error', 'not found: ' || lang FROM documents""")
def split_get_article_response(t: Tables) -> DataFrame:
    d = t.raw("documents")
    info = F.to_json(F.struct(F.col("text").alias("body")))
    payload = F.concat(
        F.lit('{"doc-'), "doc_id", F.lit('":{"error":"stale","info":'), info, F.lit('},"gone-'), "doc_id",
        F.lit('":{"error":"not found: '), "lang", F.lit('"},"none-'), "doc_id", F.lit('":{"info":null}}'),
    )
    articles, errors = payloads.split_get_article_response(d.select(payload.alias("payload")))
    good = articles.select("requested_uri", F.lit("article").alias("kind"), jsonx.text_at(F.col("article"), "body").alias("detail"))
    return good.unionByName(errors.select("requested_uri", F.lit("error").alias("kind"), F.col("error").alias("detail")))


def _keyed_payloads(t: Tables) -> DataFrame:
    """Events keyed by uri; some fields lie outside ``info``, some inside, some in both."""
    d = t.raw("documents")
    outer = F.struct(
        F.struct(
            F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("own-"), "doc_id")).when(F.col("doc_id") % 3 == 1, "").alias("uri"),
            F.col("text").alias("summary"), F.lit("2026-02-14").alias("eventDate"), F.col("lang").alias("note"),
            F.lit(1).alias("wgt"),
        ).alias("info"),
        F.when(F.col("lang") == "en", 7).alias("wgt"), F.col("n_chars").alias("totalArticleCount"),
    )
    key = F.concat(F.lit("eng-"), "doc_id")
    payload = F.concat(F.lit('{"'), key, F.lit('":'), F.to_json(outer), F.lit(',"nokey":{"wgt":1},"bad-key":"text"}'))
    return d.select("doc_id", payload.alias("payload"))


@query("flatten_event_payload", """
SELECT doc_id, CASE WHEN doc_id % 5 = 4 THEN CASE WHEN doc_id % 3 = 0 THEN 'own-' ELSE 'eng-' END ELSE 'ev-' END || doc_id AS uri
FROM documents
UNION ALL SELECT doc_id, 'copy-' || doc_id FROM documents WHERE doc_id % 5 IN (1, 3)""")
def flatten_event_payload(t: Tables) -> DataFrame:
    keyed = _keyed_payloads(t)
    a = F.concat(F.lit('{"uri":"ev-'), "doc_id", F.lit('"}'))
    two = F.concat(F.lit("["), a, F.lit(',{"uri":"copy-'), "doc_id", F.lit('"}]'))
    shape = F.col("doc_id") % 5
    payload = (
        F.when(shape == 0, F.concat(F.lit('{"event":'), a, F.lit("}")))
        .when(shape == 1, F.concat(F.lit('{"events":'), two, F.lit("}")))
        .when(shape == 2, F.concat(F.lit('{"events":{"results":['), a, F.lit("]}}")))
        .when(shape == 3, F.concat(F.lit('{"results":'), two, F.lit("}")))
        .otherwise(F.col("payload"))
    )
    flat = payloads.flatten_event_payload(keyed.withColumn("payload", payload))
    return flat.select("doc_id", jsonx.text_at(F.col("event"), "uri").alias("uri"))


@query("normalize_keyed_event", """
SELECT CASE WHEN doc_id % 3 = 0 THEN 'own-' ELSE 'eng-' END || doc_id AS uri, text AS summary, '2026-02-14' AS event_date,
  CASE WHEN lang = 'en' THEN '7' ELSE '1' END AS wgt, CAST(n_chars AS VARCHAR) AS total_article_count, lang AS note,
  'null' AS concepts
FROM documents""")
def normalize_keyed_event(t: Tables) -> DataFrame:
    v = F.col("event")
    return payloads.flatten_event_payload(_keyed_payloads(t)).select(
        *[jsonx.text_at(v, f).alias(a) for f, a in (
            ("uri", "uri"), ("summary", "summary"), ("eventDate", "event_date"), ("wgt", "wgt"),
            ("totalArticleCount", "total_article_count"), ("note", "note"))],
        jsonx.json_at(v, "concepts").alias("concepts"),
    )


_URI_LIST_SQL = """
SELECT doc_id, 0 AS position, 'doc-' || doc_id AS uri FROM documents
UNION ALL SELECT doc_id, 1, source FROM documents"""


def _requests(t: Tables) -> DataFrame:
    listed = F.to_json(F.array(
        F.concat(F.lit("doc-"), "doc_id"), F.concat(F.lit("  doc-"), "doc_id", F.lit(" ")), F.lit(""), F.lit(" "),
        F.col("source"),
    ))
    return t.raw("documents").select("doc_id", listed.alias("uris"))


@query("read_uri_list", _URI_LIST_SQL)
def read_uri_list(t: Tables) -> DataFrame:
    return payloads.read_uri_list(_requests(t))


@query("missing_uris", """
SELECT doc_id, 0 AS position, 'doc-' || doc_id AS uri FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def missing_uris(t: Tables) -> DataFrame:
    requested = payloads.read_uri_list(_requests(t)).where("position = 0")
    found = t.raw("labels").select(F.concat(F.lit("doc-"), "doc_id").alias("uri"))
    return discover.missing_uris(requested, found)


@query("set_difference", """
SELECT 'doc-' || doc_id AS uri FROM documents EXCEPT SELECT 'doc-' || doc_id FROM labels""")
def set_difference(t: Tables) -> DataFrame:
    uri = F.concat(F.lit("doc-"), "doc_id").alias("uri")
    return discover.without(t.raw("documents").select(uri), t.raw("labels").select(uri))


@query("missing_uri_report", """
WITH asked AS (SELECT d.doc_id, d.source, l.doc_id IS NULL AS lost FROM documents d LEFT JOIN labels l USING (doc_id))
SELECT doc_id, 2 AS requested_article_uri_count, CASE WHEN lost THEN 2 ELSE 1 END AS missing_article_uri_count,
  CASE WHEN lost THEN 'doc-' || doc_id || '|' ELSE '' END || source AS missing FROM asked""")
def missing_uri_report(t: Tables) -> DataFrame:
    found = t.raw("labels").select("doc_id", F.concat(F.lit("doc-"), "doc_id").alias("uri"))
    report = metrics.missing_uri_report(payloads.read_uri_list(_requests(t)), found, ["doc_id"])
    return report.select("doc_id", "requested_article_uri_count", "missing_article_uri_count",
                         F.concat_ws("|", "missing_article_uris").alias("missing"))


@query("seed_headlines", """
SELECT 'http://h/' || doc_id AS url, CASE WHEN lang = 'en' THEN 'kept' ELSE source END AS source_id,
  CASE WHEN lang = 'en' THEN 'old' ELSE text END AS title FROM documents""")
def seed_headlines(t: Tables) -> DataFrame:
    d = t.raw("documents").withColumn("url", F.concat(F.lit("http://h/"), "doc_id"))
    target = d.where("lang = 'en'").select("url", F.lit("kept").alias("source_id"), F.lit("old").alias("title"),
                                           F.lit("2026-01-01").cast("timestamp").alias("published_at"))
    seed = d.select(F.col("source").alias("id"), "url", F.col("text").alias("title"),
                    F.lit("2026-02-01 00:00:00").alias("published_at"))
    return files.seed_headlines(target, seed).select("url", "source_id", "title")


_RUN_DIR_SQL = with_fx("articles")


@query("landing_partitions", _RUN_DIR_SQL + """
SELECT DISTINCT ingestion_source, strftime(run_id, '%Y-%m-%dT%H-%M-%S.000Z') AS run_id, run_type, CAST(nth_run AS VARCHAR) AS nth_run
FROM fx_articles""")
def landing_partitions(t: Tables) -> DataFrame:
    root = work_path(t.spark, "landing")
    keyed = t.fx("articles").select(*C.RUN_KEY, "uri", "body").withColumn("run_id", times.iso_text("run_id"))
    artifacts.write_runs_partitioned(keyed, root)
    return manifests.landing_partitions(t.spark, root, "*.json").select(*C.RUN_KEY)


@query("write_run_artifact", _RUN_DIR_SQL + """
SELECT ingestion_source, strftime(run_id, '%Y-%m-%dT%H-%M-%S.000Z') AS run_id, run_type, nth_run, uri, body
FROM fx_articles""")
def write_run_artifact(t: Tables) -> DataFrame:
    root = work_path(t.spark, "runs")
    keyed = t.fx("articles").select(*C.RUN_KEY, "uri", "body").withColumn("run_id", times.iso_text("run_id"))
    artifacts.write_runs_partitioned(keyed, root)
    back = t.spark.read.schema(keyed.schema).json(root)
    return back.select(*C.RUN_KEY, "uri", "body")


@query("csv_encode", r"""
WITH cells AS (SELECT doc_id, source, replace(text, '"', '""') AS doubled, text FROM documents)
SELECT doc_id, 'doc-' || doc_id || ',' || source || ',' ||
  CASE WHEN regexp_matches(text, '[",\r\n]') THEN '"' || doubled || '"' ELSE text END || ',' AS line
FROM cells""")
def csv_encode(t: Tables) -> DataFrame:
    d = t.raw("documents").select("doc_id", F.concat(F.lit("doc-"), "doc_id").alias("uri"), "source", "text",
                                  F.lit(None).cast("string").alias("empty"))
    return d.select("doc_id", text.csv_line(["uri", "source", "text", "empty"]).alias("line"))


@query("to_article_csv_row", with_fx("articles") + """
SELECT uri, 'backfill' AS run_type, '1' AS nth_run, title, body, coalesce(event_uri, '') AS event_uri,
  coalesce(strftime(date_time_published, '%Y-%m-%dT%H:%M:%S.000Z'), '') AS date_time_published,
  '[]' AS authors, source, CASE WHEN concepts IN ('', 'null') THEN 'null' ELSE concepts END AS concepts,
  CAST(CASE WHEN lang = 'de' THEN length(title) ELSE length(body) END AS VARCHAR) AS shares, 'null' AS videos
FROM fx_articles""")
def to_article_csv_row(t: Tables) -> DataFrame:
    return rows.to_article_csv_row(api_articles(t), "backfill", 1).select(
        "uri", "run_type", "nth_run", "title", "body", "event_uri", "date_time_published", "authors", "source",
        "concepts", "shares", "videos")


@query("to_event_csv_row", """
SELECT CASE WHEN doc_id % 3 = 0 THEN 'own-' ELSE 'eng-' END || doc_id AS uri, CAST(n_chars AS VARCHAR) AS total_article_count,
  '2026-02-14' AS event_date, CASE WHEN lang = 'en' THEN '7' ELSE '1' END AS wgt, 'null' AS concepts,
  text AS summary, 'scheduled' AS run_type, '2' AS nth_run, '' AS sentiment
FROM documents""")
def to_event_csv_row(t: Tables) -> DataFrame:
    flat = payloads.flatten_event_payload(_keyed_payloads(t))
    staged = rows.to_event_csv_row(flat, "scheduled", 2)
    plain = F.try_variant_get(F.parse_json("summary"), "$", "string")
    return staged.select("uri", "total_article_count", "event_date", "wgt", "concepts", plain.alias("summary"),
                         "run_type", "nth_run", "sentiment")


_POPULATED = "count(*) FILTER (WHERE {0} IS NOT NULL AND {0} NOT IN ('', 'null'))"
_DIAG_SQL = f"""count(*) AS rows_in_artifact, {sql_ts('min(date_time_published)')} AS min_date_time_published,
  {sql_ts('max(date_time_published)')} AS max_date_time_published,
  {_POPULATED.format('source')} AS source_count, {_POPULATED.format('concepts')} AS concepts_count,
  {_POPULATED.format('categories')} AS categories_count, {_POPULATED.format('location')} AS location_count,
  count(*) AS authors_count, count(*) FILTER (WHERE doc_id % 2 = 0) AS links_count, count(*) FILTER (WHERE doc_id % 3 = 0) AS videos_count,
  count(*) FILTER (WHERE doc_id % 4 = 0) AS shares_count, count(*) FILTER (WHERE lang = 'en') AS duplicate_list_count,
  count(*) FILTER (WHERE doc_id % 5 = 0) AS extracted_dates_count, count(*) FILTER (WHERE lang <> 'en') AS original_article_count,
  count(*) FILTER (WHERE doc_id % 6 > 0) AS raw_article_count"""
_DIAG_COLS = [f"{c}_count" for c in C.ARTICLE_JSON_COLUMNS]


def diagnosed_articles(t: Tables) -> DataFrame:
    """The staged articles with every JSON column filled in some rows and null, 'null' or blank in the others."""
    i, english = F.col("uri").substr(F.lit(5), F.lit(20)).cast("bigint"), F.col("lang") == "en"
    filled = {"links": i % 2 == 0, "videos": i % 3 == 0, "shares": i % 4 == 0, "duplicate_list": english, "extracted_dates": i % 5 == 0,
              "original_article": ~english, "raw_article": i % 6 > 0}
    nothing = F.when(i % 7 == 0, F.lit("null")).when(i % 7 < 4, F.lit(""))
    return staged_articles(t).withColumns({c: F.when(test, F.lit('[{"a":1}]')).otherwise(nothing) for c, test in filled.items()})


@query("article_diagnostics", with_fx("articles") + f"SELECT {_DIAG_SQL} FROM fx_articles")
def article_diagnostics(t: Tables) -> DataFrame:
    d = metrics.article_diagnostics(diagnosed_articles(t))
    return d.select("rows_in_artifact", ts_text("min_date_time_published").alias("min_date_time_published"),
                    ts_text("max_date_time_published").alias("max_date_time_published"), *_DIAG_COLS)


@query("event_diagnostics", with_fx("articles") + """,
ev AS (SELECT event_uri, min(date_time_published) AS first, length(event_uri) AS k, right(event_uri, 1) AS z FROM fx_articles WHERE event_uri <> '' GROUP BY event_uri)
SELECT count(*) AS rows_in_artifact, strftime(min(first), '%Y-%m-%d') AS min_event_date, strftime(max(first), '%Y-%m-%d') AS max_event_date,
  count(*) AS title_count, """ + ",\n  ".join(f"count(*) FILTER (WHERE {test}) AS {c}_count" for c, test in (
    ("article_counts", "k = 5"), ("summary", "k = 6"), ("concepts", "z = '1'"), ("categories", "z > '1'"), ("common_dates", "z > '2'"),
    ("location", "z > '3'"), ("stories", "z > '4'"), ("images", "z > '5'"), ("raw_event", "z > '6'"))) + " FROM ev")
def event_diagnostics(t: Tables) -> DataFrame:
    """Every JSON column is filled in some rows and null, 'null' or blank in the others."""
    k, z = F.length("uri"), F.right(F.col("uri"), F.lit(1))
    filled = {"article_counts": k == 5, "summary": k == 6, "concepts": z == "1",
              **{c: z > str(i + 1) for i, c in enumerate(["categories", "common_dates", "location", "stories", "images", "raw_event"])}}
    nothing = F.when(z < "3", F.lit("null")).when(z < "6", F.lit(""))
    staged = staged_events(t).withColumns({c: F.when(test, F.lit('{"a":1}')).otherwise(nothing) for c, test in filled.items()})
    d = metrics.event_diagnostics(staged)
    return d.select("rows_in_artifact", F.col("min_event_date").cast("string").alias("min_event_date"),
                    F.col("max_event_date").cast("string").alias("max_event_date"), *[f"{c}_count" for c in C.EVENT_JSON_COLUMNS])


@query("artifact_counts", with_fx("articles") + """
SELECT count(*) AS rows_in_artifact, count(*) FILTER (WHERE event_uri IS NOT NULL AND event_uri <> '') AS rows_attempted FROM fx_articles""")
def artifact_counts(t: Tables) -> DataFrame:
    return metrics.artifact_counts(t.fx("articles"), "event_uri")


@query("load_report", with_fx("articles") + f""",
target AS (SELECT * FROM fx_articles WHERE lang IN ('en', 'fr')), staged AS (SELECT * FROM fx_articles WHERE lang <> 'en')
SELECT s.rows_in_artifact, m.rows_loaded, m.db_rows_unchanged, s.min_date_time_published,
  (SELECT string_agg(uri, '|' ORDER BY uri) FROM (SELECT uri FROM staged ORDER BY uri LIMIT 3)) AS samples,
  s.source_count, CAST(60000 AS BIGINT) AS duration_ms, 'loaded' AS pipeline_status
FROM (SELECT {_DIAG_SQL} FROM staged) s,
  (SELECT count(*) FILTER (WHERE t.uri IS NULL) AS rows_loaded, count(*) FILTER (WHERE t.uri IS NOT NULL) AS db_rows_unchanged
   FROM staged LEFT JOIN target t USING (uri)) m""")
def load_report(t: Tables) -> DataFrame:
    everything = t.fx("articles").select("uri", "title", "body", "source", "lang")
    target, batch = everything.where("lang IN ('en', 'fr')"), everything.where("lang <> 'en'")
    counts = merge.merge_counts(merge.merge_changed(target, batch, ["uri"], ["title", "body", "source", "lang"]))
    staged = staged_articles(t).where("lang <> 'en'")
    samples = staged.select("uri").orderBy("uri").limit(3)
    measured = metrics.event_load_metrics(counts)
    report = metrics.load_report({"run_id": RUN["run_id"]}, counts, metrics.article_diagnostics(staged), samples, measured,
                                 "2026-03-14 00:10:00", "2026-03-14 00:11:00")
    return report.select(
        "rows_in_artifact", "rows_loaded", "db_rows_unchanged", ts_text("min_date_time_published").alias("min_date_time_published"),
        F.concat_ws("|", "sample_uris").alias("samples"), F.col("populated_counts.source").alias("source_count"),
        "duration_ms", "pipeline_status")


@query("refresh_enriched", with_fx("enriched") + """
SELECT source_name, topic_label, count(*) AS stories FROM fx_enriched GROUP BY ALL""")
def refresh_enriched(t: Tables) -> DataFrame:
    path = work_path(t.spark, "enriched")
    full = t.fx("enriched")
    artifacts.refresh_table(full.where("lang = 'en'"), path)
    artifacts.refresh_table(full, path)
    return t.spark.read.parquet(path).groupBy("source_name", "topic_label").agg(F.count("*").alias("stories"))


# --- casts and filters ------------------------------------------------------------------


@query("blank_to_null", with_fx("articles") + """
SELECT uri, NULLIF(event_uri, '') AS event_uri, NULLIF(concepts, '') AS concepts, NULLIF(location, '') AS location FROM fx_articles""")
def blank_to_null(t: Tables) -> DataFrame:
    return casts.blanks_to_null(t.fx("articles").select("uri", "event_uri", "concepts", "location"))


@query("cast_articles", with_fx("articles") + f"""
SELECT uri, strftime(date_time_published, '%Y-%m-%d') AS date, strftime(date_time_published, '%H:%M:%S') AS time,
  {sql_ts('date_time_published')} AS date_time_published, CASE lang WHEN 'en' THEN true WHEN 'fr' THEN false END AS is_duplicate,
  round(length(body) / 1000.0, 6) AS sentiment, CAST(length(title) AS INT) AS relevance, 3000000000 + doc_id AS wgt,
  NULLIF(source, '') AS source, NULLIF(concepts, '') AS concepts, run_type, nth_run, '2026-03-14 00:00:00' AS run_id
FROM fx_articles""")
def cast_articles(t: Tables) -> DataFrame:
    typed = casts.cast_articles(staged_articles(t), {**RUN, "run_type": "scheduled", "nth_run": 9})
    return typed.select(
        "uri", F.col("date").cast("string").alias("date"), "time", ts_text("date_time_published").alias("date_time_published"),
        "is_duplicate", F.round("sentiment", 6).alias("sentiment"), "relevance", "wgt", "source", "concepts", "run_type",
        "nth_run", ts_text("run_id").alias("run_id"))


@query("cast_events", with_fx("articles") + """
SELECT event_uri AS uri, CAST(count(*) AS INT) AS total_article_count, strftime(min(date_time_published), '%Y-%m-%d') AS event_date,
  '{"eng":"Event, ' || event_uri || '"}' AS title, count(*) / 8 AS sentiment, 5 AS wgt
FROM fx_articles WHERE event_uri <> '' GROUP BY event_uri""")
def cast_events(t: Tables) -> DataFrame:
    typed = casts.cast_events(staged_events(t))
    return typed.select("uri", "total_article_count", F.col("event_date").cast("string").alias("event_date"), "title",
                        "sentiment", "wgt")


@query("cast_headlines", """
SELECT 'http://h/' || doc_id AS url, CASE WHEN lang <> 'en' THEN source END AS source_id, text AS content,
  '2026-03-14 00:00:00' AS published_at, '""" + C.HEADLINE_INGESTION_SOURCES[0] + """' AS ingestion_source
FROM documents""")
def cast_headlines(t: Tables) -> DataFrame:
    run = {"ingestion_source": C.HEADLINE_INGESTION_SOURCES[0], "run_id": RUN["run_id"], "collected_at": RUN["collected_at"]}
    typed = casts.cast_headlines(rows.to_headline_row(headline_payloads(t)), run)
    return typed.select("url", "source_id", "content", ts_text("published_at").alias("published_at"), "ingestion_source")


@query("cast_quarantine", """
SELECT 'doc-' || doc_id AS uri, CASE WHEN lang = 'en' THEN CAST(n_chars AS INT) END AS relevance,
  CASE WHEN lang = 'fr' THEN NULL ELSE '{"n":1}' END AS source,
  CASE WHEN lang = 'fr' THEN 'relevance|source' WHEN lang <> 'en' THEN 'relevance' ELSE '' END AS rejects
FROM documents""")
def cast_quarantine(t: Tables) -> DataFrame:
    d = staged_articles(t).withColumn("relevance", F.when(F.col("lang") == "en", F.length("body").cast("string")).otherwise("1.5"))
    d = d.withColumn("source", F.when(F.col("lang") == "fr", '{"n":').otherwise('{ "n" : 1.0 }'))
    typed = casts.cast_articles(d, mode="quarantine")
    chars = t.raw("documents").select(F.concat(F.lit("doc-"), "doc_id").alias("uri"), "n_chars")
    return typed.join(chars, "uri").select(
        "uri", F.when(F.col("relevance").isNotNull(), F.col("n_chars").cast("int")).alias("relevance"), "source",
        F.concat_ws("|", F.array_sort("_rejects")).alias("rejects"))


@query("parse_flag", """
SELECT event_id, CASE event_type WHEN 'error' THEN true WHEN 'click' THEN false END AS flag FROM events""")
def parse_flag(t: Tables) -> DataFrame:
    raw = F.when(F.col("event_type") == "error", "True").when(F.col("event_type") == "click", "FALSE").otherwise(F.col("event_type"))
    return t.raw("events").select("event_id", text.parse_flag(raw).alias("flag"))


@query("fallback_lineage", with_fx("articles") + """
SELECT uri, coalesce(NULLIF(event_uri, ''), 'from manifest') AS event_uri FROM fx_articles""")
def fallback_lineage(t: Tables) -> DataFrame:
    return t.fx("articles").select("uri", text.fallback_lineage("event_uri", "from manifest").alias("event_uri"))


@query("is_populated", with_fx("articles") + """
SELECT uri, concepts NOT IN ('', 'null') AS concepts, source NOT IN ('', 'null') AS source,
  coalesce(event_uri NOT IN ('', 'null'), false) AS event_uri FROM fx_articles""")
def is_populated(t: Tables) -> DataFrame:
    return t.fx("articles").select("uri", *[text.is_populated(c).alias(c) for c in ("concepts", "source", "event_uri")])


@query("valid_key", with_fx("articles") + "SELECT uri, event_uri FROM fx_articles WHERE event_uri IS NOT NULL AND event_uri <> ''")
def valid_key(t: Tables) -> DataFrame:
    return casts.valid_key(t.fx("articles"), "event_uri").select("uri", "event_uri")


@query("changed", with_fx("target", "staged") + """
SELECT uri, t.status IS DISTINCT FROM s.status OR t.price IS DISTINCT FROM s.price OR t.label IS DISTINCT FROM s.label AS changed
FROM fx_target t JOIN fx_staged s USING (uri)""")
def changed(t: Tables) -> DataFrame:
    joined = t.fx("target").alias("t").join(t.fx("staged").alias("s"), "uri")
    return joined.select("uri", merge.changed(["status", "price", "label"]).alias("changed"))


@query("check_violations", with_fx("anomalies") + """
SELECT anomaly_id, 'severity' AS rule FROM fx_anomalies WHERE severity NOT IN ('Low', 'Medium', 'High', 'Critical')
UNION ALL SELECT event_id, 'window' FROM events WHERE NOT ts < date_trunc('day', ts) + to_hours(CAST(20 AS INT))""")
def check_violations(t: Tables) -> DataFrame:
    bad = quality.check_violations(t.fx("anomalies"), quality.rules_for("anomalies")).select("anomaly_id", "rule")
    runs = t.raw("events").select(
        F.col("event_id").alias("anomaly_id"), F.lit("seed").alias("run_type"), F.lit(1).alias("nth_run"), F.lit("loaded").alias("status"),
        F.col("ts").alias("window_from"), (F.date_trunc("day", "ts") + times.hours(20)).alias("window_to"),
        F.lit(3).alias("rows_loaded"), F.lit(2).alias("db_rows_inserted"), F.lit(1).alias("db_rows_updated"))
    return bad.unionByName(quality.check_violations(runs, quality.rules_for("runs")).select("anomaly_id", "rule"))


@query("key_violations", """
SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY ALL HAVING count(*) > 1""")
def key_violations(t: Tables) -> DataFrame:
    return quality.key_violations(t.raw("orders"), ["o_custkey", "o_orderpriority"], F.col("o_orderstatus") == "F")


@query("orphans", """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 5)""")
def orphans(t: Tables) -> DataFrame:
    parents = t.raw("part").where("p_size > 5")
    return quality.orphans(t.raw("lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), parents, "l_partkey", "p_partkey")


@query("by_run", with_fx("articles") + """
SELECT uri, title FROM fx_articles WHERE run_id = TIMESTAMP '2026-02-20 00:00:00' AND run_type = 'scheduled' AND nth_run = 1""")
def by_run(t: Tables) -> DataFrame:
    run = {"run_id": times.instant("2026-02-20 00:00:00"), "ingestion_source": C.ARTICLE_INGESTION_SOURCE,
           "run_type": "scheduled", "nth_run": 1}
    return casts.by_run(t.fx("articles"), run).select("uri", "title")


@query("in_window", with_fx("articles") + f"""
SELECT uri, {sql_ts('date_time_published')} AS ts FROM fx_articles
WHERE date_time_published IS NULL OR (date_time_published >= TIMESTAMP '2026-02-16 10:00:00' AND date_time_published < TIMESTAMP '2026-02-18 10:00:00')""")
def in_window(t: Tables) -> DataFrame:
    rows_ = casts.in_window(t.fx("articles"), "2026-02-16 10:00:00", "2026-02-18 10:00:00", ["date_time_published"])
    return rows_.select("uri", ts_text("date_time_published").alias("ts"))


@query("has_tag", with_fx("anomalies") + """
SELECT anomaly_id, 'tag' AS kind FROM fx_anomalies WHERE list_contains(string_split(tags, ','), 'error')
UNION ALL SELECT anomaly_id, 'outlet' FROM fx_anomalies WHERE list_has_any(string_split(outlets, ','), ['outlet-3', 'outlet-21'])""")
def has_tag(t: Tables) -> DataFrame:
    a = t.fx("anomalies").withColumns({"tags": text.clean_list("tags"), "outlets": text.clean_list("outlets")})
    one = casts.has_tag(a, "tags", "error").select("anomaly_id", F.lit("tag").alias("kind"))
    two = casts.tags_overlap(a, "outlets", ["outlet-3", "outlet-21"]).select("anomaly_id", F.lit("outlet").alias("kind"))
    return one.unionByName(two)


@query("json_has_key", with_fx("articles") + """
SELECT uri, lower(CASE json_type(source) WHEN 'VARCHAR' THEN 'string' ELSE json_type(source) END) AS source_type,
  coalesce(json_type(source) = 'OBJECT' AND json_exists(source, '$.uri'), false) AS has_uri,
  coalesce(json_exists(source, '$.ranking'), false) AS has_ranking FROM fx_articles""")
def json_has_key(t: Tables) -> DataFrame:
    v = F.parse_json("source")
    return t.fx("articles").select("uri", jsonx.json_type(v).alias("source_type"), jsonx.has_key(v, "uri").alias("has_uri"),
                                   jsonx.has_key(v, "ranking").alias("has_ranking"))


@query("category_tier", with_fx("articles", more="cx AS (SELECT uri, " + sql_items("categories") + "->>'uri' AS category_uri FROM fx_articles)") + """
SELECT uri, category_uri, string_split(category_uri, '/')[1] AS root,
  CASE string_split(category_uri, '/')[1] WHEN 'news' THEN 'usable' WHEN 'dmoz' THEN 'noisy' ELSE 'unknown' END AS tier FROM cx""")
def category_tier(t: Tables) -> DataFrame:
    exploded = t.fx("articles").select("uri", F.explode(jsonx.items(jsonx.parsed("categories"))).alias("e"))
    return casts.category_tier(exploded.select("uri", jsonx.text_at(F.col("e"), "uri").alias("category_uri")))


@query("recent_by_source", with_fx("articles") + f"""
SELECT uri, {sql_ts('date_time_published')} AS ts FROM fx_articles WHERE source_uri = 'src3.example.com'
ORDER BY date_time_published DESC NULLS LAST, uri LIMIT 50""")
def recent_by_source(t: Tables) -> DataFrame:
    return casts.recent_by_source(t.fx("articles"), "src3.example.com").select("uri", ts_text("date_time_published").alias("ts"))


@query("body_gate", """
WITH m AS (SELECT label, i, avg(CAST(embedding[i] AS DOUBLE)) AS x FROM embeddings, range(1, 65) r(i) GROUP BY ALL),
cen AS (SELECT label, list(x ORDER BY i) AS centroid FROM m GROUP BY label)
SELECT vec_id, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), centroid), 6) AS similarity,
  coalesce(list_cosine_similarity(CAST(embedding AS DOUBLE[]), centroid) >= 0.3, false) AND vec_id % 2 = 0 AS body_valid
FROM embeddings JOIN cen USING (label)""")
def body_gate(t: Tables) -> DataFrame:
    e = t.raw("embeddings")
    centroids = e.groupBy("label").agg(vectors.mean_vector("embedding", 64).alias("centroid"))
    both = e.join(centroids, "label").withColumn("clean", F.col("vec_id") % 2 == 0)
    gated = casts.body_gate(both, 0.3, "embedding", "centroid", "clean")
    return gated.select("vec_id", F.round("body_headline_similarity", 6).alias("similarity"), "body_valid")
