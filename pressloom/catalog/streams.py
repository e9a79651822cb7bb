"""Queries over streams, cycles and the scalar expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressloom import contracts as C
from pressloom.catalog.base import Tables, query, sql_ts, ts_text, with_fx
from pressloom.catalog.intake import RUN, _manifest, staged_articles, staged_events
from pressloom.catalog.merging import _NEW_SOURCE
from pressloom.functions import jsonx, text, times, vectors
from pressloom.operators import discover, topics
from pressloom.plans import views
from pressloom.plans.store import TableStore
from pressloom.schemas import TABLES
from pressloom.session import work_path
from pressloom.sinks import artifacts
from pressloom.streaming import arrivals, cycles

AS_OF = "2026-03-14 01:00:00"


def _land_articles(t: Tables) -> str:
    """The document table as one landed article artifact; returns the landing root."""
    root = work_path(t.spark, "landed")
    folder = artifacts.write_run_artifact(staged_articles(t), root, RUN)
    artifacts.write_row_json(_manifest(t), f"{folder}/{C.ARTICLES.manifest_file}")
    return root


@query("stream_load", with_fx("articles") + f"""
SELECT uri, title, {_NEW_SOURCE} AS source_uri, run_type, '{AS_OF}' AS ingested_at, 'loaded' AS status FROM fx_articles""")
def stream_load(t: Tables) -> DataFrame:
    """Artifact arrival to published tables; the second run finds nothing new."""
    root, store, checkpoint = _land_articles(t), TableStore(t.spark, work_path(t.spark, "store")), work_path(t.spark, "cp")
    for _ in range(2):
        arrivals.stream_load(store, root, checkpoint, AS_OF)
    from pressloom.operators.runs import fold_run_ledger

    status = fold_run_ledger(store.read("run_log"), require_reserved=False).agg(F.max("status")).scalar()
    return store.read("articles").select("uri", "title", "source_uri", "run_type", ts_text("ingested_at").alias("ingested_at"),
                                         status.alias("status"))


@query("stream_chain", with_fx("articles", more="""
own AS (SELECT event_uri FROM fx_articles WHERE event_uri <> '')""") + f"""
SELECT 'event' AS kind, event_uri AS name, count(*) AS n FROM own GROUP BY event_uri
UNION ALL SELECT 'metric', 'events_inserted', count(DISTINCT event_uri) FROM own
UNION ALL SELECT 'metric', 'distinct_event_uris_selected', count(DISTINCT event_uri) FROM own""")
def stream_chain(t: Tables) -> DataFrame:
    """Article load to event discovery to event load; the fetch step is played by the
    event rows derived from the documents."""
    articles = staged_articles(t).withColumns({"run_type": F.lit("backfill"), "nth_run": F.lit("1")})
    root, event_root = work_path(t.spark, "landed"), work_path(t.spark, "landed-events")
    folder = artifacts.write_run_artifact(articles, root, RUN)
    artifacts.write_row_json(_manifest(t), f"{folder}/{C.ARTICLES.manifest_file}")
    store = TableStore(t.spark, work_path(t.spark, "store"))

    def fetch(wanted: DataFrame, report: dict) -> None:
        run = {**RUN, "ingestion_source": C.EVENT_INGESTION_SOURCE}
        rows = staged_events(t).join(wanted.select(F.col("event_uri").alias("uri")), "uri", "left_semi")
        target = artifacts.write_run_artifact(rows.select(*C.EVENT_COLUMNS), event_root, run, C.EVENTS)
        collected = store.read("run_metrics").where("stage = 'event_collect'")
        manifest = artifacts.build_event_manifest(rows, collected, run, run["collected_at"], report)
        artifacts.write_row_json(manifest, f"{target}/{C.EVENTS.manifest_file}")

    arrivals.stream_chain(store, root, event_root, work_path(t.spark, "cp"), AS_OF, fetch)
    events = store.read("events").select(F.lit("event").alias("kind"), F.col("uri").alias("name"),
                                         F.col("total_article_count").cast("bigint").alias("n"))
    wanted = F.col("metric_name").isin("events_inserted", "distinct_event_uris_selected")
    measured = store.read("run_metrics").where(wanted).select(
        F.lit("metric").alias("kind"), F.col("metric_name").alias("name"), F.col("metric_value").alias("n"))
    return events.unionByName(measured)


def fitted(rows: DataFrame, name: str) -> DataFrame:
    """The columns that a published table has, in its types."""
    types = dict(f.simpleString().split(":", 1) for f in rows.sparkSession.createDataFrame([], TABLES[name]).schema)
    return rows.select(*[F.col(c).cast(types[c]).alias(c) for c in rows.columns if c in types])


_REFRESHED = with_fx("articles", "outlets", "validation", "assignments", "topics", "assessments", "scope")


@query("refresh_enriched_deltas", _REFRESHED + f"""
SELECT a.uri AS story_id, a.title, a.body AS content, a.url, v.snippet_clean AS description, {sql_ts('a.date_time_published')} AS published_at,
  o.source_name, v.headline_clean, v.body_valid, v.top_category, g.topic_id, t.label AS topic_label, t.story_count AS cluster_size,
  g.composite_score, t.dominant_category, p.is_public_interest, p.label AS pi_label,
  CAST(material_impact AS INT) + CAST(institutional_action AS INT) + CAST(scope_scale AS INT) + CAST(new_information AS INT) AS met_count,
  p.material_impact, p.institutional_action, p.scope_scale, p.new_information, s.scope_status, a.ingestion_source AS source_feed
FROM fx_articles a LEFT JOIN fx_validation v ON v.story_id = a.uri LEFT JOIN fx_assignments g ON g.story_id = a.uri
LEFT JOIN fx_topics t USING (topic_id) LEFT JOIN fx_assessments p ON p.story_id = a.uri LEFT JOIN fx_scope s ON s.story_id = a.uri
LEFT JOIN fx_outlets o ON o.source_uri = a.source_uri""")
def refresh_enriched_deltas(t: Tables) -> DataFrame:
    """The story table after a first state and three deltas: stories that come later, corrected
    assessments, then new topic counts and outlet names. It must equal the join of the last state."""
    store = TableStore(t.spark, work_path(t.spark, "store"))
    now = {
        "articles": t.fx("articles"), "validation": t.fx("validation"), "assignments": t.fx("assignments"), "topics": t.fx("topics"),
        "assessments": topics.assessment_met_count(t.fx("assessments")), "scope": t.fx("scope"),
        "sources": t.fx("outlets").select(F.col("source_uri").alias("uri"), F.col("source_name").alias("title")),
    }
    english = F.col("lang") == "en"
    half = F.pmod(F.xxhash64("story_id"), F.lit(2)) == 0
    states = [
        {"articles": now["articles"].where(english), "validation": now["validation"], "assignments": now["assignments"].where(half),
         "topics": now["topics"].withColumns({"label": F.lit("new"), "story_count": F.lit(0)}),
         "assessments": now["assessments"].withColumns({"label": F.lit("open"), "met_count": F.lit(0)}),
         "sources": now["sources"].withColumn("title", F.lit("?"))},
        {"articles": now["articles"].where(~F.coalesce(english, F.lit(False))), "assignments": now["assignments"].where(~half)},
        {"assessments": now["assessments"], "scope": now["scope"]},
        {"topics": now["topics"], "sources": now["sources"]},
    ]
    for day, state in enumerate(states, 1):
        store.publish({name: fitted(rows, name) for name, rows in state.items()})
        views.refresh_enriched(store, f"2026-03-{day:02d} 00:00:00")
    found = store.read(views.VIEW)
    return found.withColumn("published_at", ts_text("published_at")).drop("enriched_at", "source_uri")


@query("dedupe_stream", "SELECT event_id, user_id, event_type, props FROM events")
def dedupe_stream(t: Tables) -> DataFrame:
    """Every event arrives twice; exact repeats are dropped."""
    e = t.stream("events").select("event_id", "ts", "user_id", "event_type", "props")
    out = work_path(t.spark, "once")
    arrivals.dedupe_stream(e.unionByName(e), ["event_id"], "ts", "2 hours", out, work_path(t.spark, "cp"))
    return t.spark.read.parquet(out).select("event_id", "user_id", "event_type", "props")


@query("stream_merge_last", """
SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id FROM events GROUP BY user_id""")
def stream_merge_last(t: Tables) -> DataFrame:
    last = arrivals.merge_last(["user_id"], ["ts", "event_id"])
    out = work_path(t.spark, "last")
    arrivals.run_available(
        t.stream("events").select("user_id", "ts", "event_id"), work_path(t.spark, "cp"),
        lambda batch, i: last(batch).write.mode("overwrite").parquet(f"{out}/batch={i}"))
    return last(t.spark.read.parquet(out)).select("user_id", "event_id")


@query("stream_stale_events", f"""
SELECT 'ev-' || user_id AS uri, {sql_ts('max(ts)')} AS last_collected_at FROM events WHERE event_type = 'purchase'
GROUP BY user_id HAVING max(ts) < TIMESTAMP '2024-01-30 12:00:00'""")
def stream_stale_events(t: Tables) -> DataFrame:
    """Latest collection per event and batch, folded, then the freshness test."""
    seen = t.stream("events").where("event_type = 'purchase'").select(F.concat(F.lit("ev-"), "user_id").alias("uri"), "ts")
    out, last = work_path(t.spark, "seen"), cycles.latest_of_batch("uri", "ts")
    arrivals.run_available(seen, work_path(t.spark, "cp"), lambda batch, i: last(batch).write.mode("overwrite").parquet(f"{out}/batch={i}"))
    state = t.spark.read.parquet(out).groupBy("uri").agg(F.max("last_collected_at").alias("last_collected_at"))
    return discover.stale_events(state, "2024-01-31 12:00:00", 24).select("uri", ts_text("last_collected_at").alias("last_collected_at"))


@query("stream_stale_alerts", f"""
WITH e AS (SELECT 'ev-' || user_id AS uri, ts FROM events WHERE event_type = 'purchase'),
n AS (SELECT *, CASE WHEN ts <= lag(ts) OVER w + INTERVAL 24 HOURS THEN 0 ELSE 1 END AS fresh FROM e WINDOW w AS (PARTITION BY uri ORDER BY ts)),
g AS (SELECT *, sum(fresh) OVER (PARTITION BY uri ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM n)
SELECT uri, {sql_ts('max(ts)')} AS last_collected_at, {sql_ts('max(ts) + INTERVAL 24 HOURS')} AS stale_at FROM g GROUP BY uri, s
HAVING max(ts) + INTERVAL 24 HOURS <= (SELECT max(ts) - INTERVAL 2 HOURS FROM e)""")
def stream_stale_alerts(t: Tables) -> DataFrame:
    """An alert for every time that an event had not been collected for a day."""
    seen = t.stream("events").where("event_type = 'purchase'").select(F.concat(F.lit("ev-"), "user_id").alias("uri"), "ts")
    out = work_path(t.spark, "alerts")
    arrivals.append_available(cycles.stale_alerts(seen, "uri", "ts", 24, "2 hours"), out, work_path(t.spark, "cp"))
    found = t.spark.read.schema("uri string, last_collected_at timestamp, stale_at timestamp").parquet(out)
    return found.select("uri", ts_text("last_collected_at").alias("last_collected_at"), ts_text("stale_at").alias("stale_at"))


@query("stream_late_articles", f"""
WITH d AS (SELECT event_id, ts, ts + to_hours(CAST(user_id % 20 AS INT)) AS seen FROM events),
c AS (SELECT *, (CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) // 21600 + 1) * 21600 AS own,
  (CAST(floor(epoch_us(seen) / 1000000) AS BIGINT) // 21600 + 1) * 21600 AS first FROM d
  WHERE seen + INTERVAL 12 HOURS <= (SELECT max(seen) - INTERVAL 3 HOURS FROM d))
SELECT event_id AS uri, {sql_ts('make_timestamp(own * 1000000)')} AS own_run, {sql_ts('make_timestamp(first * 1000000)')} AS first_run,
  (first - own) // 21600 AS cycles_late, ts >= make_timestamp((first - 43200) * 1000000) AS caught FROM c WHERE first > own""")
def stream_late_articles(t: Tables) -> DataFrame:
    """The late rows of a stream, up to the sightings that a run may still look back to; a third is sighted twice."""
    e = t.stream("events").select(F.col("event_id").alias("uri"), "ts", (F.col("ts") + times.hours((F.col("user_id") % 20).cast("int"))).alias("seen"))
    again = e.where("uri % 3 = 0").withColumn("seen", F.col("seen") + times.hours(F.lit(0)))
    out = work_path(t.spark, "late")
    arrivals.append_available(cycles.late_sightings(e.unionByName(again), "ts", "seen", 6, 12, "3 hours"), out, work_path(t.spark, "cp"))
    late = t.spark.read.schema("uri bigint, ts timestamp, seen timestamp, own_run timestamp, first_run timestamp, cycles_late bigint, caught boolean").parquet(out)
    return late.select("uri", ts_text("own_run").alias("own_run"), ts_text("first_run").alias("first_run"), "cycles_late", "caught")


def _cycle_sql(cycle: int, lookback: int, offset: int = 0) -> str:
    """Runs of one grid that cover a row: the ends in (ts, ts + lookback]."""
    step, back, off = cycle * 3600, lookback * 3600, offset * 3600
    return f"""
SELECT event_id, '{cycle}h' AS cycle, {sql_ts('make_timestamp(CAST(e AS BIGINT) * 1000000)')} AS run_id FROM (
  SELECT event_id, s, unnest(generate_series(((s - {off}) // {step} + 1) * {step} + {off}, (s + {back} - {off}) // {step} * {step} + {off}, {step})) AS e
  FROM (SELECT event_id, CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS s FROM events)) WHERE e > s AND e <= s + {back}"""


@query("assign_cycles", _cycle_sql(4, 8) + " UNION ALL " + _cycle_sql(24, 48, 10))
def assign_cycles(t: Tables) -> DataFrame:
    e = t.raw("events").select("event_id", "ts")
    short = cycles.assign_cycles(e, "ts", 4, 8).withColumn("cycle", F.lit("4h"))
    daily = cycles.assign_cycles(e, "ts", 24, 48, 10).withColumn("cycle", F.lit("24h"))
    return short.unionByName(daily).select("event_id", "cycle", ts_text("run_id").alias("run_id"))


@query("stream_assign_cycles", "SELECT run_id, count(*) AS n FROM (" + _cycle_sql(6, 12) + ") GROUP BY run_id")
def stream_assign_cycles(t: Tables) -> DataFrame:
    out = work_path(t.spark, "cycles")
    assigned = cycles.assign_cycles(t.stream("events").select("event_id", "ts"), "ts", 6, 12)
    arrivals.run_available(assigned, work_path(t.spark, "cp"), lambda batch, i: batch.write.mode("overwrite").parquet(f"{out}/batch={i}"))
    back = t.spark.read.parquet(out)
    return back.groupBy(ts_text("run_id").alias("run_id")).agg(F.count("*").alias("n"))


@query("late_articles", f"""
WITH d AS (SELECT event_id, ts, ts + to_hours(CAST(user_id % 20 AS INT)) AS seen,
  (CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) // 21600 + 1) * 21600 AS own,
  (CAST(floor(epoch_us(ts + to_hours(CAST(user_id % 20 AS INT))) / 1000000) AS BIGINT) // 21600 + 1) * 21600 AS first FROM events)
SELECT event_id AS uri, {sql_ts('make_timestamp(own * 1000000)')} AS own_run, {sql_ts('make_timestamp(first * 1000000)')} AS first_run,
  (first - own) // 21600 AS cycles_late, ts >= make_timestamp((first - 43200) * 1000000) AS caught FROM d WHERE first > own""")
def late_articles(t: Tables) -> DataFrame:
    e = t.raw("events").select(F.col("event_id").alias("uri"), "ts",
                               (F.col("ts") + times.hours((F.col("user_id") % 20).cast("int"))).alias("seen"))
    late = cycles.late_articles(e, "ts", "seen", 6, 12)
    return late.select("uri", ts_text("own_run").alias("own_run"), ts_text("first_run").alias("first_run"), "cycles_late", "caught")


# --- scalar expressions -----------------------------------------------------------------


@query("scalar_text", r"""
SELECT event_id, trim('  ' || event_type || ' ') AS trimmed, 'run_id=' || replace('2024-01-01T' || user_id || ':00:00Z', ':', '-') AS safe,
  length(substr(repeat(event_type, 400), 1, 2000)) AS cut, contains(event_type, 'ch') AS has_ch, starts_with(event_type, 's') AS s_start,
  'bucket-' || user_id AS bucket, 'out/' || event_type || '/x.json' AS prefix, 'a b/' || event_type || ':1' AS decoded,
  event_type || '|' || user_id || '|x' AS cleaned, 'a b c' AS flat
FROM events""")
def scalar_text(t: Tables) -> DataFrame:
    e = t.raw("events")
    uri = F.concat(F.lit("s3://bucket-"), "user_id", F.lit("/out/"), "event_type", F.lit("/x.json"))
    key = F.concat(F.lit("a+b/"), "event_type", F.lit("%3A1"))
    listed = F.concat(F.lit(" "), "event_type", F.lit(" ,"), "user_id", F.lit(",, x,"), "event_type")
    return e.select(
        "event_id", F.trim(F.concat(F.lit("  "), "event_type", F.lit(" "))).alias("trimmed"),
        F.concat(F.lit("run_id="), text.path_safe(F.concat(F.lit("2024-01-01T"), "user_id", F.lit(":00:00Z")))).alias("safe"),
        F.length(text.error_text(F.repeat("event_type", 400))).cast("bigint").alias("cut"), F.col("event_type").contains("ch").alias("has_ch"),
        F.col("event_type").startswith("s").alias("s_start"), text.storage_bucket(uri).alias("bucket"),
        text.storage_prefix(uri).alias("prefix"), text.object_key(key).alias("decoded"),
        F.concat_ws("|", text.clean_list(listed)).alias("cleaned"), text.one_line(F.lit("a\r\nb\nc")).alias("flat"))


@query("scalar_time", f"""
WITH d AS (SELECT event_id, ts, date_trunc('day', ts) AS day,
  date_trunc('day', ts) + to_hours(CAST(hour(ts) // 4 * 4 AS INT)) AS c4,
  date_trunc('day', ts - to_hours(CAST(10 AS INT))) + to_hours(CAST(10 AS INT)) AS hst FROM events)
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') AS iso, {sql_ts('c4')} AS run4, {sql_ts('c4 - to_hours(CAST(8 AS INT))')} AS from4,
  {sql_ts('day - to_days(CAST(1 AS INT))')} AS run24, {sql_ts('day - to_days(CAST(3 AS INT))')} AS from24,
  {sql_ts('hst')} AS run_hst, {sql_ts('hst - to_days(CAST(2 AS INT))')} AS from_hst,
  {sql_ts('day + to_hours(CAST(10 AS INT))')} AS day_from, {sql_ts('day + to_hours(CAST(34 AS INT))')} AS day_to,
  CAST(NULL AS VARCHAR) AS bad
FROM d""")
def scalar_time(t: Tables) -> DataFrame:
    ts = F.col("ts")
    short = times.run_window(ts, 4)
    daily = times.run_window(ts, 24, lookback_days=2, days_ago=1)
    local = times.run_window(ts, 24, lookback_days=2, tz="Pacific/Honolulu")
    one = times.run_window(None, tz="Pacific/Honolulu", local_date=F.to_date("ts"))
    out = {
        "run4": short["run_id"], "from4": short["window_from"], "run24": daily["run_id"], "from24": daily["window_from"],
        "run_hst": local["run_id"], "from_hst": local["window_from"], "day_from": one["window_from"], "day_to": one["window_to"],
    }
    return t.raw("events").select(
        "event_id", times.iso_text("ts").alias("iso"), *[ts_text(c).alias(n) for n, c in out.items()],
        ts_text(times.parse_instant(F.col("event_type"))).alias("bad"))


@query("day_windows", """
WITH r AS (SELECT min(CAST(ts AS DATE)) AS a, max(CAST(ts AS DATE)) AS b FROM events),
d AS (SELECT unnest(generate_series(a, b, INTERVAL 1 DAY)) AS day FROM r)
SELECT strftime(day, '%Y-%m-%d') AS local_date, strftime(day + INTERVAL 10 HOUR, '%Y-%m-%d %H:%M:%S') AS window_from,
  (SELECT count(*) FROM events WHERE ts >= day + INTERVAL 10 HOUR AND ts < day + INTERVAL 34 HOUR) AS events FROM d""")
def day_windows(t: Tables) -> DataFrame:
    """Events per local day; the calendar comes from the table's own date range."""
    e = t.raw("events")
    lo, hi = e.agg(F.min(F.to_date("ts")).cast("string"), F.max(F.to_date("ts")).cast("string")).first()
    calendar = times.day_windows(t.spark, lo, hi, "Pacific/Honolulu")
    # Group by the local day first: the join is then by day, not by range.
    per_day = e.groupBy(F.to_date(F.from_utc_timestamp("ts", "Pacific/Honolulu")).alias("local_date")).agg(F.count("*").alias("events"))
    joined = calendar.join(per_day, "local_date", "left")
    return joined.select(F.col("local_date").cast("string").alias("local_date"), ts_text("window_from").alias("window_from"),
                         F.coalesce("events", F.lit(0)).alias("events"))


@query("scalar_json", """
SELECT event_id, '{"a":[1,{"b":null,"c":"' || event_type || '"}],"k":' || user_id || '}' AS canonical, CAST(user_id AS VARCHAR) AS k,
  'null' AS absent, CAST(json_extract(props, '$.k') AS VARCHAR) AS prop
FROM events""")
def scalar_json(t: Tables) -> DataFrame:
    raw = F.concat(F.lit('{ "k" : 0, "k" : '), "user_id", F.lit(', "a" : [1.0, {"c":"'), "event_type", F.lit('", "b":null}] }'))
    v = F.parse_json(raw)
    return t.raw("events").select(
        "event_id", jsonx.canonical_json(raw).alias("canonical"), jsonx.text_at(v, "k").alias("k"),
        jsonx.json_or_null(jsonx.json_at(v, "zz")).alias("absent"), jsonx.text_at(F.parse_json("props"), "k").alias("prop"))


@query("scalar_array", """
WITH c AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)
SELECT doc_id, len(l) AS n, CAST(ceil(len(l) / 3) AS BIGINT) AS chunks, md5(array_to_string(
  list_transform(range(CAST(ceil(len(l) / 3) AS BIGINT)), lambda i: i || ':' || array_to_string(l[3 * i + 1:3 * i + 3], '|')), '#')) AS pieces FROM c""")
def scalar_array(t: Tables) -> DataFrame:
    """The lines of a text as one list, cut into batches of three."""
    c = t.raw("documents").select("doc_id", F.split("text", F.lit("\n")).alias("l"))
    pieces = text.chunk("l", 3)
    return c.select("doc_id", F.size("l").cast("bigint").alias("n"), F.size(pieces).cast("bigint").alias("chunks"),
                    F.md5(F.array_join(F.transform(pieces, lambda x, i: F.concat(i.cast("string"), F.lit(":"), F.array_join(x, "|"))), "#").cast("binary")).alias("pieces"))


@query("cosine", """
SELECT vec_id, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), CAST(list_reverse(embedding) AS DOUBLE[])), 6) AS similarity FROM embeddings""")
def cosine(t: Tables) -> DataFrame:
    return t.raw("embeddings").select("vec_id", F.round(vectors.cosine("embedding", F.reverse("embedding")), 6).alias("similarity"))
