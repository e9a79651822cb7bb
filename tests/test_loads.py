import datetime
import json

import pytest
from pyspark.sql import functions as F

from conftest import rows
from pressloom import contracts as C
from pressloom.operators import runs
from pressloom.plans import loads
from pressloom.plans.store import TableStore
from pressloom.sinks import artifacts
from pressloom.streaming import arrivals, cycles
from test_scans import MANIFEST, articles

AS_OF = "2026-03-18 11:00:00"


def land(spark, root, day, data, **changes):
    run = {"ingestion_source": C.ARTICLE_INGESTION_SOURCE, "run_id": f"2026-03-{day}T10:00:00.000Z", "run_type": "scheduled", "nth_run": 1}
    folder = artifacts.write_run_artifact(articles(spark, *data), root, run)
    manifest = {**MANIFEST, **run, "window_to": run["run_id"], "collected_at": f"2026-03-{day}T10:06:00.000Z", **changes}
    artifacts.write_text_file(spark, f"{folder}/manifest.json", json.dumps(manifest))
    return folder, manifest


def one(uri, title, concepts, source='{"uri":"s","title":"S"}', event="e-1"):
    listed = json.dumps([{"uri": c, "type": "wiki"} for c in concepts])
    return {"uri": uri, "title": title, "concepts": listed, "source": source, "event_uri": event}


def snapshot(store):
    return {
        "articles": rows(store.read("articles"), "uri", "title", "source_uri", F.date_format("run_id", "dd")),
        "links": rows(store.read("article_concepts")),
        "sources": rows(store.read("sources"), "uri", "title"),
        "concepts": rows(store.read("concepts"), "uri", "type"),
    }


DAY1 = [one("a", "A", ["x", "y"]), one("b", "B", ["x"])]
DAY2 = [one("b", "B2", []), one("c", "C", ["z"], source="null")]


@pytest.fixture()
def store(spark, folder):
    return TableStore(spark, f"{folder}/store")


def test_two_loads(spark, folder, store):
    for day, data in (("17", DAY1), ("18", DAY2)):
        target, manifest = land(spark, f"{folder}/land", day, data)
        assert loads.load_articles(store, target, manifest, AS_OF) == "loaded"
    want = {
        "articles": [("a", "A", "s", "17"), ("b", "B2", "s", "18"), ("c", "C", None, "18")],
        "links": [("a", "x"), ("a", "y"), ("c", "z")], "sources": [("s", "S")],
        "concepts": [("x", "wiki"), ("y", "wiki"), ("z", "wiki")],
    }
    assert snapshot(store) == want
    assert loads.load_articles(store, target, manifest, AS_OF) == "skipped_duplicate"
    assert snapshot(store) == want
    report = json.loads(spark.read.text(f"{target}/load_report.json", wholetext=True).first()[0])
    assert (report["rows_loaded"], report["db_rows_inserted"], report["db_rows_updated"]) == (2, 1, 1)
    assert report["sample_uris"] == ["b", "c"] and report["populated_counts"]["source"] == 1
    measured = {m["metric_name"]: m["metric_value"] for m in report["pipeline_run_metrics"]}
    assert measured["articles_upserted"] == 2 and measured["article_concept_links"] == 1 and measured["articles_with_source_uri"] == 1
    for name in ("articles", "article_concepts"):
        store.compact(name)
    assert snapshot(store) == want


def test_csv_and_jsonl_give_the_same_tables(spark, folder):
    stores = {}
    for data in ("csv", "jsonl"):
        store = stores[data] = TableStore(spark, f"{folder}/{data}")
        for day, listed in (("17", DAY1), ("18", DAY2)):
            run = {"ingestion_source": C.ARTICLE_INGESTION_SOURCE, "run_id": f"2026-03-{day}T10:00:00.000Z", "run_type": "scheduled", "nth_run": 1}
            df = articles(spark, *listed)
            records = df.select(F.to_json(F.struct(*df.columns)).alias("value"))
            target = artifacts.write_run_artifact(df, f"{folder}/land-{data}", run, records=records)
            manifest = {**MANIFEST, **run, "window_to": run["run_id"], "collected_at": f"2026-03-{day}T10:06:00.000Z"}
            assert loads.load_articles(store, target, manifest, AS_OF, data=data) == "loaded"
    assert snapshot(stores["csv"]) == snapshot(stores["jsonl"])
    assert stores["csv"].read("articles").exceptAll(stores["jsonl"].read("articles")).isEmpty()
    with pytest.raises(ValueError):
        loads.load_articles(stores["csv"], target, {**manifest, "nth_run": 2}, AS_OF, data="xml")


def test_stream_in_one_or_many_batches(spark, folder):
    """The same artifacts in one batch, in two, and after a restart give the same tables."""
    late, early = TableStore(spark, f"{folder}/s1"), TableStore(spark, f"{folder}/s2")
    land(spark, f"{folder}/land", "17", DAY1)
    arrivals.stream_load(early, f"{folder}/land", f"{folder}/cp2", AS_OF)
    land(spark, f"{folder}/land", "18", DAY2)
    arrivals.stream_load(early, f"{folder}/land", f"{folder}/cp2", AS_OF)
    arrivals.stream_load(late, f"{folder}/land", f"{folder}/cp1", AS_OF)
    first = snapshot(late)
    assert first == snapshot(early)
    arrivals.stream_load(late, f"{folder}/land", f"{folder}/cp1", AS_OF)
    # A lost checkpoint sees the files again; loaded runs are skipped.
    arrivals.stream_load(late, f"{folder}/land", f"{folder}/cp3", AS_OF)
    assert snapshot(late) == first
    assert rows(runs.fold_run_ledger(late.read("run_log"), require_reserved=False), "status") == [("loaded",), ("loaded",)]


def test_bad_artifact_publishes_nothing(spark, folder, store):
    target, manifest = land(spark, f"{folder}/land", "17", [{"uri": "a", "relevance": "1.5"}])
    with pytest.raises(Exception):
        loads.load_articles(store, target, manifest, AS_OF)
    assert store.read("articles").isEmpty()
    ledger = runs.fold_run_ledger(store.read("run_log"), require_reserved=False)
    assert rows(ledger, "status", "error_code") == [("failed", "loader_error")]
    assert ledger.where(F.length("error_message") > 0).count() == 1


def test_two_writers_do_not_both_publish(spark, folder, store):
    other = TableStore(spark, store.root)
    rows_ = spark.createDataFrame([("a", "x")], "article_uri string, concept_uri string")
    number = store._pointer()
    store.publish({"article_concepts": rows_})
    other._pointer = lambda: number
    with pytest.raises(Exception):
        other.publish({"article_concepts": rows_})
    assert rows(store.read("article_concepts")) == [("a", "x")]


def test_interleaved_loads_lose_no_update(spark, folder, store):
    """Two writers read version 1; the second to publish fails, also if the first has long been done."""
    first = spark.createDataFrame([("a", "x")], "article_uri string, concept_uri string")
    store.publish({"article_concepts": first})
    one, two = store.pinned(), TableStore(spark, store.root).pinned()
    two.publish({"article_concepts": spark.createDataFrame([("b", "y")], first.schema)})
    assert rows(one.read("article_concepts")) == [("a", "x")]
    with pytest.raises(Exception):
        one.publish({"article_concepts": spark.createDataFrame([("b", "z")], first.schema)})
    assert rows(store.read("article_concepts")) == [("a", "x"), ("b", "y")]
    again = store.pinned()
    for value in ("z", "w"):
        again.publish({"article_concepts": spark.createDataFrame([("b", value)], first.schema)})
    assert rows(again.read("article_concepts")) == rows(store.read("article_concepts")) == [("a", "x"), ("b", "w")]


def test_event_load_and_zero_events(spark, folder, store):
    assert loads.load_events(store, folder, {"events_fetched": 0}, AS_OF) == "loaded_zero_events"
    run = {"ingestion_source": C.EVENT_INGESTION_SOURCE, "run_id": "2026-03-17T10:00:00.000Z", "run_type": "scheduled", "nth_run": 1}
    row = {**{c: "" for c in C.EVENT_COLUMNS}, "uri": "e-1", "title": '{"eng":"T"}', "total_article_count": "3"}
    df = spark.createDataFrame([tuple(row[c] for c in C.EVENT_COLUMNS)], C.EVENTS.csv_schema)
    target = artifacts.write_run_artifact(df, f"{folder}/ev", run, C.EVENTS)
    manifest = {**run, "artifact_contract_version": C.EVENT_CONTRACT_VERSION, "collected_at": "2026-03-17T11:00:00Z", "events_fetched": 1}
    assert [loads.load_events(store, target, manifest, AS_OF) for _ in range(2)] == ["loaded", "skipped_duplicate"]
    assert rows(store.read("events"), "uri", "total_article_count", "title") == [("e-1", 3, '{"eng":"T"}')]
    # Measured once, under the event source: the second load was skipped.
    assert rows(store.read("run_metrics").where("metric_name = 'events_upserted'"), "ingestion_source", "metric_value") == [
        (C.EVENT_INGESTION_SOURCE, 1)]
    ledger = runs.fold_run_ledger(store.read("run_log"), require_reserved=False)
    assert rows(ledger, "status", "rows_loaded") == [("loaded", 1)]
    skipped = json.loads(spark.read.text(f"{target}/load_report_skipped.json", wholetext=True).first()[0])
    assert skipped["pipeline_status"] == "skipped_duplicate"


def test_event_manifest(spark):
    measured = spark.createDataFrame([("candidate_articles_scanned", 889), ("distinct_event_uris_discovered", 304),
                                      ("distinct_event_uris_selected", 0)], "metric_name string, metric_value bigint")
    parent = {"run_id": "2026-02-15T10:00:00.000Z", "ingestion_source": C.ARTICLE_INGESTION_SOURCE, "run_type": "backfill", "nth_run": 3}
    run = {**parent, "ingestion_source": C.EVENT_INGESTION_SOURCE}
    fetched = spark.createDataFrame([], "uri string")
    m = artifacts.build_event_manifest(fetched, measured, run, "2026-03-14T09:33:01.937Z", parent).first()
    assert (m.candidate_articles_scanned, m.distinct_event_uris_discovered, m.distinct_event_uris_selected, m.events_fetched) == (889, 304, 0, 0)
    assert (m.parent_nth_run, m.parent_ingestion_source, m.stale_after_hours, m.csv_file) == (3, C.ARTICLE_INGESTION_SOURCE, 24, "events.csv")
    without = artifacts.build_event_manifest(fetched, measured, run, "x", scope="full_corpus", include_stale=False).first()
    assert without.parent_run_id is None and without.stale_after_hours is None


def test_headline_load(spark, folder, store):
    run = {"ingestion_source": C.HEADLINE_INGESTION_SOURCES[0], "run_id": "2026-03-17T10:00:00.000Z", "run_type": "scheduled", "nth_run": 1}
    df = spark.createDataFrame([tuple(f"{c}" if c != "published_at" else "2026-03-17T01:00:00Z" for c in C.HEADLINE_COLUMNS)], C.HEADLINES.csv_schema)
    target = artifacts.write_run_artifact(df, folder, run, C.HEADLINES)
    manifest = {**run, "collected_at": "2026-03-17T10:05:00Z"}
    assert loads.load_headlines(store, target, manifest, AS_OF)["db_rows_inserted"] == 1
    assert loads.load_headlines(store, target, manifest, AS_OF) == {"status": "skipped_duplicate"}
    assert rows(store.read("headlines"), "url", "title") == [("url", "title")]
    report = json.loads(spark.read.text(f"{target}/{C.HEADLINES.report_file}", wholetext=True).first()[0])
    assert (report["db_rows_inserted"], report["pipeline_status"], report["run_type"]) == (1, "loaded", "scheduled")
    bad = {**manifest, "run_id": "2026-03-18T10:00:00.000Z"}
    with pytest.raises(Exception):
        loads.load_headlines(store, f"{folder}/nowhere", bad, AS_OF)
    ledger = runs.fold_run_ledger(store.read("run_log"), require_reserved=False)
    assert rows(ledger, "status", "error_code") == [("failed", "loader_error"), ("loaded", None)]


def test_last_staged_row_counts(spark, folder, store):
    """A uri staged twice gives one row, its links and its counts, all of the last version."""
    first = {"uri": "a", "title": "old", "concepts": '[{"uri":"k1"}]'}
    last = {"uri": "a", "title": "new", "concepts": '[{"uri":"k2"}]'}
    target, manifest = land(spark, f"{folder}/land", "17", [first, last])
    assert loads.load_articles(store, target, manifest, AS_OF, on_duplicate="last") == "loaded"
    assert rows(store.read("articles"), "uri", "title") == [("a", "new")]
    assert rows(store.read("article_concepts"), "article_uri", "concept_uri") == [("a", "k2")]
    assert rows(store.read("run_metrics").where("metric_name = 'articles_upserted'"), "metric_value") == [(1,)]

def test_event_metrics_are_filed_under_the_parent(spark, folder, store):
    target, manifest = land(spark, f"{folder}/land", "17", DAY1)
    loads.load_articles(store, target, manifest, AS_OF)
    wanted = loads.collect_events(store, manifest, AS_OF)
    assert rows(wanted, "event_uri") == [("e-1",)]
    found = store.read("run_metrics").where("stage = 'event_collect'")
    assert rows(found, "ingestion_source", "metric_name", "metric_value") == [
        (C.ARTICLE_INGESTION_SOURCE, "candidate_articles_scanned", 2), (C.ARTICLE_INGESTION_SOURCE, "distinct_event_uris_discovered", 1),
        (C.ARTICLE_INGESTION_SOURCE, "distinct_event_uris_selected", 1), (C.ARTICLE_INGESTION_SOURCE, "events_fetched", 1)]


def test_cycles(spark):
    df = spark.sql("SELECT timestamp'2026-01-01 03:59:59' ts UNION ALL SELECT timestamp'2026-01-01 04:00:00'")
    got = cycles.assign_cycles(df, "ts", 4, 8).select(F.date_format("ts", "HH:mm"), F.date_format("run_id", "HH:mm"))
    assert rows(got) == [("03:59", "04:00"), ("03:59", "08:00"), ("04:00", "08:00"), ("04:00", "12:00")]


def test_late_rows_on_a_shifted_grid(spark):
    """Daily windows that end at 10:00: seen before that, a row is on time."""
    df = spark.sql("""SELECT 'on time' uri, timestamp'2026-01-01 01:00:00' ts, timestamp'2026-01-01 09:00:00' seen
        UNION ALL SELECT 'late', timestamp'2026-01-01 09:00:00', timestamp'2026-01-01 11:00:00'""")
    assert rows(cycles.late_articles(df, "ts", "seen", 24, 48, offset_hours=10), "uri", "cycles_late", "caught") == [("late", 1, True)]
    assert cycles.late_articles(df, "ts", "seen", 24, 48).isEmpty()


def test_late_rows(spark):
    df = spark.sql("""SELECT 'on time' uri, timestamp'2026-01-01 01:00:00' ts, timestamp'2026-01-01 02:00:00' seen
        UNION ALL SELECT 'late', timestamp'2026-01-01 01:00:00', timestamp'2026-01-01 05:00:00'
        UNION ALL SELECT 'lost', timestamp'2026-01-01 01:00:00', timestamp'2026-01-01 09:00:00'""")
    assert rows(cycles.late_articles(df, "ts", "seen", 4, 8), "uri", "cycles_late", "caught") == [("late", 1, True), ("lost", 2, False)]


def test_late_first_sightings_stay(spark, folder):
    """A later batch holds new ids far behind the newest, and repeats: only the repeats go."""
    schema = "event_id long, ts timestamp, user_id long"

    def land(rows):
        spark.createDataFrame(
            [(e, None if t is None else datetime.datetime.fromisoformat(t), 7) for e, t in rows], schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        arrivals.dedupe_stream(spark.readStream.schema(schema).parquet(f"{folder}/in"), ["event_id"], "ts", "2 hours", f"{folder}/once", f"{folder}/cp")

    first = [(1, "2024-01-05T12:00:00"), (1, "2024-01-05T12:00:00"), (2, "2024-01-05T23:30:00"), (3, None), (None, "2024-01-05T10:00:00")]
    land(first)
    land([(4, "2024-01-01T00:00:00"), (5, "2024-01-05T01:00:00"), (1, "2024-01-05T12:00:00"), (2, "2024-01-06T00:30:00"), (4, "2024-01-01T00:00:00"), (3, None),
          (None, "2024-01-05T10:00:00")])
    land([(4, "2024-01-01T00:00:00"), (6, "2023-12-01T00:00:00")])
    found = spark.read.parquet(f"{folder}/once")
    assert sorted(str(r.event_id) for r in found.collect()) == ["1", "2", "3", "4", "5", "6", "None"]
    # A batch that is run again replaces its rows.
    step = arrivals.first_arrivals(spark, f"{folder}/once", spark.createDataFrame([], schema).schema, ["event_id"], "ts", "2 hours")
    step(spark.createDataFrame([(6, datetime.datetime(2023, 12, 1), 7), (4, datetime.datetime(2024, 1, 1), 7)], schema), 2)
    assert spark.read.parquet(f"{folder}/once").count() == 7


def land_rows(spark, root, batch, data, schema):
    spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(f"{root}/{batch}")


def test_stale_alerts_of_three_batches(spark, folder):
    """State is held for keys of the stale window only; a key may go stale twice; what is too late is not counted."""
    schema, root, out, cp = "uri string, ts timestamp", f"{folder}/seen", f"{folder}/alerts", f"{folder}/cp"
    days = [[("a", 1, 0), ("b", 1, 5), ("c", 1, 9), ("b", 1, 20)], [("b", 2, 3), ("d", 2, 23), ("e", 3, 2)], [("a", 5, 0), ("late", 3, 1), ("f", 9, 0)]]

    def stamp(rows_):
        return [(u, datetime.datetime(2026, 1, d, h)) for u, d, h in rows_]

    held = []
    for i, batch in enumerate(days):
        land_rows(spark, root, i, stamp(batch), schema)
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(root)
        query = arrivals.append_available(cycles.stale_alerts(stream, "uri", "ts", 24, "1 hour"), out, cp)
        held.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    got = sorted((r.uri, r.last_collected_at, r.stale_at) for r in spark.read.parquet(out).collect())
    day = datetime.timedelta(days=1)
    # "late" came more than an hour behind the newest row of an earlier batch, but within the window's own time it still opens a session.
    want = [(u, t, t + day) for u, t in stamp([("a", 1, 0), ("a", 5, 0), ("b", 2, 3), ("c", 1, 9), ("d", 2, 23), ("e", 3, 2)])]
    assert [g for g in got if g[0] != "late"] == want
    assert held[-1] == 1 and max(held) <= 4


def test_late_sightings_of_a_stream(spark, folder):
    schema, root, out = "uri string, ts timestamp, seen timestamp", f"{folder}/s", f"{folder}/late"
    at = datetime.datetime(2026, 1, 1)
    hour = datetime.timedelta(hours=1)
    data = [("x", 1, 1), ("x", 1, 8), ("y", 2, 9), ("y", 2, 10), ("z", 3, 20), ("end", 90, 90)]
    rows_ = [(u, at + t * hour, at + s * hour) for u, t, s in data]
    for i in range(3):
        land_rows(spark, root, i, rows_[2 * i:2 * i + 2], schema)
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(root)
        arrivals.append_available(cycles.late_sightings(stream, "ts", "seen", 6, 12, "30 hours"), out, f"{folder}/cp")
    whole = cycles.late_articles(spark.createDataFrame(rows_[:-1], schema), "ts", "seen", 6, 12)
    cols = ["uri", "own_run", "first_run", "cycles_late", "caught"]
    assert rows(spark.read.parquet(out), *cols) == rows(whole, *cols) and whole.count() == 2
