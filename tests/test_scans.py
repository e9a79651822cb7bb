import json

import pytest
from pyspark.sql import functions as F

from conftest import rows
from pressloom import contracts as C
from pressloom.operators import casts
from pressloom.sinks import artifacts
from pressloom.sources import files, manifests, payloads

RUN = {"ingestion_source": C.ARTICLE_INGESTION_SOURCE, "run_id": "2026-03-18T10:00:00.000Z", "run_type": "scheduled", "nth_run": 1}


def article_row(**values):
    return {**{c: "" for c in C.ARTICLE_COLUMNS}, **{c: "null" for c in C.ARTICLE_JSON_COLUMNS}, **values}


def articles(spark, *dicts):
    return spark.createDataFrame([tuple(article_row(**d)[c] for c in C.ARTICLE_COLUMNS) for d in dicts], C.ARTICLES.csv_schema)


EDGE = ['say "hi", twice', "one\r\ntwo\nthree", "back\\slash \\\" end", "plain", " blanks around "]


def test_csv_round_trip_keeps_every_cell(spark, folder):
    df = articles(spark, *[{"uri": f"u{i}", "body": b} for i, b in enumerate(EDGE)])
    target = artifacts.write_run_artifact(df, folder, RUN)
    assert target.endswith("run_id=2026-03-18T10-00-00.000Z/run_type=scheduled/nth_run=1")
    back = files.scan_article_csv(spark, f"{target}/articles.csv")
    assert rows(back, "uri", "body") == [(f"u{i}", b) for i, b in enumerate(EDGE)]


def test_artifact_is_written_once(spark, folder):
    df = articles(spark, {"uri": "a"})
    artifacts.write_run_artifact(df, folder, RUN)
    with pytest.raises(Exception, match="already exists"):
        artifacts.write_run_artifact(df, folder, RUN)


@pytest.mark.parametrize("change", ["swap", "rename", "case", "short", "long"])
def test_header_must_match(spark, folder, change):
    cols = list(C.HEADLINE_COLUMNS)
    if change == "swap":
        cols[0], cols[1] = cols[1], cols[0]
    elif change == "rename":
        cols[3] = "headline"
    elif change == "case":
        cols[5] = "URL"
    elif change == "short":
        cols = cols[:-1]
    else:
        cols.append("extra")
    artifacts.write_text_file(spark, f"{folder}/h.csv", ",".join(cols) + "\n" + ",".join("x" for _ in cols) + "\n")
    with pytest.raises(files.ContractError):
        files.scan_headline_csv(spark, f"{folder}/h.csv")


def test_second_file_with_other_header_fails(spark, folder):
    good = ",".join(C.HEADLINE_COLUMNS)
    bad = good.replace("title,description", "description,title")
    for name, header in (("a.csv", good), ("b.csv", bad)):
        artifacts.write_text_file(spark, f"{folder}/set/{name}", header + "\n" + "1,2,3,4,5,6,7,8,9\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.scan_headline_csv(spark, f"{folder}/set").collect()


def test_zero_event_file(spark, folder):
    artifacts.write_text_file(spark, f"{folder}/events.csv", ",".join(C.EVENT_COLUMNS) + "\n\n")
    assert files.scan_event_csv(spark, f"{folder}/events.csv").count() == 0


MANIFEST = {
    "artifact_contract_version": C.ARTICLE_CONTRACT_VERSION, **RUN, "window_from": "2026-03-16T10:00:00.000Z",
    "window_to": "2026-03-18T10:00:00.000Z", "collected_at": "2026-03-18T10:06:29.318Z",
    "source_uris": ["a.com"], "articles_fetched": 6600, "articles_deduped": 6564, "article_uri_batch_size": None,
}


def put_manifest(spark, path, **changes):
    artifacts.write_text_file(spark, path, json.dumps({**MANIFEST, **changes}, indent=2))


def test_manifest_name_is_matched_whole(spark, folder):
    put_manifest(spark, f"{folder}/a/manifest.json")
    put_manifest(spark, f"{folder}/a/event-manifest.json")
    found = manifests.validate_manifest(manifests.scan_manifests(spark, folder))
    assert rows(found, "articles_fetched", "articles_deduped") == [(6600, 6564)]


@pytest.mark.parametrize("changes, message", [
    ({"artifact_contract_version": "v1"}, "expected contract"),
    ({"collected_at": None}, "lacks collected_at"),
    ({"window_from": ""}, "lacks window_from"),
])
def test_bad_manifest_fails(spark, folder, changes, message):
    put_manifest(spark, f"{folder}/a/manifest.json", **changes)
    with pytest.raises(Exception, match=message):
        manifests.validate_manifest(manifests.scan_manifests(spark, folder)).collect()


def test_event_manifest_needs_its_data_file(spark, folder):
    body = {"artifact_contract_version": C.EVENT_CONTRACT_VERSION, **RUN, "collected_at": "2026-03-14T09:33:01Z",
            "csv_file": "other.csv", "events_fetched": 0}
    artifacts.write_text_file(spark, f"{folder}/event-manifest.json", json.dumps(body))
    with pytest.raises(Exception, match="expected data file"):
        manifests.validate_manifest(manifests.scan_manifests(spark, folder, C.EVENTS), C.EVENTS).collect()


def reports(spark, *data):
    return spark.createDataFrame(data, "run_id string, ingestion_source string, run_type string, nth_run int, pipeline_status string, modified_at int")


def test_parent_run(spark):
    r = reports(spark, ("r1", "s", "seed", 1, "loaded", 1), ("r2", "s", "scheduled", 2, "loaded", 5))
    assert rows(manifests.resolve_parent_run(r)) == [("r2", "s", "scheduled", 2)]
    override = {"run_id": "x", "ingestion_source": "y", "run_type": "backfill", "nth_run": "3"}
    assert rows(manifests.resolve_parent_run(r, override)) == [("x", "y", "backfill", 3)]
    assert rows(manifests.resolve_parent_run(r, {"run_id": "x"})) == [("r2", "s", "scheduled", 2)]
    with pytest.raises(ValueError):
        manifests.resolve_parent_run(r, {**override, "nth_run": 0})
    late = r.unionByName(reports(spark, ("r3", "s", "seed", 1, "skipped_duplicate", 9)))
    with pytest.raises(Exception, match="not loaded"):
        manifests.resolve_parent_run(late).collect()


def test_casts_fail_or_quarantine(spark):
    good = {"uri": "a", "relevance": "3", "wgt": "5000000000", "time": "10:11:12.500", "is_duplicate": "TRUE",
            "source": '{"b": 1.0, "a": {"d":1,"c":2}, "b": 2}'}
    typed = casts.cast_articles(articles(spark, good, {"uri": ""}))
    assert rows(typed, "uri", "relevance", "wgt", "time", "is_duplicate", "source") == [
        ("a", 3, 5000000000, "10:11:12.5", True, '{"a":{"c":2,"d":1},"b":2}')]
    bad = articles(spark, {"uri": "b", "relevance": "1.5", "concepts": "[{"})
    with pytest.raises(Exception, match="1.5|MALFORMED"):
        casts.cast_articles(bad).collect()
    kept = casts.cast_articles(bad, mode="quarantine")
    assert rows(kept, "uri", "relevance", "concepts", F.array_sort("_rejects")) == [("b", None, None, ["concepts", "relevance"])]


def test_row_lineage_wins(spark):
    run = {**RUN, "collected_at": "2026-03-18T10:06:29Z"}
    typed = casts.cast_articles(articles(spark, {"uri": "a", "run_type": "seed", "nth_run": "4"}, {"uri": "b"}), run)
    assert rows(typed, "uri", "run_type", "nth_run") == [("a", "seed", 4), ("b", "scheduled", 1)]


def test_uri_list_errors(spark):
    def read(text):
        return payloads.read_uri_list(spark.createDataFrame([(text,)], "uris string"))

    assert rows(read('[" a ", "b", null, "", "a", 7]'), "position", "uri") == [(0, "a"), (1, "b"), (2, "7")]
    for bad in ('{"a":1}', '["", " "]', "not json"):
        with pytest.raises(Exception, match="uri list"):
            read(bad).collect()


def test_in_window_is_half_open_and_keeps_undated(spark):
    df = spark.sql("SELECT 1 id, timestamp'2026-01-01' ts UNION ALL SELECT 2, timestamp'2026-01-02' UNION ALL SELECT 3, NULL")
    assert rows(casts.in_window(df, "2026-01-01", "2026-01-02", ["ts"]), "id") == [(1,), (3,)]
    assert rows(casts.in_window(df, "2026-01-01", "2026-01-02", ["ts"], keep_undated=False), "id") == [(1,)]
