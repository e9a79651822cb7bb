import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from pressloom import contracts as C
from pressloom.operators import casts, dims, merge
from pressloom.functions.times import instant
from test_scans import article_row, articles

SCHEMA = "uri string, a string, n int, updated_at string"


def table(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def staged(spark, data):
    return spark.createDataFrame(data, "uri string, a string, n int")


def run_merge(target, new, **options):
    return merge.merge_changed(target, new, ["uri"], ["a", "n"], on_insert={"updated_at": F.lit("now")},
                               on_change={"updated_at": F.lit("now")}, **options)


def test_actions_and_null_safety(spark):
    target = table(spark, [("k", "x", 1, "old"), ("same", None, 2, "old"), ("null", None, 3, "old"), ("diff", "x", 4, "old")])
    new = staged(spark, [("same", None, 2), ("null", "y", 3), ("diff", None, 4), ("new", "z", None)])
    got = rows(run_merge(target, new), "uri", "a", "n", "updated_at", "_action")
    assert got == [
        ("diff", None, 4, "now", "updated"), ("k", "x", 1, "old", "kept"), ("new", "z", None, "now", "inserted"),
        ("null", "y", 3, "now", "updated"), ("same", None, 2, "old", "unchanged")]
    assert rows(merge.merge_counts(run_merge(target, new))) == [(4, 3, 1, 2, 1)]


def test_duplicate_staged_keys(spark):
    new = staged(spark, [("a", "x", 1), ("a", "y", 2)])
    with pytest.raises(Exception, match="duplicate staged key"):
        run_merge(table(spark, []), new).collect()
    assert rows(run_merge(table(spark, []), new, on_duplicate="last", order=["n"]), "uri", "a") == [("a", "y")]


def test_replay_changes_nothing_and_order_does_not_matter(spark):
    rng = random.Random(5)
    for _ in range(3):
        old = [(f"u{i}", rng.choice("ab"), rng.randint(0, 2), "old") for i in range(20)]
        new = [(f"u{i}", rng.choice(["a", "b", None]), rng.randint(0, 2)) for i in range(10, 30)]
        once = run_merge(table(spark, old), staged(spark, new))
        shuffled = run_merge(table(spark, rng.sample(old, 20)).repartition(7), staged(spark, rng.sample(new, 20)))
        assert rows(once) == rows(shuffled)
        again = run_merge(once.drop("_action"), staged(spark, new))
        assert rows(again.drop("_action")) == rows(once.drop("_action"))
        assert again.where("_action IN ('inserted', 'updated')").isEmpty()


def test_same_json_in_other_spelling_is_unchanged(spark):
    run = {"ingestion_source": C.ARTICLE_INGESTION_SOURCE, "run_id": "2026-01-01T00:00:00Z", "run_type": "seed", "nth_run": 1,
           "collected_at": "2026-01-01T00:01:00Z"}
    one = casts.cast_articles(articles(spark, {"uri": "a", "source": '{"a":1,"b":[1]}'}), run)
    two = casts.cast_articles(articles(spark, {"uri": "a", "source": '{ "b" : [1.0], "a":2, "a" : 1.0 }'}), run)
    stored = merge.upsert_articles(one.limit(0).withColumns({c: instant("2026-01-01") for c in ("ingested_at", "created_at", "updated_at")}),
                                   one, "2026-01-02").drop("_action")
    assert rows(merge.upsert_articles(stored, two, "2026-01-03"), "_action") == [("unchanged",)]
    later = casts.cast_articles(articles(spark, {"uri": "a", "source": '{"a":1,"b":[1]}'}), {**run, "run_id": "2026-01-02T00:00:00Z"})
    assert rows(merge.upsert_articles(stored, later, "2026-01-03"), "_action") == [("updated",)]


def events(spark, count):
    row = {**{c: "" for c in C.EVENT_COLUMNS}, "uri": "e", "total_article_count": str(count)}
    return casts.cast_events(spark.createDataFrame([tuple(row[c] for c in C.EVENT_COLUMNS)], C.EVENTS.csv_schema))


def test_event_times(spark):
    first = events(spark, 1)
    empty = first.limit(0).withColumns({c: instant("2026-01-01") for c in ("first_collected_at", "last_collected_at", "created_at", "updated_at")})
    stored = merge.upsert_events(empty, first, "2026-01-02").drop("_action")

    def times(df):
        return [tuple(str(v)[:10] for v in r) for r in df.select("first_collected_at", "last_collected_at").collect()]

    assert times(merge.upsert_events(stored, first, "2026-01-05")) == [("2026-01-02", "2026-01-02")]
    assert times(merge.upsert_events(stored, first, "2026-01-05", touch_unchanged=True)) == [("2026-01-02", "2026-01-05")]
    assert times(merge.upsert_events(stored, events(spark, 2), "2026-01-05")) == [("2026-01-02", "2026-01-05")]


def test_json_null_overwrites_absent_does_not(spark):
    target = spark.createDataFrame([("s", '{"old":1}', "t")], "uri string, ranking string, title string")
    batch = articles(spark, {"uri": "a", "source": '{"uri":"s","ranking":null}'})
    merged = merge.merge_dimension(target, dims.best_sources(batch).select("uri", "ranking", "title"))
    assert rows(merged, "ranking", "title") == [("null", "t")]
    absent = articles(spark, {"uri": "a", "source": '{"uri":"s"}'})
    assert rows(merge.merge_dimension(target, dims.best_sources(absent).select("uri", "ranking", "title")), "ranking") == [('{"old":1}',)]


def test_unusable_sources_and_concepts(spark):
    batch = articles(
        spark, {"uri": "a", "source": '"text"', "concepts": '{"uri":"x"}'}, {"uri": "b", "source": '{"title":"no uri"}'},
        {"uri": "c", "source": '{"uri":""}', "concepts": '[{"uri":null},{"uri":""},{"label":{}},{"uri":"ok"},{"uri":"ok"}]'},
        {"uri": "", "source": '{"uri":"lost"}', "concepts": '[{"uri":"lost"}]'}, {"uri": "d", "source": "", "concepts": ""})
    assert rows(dims.best_sources(batch)) == []
    assert rows(dims.concept_links(batch)) == [("c", "ok")]


def test_best_rows_do_not_depend_on_partitioning(spark):
    rng = random.Random(3)
    data = [{"uri": f"a{i}", "concepts": '[{"uri":"hot"%s%s}]' % (
        rng.choice(["", ',"type":"org"', ',"type":"loc"']), rng.choice(["", ',"image":"i1"', ',"image":"i2"']))} for i in range(60)]
    first = rows(dims.best_concepts(articles(spark, *data).coalesce(1)))
    assert first == rows(dims.best_concepts(articles(spark, *rng.sample(data, 60)).repartition(40)))
    assert first[0][1:3] == ("org", "i2")


def test_links_follow_the_staged_list(spark):
    bridge = spark.createDataFrame([("a", "old"), ("b", "old"), ("c", "old")], "article_uri string, concept_uri string")
    batch = articles(spark, {"uri": "a", "concepts": '[{"uri":"n1"},{"uri":"n1"}]'}, {"uri": "b", "concepts": "[]"})
    new = merge.replace_links(bridge, dims.staged_uris(batch), dims.concept_links(batch))
    assert rows(new) == [("a", "n1"), ("c", "old")]


def test_source_uri_is_cleared(spark):
    stored = spark.createDataFrame([("a", "s"), ("b", "s"), ("c", "s")], "uri string, source_uri string").withColumn("updated_at", instant("2026-01-01"))
    batch = articles(spark, {"uri": "a"}, {"uri": "b", "source": '{"uri":"t"}'})
    assert rows(dims.sync_source_uri(stored, batch, "2026-02-01"), "uri", "source_uri") == [("a", None), ("b", "t"), ("c", "s")]
    assert rows(dims.sync_source_uri(stored, batch, "2026-02-01", clear=False), "uri", "source_uri") == [("a", "s"), ("b", "t"), ("c", "s")]


def test_insert_if_absent_takes_one_row_per_new_key(spark):
    target = spark.createDataFrame([("a", 1)], "k string, v int")
    new = spark.createDataFrame([("a", 9), ("b", 5), ("b", 3)], "k string, v int")
    assert rows(merge.insert_if_absent(target, new, ["k"])) == [("a", 1), ("b", 3)]


def test_article_row_has_every_column():
    assert list(article_row()) and set(article_row()) == set(C.ARTICLE_COLUMNS) and len(C.ARTICLE_TRACKED) == 34
    assert len(C.EVENT_TRACKED) == 16 and len(C.HEADLINE_TRACKED) == 11


def test_repeated_staged_uris_repeat_nothing(spark):
    stored = spark.createDataFrame([("a", None, None)], "uri string, source_uri string, updated_at timestamp")
    twice = spark.createDataFrame([("a", '{"uri":"s"}'), ("a", '{"uri":"t"}'), ("", "{}"), (None, "{}"), ("", "{}")], "uri string, source string")
    with pytest.raises(Exception, match="duplicate staged key"):
        dims.sync_source_uri(stored, twice, "2026-02-01").collect()
    once = twice.where("source <> '{\"uri\":\"t\"}'")
    assert rows(dims.sync_source_uri(stored, once, "2026-02-01"), "uri", "source_uri") == [("a", "s")]


def test_last_needs_an_order(spark):
    new = staged(spark, [("a", "x", 1), ("a", "y", 2)])
    with pytest.raises(ValueError, match="order"):
        run_merge(table(spark, []), new, on_duplicate="last")


def test_wide_rows_stay_where_they_are(spark, tmp_path):
    """Replaced rows go by an anti join on their places; the body is in no shuffle."""
    rng = random.Random(3)
    data = [(rng.choice(["a", "b", "c", None, f"k{i}"]), rng.choice([None, 1, 2, 3]), "body " * i) for i in range(200)] + [("a", 3, "x")] * 3
    spark.createDataFrame(data, "uri string, n int, body string").repartition(4).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t")).select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    late, plain = merge.dedupe_last(df, ["uri"], ["n"], ["file", "row"]), merge.dedupe_last(df, ["uri"], ["n", "file", "row"])
    assert rows(late) == rows(plain)
    assert late.count() == len({u for u, _, _ in data})
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = late.selectExpr("*")._jdf.queryExecution().explainString(late._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    shuffled = [part for part in text.split("\n\n") if ") Exchange" in part]
    assert "BroadcastExchange" in text and not any("body" in part for part in shuffled)
