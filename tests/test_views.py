"""Upkeep of the story table against the full join."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from pressloom.operators.coverage import enriched_headlines
from pressloom.plans import views
from pressloom.plans.store import TableStore
from pressloom.schemas import TABLES

DAYS = [f"2026-03-{d:02d} 00:00:00" for d in range(1, 9)]


@pytest.fixture()
def store(spark, folder):
    return TableStore(spark, f"{folder}/store")


def table(spark, name, *given):
    """Rows of a published table; columns that are not given are NULL."""
    schema = spark.createDataFrame([], TABLES[name]).schema
    return spark.createDataFrame([tuple(r.get(c) for c in schema.names) for r in given], schema)


def put(spark, store, **given):
    store.publish({name: table(spark, name, *rows_) for name, rows_ in given.items()})


def full(store):
    names = ("articles", "sources", "validation", "assignments", "topics", "assessments", "scope")
    return enriched_headlines(*[store.read(n) for n in names], DAYS[0], keep=("source_uri",)).drop("enriched_at")


def same(store):
    want = full(store)
    assert rows(store.read(views.VIEW), *want.columns) == rows(want)
    return rows(store.read(views.VIEW), "story_id", F.dayofmonth("enriched_at"))


def test_three_deltas_equal_the_full_join(spark, store):
    put(spark, store,
        articles=[{"uri": u, "title": u.upper(), "body": "x" * 10, "source_uri": s} for u, s in
                  [("a", "s1"), ("b", "s1"), ("c", None), ("d", "s2"), ("e", "gone")]],
        sources=[{"uri": "s1", "title": "One"}, {"uri": "s2"}], topics=[{"topic_id": "t1", "label": "T", "story_count": 2}],
        assignments=[{"story_id": "a", "topic_id": "t1", "composite_score": 0.5}, {"story_id": "c", "topic_id": "t2"}, {"story_id": "d", "topic_id": None}],
        validation=[{"story_id": "a", "body_valid": True}, {"story_id": "nowhere", "body_valid": True}])
    assert views.refresh_enriched(store, DAYS[0]) == 1
    assert same(store) == [(u, 1) for u in "abcde"]
    # A story's own rows: only that story is written.
    put(spark, store, scope=[{"story_id": "b", "scope_status": "IN_SCOPE"}], assessments=[{"story_id": "b", "label": "High", "met_count": 2}])
    views.refresh_enriched(store, DAYS[1])
    assert same(store) == [("a", 1), ("b", 2), ("c", 1), ("d", 1), ("e", 1)]
    # Shared rows: a topic that is new to "c", a count, an outlet; "t1" keeps what "a" shows of it.
    put(spark, store, topics=[{"topic_id": "t1", "label": "T", "story_count": 2}, {"topic_id": "t2", "label": "U", "story_count": 1}],
        sources=[{"uri": "s2", "title": "Two"}])
    views.refresh_enriched(store, DAYS[2])
    assert same(store) == [("a", 1), ("b", 2), ("c", 3), ("d", 3), ("e", 1)]
    # Both at once, for one story: moved to another outlet and topic, whose rows change too.
    put(spark, store, articles=[{"uri": "a", "title": "A2", "source_uri": "s2"}, {"uri": "f", "source_uri": "s3"}],
        assignments=[{"story_id": "a", "topic_id": "t2", "composite_score": 0.9}],
        topics=[{"topic_id": "t2", "label": "U", "story_count": 2}, {"topic_id": "t1", "label": "T", "story_count": 1}],
        sources=[{"uri": "s3", "title": "Three"}])
    views.refresh_enriched(store, DAYS[3])
    assert same(store) == [("a", 4), ("b", 2), ("c", 4), ("d", 3), ("e", 1), ("f", 4)]
    version = store.version()
    assert views.refresh_enriched(store, DAYS[4]) == version - 1 and store.version() == version  # nothing to do


def test_several_loads_and_a_compaction_between_refreshes(spark, store):
    put(spark, store, articles=[{"uri": u, "source_uri": "s"} for u in "abc"], sources=[{"uri": "s", "title": "S"}])
    views.refresh_enriched(store, DAYS[0])
    put(spark, store, articles=[{"uri": "a", "title": "first", "source_uri": "s"}])
    put(spark, store, articles=[{"uri": "a", "title": "second", "source_uri": "s"}])
    store.compact("articles")
    put(spark, store, articles=[{"uri": "b", "title": "third", "source_uri": "s"}])
    assert rows(store.changes("articles", 1), "uri", "title") == [("a", "first"), ("a", "second"), ("b", "third")]
    assert store.changes("sources", 1) is None
    views.refresh_enriched(store, DAYS[1])
    assert same(store) == [("a", 2), ("b", 2), ("c", 1)]
    store.compact(views.VIEW)
    assert same(store) == [("a", 2), ("b", 2), ("c", 1)]


def test_a_refresh_fails_if_a_load_comes_between(spark, store):
    put(spark, store, articles=[{"uri": "a"}])
    pinned = store.pinned()
    put(spark, store, articles=[{"uri": "b"}])
    pinned.pinned = lambda: pinned
    with pytest.raises(Exception):
        views.refresh_enriched(pinned, DAYS[0])
    assert rows(store.read(views.VIEW)) == []
    views.refresh_enriched(store, DAYS[0])
    assert same(store) == [("a", 1), ("b", 1)]


def test_stories_topics_and_outlets_that_are_gone(spark):
    """The operator on plain tables: rows may have gone altogether."""
    def state(articles, topics, sources):
        kept = {"articles": table(spark, "articles", *articles), "topics": table(spark, "topics", *topics),
                "sources": table(spark, "sources", *sources),
                "assignments": table(spark, "assignments", *[{"story_id": u, "topic_id": "t"} for u in "abc"])}
        kept.update({n: table(spark, n) for n in ("validation", "assessments", "scope")})
        return kept

    def read(tables):
        return lambda name, keys: tables[name].join(keys.distinct(), keys.columns, "left_semi")

    empty = table(spark, "enriched").drop("deleted")
    old = state([{"uri": u, "source_uri": "s"} for u in "abc"], [{"topic_id": "t", "label": "T"}], [{"uri": "s", "title": "S"}])
    first = views.enriched_changes(read(old), empty, old, DAYS[0])
    assert rows(first, "story_id", "topic_label", "source_name", "deleted") == [(u, "T", "S", False) for u in "abc"]
    new = state([{"uri": u, "source_uri": "s"} for u in "ac"], [], [])
    deltas = {"articles": old["articles"].where("uri = 'b'"), "topics": old["topics"], "sources": old["sources"]}
    second = views.enriched_changes(read(new), first.drop("deleted"), deltas, DAYS[1])
    assert rows(second, "story_id", "topic_label", "source_name", "deleted") == [
        ("a", None, None, False), ("b", "T", "S", True), ("c", None, None, False)]
    assert rows(views.enriched_changes(read(new), first.drop("deleted"), {}, DAYS[1])) == []


def test_a_changed_story_reads_no_body_of_the_others(spark, store):
    """Inputs are filtered by the touched keys before anything else is joined."""
    put(spark, store, articles=[{"uri": u, "body": "x"} for u in "abc"])
    views.refresh_enriched(store, DAYS[0])
    put(spark, store, scope=[{"story_id": "a", "scope_status": "IN_SCOPE"}])
    views.refresh_enriched(store, DAYS[1])
    last = store.changes(views.VIEW, store.version() - 1)
    assert rows(last, "story_id", "scope_status", "deleted") == [("a", "IN_SCOPE", False)]
