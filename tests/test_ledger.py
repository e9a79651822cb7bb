import pytest
from pyspark.sql import functions as F

from conftest import rows
from pressloom import contracts as C
from pressloom.functions.times import instant
from pressloom.operators import discover, metrics, quality, ranking, runs

KEY = {"run_id": "2026-01-02", "ingestion_source": "s", "run_type": "scheduled", "nth_run": 1}


def event(spark, at, **fields):
    values = {**KEY, **fields}
    return spark.range(1).select(
        instant(at).alias("at"),
        *[(instant(v) if k in ("run_id", "window_from", "window_to") else F.lit(v)).alias(k) for k, v in values.items()])


def empty(spark):
    return spark.createDataFrame([], runs.LOG_SCHEMA)


def requests(spark, n, run_type="scheduled"):
    return spark.range(n).select(
        instant("2026-01-02").alias("run_id"), F.lit("s").alias("ingestion_source"), F.lit(run_type).alias("run_type"),
        (instant("2026-01-02") + F.make_dt_interval(secs=F.col("id"))).alias("at"), instant("2025-12-31").alias("window_from"),
        instant("2026-01-02").alias("window_to"), "id")


def test_reserved_numbers_go_on(spark):
    order = [F.col("at"), F.col("id")]
    log = runs.reserve_runs(empty(spark), requests(spark, 3), order)
    log = runs.reserve_runs(log, requests(spark, 2), order)
    log = runs.reserve_runs(log, requests(spark, 1, "seed"), order)
    assert rows(log, "run_type", "nth_run") == [("scheduled", i) for i in range(1, 6)] + [("seed", 1)]


def test_life_of_a_run(spark):
    log = runs.reserve_runs(empty(spark), requests(spark, 1), [F.col("at"), F.col("id")])
    log = runs.mark_collected(log, event(spark, "2026-01-02 01:00:00", articles_fetched=10, articles_deduped=8))
    log = runs.mark_load_started(log, event(spark, "2026-01-02 02:00:00"))
    log = runs.mark_failed(log, event(spark, "2026-01-02 02:05:00", error_code="loader_error", error_message="x" * 3000))
    failed = runs.fold_run_ledger(log)
    assert rows(failed, "status", "error_code", F.length("error_message"), "articles_fetched") == [("failed", "loader_error", 3000, 10)]
    log = runs.mark_load_started(log, event(spark, "2026-01-02 03:00:00"))
    log = runs.mark_loaded(log, event(spark, "2026-01-02 03:05:00", rows_loaded=8, db_rows_inserted=5, db_rows_updated=3))
    done = runs.fold_run_ledger(log)
    got = done.select("status", "error_code", "error_message", F.date_format("load_started_at", "HH:mm"), "rows_loaded").first()
    assert tuple(got) == ("loaded", None, None, "02:00", 8)
    assert quality.check_violations(done, quality.rules_for("runs")).isEmpty()
    manifests = spark.createDataFrame([("s", "scheduled", 1), ("s", "scheduled", 2)], "ingestion_source string, run_type string, nth_run int")
    manifests = manifests.withColumn("run_id", instant("2026-01-02"))
    assert rows(runs.skip_already_loaded(manifests, done), "nth_run") == [(2,)]
    assert rows(metrics.skip_report(manifests, done, "2026-01-03"), "nth_run", "skip_reason") == [(1, "pipeline_run_already_loaded")]
    log = runs.restart_run(log, event(spark, "2026-01-02 04:00:00", window_from="2025-12-30", window_to="2026-01-02"))
    assert rows(runs.fold_run_ledger(log), "status", F.date_format("window_from", "dd")) == [("started", "30")]


def test_events_of_unreserved_runs_change_nothing(spark):
    log = runs.mark_loaded(empty(spark), event(spark, "2026-01-02", rows_loaded=1, db_rows_inserted=1, db_rows_updated=0))
    assert runs.fold_run_ledger(log).isEmpty()
    assert runs.fold_run_ledger(log, require_reserved=False).count() == 1


def test_violations_pass_null_and_name_the_rule(spark):
    df = spark.createDataFrame([("scheduled", 1, "news"), ("nightly", 0, None), (None, None, "tweet")], "run_type string, nth_run int, data_type string")
    df = df.withColumn("ingestion_source", F.lit(C.ARTICLE_INGESTION_SOURCE))
    found = quality.check_violations(df, quality.rules_for("articles"))
    assert rows(found, "rule") == [("data_type",), ("nth_run",), ("run_type",)]


def test_numbering_a_hot_group(spark):
    """One group holds nearly all rows and spans many partitions."""
    df = spark.range(5000).select("id", F.when(F.col("id") % 50 == 0, F.concat(F.lit("g"), F.col("id") % 7)).otherwise("hot").alias("g"),
                                  F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 10).alias("o"))
    got = ranking.number_rows(df.repartition(13), ["g"], [F.col("o").asc_nulls_last(), F.col("id").asc()])
    from pyspark.sql import Window

    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy(F.col("o").asc_nulls_last(), "id")).cast("bigint"))
    assert rows(got, "id", "rn") == rows(want, "id", "rn")


def test_numbering_null_groups(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "g string, id int")
    assert rows(ranking.number_rows(df, ["g"], [F.col("id").desc()]), "id", "rn") == [(1, 2), (2, 1), (3, 1)]


def test_assign_keeps_given_numbers(spark):
    df = spark.createDataFrame([(1, 7), (2, None)], "id int, nth_run int").withColumns({
        "run_id": instant("2026-01-02"), "ingestion_source": F.lit("s"), "run_type": F.lit("seed"), "created_at": instant("2026-01-02")})
    assert rows(runs.assign_nth_run(df, "id"), "id", "nth_run") == [(1, 7), (2, 2)]


@pytest.mark.parametrize("only_missing, include_stale, want", [
    (False, False, ["fresh", "missing", "stale"]), (True, False, ["missing"]),
    (False, True, ["missing", "stale"]), (True, True, ["missing", "stale"])])
def test_freshness_truth_table(spark, only_missing, include_stale, want):
    candidates = spark.createDataFrame([("missing",), ("fresh",), ("stale",)], "event_uri string")
    events = spark.sql("SELECT 'fresh' uri, timestamp'2026-01-02 00:00:00' last_collected_at UNION ALL SELECT 'stale', timestamp'2026-01-01 00:00:00'")
    got = discover.freshness_filter(candidates, events, "2026-01-02 12:00:00", only_missing, include_stale)
    assert [r[0] for r in rows(got)] == want


def test_discovery_scopes(spark):
    a = spark.sql("SELECT 'e1' event_uri, 'x' source_uri, 'r' run_type UNION ALL SELECT '', 'x', 'r' UNION ALL SELECT NULL, 'y', 'r' UNION ALL SELECT 'e0', 'y', 'q'")
    assert rows(discover.discover_events(a, "full_corpus")) == rows(discover.discover_events(a, "custom_filter")) == [("e0",), ("e1",)]
    assert rows(discover.discover_events(a, "full_corpus", cap=1)) == [("e0",)]
    assert rows(discover.discover_events(a, "custom_filter", sources=["x"])) == [("e1",)]
    assert rows(discover.discover_events(a, "parent_run", {"run_type": "r"})) == [("e1",)]
    for bad in ({"scope": "nope"}, {"scope": "parent_run"}, {"scope": "time_window"}, {"scope": "time_window", "time_column": "wgt"}):
        with pytest.raises(ValueError):
            discover.discover_events(a, **bad)


def pages(spark, listing, size):
    """Pages of single letters; the time falls by an hour per page."""
    data = [(p, i, u, f"2026-01-10 {20 - p:02d}:00:00") for p, us in enumerate(listing, 1) for i, u in enumerate(us)]
    df = spark.createDataFrame(data, "page int, pos int, uri string, t string")
    return df.select(F.lit(1).alias("run"), "page", "pos", "uri", F.col("t").cast("timestamp").alias("ts"))


def facts(spark, listing, stop="2026-01-01"):
    audit = quality.page_audit(pages(spark, listing, 2), stop, ["run"])
    return [tuple(r) for r in audit.orderBy("page").select("articles", "new_uris", "seen_before_streak", "trusted_stop_streak").collect()]


def test_page_facts(spark):
    assert facts(spark, ["ab", "cd", "e"]) == [(2, 2, 0, 0), (2, 2, 0, 0), (1, 1, 0, 0)]
    assert facts(spark, ["ab", "ab", "ab", "ab", "cd", "cd"]) == [(2, 2, 0, 0), (2, 0, 1, 0), (2, 0, 2, 0), (2, 0, 3, 0), (2, 2, 0, 0), (2, 0, 1, 0)]
    # Beyond the boundary, a page that was seen or has nothing new ends the trusted ones.
    late = "2026-01-11"
    assert [f[2:] for f in facts(spark, ["ab", "cd", "ef"], late)] == [(0, 1), (0, 2), (0, 3)]
    assert [f[2:] for f in facts(spark, ["ab", "ab", "cd", "ef"], late)] == [(0, 1), (1, 0), (0, 1), (0, 2)]
    assert [f[2:] for f in facts(spark, ["ab", "ba", "cd", "ef"], late)] == [(0, 1), (0, 0), (0, 1), (0, 2)]


def verdicts(spark, listing, stop="2026-01-01"):
    audit = quality.page_audit(pages(spark, listing, 2), stop, ["run"], page_size=2)
    return [r[0] for r in audit.orderBy("page").select("verdict").collect()]


def test_page_verdicts(spark):
    assert verdicts(spark, ["ab", "cd", "e"]) == ["continue", "continue", "last_page"]
    assert verdicts(spark, ["ab", "ab", "ab", "cd"]) == ["continue"] * 4
    assert verdicts(spark, ["ab", "ab", "ab", "ab", "cd"]) == ["continue", "continue", "continue", "abort", "not_reached"]
    # Two trustworthy pages beyond the boundary stop; a repeated one in between resets.
    late = "2026-01-11"
    assert verdicts(spark, ["ab", "cd", "ef"], late) == ["continue", "early_stop", "not_reached"]
    assert verdicts(spark, ["ab", "ab", "cd", "ef"], late) == ["continue", "continue", "continue", "early_stop"]
    assert verdicts(spark, ["ab", "ba", "cd", "ef"], late) == ["continue", "continue", "continue", "early_stop"]


def test_nulls_do_not_collide(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 1), (None, 1)], "k string, n int")
    assert rows(quality.key_violations(df, ["k"])) == [("a", 2)]
    parent = spark.createDataFrame([("b",)], "uri string")
    assert rows(quality.orphans(df, parent, "k", "uri"), "k") == [("a",), ("a",)]
