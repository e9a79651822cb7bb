import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from conftest import rows
from pressloom.catalog import load_all
from pressloom.catalog.base import REGISTRY, Tables
from pressloom.operators import coverage, pairs, topics

load_all()


def bridge(spark, lists):
    return spark.createDataFrame([(a, c) for a, cs in lists.items() for c in cs], "article_uri string, concept_uri string")


def brute(lists, min_shared):
    found = {}
    for x, y in combinations(sorted(lists), 2):
        n = len(set(lists[x]) & set(lists[y]))
        if n >= min_shared:
            found[x, y] = n
    return found


def top(lists, k, min_shared=1):
    return sorted(brute(lists, min_shared).items(), key=lambda e: (-e[1], e[0]))[:k]


def listed(df):
    return [((r.article_1, r.article_2), r.shared_concepts) for r in df.orderBy(F.desc("shared_concepts"), "article_1", "article_2").collect()]


def skewed(rng, n):
    """A third of the articles are copies, nearly all have the hot concept."""
    out = {}
    for i in range(n):
        if i % 3 == 0:
            out[f"a{i:03d}"] = ["hot", "c1", "c2", "c3"]
        else:
            out[f"a{i:03d}"] = ["hot"] + rng.sample([f"c{j}" for j in range(40)], rng.randint(0, 6))
    return out


@pytest.mark.parametrize("seed", range(2))
def test_top_pairs_under_skew(spark, seed):
    lists = skewed(random.Random(seed), 45)
    assert listed(pairs.shared_concepts(bridge(spark, lists), k=20)) == top(lists, 20)


def test_top_pairs_that_share_one_concept(spark):
    lists = {f"a{i:02d}": ["hot", f"own{i}"] for i in range(40)}
    lists["a00"].append("x")
    lists["a39"].append("x")
    assert listed(pairs.shared_concepts(bridge(spark, lists), k=7)) == top(lists, 7)


def test_fewer_pairs_than_asked(spark):
    lists = {"a": ["x", "y"], "b": ["x", "y"], "c": ["x"], "d": ["z"]}
    assert listed(pairs.shared_concepts(bridge(spark, lists), k=20)) == top(lists, 20)
    assert listed(pairs.shared_concepts(bridge(spark, lists), k=20, min_shared=2)) == top(lists, 20, 2)
    assert listed(pairs.shared_concepts(bridge(spark, lists), k=20, min_shared=9)) == []
    assert listed(pairs.shared_concepts(bridge(spark, {}), k=20)) == []


def test_many_pairs_of_equal_overlap(spark):
    """Nearly all pairs tie, so the answer hangs on the order of the articles."""
    lists = {f"a{i:02d}": ["hot", "warm", f"own{i}", f"also{i % 5}"] for i in range(40)}
    assert listed(pairs.shared_concepts(bridge(spark, lists), k=9)) == top(lists, 9)
    assert listed(pairs.shared_concepts(bridge(spark, lists), k=60)) == top(lists, 60)
    copies = {f"a{i:02d}": ["x"] if i % 2 else ["x", "y"] for i in range(12)}
    assert listed(pairs.shared_concepts(bridge(spark, copies), k=25)) == top(copies, 25)


@pytest.mark.parametrize("seed", range(3))
def test_top_pairs_of_random_sets(spark, seed):
    rng = random.Random(seed)
    lists = {f"a{i:03d}": rng.sample([f"c{j}" for j in range(12)], rng.randint(1, 7)) for i in range(rng.choice([4, 20, 60]))}
    k = rng.choice([1, 5, 200])
    assert listed(pairs.shared_concepts(bridge(spark, lists), k=k)) == top(lists, k)


def test_offers_grow_with_the_lists(spark):
    """Each list of a hot combination offers two pairs, not all of them."""
    lists = {f"a{i:03d}": ["hot", "warm", f"own{i}"] for i in range(200)}
    distinct = pairs._compared_sets(pairs.concept_sets(bridge(spark, lists)), 5, "article_uri")
    assert pairs._offered(distinct).count() <= 2


@pytest.mark.parametrize("min_shared", [1, 2, 3])
def test_all_pairs(spark, min_shared):
    lists = skewed(random.Random(4), 30)
    got = dict(listed(pairs.shared_concept_pairs(bridge(spark, lists), min_shared)))
    assert got == brute(lists, min_shared)


def components(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[find(a)] = find(b)
    members = {}
    for n in nodes:
        members.setdefault(find(n), set()).add(n)
    return sorted(sorted(m) for m in members.values())


@pytest.mark.parametrize("seed, gate", [(0, "both"), (1, "concept_branch")])
def test_links_connect_what_matching_pairs_connect(spark, seed, gate):
    rng = random.Random(seed)
    lists = skewed(rng, 40)
    meta = {a: (rng.choice(["e1", "e2", "", None]), rng.choice("pq"), rng.randint(0, 120)) for a in lists}
    arts = spark.createDataFrame([(a, *m) for a, m in meta.items()], "article_uri string, event_uri string, category string, h int")
    arts = arts.withColumn("ts", F.lit("2026-01-01").cast("timestamp") + F.make_dt_interval(hours=F.col("h")))
    got = rows(pairs.multi_signal_links(arts, bridge(spark, lists), k=3, max_hours=24, time_gate=gate), "article_1", "article_2")
    want = []
    for x, y in combinations(sorted(lists), 2):
        (e1, c1, h1), (e2, c2, h2) = meta[x], meta[y]
        near = abs(h1 - h2) <= 24
        same_event = bool(e1) and e1 == e2
        shared = len(set(lists[x]) & set(lists[y])) >= 3 and c1 == c2
        if (same_event and (near or gate == "concept_branch")) or (shared and near):
            want.append((x, y))
    pairs_ = {tuple(sorted(p)) for p in got}
    assert pairs_ <= set(want)
    assert components(lists, got) == components(lists, want)


def test_link_count_grows_with_rows(spark):
    n = 300
    arts = spark.range(n).select(F.concat(F.lit("a"), "id").alias("article_uri"), F.lit("e").alias("event_uri"), F.lit("c").alias("category"),
                                 (F.lit("2026-01-01").cast("timestamp") + F.make_dt_interval(mins=F.col("id").cast("int"))).alias("ts"))
    links = arts.select("article_uri", F.explode(F.array(*[F.lit(c) for c in "xyz"])).alias("concept_uri"))
    assert pairs.multi_signal_links(arts, links).count() == n - 1


@pytest.mark.parametrize("seed, gate", [(3, "both"), (4, "concept_branch")])
def test_clusters_are_the_components(spark, seed, gate):
    rng = random.Random(seed)
    lists = skewed(rng, 60)
    meta = {a: (rng.choice([f"e{i}" for i in range(9)] + ["", None]), rng.choice("pq"), rng.randint(0, 400)) for a in lists}
    arts = spark.createDataFrame([(a, *m) for a, m in meta.items()], "article_uri string, event_uri string, category string, h int")
    arts = arts.withColumn("ts", F.lit("2026-01-01").cast("timestamp") + F.make_dt_interval(hours=F.col("h")))
    want = []
    for x, y in combinations(sorted(lists), 2):
        (e1, c1, h1), (e2, c2, h2) = meta[x], meta[y]
        near = abs(h1 - h2) <= 24
        shared = len(set(lists[x]) & set(lists[y])) >= 3 and c1 == c2
        if (bool(e1) and e1 == e2 and (near or gate == "concept_branch")) or (shared and near):
            want.append((x, y))
    named = {a: members[0] for members in components(lists, want) for a in members}
    got = pairs.multi_signal_clusters(arts, bridge(spark, lists), k=3, max_hours=24, time_gate=gate)
    assert dict(rows(got, "article_uri", "cluster")) == named


def test_labels_of_a_long_chain(spark):
    """Labels jump, so a chain of 300 takes far fewer rounds; empty links give no labels."""
    links = spark.range(300).selectExpr("id + 1 AS a", "id AS b")
    assert pairs.propagate_labels(links).agg(F.max("label"), F.count("*")).first() == (0, 301)
    assert pairs.propagate_labels(links.limit(0)).isEmpty()


def test_links_of_unequal_sets(spark):
    """Articles whose sets all differ: one link per article and key at most, where all pairs match."""
    n = 120
    lists = {f"a{i:03d}": ["x", "y", f"own{i}"] for i in range(n)}
    arts = spark.createDataFrame([(a, None, "c", i) for i, a in enumerate(lists)], "article_uri string, event_uri string, category string, h int")
    arts = arts.withColumn("ts", F.lit("2026-01-01").cast("timestamp") + F.make_dt_interval(mins=F.col("h")))
    assert pairs.multi_signal_links(arts, bridge(spark, lists), k=2).count() == n - 1


def test_omissions(spark):
    articles = spark.createDataFrame([("e1", "a"), ("e1", "b"), ("e2", "a"), ("e2", "other"), ("", "c"), (None, "c")], "event_uri string, source_uri string")
    outlets = spark.createDataFrame([("a",), ("b",), ("c",)], "source_uri string")
    assert rows(coverage.coverage_omissions(articles, outlets), "event_uri", "source_uri") == [("e1", "c"), ("e2", "b"), ("e2", "c")]
    assert coverage.coverage_omissions(articles, outlets.limit(0)).isEmpty()


def test_omissions_of_many_outlets(spark):
    """Outlets fill several words, the last one in part."""
    rng = random.Random(6)
    names = [f"o{i:03d}" for i in range(150)]
    seen = {(f"e{rng.randrange(9)}", rng.choice(names + ["else", None])) for _ in range(600)} | {("bare", "else"), ("empty", None), *(("full", n) for n in names)}
    articles = spark.createDataFrame(sorted(seen, key=str) * 2, "event_uri string, source_uri string")
    outlets = spark.createDataFrame([(n,) for n in names] + [(None,), (names[0],)], "source_uri string")
    want = sorted((e, n) for e in {e for e, _ in seen} for n in names if (e, n) not in seen)
    assert rows(coverage.coverage_omissions(articles, outlets), "event_uri", "source_uri") == want


def test_candidate_topics(spark):
    """The index finds nine of ten of the topics that a comparison with all topics finds; both leave the same similarities."""
    rng = random.Random(8)
    middles = [[rng.gauss(0, 1) for _ in range(16)] for _ in range(12)]
    topic_rows = [(i, [x + rng.gauss(0, 0.5) for x in middles[i % 12]]) for i in range(400)] + [(1000, [0.0] * 16)]
    story_rows = [(i, [x + rng.gauss(0, 0.5) for x in middles[i % 12]]) for i in range(300)] + [(900, [0.0] * 16)]
    stories = spark.createDataFrame(story_rows, "story_id int, embedding array<double>")
    centroids = spark.createDataFrame(topic_rows, "topic_id int, centroid array<double>")
    exact = {(r.story_id, r.topic_id): r.embedding_similarity for r in topics.candidate_topics(stories, centroids, 16, 5, exact=True, block=64).collect()}
    found = {(r.story_id, r.topic_id): r.embedding_similarity for r in topics.candidate_topics(stories, centroids, 16, 5).collect()}
    assert len(exact) == 5 * 300 and all(exact.get(p, s) == s for p, s in found.items())
    assert len(exact.keys() & found.keys()) >= 0.9 * len(exact)
    assert topics.candidate_topics(stories, centroids.limit(0), 16, exact=True).isEmpty()
    assert topics.candidate_topics(stories.limit(0), centroids, 16).isEmpty()


def test_ancestors_end_at_gaps_and_cycles(spark):
    c = spark.createDataFrame([("a", "b"), ("b", "gone"), ("x", "y"), ("y", "x"), ("root", None)], "uri string, parent_uri string")
    got = rows(topics.category_ancestors(c), "uri", "ancestor_uri", "depth")
    assert got == [("a", "b", 1), ("a", "gone", 2), ("b", "gone", 1), ("x", "x", 2), ("x", "y", 1), ("y", "x", 1), ("y", "y", 2)]


def test_ancestors_of_a_long_chain(spark):
    c = spark.createDataFrame([(f"n{i}", f"n{i + 1}") for i in range(40)], "uri string, parent_uri string")
    got = topics.category_ancestors(c)
    assert got.count() == 40 * 41 // 2
    assert rows(got.where("uri = 'n0' AND depth >= 39"), "ancestor_uri", "depth") == [("n39", 39), ("n40", 40)]


def test_concept_label_may_be_escaped(spark):
    a = spark.createDataFrame([('[{"label":{"eng":"O\\u0027Brien"}}]', '{"title":"T"}'), ('[{"label":{"eng":"O\'Brien"}}]', '{"title":"T"}')], "concepts string, source string")
    assert rows(coverage.concept_coverage_by_source(a, "O'Brien")) == [("T", 2)]


def test_keyed_rows_are_shuffled_once(spark, monkeypatch):
    """One exchange deals the rows of all keys; hot keys, cut into hours, give the same links."""
    rng = random.Random(8)
    lists = {f"a{i:03d}": rng.sample("abcdef", rng.randrange(1, 5)) for i in range(150)}
    data = [(a, rng.choice(["e1", "e2", "", None]), rng.choice(["x", "y", None]), rng.randrange(400)) for a in lists] * 2
    arts = spark.createDataFrame(data, "article_uri string, event_uri string, category string, h int").select(
        "*", F.expr("CASE WHEN h < 380 THEN timestamp'2026-01-01 00:00:00' + make_dt_interval(0, 0, h * 20) END").alias("ts"))
    found = {gate: rows(pairs.multi_signal_links(arts, bridge(spark, lists), k=2, max_hours=5, time_gate=gate)) for gate in ("both", "concept_branch")}
    assert len(found["both"]) > 100 and len(found["concept_branch"]) > len(found["both"])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        links = pairs.multi_signal_links(arts, bridge(spark, lists), k=2, max_hours=5)
        text = links._jdf.queryExecution().explainString(links._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert text.count("Exchange hashpartitioning(key") == 2  # of the events and of the combinations
    monkeypatch.setattr(pairs, "HOT_ROWS", 5)
    for gate, want in found.items():
        assert rows(pairs.multi_signal_links(arts, bridge(spark, lists), k=2, max_hours=5, time_gate=gate)) == want


def test_heatmap_order_and_zeros(spark):
    e = spark.createDataFrame(
        [("T1", "left", True, "IN_SCOPE", 5), ("T1", "right", False, "IN_SCOPE", 5), ("T2", "left", None, "IN_SCOPE", 9), ("T2", "left", True, "OUT_OF_SCOPE", 9)],
        "topic_label string, source_name string, is_public_interest boolean, scope_status string, cluster_size int")
    cells = coverage.heatmap_cells(e)
    assert rows(cells, "topic_label", "source_name", "pi_count", "noise_count", "news_to_noise_ratio") == [
        ("T1", "left", 1, 0, None), ("T1", "right", 0, 1, 0.0), ("T2", "left", 0, 1, 0.0)]
    wide = coverage.heatmap_wide(cells, ["left", "right"])
    assert [tuple(r) for r in wide.collect()] == [("T2", 9, 1, 0), ("T1", 5, 1, 1)]


def test_outlets_in_bias_order(spark, monkeypatch):
    o = spark.createDataFrame([("mid", 0.0), ("right", 9.5), ("none", None), ("left", -3.0), ("also", 0.0), ("left", -2.0), (None, 1.0), ("bare", None)], "source_name string, adfontes_bias_score double")
    names = coverage.outlets_by_bias(o)
    assert names == ["left", "also", "mid", "right", "bare", "none"]
    cells = spark.createDataFrame([("T", 3, "mid", 4)], "topic_label string, cluster_size int, source_name string, article_count long")
    assert coverage.heatmap_wide(cells, names).columns == ["topic_label", "cluster_size", *names]
    monkeypatch.setattr(coverage, "MOST_OUTLETS", 3)
    with pytest.raises(ValueError):
        coverage.outlets_by_bias(o)


def test_wide_heatmap_of_many_listed_outlets(spark, folder):
    """The outlet table may list more outlets than a table has columns; stories of others keep their topic's row."""
    spark.range(3000).selectExpr("id + 1 AS s_suppkey", "'n' AS s_name", "1 AS s_nationkey", "0D AS s_acctbal").write.parquet(f"{folder}/supplier.parquet")
    spark.sql("SELECT 1 AS n_nationkey, 'n' AS n_name, 1 AS n_regionkey").write.parquet(f"{folder}/nation.parquet")
    spark.sql("SELECT * FROM VALUES (10L, 'en', 'src3'), (20L, 'en', 'src3'), (30L, 'en', 'src0'), (11L, 'en', 'src2999'), (12L, 'en', NULL) AS d (doc_id, lang, source)").write.parquet(f"{folder}/documents.parquet")
    spark.sql("SELECT 10L AS doc_id, 1 AS quality, 0 AS toxic").write.parquet(f"{folder}/labels.parquet")
    found = REGISTRY["v_heatmap_wide"].build(Tables(spark, folder))
    assert found.columns == ["topic_label", *(f"src{i}" for i in range(20))]
    assert {r.topic_label: {c: n for c, n in r.asDict().items() if n and c != "topic_label"} for r in found.collect()} == {
        "Topic 0": {"src3": 2, "src0": 1}, "Topic 1": {}, "Topic 2": {}}


def test_topic_states_add_up(spark):
    """Batches in any order and grouping give the roll-up of all stories."""
    rng = random.Random(2)
    data = [(rng.choice("xyz"), [rng.random() for _ in range(3)] if rng.random() < 0.9 else None, rng.choice(["a", "b", None]),
             rng.sample(["p", "q", "r"], rng.randrange(4)), rng.choice(["m", None])) for _ in range(90)] + [("lone", None, None, [], None)]
    df = spark.createDataFrame([(*d, i) for i, d in enumerate(data)], "topic_id string, embedding array<double>, top_category string, concept array<string>, entity string, i int")
    df = df.withColumn("published_at", F.lit("2026-01-01").cast("timestamp") + F.make_dt_interval(hours=F.col("i")))
    one = topics.merge_topic_states(topics.topic_state(df, 3), 3)
    parts = [topics.topic_state(df.where(F.col("i") % 4 == k), 3) for k in (2, 0, 3, 1)]
    two = topics.merge_topic_states(topics.merge_topic_states(parts[0].unionByName(parts[1]), 3).unionByName(topics.merge_topic_states(parts[2].unionByName(parts[3]), 3)), 3)

    def plain(state):
        return sorted(str([*r[:5], [round(x, 9) if x is not None else None for x in r["centroid"] or []], *r[5:7]]) for r in topics.rollup_of_state(state).select(
            "topic_id", "story_count", "earliest_published_at", "latest_published_at", "dominant_category", "dominant_concept", "dominant_entity", "centroid").collect())

    assert plain(one) == plain(two)
    assert rows(one.where("kind <> 'topic'"), "topic_id", "kind", "value", "n") == rows(two.where("kind <> 'topic'"), "topic_id", "kind", "value", "n")
    counts = {(r.topic_id, r.value): r.n for r in one.where("kind = 'concept'").collect()}
    assert counts == {(t, c): n for t in "xyz" for c in "pqr" if (n := sum(d[0] == t and c in d[3] for d in data))}


def test_concept_coverage_by_label_with_quotes(spark):
    import json

    label = 'A "quoted" ü'
    a = spark.createDataFrame([(json.dumps({"title": "s"}), json.dumps([{"label": {"eng": label}}]))], "source string, concepts string")
    assert rows(coverage.concept_coverage_by_source(a, label)) == [("s", 1)]
