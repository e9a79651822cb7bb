"""Queries over joins, coverage analytics, topics and evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressloom.catalog.base import Tables, query, sql_items, sql_ts, ts_text, with_fx
from pressloom.catalog.merging import _CAT, _CON, dims_cte
from pressloom.functions.vectors import cosine
from pressloom.operators import coverage, dims, pairs, topics
from pressloom.operators.joins import lookup

_TITLE = "CASE WHEN source NOT IN ('', 'null') THEN source->>'title' END"


# --- shared concepts --------------------------------------------------------------------


@query("shared_concepts", with_fx("links") + """
SELECT a1.article_uri AS article_1, a2.article_uri AS article_2, count(*) AS shared_concepts
FROM fx_links a1 JOIN fx_links a2 ON a1.concept_uri = a2.concept_uri AND a1.article_uri < a2.article_uri
GROUP BY ALL ORDER BY shared_concepts DESC, article_1, article_2 LIMIT 20""")
def shared_concepts(t: Tables) -> DataFrame:
    return pairs.shared_concepts(t.fx("links"), k=20)


@query("shared_concept_pairs", with_fx("links") + """
SELECT a1.article_uri AS article_1, a2.article_uri AS article_2, count(*) AS shared_concepts
FROM fx_links a1 JOIN fx_links a2 ON a1.concept_uri = a2.concept_uri AND a1.article_uri < a2.article_uri
GROUP BY ALL HAVING count(*) >= 2""")
def shared_concept_pairs(t: Tables) -> DataFrame:
    return pairs.shared_concept_pairs(t.fx("links"), 2)


_MULTI = with_fx("stories", "links", more="""
keyed AS (SELECT s.uri, s.ts, s.category || '|' || a.concept_uri || '|' || b.concept_uri AS key
  FROM fx_links a JOIN fx_links b ON a.article_uri = b.article_uri AND a.concept_uri < b.concept_uri JOIN fx_stories s ON s.uri = a.article_uri
  WHERE s.category IS NOT NULL
  UNION ALL SELECT uri, ts, event_uri FROM fx_stories WHERE event_uri <> ''),
chains AS (SELECT lag(uri) OVER w AS article_1, lag(ts) OVER w AS before, uri AS article_2, ts FROM keyed
  WHERE ts IS NOT NULL WINDOW w AS (PARTITION BY key ORDER BY ts, uri)),
chained AS (SELECT DISTINCT article_1, article_2 FROM chains WHERE article_1 IS NOT NULL AND ts <= before + to_days(CAST(30 AS INT)))""")


def _story_concepts(t: Tables) -> DataFrame:
    """The rows of the links, dealt by article before they are made distinct: all that follows groups by article."""
    named = t.raw("lineitem").select(F.concat(F.lit("a-"), F.col("l_orderkey").cast("string")).alias("uri"),
                                     F.concat(F.lit("c-"), F.col("l_partkey").cast("string")).alias("concept_uri"))
    return named.repartition("uri").distinct()


@query("multi_signal_links", _MULTI + "SELECT article_1, article_2 FROM chained")
def multi_signal_links(t: Tables) -> DataFrame:
    return pairs.multi_signal_links(t.fx("stories"), _story_concepts(t), k=2, max_hours=720,
                                    article="uri")


@query("multi_signal_clusters", _MULTI.replace("WITH ", "WITH RECURSIVE ", 1) + """,
edges AS (SELECT article_1 AS a, article_2 AS b FROM chained UNION SELECT article_2, article_1 FROM chained),
labels(uri, cluster) USING KEY (uri) AS (
  SELECT uri, uri FROM fx_stories
  UNION (SELECT e.a, min(l.cluster) FROM labels l JOIN edges e ON e.b = l.uri JOIN recurring.labels r ON r.uri = e.a
    WHERE l.cluster < r.cluster GROUP BY e.a))
SELECT uri, cluster FROM labels""")
def multi_signal_clusters(t: Tables) -> DataFrame:
    return pairs.multi_signal_clusters(t.fx("stories"), _story_concepts(t), k=2, max_hours=720,
                                       article="uri")


@query("top_entities", with_fx("links") + """
SELECT concept_uri, count(*) AS article_count FROM fx_links GROUP BY ALL ORDER BY article_count DESC, concept_uri LIMIT 25""")
def top_entities(t: Tables) -> DataFrame:
    return pairs.top_entities(t.fx("links"))


@query("top_entities_by_label", dims_cte(f"ce AS (SELECT {sql_items('concepts')} AS c FROM fx_articles)") + """
SELECT c->'label'->>'eng' AS concept, count(*) AS article_count FROM ce GROUP BY ALL ORDER BY article_count DESC, concept LIMIT 25""")
def top_entities_by_label(t: Tables) -> DataFrame:
    return coverage.top_entities_by_label(t.fx("articles"))


@query("stop_concepts", dims_cte(_CAT) + """,
links AS (SELECT DISTINCT article_uri, uri AS concept_uri FROM cat)
SELECT concept_uri, count(*) AS article_count, round(count(*) / (SELECT count(DISTINCT article_uri) FROM links), 6) AS share
FROM links GROUP BY ALL HAVING count(*) / (SELECT count(DISTINCT article_uri) FROM links) > 0.1""")
def stop_concepts(t: Tables) -> DataFrame:
    links = dims.category_links(t.fx("articles")).withColumnRenamed("category_uri", "concept_uri")
    return pairs.stop_concepts(links, 0.1).withColumn("share", F.round("share", 6))


# --- lookups ----------------------------------------------------------------------------


@query("articles_for_concept", dims_cte(_CON) + """
SELECT DISTINCT 'uri' AS given, article_uri AS uri FROM con WHERE uri = 'c/3'
UNION ALL SELECT DISTINCT 'label', article_uri FROM con WHERE label = '{"eng":"C20"}'""")
def articles_for_concept(t: Tables) -> DataFrame:
    a = t.fx("articles")
    links, concepts = dims.concept_links(a), dims.best_concepts(a)
    one = coverage.articles_for_concept(a, links, uri="c/3").select(F.lit("uri").alias("given"), "uri")
    two = coverage.articles_for_concept(a, links, concepts, label="C20").select(F.lit("label").alias("given"), "uri")
    return one.unionByName(two)


@query("flag_public_interest_concepts", with_fx("stories", "links") + """
SELECT uri, uri IN (SELECT article_uri FROM fx_links JOIN part ON concept_uri = 'c-' || p_partkey WHERE p_size = 7) AS public_interest_concept
FROM fx_stories""")
def flag_public_interest_concepts(t: Tables) -> DataFrame:
    watch = t.raw("part").where("p_size = 7").select(F.concat(F.lit("c-"), "p_partkey").alias("concept_uri"))
    return coverage.flag_public_interest_concepts(t.fx("stories"), t.fx("links"), watch).select("uri", "public_interest_concept")


@query("top_sources", with_fx("articles", "outlets") + """
SELECT o.source_name AS title, a.source_uri, count(*) AS articles
FROM fx_articles a LEFT JOIN (SELECT * FROM fx_outlets WHERE geo_group <> 'US') o USING (source_uri)
GROUP BY ALL ORDER BY articles DESC, source_uri NULLS LAST LIMIT 25""")
def top_sources(t: Tables) -> DataFrame:
    sources = t.fx("outlets").where("geo_group <> 'US'").select(F.col("source_uri").alias("uri"), F.col("source_name").alias("title"))
    return coverage.top_sources(t.fx("articles"), sources)


@query("recent_for_concept", dims_cte(_CON) + f"""
SELECT a.uri, a.title, {sql_ts('date_time_published')} AS date_time_published
FROM fx_articles a JOIN (SELECT DISTINCT article_uri, uri AS concept_uri FROM con) c ON c.article_uri = a.uri
WHERE concept_uri = 'c/5' ORDER BY a.date_time_published DESC NULLS FIRST, a.uri LIMIT 50""")
def recent_for_concept(t: Tables) -> DataFrame:
    a = t.fx("articles")
    found = coverage.recent_for_concept(a, dims.concept_links(a), "c/5")
    return found.withColumn("date_time_published", ts_text("date_time_published"))


@query("top_categories", with_fx("supply_links", "categories") + """
SELECT c.uri, c.label, count(*) AS article_count FROM fx_supply_links l JOIN fx_categories c ON c.uri = replace(l.category_uri, 's-', 's/')
GROUP BY ALL ORDER BY article_count DESC, c.uri LIMIT 25""")
def top_categories(t: Tables) -> DataFrame:
    links = t.fx("supply_links").withColumn("category_uri", F.replace("category_uri", F.lit("s-"), F.lit("s/")))
    return coverage.top_categories(links, t.fx("categories"))


@query("stories_with_assessment", with_fx("articles", "validation", "assessments", "scope") + """
SELECT a.title, v.top_category, p.label AS pi_label, CAST(material_impact AS INT) + CAST(institutional_action AS INT)
  + CAST(scope_scale AS INT) + CAST(new_information AS INT) AS met_count, s.scope_status
FROM fx_articles a JOIN fx_validation v ON v.story_id = a.uri JOIN fx_assessments p ON p.story_id = a.uri LEFT JOIN fx_scope s ON s.story_id = a.uri
WHERE p.is_public_interest ORDER BY a.date_time_published DESC NULLS FIRST, a.uri LIMIT 25""")
def stories_with_assessment(t: Tables) -> DataFrame:
    assessed = topics.assessment_met_count(t.fx("assessments"))
    return coverage.stories_with_assessment(t.fx("articles"), t.fx("validation"), assessed, t.fx("scope"))


@query("assessment_met_count", with_fx("assessments") + """
SELECT story_id, CAST(material_impact AS INT) + CAST(institutional_action AS INT) + CAST(scope_scale AS INT) + CAST(new_information AS INT) AS met_count
FROM fx_assessments""")
def assessment_met_count(t: Tables) -> DataFrame:
    return topics.assessment_met_count(t.fx("assessments")).select("story_id", "met_count")


@query("enriched_headlines", with_fx("articles", "outlets", "validation", "assignments", "topics", "assessments", "scope") + """
SELECT a.uri AS story_id, a.title, v.snippet_clean AS description, o.source_name, v.headline_clean, v.body_valid, v.top_category, g.topic_id,
  t.label AS topic_label, t.story_count AS cluster_size, g.composite_score, t.dominant_category, p.is_public_interest, p.label AS pi_label,
  p.new_information, s.scope_status, a.ingestion_source AS source_feed
FROM fx_articles a LEFT JOIN fx_validation v ON v.story_id = a.uri LEFT JOIN fx_assignments g ON g.story_id = a.uri
LEFT JOIN fx_topics t USING (topic_id) LEFT JOIN fx_assessments p ON p.story_id = a.uri LEFT JOIN fx_scope s ON s.story_id = a.uri
LEFT JOIN fx_outlets o ON o.source_uri = a.source_uri""")
def enriched_headlines(t: Tables) -> DataFrame:
    sources = t.fx("outlets").select(F.col("source_uri").alias("uri"), F.col("source_name").alias("title"))
    joined = coverage.enriched_headlines(
        t.fx("articles"), sources, t.fx("validation"), t.fx("assignments"), t.fx("topics"),
        topics.assessment_met_count(t.fx("assessments")), t.fx("scope"), "2026-03-01 00:00:00")
    return joined.select("story_id", "title", "description", "source_name", "headline_clean", "body_valid", "top_category", "topic_id",
                         "topic_label", "cluster_size", "composite_score", "dominant_category", "is_public_interest", "pi_label",
                         "new_information", "scope_status", "source_feed")


_BIAS = """
resc AS (SELECT *, CAST(allsides_bias_score IS NOT NULL AS INT) + CAST(adfontes_bias_score IS NOT NULL AS INT) + CAST(mbfc_bias_score IS NOT NULL AS INT) AS n,
  coalesce(allsides_bias_score, 0) + coalesce(adfontes_bias_score / 7, 0) + coalesce(mbfc_bias_score * 0.6, 0) AS total FROM fx_outlets),
scored AS (SELECT *, CASE WHEN n > 0 THEN total / n END AS s FROM resc),
bias AS (SELECT *, CASE WHEN s IS NULL THEN NULL WHEN s <= -3 THEN 'Left' WHEN s <= -1 THEN 'Lean Left' WHEN s < 1 THEN 'Center' WHEN s < 3 THEN 'Lean Right' ELSE 'Right' END AS lbl,
  CASE WHEN s IS NULL THEN NULL WHEN s <= -1 THEN 'Left' WHEN s < 1 THEN 'Center' ELSE 'Right' END AS grp FROM scored)"""


@query("composite_bias", with_fx("outlets", more=_BIAS) + """
SELECT source_name, round(s, 6) AS composite_bias_score, lbl AS composite_bias_label, grp AS political_group FROM bias""")
def composite_bias(t: Tables) -> DataFrame:
    b = coverage.composite_bias(t.fx("outlets"))
    return b.select("source_name", F.round("composite_bias_score", 6).alias("composite_bias_score"), "composite_bias_label", "political_group")


@query("topic_coverage_by_bias", with_fx("enriched", "outlets", more=_BIAS) + """
SELECT topic_label, lbl AS composite_bias_label, count(*) AS article_count FROM fx_enriched JOIN bias USING (source_name)
WHERE scope_status = 'IN_SCOPE' GROUP BY ALL ORDER BY article_count DESC, topic_label, composite_bias_label NULLS LAST LIMIT 50""")
def topic_coverage_by_bias(t: Tables) -> DataFrame:
    return coverage.topic_coverage_by_bias(t.fx("enriched"), coverage.composite_bias(t.fx("outlets")))


@query("dockets_by_comments", with_fx("dockets", "comment_counts") + """
SELECT d.docket_id, d.agency_id, d.title, r.comment_count AS received, p.comment_count AS posted FROM fx_dockets d
LEFT JOIN fx_comment_counts r ON r.entity_id = d.docket_id AND r.entity_type = 'docket_received'
LEFT JOIN fx_comment_counts p ON p.entity_id = d.docket_id AND p.entity_type = 'docket_posted'
ORDER BY received DESC NULLS LAST, d.docket_id LIMIT 25""")
def dockets_by_comments(t: Tables) -> DataFrame:
    return coverage.dockets_by_comments(t.fx("dockets"), t.fx("comment_counts"))


@query("open_documents_by_agency", """
SELECT c_mktsegment AS agency_id, count(*) AS open_documents FROM customer WHERE c_acctbal > 0 GROUP BY ALL""")
def open_documents_by_agency(t: Tables) -> DataFrame:
    docs = t.raw("customer").select(F.col("c_mktsegment").alias("agency_id"), (F.col("c_acctbal") > 0).alias("open_for_comment"))
    return coverage.open_documents_by_agency(docs)


@query("recent_collection_runs", f"SELECT event_id AS run_id, event_type AS status, {sql_ts('ts')} AS started_at FROM events ORDER BY ts DESC, event_id LIMIT 10")
def recent_collection_runs(t: Tables) -> DataFrame:
    r = t.raw("events").select(F.col("event_id").alias("run_id"), F.col("event_type").alias("status"), F.col("ts").alias("started_at"))
    return coverage.recent_collection_runs(r).withColumn("started_at", ts_text("started_at"))


@query("score_topic_assignment", """
WITH m AS (SELECT label, i, avg(CAST(embedding[i] AS DOUBLE)) AS x FROM embeddings, range(1, 65) r(i) GROUP BY ALL),
cen AS (SELECT label AS topic_id, list(x ORDER BY i) AS centroid FROM m GROUP BY label),
scored AS (SELECT vec_id AS story_id, topic_id, 0.5 * list_cosine_similarity(CAST(embedding AS DOUBLE[]), centroid) + 0.3 * ((vec_id % 4) / 4)
  + CASE WHEN label = topic_id THEN 0.1 ELSE 0 END + 0.1 * greatest(0, 1 - abs(topic_id - vec_id % 10) * 12 / 72) AS score
  FROM embeddings JOIN cen ON topic_id IN (label, (label + 1) % 10, (label + 4) % 10))
SELECT story_id, arg_min(topic_id, (-score, topic_id)) AS topic_id, round(max(score), 5) AS composite_score,
  CASE WHEN max(score) >= 0.6 THEN 'assigned_existing' ELSE 'created_new' END AS action FROM scored GROUP BY story_id""")
def score_topic_assignment(t: Tables) -> DataFrame:
    """Each story has three candidate topics."""
    e = t.raw("embeddings")
    centroids = topics.topic_centroids(e.withColumnRenamed("label", "topic_id"), 64)
    offered = F.array(*[((F.col("label") + i) % 10) for i in (0, 1, 4)])
    near = F.abs(F.col("topic_id") - F.col("vec_id") % 10) * 12.0
    candidates = lookup(e.withColumn("topic_id", F.explode(offered)), centroids, "topic_id", ["vec_id"], "inner").select(
        F.col("vec_id").alias("story_id"), "topic_id", cosine("embedding", "centroid").alias("embedding_similarity"),
        (F.col("vec_id") % 4 / 4).alias("concept_overlap_score"), (F.col("label") == F.col("topic_id")).alias("category_match"),
        near.alias("temporal_distance_hours"))
    best = topics.score_topic_assignment(candidates)
    return best.select("story_id", "topic_id", F.round("composite_score", 5).alias("composite_score"), "action")


@query("candidate_topics", """
WITH st AS (SELECT vec_id AS story_id, embedding, (vec_id % 37) * 10 + label AS topic_id FROM embeddings),
m AS (SELECT topic_id, i, avg(CAST(embedding[i] AS DOUBLE)) AS x FROM st, range(1, 65) r(i) GROUP BY ALL),
cen AS (SELECT topic_id, list(x ORDER BY i) AS centroid FROM m GROUP BY topic_id),
near AS (SELECT story_id, cen.topic_id, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), centroid), 9) AS s FROM st, cen)
SELECT story_id, topic_id, round(s, 6) AS embedding_similarity FROM near
QUALIFY row_number() OVER (PARTITION BY story_id ORDER BY s DESC, topic_id) <= 3""")
def candidate_topics(t: Tables) -> DataFrame:
    """Every story against the centroids of up to 370 topics, all of them compared."""
    stories = t.raw("embeddings").select(F.col("vec_id").alias("story_id"), "embedding", (F.col("vec_id") % 37 * 10 + F.col("label")).alias("topic_id"))
    found = topics.candidate_topics(stories, topics.topic_centroids(stories, 64), 64, exact=True, block=64)
    return found.withColumn("embedding_similarity", F.round("embedding_similarity", 6))


@query("coverage_omissions", with_fx("articles", "outlets") + """
SELECT e.event_uri, o.source_uri FROM (SELECT DISTINCT event_uri FROM fx_articles WHERE event_uri <> '') e, fx_outlets o
WHERE NOT EXISTS (SELECT 1 FROM fx_articles a WHERE a.event_uri = e.event_uri AND a.source_uri = o.source_uri)""")
def coverage_omissions(t: Tables) -> DataFrame:
    return coverage.coverage_omissions(t.fx("articles"), t.fx("outlets"))


@query("category_ancestors", with_fx("categories").replace("WITH ", "WITH RECURSIVE ", 1) + """,
up AS (SELECT uri, parent_uri AS ancestor_uri, 1 AS depth FROM fx_categories WHERE parent_uri IS NOT NULL
  UNION ALL SELECT up.uri, c.parent_uri, depth + 1 FROM up JOIN fx_categories c ON c.uri = up.ancestor_uri WHERE c.parent_uri IS NOT NULL)
SELECT uri, ancestor_uri, min(depth) AS depth FROM up GROUP BY ALL""")
def category_ancestors(t: Tables) -> DataFrame:
    return topics.category_ancestors(t.fx("categories"))


# --- coverage ---------------------------------------------------------------------------


@query("concept_coverage_by_source", dims_cte(f"ce AS (SELECT {_TITLE} AS source_title, {sql_items('concepts')} AS c FROM fx_articles)") + """
SELECT source_title, count(*) AS articles FROM ce WHERE (c->'label'->>'eng') = 'C19' GROUP BY ALL""")
def concept_coverage_by_source(t: Tables) -> DataFrame:
    return coverage.concept_coverage_by_source(t.fx("articles"), "C19")


@query("category_distribution", dims_cte(f"ge AS (SELECT {sql_items('categories')} AS c FROM fx_articles)") + """
SELECT c->>'uri' AS category, count(*) AS articles FROM ge GROUP BY ALL""")
def category_distribution(t: Tables) -> DataFrame:
    return coverage.category_distribution(t.fx("articles"))


_PAIR_CTE = (f"ce AS (SELECT uri, categories, {sql_items('concepts')} AS c FROM fx_articles), "
             f"cg AS (SELECT uri, c, {sql_items('categories')} AS g FROM ce)")


@query("concept_category_pairs", dims_cte(_PAIR_CTE) + "SELECT uri, c->'label'->>'eng' AS concept, g->>'uri' AS category FROM cg")
def concept_category_pairs(t: Tables) -> DataFrame:
    return coverage.concept_category_pairs(t.fx("articles"))


@query("concept_category_matrix", dims_cte(_PAIR_CTE) + """
SELECT c->'label'->>'eng' AS concept, g->>'uri' AS category, count(*) AS article_count FROM cg GROUP BY ALL
ORDER BY article_count DESC, concept, category LIMIT 50""")
def concept_category_matrix(t: Tables) -> DataFrame:
    return coverage.concept_category_matrix(t.fx("articles"))


@query("location_distribution", with_fx("articles") + """
SELECT location->'label'->>'eng' AS location, count(*) AS articles FROM fx_articles WHERE location NOT IN ('', 'null')
GROUP BY ALL ORDER BY articles DESC, location LIMIT 20""")
def location_distribution(t: Tables) -> DataFrame:
    return coverage.location_distribution(t.fx("articles"))


@query("source_specialization", dims_cte(f"ge AS (SELECT {_TITLE} AS source_title, {sql_items('categories')} AS c FROM fx_articles)") + """
SELECT source_title, c->>'uri' AS category, count(*) AS articles FROM ge GROUP BY ALL
ORDER BY articles DESC, source_title NULLS LAST, category LIMIT 50""")
def source_specialization(t: Tables) -> DataFrame:
    return coverage.source_specialization(t.fx("articles"))


@query("event_source_coverage", with_fx("articles") + f"""
SELECT event_uri, {_TITLE} AS source_title, count(*) AS articles FROM fx_articles GROUP BY ALL""")
def event_source_coverage(t: Tables) -> DataFrame:
    return coverage.event_source_coverage(t.fx("articles"))


@query("narrative_propagation", with_fx("articles", more=f"""
fa AS (SELECT event_uri, {_TITLE} AS source_title, min(date_time_published) AS f FROM fx_articles WHERE event_uri <> '' GROUP BY ALL)""") + f"""
SELECT event_uri, source_title, {sql_ts('f')} AS first_article, rank() OVER (PARTITION BY event_uri ORDER BY f NULLS LAST) AS arrival FROM fa""")
def narrative_propagation(t: Tables) -> DataFrame:
    return coverage.narrative_propagation(t.fx("articles")).withColumn("first_article", ts_text("first_article"))


@query("coverage_heatmap", with_fx("articles") + """
SELECT event_uri, source_uri, count(*) AS coverage FROM fx_articles GROUP BY ALL""")
def coverage_heatmap(t: Tables) -> DataFrame:
    return coverage.event_outlet_counts(t.fx("articles"))


@query("v_heatmap", with_fx("enriched", "outlets") + """
SELECT topic_label, source_name, count(*) AS article_count, count(*) FILTER (WHERE coalesce(is_public_interest, false)) AS pi_count,
  count(*) FILTER (WHERE NOT coalesce(is_public_interest, false)) AS noise_count,
  round(count(*) FILTER (WHERE is_public_interest) / NULLIF(count(*) FILTER (WHERE NOT coalesce(is_public_interest, false)), 0), 6) AS news_to_noise_ratio,
  any_value(adfontes_bias_score) AS adfontes_bias_score
FROM fx_enriched LEFT JOIN fx_outlets USING (source_name) WHERE scope_status = 'IN_SCOPE' GROUP BY topic_label, source_name""")
def v_heatmap(t: Tables) -> DataFrame:
    cells = coverage.heatmap_cells(t.fx("enriched"), t.fx("outlets"))
    return cells.select("topic_label", "source_name", "article_count", "pi_count", "noise_count",
                        F.round("news_to_noise_ratio", 6).alias("news_to_noise_ratio"), "adfontes_bias_score")


_OUTLETS = [f"src{i}" for i in range(20)]


@query("v_heatmap_wide", with_fx("enriched") + "SELECT topic_label, " + ", ".join(
    f"count(*) FILTER (WHERE source_name = '{o}') AS {o}" for o in _OUTLETS) + """
FROM fx_enriched WHERE scope_status = 'IN_SCOPE' GROUP BY topic_label""")
def v_heatmap_wide(t: Tables) -> DataFrame:
    """One column for each outlet of the answer, zeros where it has no stories; the outlet table may list any number of others."""
    cells = coverage.heatmap_cells(t.fx("enriched"))
    shown = t.spark.range(1).select(F.explode(F.array(*map(F.lit, _OUTLETS))).alias("source_name"))
    rated = shown.join(t.fx("outlets").select("source_name", "adfontes_bias_score"), "source_name", "left")
    return coverage.heatmap_wide(cells, coverage.outlets_by_bias(rated)).select("topic_label", *_OUTLETS)


@query("heatmap_asymmetry", with_fx("enriched", "outlets", more=_BIAS) + """,
n AS (SELECT topic_label, count(*) FILTER (WHERE grp = 'Left') AS l, count(*) FILTER (WHERE grp = 'Right') AS r,
  count(*) FILTER (WHERE geo_group = 'US') AS u, count(*) FILTER (WHERE geo_group = 'Non-US') AS x
  FROM fx_enriched JOIN bias USING (source_name) WHERE scope_status = 'IN_SCOPE' GROUP BY topic_label)
SELECT topic_label, round((l - r) / NULLIF(l + r, 0), 6) AS political_skew, round((u - x) / NULLIF(u + x, 0), 6) AS geo_skew FROM n""")
def heatmap_asymmetry(t: Tables) -> DataFrame:
    a = coverage.heatmap_asymmetry(t.fx("enriched"), coverage.composite_bias(t.fx("outlets")))
    return a.select("topic_label", F.round("political_skew", 6).alias("political_skew"), F.round("geo_skew", 6).alias("geo_skew"))


@query("topic_rollup", with_fx("articles") + """,
st AS (SELECT label AS topic_id, vec_id AS story_id, embedding, d.lang AS top_category, 'H' || vec_id AS headline,
  TIMESTAMP '2026-02-14 00:00:00' + to_hours(CAST(vec_id AS INT)) AS published_at FROM embeddings LEFT JOIN documents d ON d.doc_id = vec_id),
m AS (SELECT topic_id, i, avg(CAST(embedding[i] AS DOUBLE)) AS x FROM st, range(1, 65) r(i) GROUP BY ALL),
cen AS (SELECT topic_id, list(x ORDER BY i) AS centroid FROM m GROUP BY topic_id),
sim AS (SELECT topic_id, story_id, headline, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), centroid), 9) AS s FROM st JOIN cen USING (topic_id)),
med AS (SELECT topic_id, arg_min(story_id, (-s, story_id)) AS medoid_id, arg_min(headline, (-s, story_id)) AS label, max(s) AS s FROM sim GROUP BY topic_id),
cat AS (SELECT topic_id, top_category, count(*) AS n FROM st WHERE top_category IS NOT NULL GROUP BY ALL),
cats AS (SELECT topic_id, string_agg(top_category || '=' || n, ',' ORDER BY top_category) AS category_counts, arg_min(top_category, (-n, top_category)) AS dominant_category FROM cat GROUP BY topic_id)
SELECT topic_id, count(*) AS story_count, strftime(min(published_at), '%Y-%m-%d %H:%M:%S') AS earliest_published_at, any_value(med.medoid_id) AS medoid_id,
  any_value(med.label) AS label, round(any_value(med.s), 6) AS medoid_similarity, any_value(category_counts) AS category_counts, any_value(dominant_category) AS dominant_category,
  array_to_string(list_transform(any_value(cen.centroid), lambda v: CAST(round(v * 100000) AS BIGINT)), ',') AS centroid
FROM st JOIN med USING (topic_id) JOIN cen USING (topic_id) LEFT JOIN cats USING (topic_id) GROUP BY topic_id""")
def topic_rollup(t: Tables) -> DataFrame:
    lang = t.raw("documents").select(F.col("doc_id").alias("vec_id"), F.col("lang").alias("top_category"))
    stories = t.raw("embeddings").join(lang, "vec_id", "left").select(
        F.col("label").alias("topic_id"), F.col("vec_id").alias("story_id"), "embedding", "top_category",
        F.concat(F.lit("H"), "vec_id").alias("headline"),
        (F.lit("2026-02-14").cast("timestamp") + F.make_dt_interval(hours=F.col("vec_id").cast("int"))).alias("published_at"))
    r = topics.topic_rollup(stories, 64)
    listed = F.transform(F.map_entries("category_counts"), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return r.select("topic_id", "story_count", ts_text("earliest_published_at").alias("earliest_published_at"), "medoid_id", "label",
                    F.round("medoid_similarity", 6).alias("medoid_similarity"),
                    F.when(F.col("category_counts").isNotNull(), F.concat_ws(",", listed)).alias("category_counts"),
                    "dominant_category", _centroid_text())


def _centroid_text():
    return F.array_join(F.transform("centroid", lambda x: F.round(x * 100000).cast("bigint")), ",").alias("centroid")


def _topic_stories(t: Tables) -> DataFrame:
    """Stories of ten topics with a language, two concepts and an entity."""
    lang = t.raw("documents").select(F.col("doc_id").alias("vec_id"), F.col("lang").alias("top_category"))
    return t.raw("embeddings").join(lang, "vec_id", "left").select(
        F.col("label").alias("topic_id"), "vec_id", "embedding", "top_category",
        F.array(F.concat(F.lit("c"), F.col("vec_id") % 7), F.concat(F.lit("c"), F.col("vec_id") % 5)).alias("concept"),
        F.when(F.col("vec_id") % 3 > 0, F.concat(F.lit("e"), F.col("vec_id") % 11)).alias("entity"),
        (F.lit("2026-02-14").cast("timestamp") + F.make_dt_interval(hours=F.col("vec_id").cast("int"))).alias("published_at"))


_TOPIC_STATE = """
WITH st AS (SELECT label AS topic_id, vec_id, embedding, d.lang, 'c' || vec_id % 7 AS c1, 'c' || vec_id % 5 AS c2,
  CASE WHEN vec_id % 3 > 0 THEN 'e' || vec_id % 11 END AS e FROM embeddings LEFT JOIN documents d ON d.doc_id = vec_id),
vals AS (SELECT topic_id, 'top_category' AS kind, lang AS value FROM st UNION ALL SELECT topic_id, 'concept', c1 FROM st
  UNION ALL SELECT topic_id, 'concept', c2 FROM st WHERE c1 <> c2 UNION ALL SELECT topic_id, 'entity', e FROM st),
counts AS (SELECT topic_id, kind, value, count(*) AS n FROM vals WHERE value IS NOT NULL GROUP BY ALL),
m AS (SELECT topic_id, i, avg(CAST(embedding[i] AS DOUBLE)) AS x FROM st, range(1, 65) r(i) GROUP BY ALL),
cen AS (SELECT topic_id, list(x ORDER BY i) AS centroid FROM m GROUP BY topic_id)"""


def _merged_state(t: Tables) -> DataFrame:
    """The state of three batches, added up one after the other."""
    stories, state = _topic_stories(t), None
    for batch in range(3):
        more = topics.topic_state(stories.where(F.col("vec_id") % 3 == batch), 64)
        state = more if state is None else topics.merge_topic_states(state.unionByName(more), 64)
    return state


@query("topic_state_counts", _TOPIC_STATE + "SELECT topic_id, kind, value, n FROM counts")
def topic_state_counts(t: Tables) -> DataFrame:
    return _merged_state(t).where("kind <> 'topic'").select("topic_id", "kind", "value", "n")


@query("topic_rollup_of_batches", _TOPIC_STATE + """,
top AS (SELECT topic_id, kind, arg_min(value, (-n, value)) AS value FROM counts GROUP BY ALL)
SELECT st.topic_id, count(*) AS story_count, strftime(TIMESTAMP '2026-02-14 00:00:00' + to_hours(CAST(min(vec_id) AS INT)), '%Y-%m-%d %H:%M:%S') AS earliest_published_at,
  strftime(TIMESTAMP '2026-02-14 00:00:00' + to_hours(CAST(max(vec_id) AS INT)), '%Y-%m-%d %H:%M:%S') AS latest_published_at,
  array_to_string(list_transform(any_value(cen.centroid), lambda v: CAST(round(v * 100000) AS BIGINT)), ',') AS centroid,
  any_value(a.value) AS dominant_category, any_value(b.value) AS dominant_concept, any_value(c.value) AS dominant_entity
FROM st JOIN cen USING (topic_id) LEFT JOIN top a ON a.topic_id = st.topic_id AND a.kind = 'top_category'
  LEFT JOIN top b ON b.topic_id = st.topic_id AND b.kind = 'concept' LEFT JOIN top c ON c.topic_id = st.topic_id AND c.kind = 'entity' GROUP BY st.topic_id""")
def topic_rollup_of_batches(t: Tables) -> DataFrame:
    r = topics.rollup_of_state(_merged_state(t))
    return r.select("topic_id", "story_count", ts_text("earliest_published_at").alias("earliest_published_at"), ts_text("latest_published_at").alias("latest_published_at"),
                    _centroid_text(), "dominant_category", "dominant_concept", "dominant_entity")


@query("topic_value_counts", with_fx("links", "stories") + """
SELECT category AS topic_id, concept_uri AS value, count(*) AS n FROM fx_links JOIN fx_stories ON uri = article_uri GROUP BY ALL""")
def topic_value_counts(t: Tables) -> DataFrame:
    linked = t.fx("links").join(t.fx("stories").select(F.col("uri").alias("article_uri"), "category"), "article_uri")
    return topics.topic_value_counts(linked.withColumnRenamed("category", "topic_id"), "concept_uri")


_EVAL = """
WITH r AS (SELECT doc_id, doc_id % 4 AS run_id, quality = 1 AS human, toxic = 0 AS llm, quality = 1 AS hm, doc_id % 2 = 0 AS lm,
  toxic = 1 AS hi, doc_id % 3 = 0 AS li, true AS hs, doc_id % 5 > 0 AS ls, quality = 1 AS hn, quality = 1 AS ln FROM labels)"""


def _eval_results(t: Tables) -> DataFrame:
    q, x, i = F.col("quality") == 1, F.col("toxic") == 1, F.col("doc_id")
    return t.raw("labels").select(
        i.alias("story_id"), (i % 4).alias("run_id"), q.alias("human_is_public_interest"), (~x).alias("llm_is_public_interest"),
        F.when(q, "High").otherwise("Low").alias("human_label"), F.when(~x, "High").otherwise("Low").alias("llm_label"),
        q.alias("human_material_impact"), (i % 2 == 0).alias("llm_material_impact"),
        x.alias("human_institutional_action"), (i % 3 == 0).alias("llm_institutional_action"),
        F.lit(True).alias("human_scope_scale"), (i % 5 > 0).alias("llm_scope_scale"),
        q.alias("human_new_information"), q.alias("llm_new_information"))


@query("pi_eval_metrics", _EVAL + """,
c AS (SELECT run_id, count(*) AS benchmark_size, count(*) FILTER (WHERE llm AND human) AS tp, count(*) FILTER (WHERE llm AND NOT human) AS fp,
  count(*) FILTER (WHERE NOT llm AND human) AS fn, count(*) FILTER (WHERE NOT llm AND NOT human) AS tn,
  avg(CAST(hm = lm AS INT)) AS am, avg(CAST(hi = li AS INT)) AS ai, avg(CAST(hs = ls AS INT)) AS asc_, avg(CAST(hn = ln AS INT)) AS an FROM r GROUP BY run_id)
SELECT run_id, benchmark_size, round((tp + tn) / benchmark_size, 6) AS accuracy, round(tp / NULLIF(tp + fp, 0), 6) AS precision_pi,
  round(tp / NULLIF(tp + fn, 0), 6) AS recall_pi, round(2 * tp / NULLIF(2 * tp + fp + fn, 0), 6) AS f1_pi,
  round(fp / NULLIF(fp + tn, 0), 6) AS false_positive_rate, round(fn / NULLIF(fn + tp, 0), 6) AS false_negative_rate,
  round(am, 6) AS accuracy_material_impact, round(ai, 6) AS accuracy_institutional_action, round(asc_, 6) AS accuracy_scope_scale,
  round(an, 6) AS accuracy_new_information FROM c""")
def pi_eval_metrics(t: Tables) -> DataFrame:
    m = topics.pi_eval_metrics(_eval_results(t), ["run_id"])
    return m.select("run_id", "benchmark_size", *[F.round(c, 6).alias(c) for c in m.columns if c not in ("run_id", "benchmark_size")])


@query("pi_eval_matches", _EVAL + """
SELECT doc_id AS story_id, human = llm AS pi_match, human = llm AS label_match,
  CAST(hm = lm AS INT) + CAST(hi = li AS INT) + CAST(hs = ls AS INT) + CAST(hn = ln AS INT) AS criteria_match_count FROM r""")
def pi_eval_matches(t: Tables) -> DataFrame:
    return topics.eval_matches(_eval_results(t)).select("story_id", "pi_match", "label_match", "criteria_match_count")


@query("backfill_progress", with_fx("runs") + f"""
SELECT {sql_ts('run_id')} AS run_id, 'loaded' AS status, count(*) AS articles_fetched, count(DISTINCT user_id) AS articles_deduped
FROM fx_runs WHERE run_type = 'backfill' GROUP BY run_id""")
def backfill_progress(t: Tables) -> DataFrame:
    r = t.fx("runs").groupBy("run_id", "run_type").agg(
        F.lit("loaded").alias("status"), F.count("*").alias("articles_fetched"), F.count_distinct("user_id").alias("articles_deduped"),
        *[F.lit(0).alias(c) for c in ("rows_loaded", "db_rows_inserted", "db_rows_updated")])
    return coverage.backfill_progress(r).select(ts_text("run_id").alias("run_id"), "status", "articles_fetched", "articles_deduped")


@query("volume_by_source_day", with_fx("articles") + """
SELECT source_uri, count(*) AS articles, round(count(date_time_published)
  / (date_diff('day', min(CAST(date_time_published AS DATE)), max(CAST(date_time_published AS DATE))) + 1), 6) AS per_day
FROM fx_articles GROUP BY source_uri""")
def volume_by_source_day(t: Tables) -> DataFrame:
    return coverage.volume_by_source_day(t.fx("articles")).withColumn("per_day", F.round("per_day", 6))


@query("dedup_summary", with_fx("validation") + """
SELECT dedup_status, rule, count(*) AS stories FROM (SELECT dedup_status, trim(unnest(string_split(dedup_reason, ','))) AS rule FROM fx_validation
  WHERE dedup_status = 'duplicate' UNION ALL SELECT dedup_status, NULL FROM fx_validation WHERE dedup_status = 'keep') GROUP BY ALL""")
def dedup_summary(t: Tables) -> DataFrame:
    return coverage.dedup_summary(t.fx("validation"))


@query("concept_facets_by_run", with_fx("stories", "supply_links") + f"""
SELECT {sql_ts('run_id')} AS run_id, run_type, nth_run, category_uri AS concept_uri, count(*) AS articles
FROM fx_supply_links JOIN fx_stories ON uri = article_uri GROUP BY ALL""")
def concept_facets_by_run(t: Tables) -> DataFrame:
    links = t.fx("supply_links").withColumnRenamed("category_uri", "concept_uri")
    return coverage.concept_facets_by_run(t.fx("stories"), links).withColumn("run_id", ts_text("run_id"))


@query("concept_facets_by_window", dims_cte(_CON) + """
SELECT strftime(date_trunc('day', date_time_published), '%Y-%m-%d') AS day, concept_uri, count(*) AS articles
FROM (SELECT DISTINCT article_uri, uri AS concept_uri FROM con) c JOIN fx_articles a ON a.uri = c.article_uri
WHERE date_time_published IS NOT NULL GROUP BY ALL""")
def concept_facets_by_window(t: Tables) -> DataFrame:
    a = t.fx("articles")
    facets = coverage.concept_facets_by_window(a, dims.concept_links(a))
    return facets.select(F.date_format("window_start", "yyyy-MM-dd").alias("day"), "concept_uri", "articles")


@query("category_features", dims_cte(_CAT) + """
SELECT article_uri, count(*) FILTER (WHERE uri LIKE 'news/%') AS n_news, count(*) FILTER (WHERE uri LIKE 'dmoz/%') AS n_dmoz
FROM (SELECT DISTINCT article_uri, uri FROM cat) GROUP BY article_uri""")
def category_features(t: Tables) -> DataFrame:
    return coverage.category_features(dims.category_links(t.fx("articles")), ["news", "dmoz"])


@query("anomaly_summary", with_fx("anomalies") + """
SELECT category, severity, resolution_status, count(*) AS anomalies,
  CASE severity WHEN 'Low' THEN 1 WHEN 'Medium' THEN 2 WHEN 'High' THEN 3 WHEN 'Critical' THEN 4 ELSE 0 END AS severity_rank
FROM fx_anomalies GROUP BY ALL""")
def anomaly_summary(t: Tables) -> DataFrame:
    return coverage.anomaly_summary(t.fx("anomalies"))


@query("anomalies_by_item", with_fx("anomalies") + """
SELECT 'outlet' AS kind, item, count(*) AS anomalies FROM (SELECT unnest(list_distinct(string_split(outlets, ','))) AS item FROM fx_anomalies) GROUP BY ALL
UNION ALL SELECT 'tag', item, count(*) FROM (SELECT unnest(string_split(tags, ',')) AS item FROM fx_anomalies) GROUP BY ALL""")
def anomalies_by_item(t: Tables) -> DataFrame:
    from pressloom.functions.text import clean_list

    a = t.fx("anomalies").withColumns({"outlets": clean_list("outlets"), "tags": clean_list("tags")})
    one = coverage.anomalies_by_item(a, "outlets").withColumn("kind", F.lit("outlet"))
    return one.unionByName(coverage.anomalies_by_item(a, "tags").withColumn("kind", F.lit("tag")))


@query("enrichment_funnel", """
WITH r AS (SELECT date_trunc('day', ts) AS run_id, count(*) AS a, count(*) FILTER (WHERE event_type <> 'error') AS b,
  count(*) FILTER (WHERE event_type IN ('click', 'view', 'purchase')) AS c, count(*) FILTER (WHERE event_type IN ('click', 'view')) AS d,
  count(*) FILTER (WHERE event_type = 'view') AS e FROM events GROUP BY 1)
SELECT strftime(run_id, '%Y-%m-%d') AS run_id, a AS stories_selected, round(b / NULLIF(a, 0), 6) AS validated_rate, round(c / NULLIF(b, 0), 6) AS clustered_rate,
  round(d / NULLIF(c, 0), 6) AS judged_rate, round(e / NULLIF(d, 0), 6) AS scoped_rate, round(e / NULLIF(a, 0), 6) AS overall_rate FROM r""")
def enrichment_funnel(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    runs = t.raw("events").groupBy(F.date_trunc("day", "ts").alias("run_id")).agg(
        F.count("*").alias("stories_selected"), F.count_if(kind != "error").alias("stories_validated"),
        F.count_if(kind.isin("click", "view", "purchase")).alias("stories_clustered"),
        F.count_if(kind.isin("click", "view")).alias("stories_judged"), F.count_if(kind == "view").alias("stories_scoped"))
    f = coverage.enrichment_funnel(runs)
    rates = [c for c in f.columns if c.endswith("_rate")]
    return f.select(F.date_format("run_id", "yyyy-MM-dd").alias("run_id"), "stories_selected", *[F.round(c, 6).alias(c) for c in rates])
