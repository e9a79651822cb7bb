"""News tables projected from the input tables.

One SQL text per projection, valid in Spark and in the oracle; ``$name`` is an input table
or another projection. All rows of the input are used. JSON texts have sorted keys and no
blanks, so they are already canonical; NULLs, blanks, JSON nulls and values of the wrong
JSON type are there on purpose.
"""

from pressloom.contracts import ARTICLE_INGESTION_SOURCE

PROJECTIONS = {
    "articles": """
SELECT doc_id,
  'doc-' || CAST(doc_id AS STRING) AS uri,
  'http://' || source || '.example.com/' || CAST(doc_id AS STRING) AS url,
  substr(text, 1, 60) AS title, text AS body, lang,
  CASE WHEN doc_id % 29 = 0 THEN NULL ELSE source || '.example.com' END AS source_uri,
  CASE WHEN doc_id % 11 = 0 THEN NULL WHEN doc_id % 13 = 0 THEN '' ELSE 'eng-' || CAST(doc_id % 97 AS STRING) END AS event_uri,
  CASE WHEN doc_id % 43 = 0 THEN NULL ELSE TIMESTAMP '2026-02-14 00:00:00'
    + INTERVAL '1' DAY * CAST(doc_id % 28 AS INT)
    + INTERVAL '1' MINUTE * CAST(doc_id * 37 % 1440 AS INT) END AS date_time_published,
  CASE WHEN doc_id % 29 = 0 THEN 'null' WHEN doc_id % 31 = 0 THEN '"plain text"'
    WHEN doc_id % 37 = 0 THEN '{"title":"' || source || '"}'
    ELSE '{' || CASE WHEN doc_id % 3 = 0 THEN '"description":"d' || CAST(doc_id % 5 AS STRING) || '",' ELSE '' END
      || CASE WHEN doc_id % 4 = 0 THEN '"image":"i' || CAST(doc_id % 6 AS STRING) || '",' ELSE '' END
      || CASE WHEN doc_id % 5 = 0 THEN '"ranking":{"rank":' || CAST(doc_id % 8 AS STRING) || '},' ELSE '' END
      || '"title":"' || source || '","uri":"' || source || '.example.com"}' END AS source,
  CASE WHEN doc_id % 9 = 0 THEN 'null' WHEN doc_id % 10 = 0 THEN '' WHEN doc_id % 41 = 0 THEN '{"uri":"no list"}'
    ELSE '[{' || CASE WHEN doc_id % 4 = 1 THEN '"image":"p' || CAST(doc_id % 5 AS STRING) || '",' ELSE '' END
    || '"label":{"eng":"C' || CAST(doc_id % 17 AS STRING) || '"},"type":"wiki","uri":"c/' || CAST(doc_id % 17 AS STRING) || '"},'
    || '{"label":{"eng":"C' || CAST(17 + doc_id % 23 AS STRING) || '"}'
    || CASE WHEN doc_id % 2 = 0 THEN ',"type":"org"' ELSE '' END
    || ',"uri":"c/' || CAST(17 + doc_id % 23 AS STRING) || '"},{"label":{"eng":"no uri"},"uri":""}]' END AS concepts,
  '[{"label":"' || lang || '","uri":"news/' || lang || '","wgt":' || CAST(doc_id % 100 AS STRING)
    || '},{' || CASE WHEN doc_id % 2 = 0 THEN '"parentUri":"dmoz",' ELSE '' END
    || '"uri":"dmoz/' || source || '","wgt":50}]' AS categories,
  CASE WHEN doc_id % 7 = 0 THEN 'null' WHEN doc_id % 8 = 0 THEN ''
    ELSE '{"label":{"eng":"City ' || CAST(doc_id % 31 AS STRING) || '"}}' END AS location,
  TIMESTAMP '2026-02-15 00:00:00' + INTERVAL '1' DAY * CAST(doc_id % 28 AS INT) AS run_id,
  '""" + ARTICLE_INGESTION_SOURCE + """' AS ingestion_source,
  CASE lang WHEN 'en' THEN 'scheduled' WHEN 'fr' THEN 'backfill' ELSE 'seed' END AS run_type,
  1 AS nth_run
FROM $documents""",
    "links": """
SELECT DISTINCT 'a-' || CAST(l_orderkey AS STRING) AS article_uri, 'c-' || CAST(l_partkey AS STRING) AS concept_uri
FROM $lineitem""",
    "supply_links": """
SELECT DISTINCT 'a-' || CAST(l_orderkey AS STRING) AS article_uri, 's-' || CAST(l_suppkey AS STRING) AS category_uri
FROM $lineitem""",
    # Articles of the links: one per order.
    "stories": """
SELECT 'a-' || CAST(o_orderkey AS STRING) AS uri, 'Story ' || CAST(o_orderkey AS STRING) AS title,
  'cust-' || CAST(o_custkey AS STRING) AS source_uri, o_orderpriority AS category,
  CASE WHEN o_orderstatus = 'P' THEN NULL ELSE 'ev-' || CAST(o_custkey AS STRING) END AS event_uri,
  o_orderdate AS ts, o_orderdate AS date_time_published, o_totalprice AS price,
  '""" + ARTICLE_INGESTION_SOURCE + """' AS ingestion_source, date_trunc('month', o_orderdate) AS run_id,
  CASE o_orderstatus WHEN 'F' THEN 'scheduled' WHEN 'O' THEN 'backfill' ELSE 'seed' END AS run_type, 1 AS nth_run
FROM $orders""",
    "categories": """
SELECT 'n/' || CAST(n_nationkey AS STRING) AS uri, 'r/' || CAST(n_regionkey AS STRING) AS parent_uri, n_name AS label FROM $nation
UNION ALL SELECT 'r/' || CAST(r_regionkey AS STRING), 'world', r_name FROM $region
UNION ALL SELECT 's/' || CAST(s_suppkey AS STRING), 'n/' || CAST(s_nationkey AS STRING), s_name FROM $supplier""",
    "runs": """
SELECT event_id, date_trunc('day', ts) AS run_id, 'src-' || CAST(user_id % 3 AS STRING) AS ingestion_source,
  CASE event_type WHEN 'signup' THEN 'seed' WHEN 'purchase' THEN 'backfill' ELSE 'scheduled' END AS run_type,
  event_type, user_id, value, ts AS created_at
FROM $events""",
    # Outlets and their ratings: one per supplier, named like the document sources.
    "outlets": """
SELECT 'src' || CAST(s_suppkey AS STRING) AS source_name, 'src' || CAST(s_suppkey AS STRING) || '.example.com' AS source_uri,
  CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE CAST(s_suppkey * 5 % 13 AS DOUBLE) - 6 END AS allsides_bias_score,
  CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE CAST(s_suppkey * 11 % 85 AS DOUBLE) - 42 END AS adfontes_bias_score,
  CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE CAST(s_suppkey * 7 % 21 AS DOUBLE) - 10 END AS mbfc_bias_score,
  CASE WHEN n_regionkey = 1 THEN 'US' ELSE 'Non-US' END AS geo_group
FROM $supplier JOIN $nation ON s_nationkey = n_nationkey""",
    "assessments": """
SELECT 'doc-' || CAST(doc_id AS STRING) AS story_id, quality = 1 AS is_public_interest,
  CASE WHEN quality = 1 AND toxic = 0 THEN 'High' WHEN quality = 1 THEN 'Moderate' ELSE 'Not Public Interest' END AS label,
  quality = 1 AS material_impact, toxic = 1 AS institutional_action, doc_id % 3 = 0 AS scope_scale, doc_id % 2 = 0 AS new_information
FROM $labels""",
    "scope": """
SELECT 'doc-' || CAST(doc_id AS STRING) AS story_id, CASE WHEN toxic = 1 THEN 'OUT_OF_SCOPE' ELSE 'IN_SCOPE' END AS scope_status
FROM $labels""",
    "validation": """
SELECT 'doc-' || CAST(doc_id AS STRING) AS story_id, lang AS top_category, 'headline ' || CAST(doc_id AS STRING) AS headline_clean,
  'snippet ' || CAST(doc_id AS STRING) AS snippet_clean, n_chars > 400 AS body_valid,
  CASE WHEN doc_id % 5 = 0 THEN 'duplicate' ELSE 'keep' END AS dedup_status,
  CASE WHEN doc_id % 10 = 0 THEN 'same_url, same_title' WHEN doc_id % 5 = 0 THEN 'same_title' ELSE NULL END AS dedup_reason
FROM $documents""",
    "assignments": """
SELECT 'doc-' || CAST(doc_id AS STRING) AS story_id, 'topic-' || CAST(doc_id % 10 AS STRING) AS topic_id,
  CAST(50 + doc_id % 50 AS DOUBLE) / 100 AS composite_score FROM $documents""",
    "topics": """
SELECT 'topic-' || CAST(doc_id % 10 AS STRING) AS topic_id, 'Topic ' || CAST(doc_id % 10 AS STRING) AS label,
  count(*) AS story_count, max(lang) AS dominant_category FROM $documents GROUP BY doc_id % 10""",
    "enriched": """
SELECT d.doc_id, 'doc-' || CAST(d.doc_id AS STRING) AS story_id, d.source AS source_name, d.lang,
  'Topic ' || CAST(d.doc_id % 10 AS STRING) AS topic_label, l.quality = 1 AS is_public_interest,
  CASE WHEN l.toxic = 1 THEN 'OUT_OF_SCOPE' ELSE 'IN_SCOPE' END AS scope_status,
  CAST(100 - d.doc_id % 10 AS INT) AS cluster_size
FROM $documents d LEFT JOIN $labels l ON d.doc_id = l.doc_id""",
    # Target and staged rows of the merge queries: they overlap in status P, where urgent
    # orders have a new price.
    "target": """
SELECT 'o-' || CAST(o_orderkey AS STRING) AS uri, o_orderstatus AS status, o_totalprice AS price, o_orderpriority AS label,
  TIMESTAMP '2026-01-01 00:00:00' AS created_at, TIMESTAMP '2026-01-01 00:00:00' AS updated_at
FROM $orders WHERE o_orderstatus IN ('F', 'P')""",
    "staged": """
SELECT 'o-' || CAST(o_orderkey AS STRING) AS uri, o_orderstatus AS status,
  CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 1 ELSE o_totalprice END AS price,
  CASE WHEN o_orderpriority = '2-HIGH' THEN NULL ELSE o_orderpriority END AS label
FROM $orders WHERE o_orderstatus IN ('O', 'P')""",
    "dockets": """
SELECT 'd-' || CAST(c_custkey AS STRING) AS docket_id, c_mktsegment AS agency_id, c_name AS title FROM $customer""",
    "comment_counts": """
SELECT CASE o_orderstatus WHEN 'F' THEN 'docket_received' WHEN 'O' THEN 'docket_posted' ELSE 'document' END AS entity_type,
  'd-' || CAST(o_custkey AS STRING) AS entity_id, count(*) AS comment_count
FROM $orders GROUP BY 1, 2""",
    "anomalies": """
SELECT event_id AS anomaly_id, ts AS report_time,
  CASE event_type WHEN 'error' THEN 'Saturation Event' WHEN 'signup' THEN 'Ignored Policy Proposals' ELSE 'Ignored Human Rights Violation' END AS category,
  CASE event_id % 5 WHEN 0 THEN 'Low' WHEN 1 THEN 'Medium' WHEN 2 THEN 'High' WHEN 3 THEN 'Critical' ELSE 'Unknown' END AS severity,
  CASE user_id % 3 WHEN 0 THEN 'Pending' WHEN 1 THEN 'Validated' ELSE 'Invalidated' END AS resolution_status,
  'outlet-' || CAST(user_id % 20 AS STRING) || ',outlet-' || CAST(user_id % 7 + 20 AS STRING) AS outlets,
  event_type || ',policy' AS tags
FROM $events""",
}
