"""Schemas of the published tables."""

from __future__ import annotations

from pressloom.contracts import ARTICLE_CASTS, ARTICLE_COLUMNS, EVENT_CASTS, EVENT_COLUMNS, HEADLINE_CASTS, HEADLINE_COLUMNS
from pressloom.operators.runs import LOG_SCHEMA

_SQL = {"json": "string", "flag": "boolean", "time": "string"}


def _ddl(columns: list[str], casts: dict[str, str], skip: set[str] = frozenset()) -> str:
    return ", ".join(
        f"`{c}` {_SQL.get(casts.get(c, 'string'), casts.get(c, 'string'))}" for c in columns if c not in skip
    )


_AUDIT = "created_at timestamp, updated_at timestamp"
_RUN = "run_id timestamp, ingestion_source string, run_type string, nth_run int"

_CRITERIA = ("is_public_interest boolean, met_count int, material_impact boolean, institutional_action boolean, "
             "scope_scale boolean, new_information boolean")

TABLES = {
    "articles": _ddl(ARTICLE_COLUMNS, ARTICLE_CASTS, {"run_type", "nth_run"})
    + f", {_RUN}, collected_at timestamp, ingested_at timestamp, {_AUDIT}, source_uri string",
    "events": _ddl(EVENT_COLUMNS, EVENT_CASTS, {"run_type", "nth_run"})
    + f", first_collected_at timestamp, last_collected_at timestamp, {_AUDIT}",
    "headlines": _ddl(HEADLINE_COLUMNS, HEADLINE_CASTS)
    + f", ingestion_source string, run_id timestamp, collected_at timestamp, ingested_at timestamp, {_AUDIT}",
    "sources": "uri string, title string, description string, social_media string, ranking string, "
    f"location string, image string, thumb_image string, {_AUDIT}",
    "concepts": f"uri string, type string, image string, label string, location string, synonyms string, {_AUDIT}",
    "categories": f"uri string, parent_uri string, label string, {_AUDIT}",
    "article_concepts": "article_uri string, concept_uri string",
    "article_categories": "article_uri string, category_uri string",
    "run_metrics": f"{_RUN}, stage string, metric_name string, metric_value bigint, "
    "stage_started_at timestamp, stage_completed_at timestamp, created_at timestamp",
    "event_requests": f"{_RUN}, event_uri string",
    "run_log": LOG_SCHEMA,
    "validation": "story_id string, headline_clean string, snippet_clean string, body_valid boolean, top_category string",
    "assignments": "story_id string, topic_id string, composite_score double",
    "topics": "topic_id string, label string, story_count bigint, dominant_category string",
    "assessments": f"story_id string, label string, {_CRITERIA}",
    "scope": "story_id string, scope_status string",
    "enriched": "story_id string, title string, description string, content string, url string, source_name string, "
    "published_at timestamp, headline_clean string, body_valid boolean, top_category string, topic_id string, topic_label string, "
    f"cluster_size bigint, composite_score double, dominant_category string, pi_label string, {_CRITERIA}, scope_status string, "
    "source_feed string, enriched_at timestamp, source_uri string, deleted boolean",
    "view_log": "view string, version bigint, at timestamp",
}

# Row identity: the newest row per key is current. Bridges are current per article.
TABLE_KEYS = {
    "articles": ["uri"], "events": ["uri"], "headlines": ["url"], "sources": ["uri"], "concepts": ["uri"],
    "categories": ["uri"], "topics": ["topic_id"],
    **{name: ["story_id"] for name in ("validation", "assignments", "assessments", "scope", "enriched")},
    "run_metrics": ["run_id", "ingestion_source", "run_type", "nth_run", "stage", "metric_name"],
}
BRIDGES = {"article_concepts": "article_uri", "article_categories": "article_uri"}
LOGS = ["run_log", "event_requests", "view_log"]
# Flag of rows that take their key out of the table.
TOMBSTONES = {"enriched": "deleted"}
