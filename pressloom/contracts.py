"""Artifact contracts: column lists, versions, file names and closed value sets."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- fixed values: they must equal those in existing artifacts and tables ----------

ARTICLE_CONTRACT_VERSION = "newsapi-ai/v3"
EVENT_CONTRACT_VERSION = "newsapi-ai-events/v1"
ARTICLE_INGESTION_SOURCE = "newsapi-ai"
EVENT_INGESTION_SOURCE = "newsapi-ai-events"
HEADLINE_INGESTION_SOURCES = ["newsapi-org", "rss", "scraper"]

ARTICLE_COLUMNS = [
    "uri", "run_type", "nth_run", "url", "title", "body", "date", "time", "date_time",
    "date_time_published", "lang", "is_duplicate", "data_type", "sentiment", "event_uri",
    "relevance", "story_uri", "image", "source", "authors", "sim", "wgt", "categories",
    "concepts", "links", "videos", "shares", "duplicate_list", "extracted_dates",
    "location", "original_article", "raw_article",
]

EVENT_COLUMNS = [
    "uri", "run_type", "nth_run", "total_article_count", "relevance", "event_date",
    "sentiment", "social_score", "article_counts", "title", "summary", "concepts",
    "categories", "common_dates", "location", "stories", "images", "wgt", "raw_event",
]

HEADLINE_COLUMNS = [
    "source_id", "source_name", "author", "title", "description", "url", "url_to_image",
    "published_at", "content",
]

RUN_TYPES = ["scheduled", "backfill", "seed"]
RUN_STATUSES = ["started", "collected", "loaded", "failed"]
RUN_STAGES = ["article_collect", "article_load", "event_collect", "event_load"]
DATA_TYPES = ["news", "blog", "pr"]
CONCEPT_TYPES = ["person", "loc", "org", "wiki"]
CYCLE_HOURS = [4, 6, 24]
DISCOVERY_SCOPES = ["parent_run", "time_window", "full_corpus", "custom_filter"]
DISCOVERY_TIME_COLUMNS = ["ingested_at", "date_time_published", "created_at"]
COMMENT_ENTITY_TYPES = ["docket_received", "docket_posted", "document"]
API_ACCESS_TYPES = ["Free", "Paid", "No API", "Pending"]
PAYWALL_TYPES = ["Hard", "Soft", "No Paywall", "Pending"]
ANOMALY_SEVERITIES = ["Low", "Medium", "High", "Critical"]
ANOMALY_CATEGORIES = [
    "Saturation Event", "Ignored Policy Proposals", "Ignored Human Rights Violation",
]
ANOMALY_STATUSES = ["Pending", "Validated", "Invalidated"]

SEED_RUN_ID = "1900-01-01 00:00:00"
ERROR_MESSAGE_CHARS = 2000
PAGE_SIZE = 100
MAX_PAGES = 500
MAX_REPEATED_PAGES = 3
TRUSTED_STOP_PAGES = 2
URI_BATCH_SIZE = 100
EVENT_BATCH_SIZE = 50
STALE_AFTER_HOURS = 24

RUN_KEY = ["run_id", "ingestion_source", "run_type", "nth_run"]
METRIC_KEY = RUN_KEY + ["stage", "metric_name"]

ARTICLE_JSON_COLUMNS = [
    "source", "authors", "categories", "concepts", "links", "videos", "shares",
    "duplicate_list", "extracted_dates", "location", "original_article", "raw_article",
]
EVENT_JSON_COLUMNS = [
    "article_counts", "title", "summary", "concepts", "categories", "common_dates",
    "location", "stories", "images", "raw_event",
]

ARTICLE_CASTS = {
    "date": "date", "time": "time", "date_time": "timestamp",
    "date_time_published": "timestamp", "is_duplicate": "flag", "sentiment": "double",
    "relevance": "int", "sim": "double", "wgt": "bigint",
    **{c: "json" for c in ARTICLE_JSON_COLUMNS},
}
EVENT_CASTS = {
    "total_article_count": "int", "relevance": "int", "event_date": "date",
    "sentiment": "double", "social_score": "double", "wgt": "bigint",
    **{c: "json" for c in EVENT_JSON_COLUMNS},
}
HEADLINE_CASTS = {"published_at": "timestamp"}

# Fields an event entry may carry outside or inside its ``info`` object.
EVENT_FIELDS = [
    "concepts", "categories", "eventDate", "totalArticleCount", "title", "summary", "images",
    "location", "commonDates", "articleCounts", "stories", "relevance", "sentiment",
    "socialScore", "wgt",
]

LINEAGE_COLUMNS = ["ingestion_source", "run_id", "run_type", "nth_run", "collected_at"]

# --- end of the fixed values --------------------------------------------------------

# Columns whose change makes a row "updated". Lineage counts for articles and
# headlines; events compare payload columns only.
ARTICLE_TRACKED = [
    c for c in ARTICLE_COLUMNS if c not in ("uri", "run_type", "nth_run")
] + LINEAGE_COLUMNS
EVENT_TRACKED = [c for c in EVENT_COLUMNS if c not in ("uri", "run_type", "nth_run")]
HEADLINE_TRACKED = [c for c in HEADLINE_COLUMNS if c != "url"] + [
    "ingestion_source", "run_id", "collected_at",
]


@dataclass(frozen=True)
class Contract:
    """What one kind of artifact directory must look like."""

    name: str
    key: str
    columns: tuple[str, ...]
    casts: tuple[tuple[str, str], ...]
    version: str | None
    data_file: str
    manifest_file: str
    report_file: str
    required: tuple[str, ...]

    @property
    def csv_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType()) for c in self.columns])


ARTICLES = Contract(
    "articles", "uri", tuple(ARTICLE_COLUMNS), tuple(ARTICLE_CASTS.items()),
    ARTICLE_CONTRACT_VERSION, "articles.csv", "manifest.json", "load_report.json",
    ("ingestion_source", "run_id", "collected_at", "window_from", "window_to"),
)
EVENTS = Contract(
    "events", "uri", tuple(EVENT_COLUMNS), tuple(EVENT_CASTS.items()),
    EVENT_CONTRACT_VERSION, "events.csv", "event-manifest.json", "event-load-report.json",
    ("ingestion_source", "run_id", "collected_at", "csv_file"),
)
HEADLINES = Contract(
    "headlines", "url", tuple(HEADLINE_COLUMNS), tuple(HEADLINE_CASTS.items()),
    None, "articles.csv", "manifest.json", "load_report.json",
    ("ingestion_source", "run_id", "collected_at", "window_from", "window_to"),
)

# DDL texts: readers parse them once there is a session.
MANIFEST_SCHEMA = (
    "artifact_contract_version string, ingestion_source string, canonical_tz string, "
    "collector_mode string, cycle_hours int, run_id string, run_type string, nth_run int, "
    "window_from string, window_to string, collected_at string, source_uris array<string>, "
    "lang string, articles_fetched bigint, articles_deduped bigint, "
    "requested_article_uri_count bigint, missing_article_uri_count bigint, "
    "article_uri_batch_size int, page_size int, max_pages int, pagination_optimization string, "
    "schedule_recommendation struct<service:string,timezone:string,time:string,note:string>, "
    "csv_file string"
)
EVENT_MANIFEST_SCHEMA = (
    "artifact_contract_version string, ingestion_source string, run_id string, run_type string, "
    "nth_run int, collected_at string, parent_run_id string, parent_run_type string, "
    "parent_nth_run int, parent_ingestion_source string, parent_load_report_path string, "
    "artifact_dir string, discovery_scope string, discovery_time_column string, "
    "discovery_start string, discovery_end string, discovery_source_uris array<string>, "
    "only_missing boolean, include_stale boolean, stale_after_hours int, "
    "candidate_articles_scanned bigint, distinct_event_uris_discovered bigint, "
    "distinct_event_uris_selected bigint, events_fetched bigint, csv_file string"
)
REPORT_SCHEMA = (
    "artifact_contract_version string, ingestion_source string, run_id string, run_type string, "
    "nth_run int, artifacts_dir string, rows_in_artifact bigint, rows_attempted bigint, "
    "rows_loaded bigint, db_rows_inserted bigint, db_rows_updated bigint, "
    "db_rows_unchanged bigint, load_started_at string, load_completed_at string, "
    "pipeline_status string, skip_reason string"
)
