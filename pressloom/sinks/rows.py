"""API rows to artifact rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressloom.contracts import ARTICLE_COLUMNS, EVENT_COLUMNS, HEADLINE_COLUMNS
from pressloom.functions.jsonx import json_at, text_at

# Artifact column -> API field, where they differ by more than nothing.
_ARTICLE_FIELDS = {
    "date_time": "dateTime", "date_time_published": "dateTimePub", "is_duplicate": "isDuplicate",
    "data_type": "dataType", "event_uri": "eventUri", "story_uri": "storyUri",
    "duplicate_list": "duplicateList", "extracted_dates": "extractedDates",
    "original_article": "originalArticle",
}
_ARTICLE_JSON = [
    "source", "categories", "concepts", "links", "videos", "duplicate_list", "extracted_dates",
    "location", "original_article",
]
_EVENT_FIELDS = {
    "total_article_count": "totalArticleCount", "event_date": "eventDate",
    "social_score": "socialScore", "article_counts": "articleCounts", "common_dates": "commonDates",
}
_EVENT_JSON = [
    "article_counts", "title", "summary", "concepts", "categories", "common_dates", "location",
    "stories", "images",
]


def _json(value: Column, path: str) -> Column:
    """JSON text of a member; an absent one is the text ``null``."""
    return F.coalesce(json_at(value, path), F.lit("null"))


def _filled_json(value: Column, path: str) -> Column:
    return F.nullif(json_at(value, path), F.lit("null"))


def _run(value) -> Column:
    return (value if isinstance(value, Column) else F.lit(value)).cast("string")


def to_article_csv_row(articles: DataFrame, run_type, nth_run, article: str = "article") -> DataFrame:
    """VARIANT articles to the 32 text columns; an absent JSON value is the text ``null``,
    an absent scalar is empty, authors default to ``[]``, shares to the social score."""
    v = F.col(article)
    out = {c: F.coalesce(text_at(v, _ARTICLE_FIELDS.get(c, c)), F.lit("")) for c in ARTICLE_COLUMNS}
    out |= {c: _json(v, _ARTICLE_FIELDS.get(c, c)) for c in _ARTICLE_JSON}
    out |= {
        "run_type": _run(run_type),
        "nth_run": _run(nth_run),
        "authors": F.coalesce(_filled_json(v, "authors"), F.lit("[]")),
        "shares": F.coalesce(_filled_json(v, "shares"), _json(v, "socialScore")),
        "raw_article": F.to_json(v),
    }
    return articles.select(*[out[c].alias(c) for c in ARTICLE_COLUMNS])


def to_article_json_record(articles: DataFrame, run: dict, article: str = "article") -> DataFrame:
    """One JSON text per article for the JSONL file: lineage, fields, the raw article."""
    v = F.col(article)
    lineage = ["ingestion_source", "run_id", "run_type", "nth_run", "collected_at", "window_from", "window_to"]
    parts = [F.lit(run[c]).alias(c) for c in lineage]
    parts.append(text_at(v, "uri").alias("uri"))
    for c in ARTICLE_COLUMNS:
        if c in ("uri", "run_type", "nth_run"):
            continue
        if c == "authors":
            value = F.parse_json(F.coalesce(_filled_json(v, "authors"), F.lit("[]")))
        elif c == "shares":
            value = F.parse_json(F.coalesce(_filled_json(v, "shares"), _json(v, "socialScore")))
        elif c == "raw_article":
            value = v
        else:
            value = F.try_variant_get(v, f"$.{_ARTICLE_FIELDS.get(c, c)}", "variant")
        parts.append(value.alias(c))
    return articles.select(F.to_json(F.struct(*parts), {"ignoreNullFields": "false"}).alias("record"))


def to_event_csv_row(events: DataFrame, run_type, nth_run, event: str = "event") -> DataFrame:
    """VARIANT events to the 19 text columns."""
    v = F.col(event)
    out = {c: F.coalesce(text_at(v, _EVENT_FIELDS.get(c, c)), F.lit("")) for c in EVENT_COLUMNS}
    out |= {c: _json(v, _EVENT_FIELDS.get(c, c)) for c in _EVENT_JSON}
    out |= {"run_type": _run(run_type), "nth_run": _run(nth_run), "raw_event": F.to_json(v)}
    return events.select(*[out[c].alias(c) for c in EVENT_COLUMNS])


def to_headline_row(headlines: DataFrame, article: str = "article") -> DataFrame:
    """VARIANT headlines to the 9 text columns; the nested source is flattened."""
    paths = {
        "source_id": "source.id", "source_name": "source.name", "url_to_image": "urlToImage",
        "published_at": "publishedAt",
    }
    v = F.col(article)
    return headlines.select(*[F.coalesce(text_at(v, paths.get(c, c)), F.lit("")).alias(c) for c in HEADLINE_COLUMNS])
