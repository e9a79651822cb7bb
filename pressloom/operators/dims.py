"""JSON enrichment of staged articles to dimensions and bridges.

Staged input is the all-text table: ``source``, ``concepts`` and ``categories`` hold JSON.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressloom.functions.jsonx import filled_text_at, items, json_at, parsed
from pressloom.functions.text import blank_to_null
from pressloom.functions.times import instant
from pressloom.operators.casts import valid_key
from pressloom.operators.merge import merge_dimension, replace_links, require_unique


def source_uri_of(column: str = "source") -> Column:
    """uri of a source object; a path into anything but an object gives NULL."""
    return filled_text_at(parsed(column), "uri")


def explode_sources(staged: DataFrame) -> DataFrame:
    rows = valid_key(staged, "uri").select(parsed("source").alias("_v"))
    v = F.col("_v")
    return rows.select(
        filled_text_at(v, "uri").alias("uri"),
        filled_text_at(v, "title").alias("title"),
        filled_text_at(v, "description").alias("description"),
        json_at(v, "socialMedia").alias("social_media"),
        json_at(v, "ranking").alias("ranking"),
        json_at(v, "location").alias("location"),
        filled_text_at(v, "image").alias("image"),
        filled_text_at(v, "thumbImage").alias("thumb_image"),
    ).where("uri IS NOT NULL")


def _elements(staged: DataFrame, column: str) -> DataFrame:
    """(article_uri, element) per array element; other JSON types give no rows."""
    return valid_key(staged, "uri").select(
        F.col("uri").alias("article_uri"), F.explode(items(parsed(column))).alias("_e")
    )


def explode_concepts(staged: DataFrame) -> DataFrame:
    e = F.col("_e")
    return _elements(staged, "concepts").select(
        "article_uri",
        filled_text_at(e, "uri").alias("uri"),
        filled_text_at(e, "type").alias("type"),
        filled_text_at(e, "image").alias("image"),
        json_at(e, "label").alias("label"),
        json_at(e, "location").alias("location"),
        json_at(e, "synonyms").alias("synonyms"),
    ).where("uri IS NOT NULL")


def explode_categories(staged: DataFrame) -> DataFrame:
    e = F.col("_e")
    return _elements(staged, "categories").select(
        "article_uri",
        filled_text_at(e, "uri").alias("uri"),
        filled_text_at(e, "parentUri").alias("parent_uri"),
        filled_text_at(e, "label").alias("label"),
    ).where("uri IS NOT NULL")


def _best(rows: DataFrame, key: str, prefer: list[str], columns: list[str]) -> DataFrame:
    """Row per key with most preferred columns filled (in that order of weight), ties by
    the largest remaining values.

    ``max_by`` combines on the map side, so a key in a third of all rows costs one row
    per task and no sort of its group.
    """
    flags = [F.col(c).isNotNull().alias(f"_{c}") for c in prefer]
    rank = F.struct(*flags, *[F.col(c) for c in columns])
    return rows.groupBy(key).agg(F.max_by(F.struct(*columns), rank).alias("_w")).select(key, "_w.*")


def best_sources(staged: DataFrame) -> DataFrame:
    return _best(
        explode_sources(staged), "uri",
        ["description", "image", "thumb_image", "social_media", "ranking", "location"],
        ["title", "description", "social_media", "ranking", "location", "image", "thumb_image"],
    )


def best_concepts(staged: DataFrame) -> DataFrame:
    cols = ["type", "image", "label", "location", "synonyms"]
    return _best(explode_concepts(staged), "uri", cols, cols)


def best_categories(staged: DataFrame) -> DataFrame:
    cols = ["parent_uri", "label"]
    return _best(explode_categories(staged), "uri", cols, cols)


def concept_links(staged: DataFrame) -> DataFrame:
    return explode_concepts(staged).select("article_uri", F.col("uri").alias("concept_uri")).distinct()


def category_links(staged: DataFrame) -> DataFrame:
    return explode_categories(staged).select("article_uri", F.col("uri").alias("category_uri")).distinct()


def sync_source_uri(articles: DataFrame, staged: DataFrame, as_of, clear: bool = True) -> DataFrame:
    """Set ``source_uri`` of staged articles from their source object.

    An article whose new payload has no usable source loses it; with ``clear=False`` (the
    one-off backfill) it keeps the old one. A uri that is staged twice fails the job, since its
    rows may disagree; pick one before.
    """
    new = require_unique(valid_key(staged, "uri"), ["uri"]).select("uri", source_uri_of().alias("_new"), F.lit(True).alias("_hit"))
    value, old = F.col("_new"), F.col("source_uri")
    differs = F.coalesce(F.col("_hit"), F.lit(False)) & ~old.eqNullSafe(value)
    if not clear:
        differs = differs & value.isNotNull()
    return (
        articles.join(new, "uri", "left")
        .withColumn("updated_at", F.when(differs, instant(as_of)).otherwise(F.col("updated_at")))
        .withColumn("source_uri", F.when(differs, value).otherwise(old))
        .select(*articles.columns)
    )


def staged_uris(staged: DataFrame) -> DataFrame:
    return staged.select(blank_to_null("uri").alias("article_uri")).where("article_uri IS NOT NULL").distinct()


def normalize_articles(staged: DataFrame, tables: dict[str, DataFrame], as_of) -> dict[str, DataFrame]:
    """Whole dimension sync of one staged batch.

    ``tables`` holds articles, sources, concepts, categories, article_concepts and
    article_categories; the same names come back with their new content. The staged table
    feeds eight outputs, so persist it first. A uri that is staged twice fails the job.
    """
    uris = staged_uris(staged)
    return {
        "articles": sync_source_uri(tables["articles"], staged, as_of),
        "sources": merge_dimension(tables["sources"], best_sources(staged), as_of=as_of).drop("_action"),
        "concepts": merge_dimension(tables["concepts"], best_concepts(staged), as_of=as_of).drop("_action"),
        "categories": merge_dimension(tables["categories"], best_categories(staged), as_of=as_of).drop("_action"),
        "article_concepts": replace_links(tables["article_concepts"], uris, concept_links(staged)),
        "article_categories": replace_links(tables["article_categories"], uris, category_links(staged)),
    }
