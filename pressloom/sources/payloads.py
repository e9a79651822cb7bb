"""Landed API payloads (one JSON text per row) to article and event rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressloom.contracts import EVENT_FIELDS
from pressloom.functions.jsonx import is_object, items, text_at
from pressloom.functions.text import blank_to_null


def _object(value: Column, path: str) -> Column:
    found = F.try_variant_get(value, f"$.{path}", "variant")
    return F.when(is_object(found), found)


def _list(value: Column, path: str) -> Column:
    return F.try_variant_get(value, f"$.{path}", "array<variant>")


def _entries(value: Column) -> Column:
    return F.try_variant_get(value, "$", "map<string,variant>")


def _parse(raw: DataFrame, payload: str) -> DataFrame:
    return raw.withColumn("_v", F.parse_json(F.col(payload)))


def flatten_article_payload(raw: DataFrame, payload: str = "payload") -> DataFrame:
    """API envelope to one VARIANT ``article`` per row; the first shape present wins:
    ``article``, ``articles[]``, ``articles.results[]``, ``results[]``, else no rows."""
    v = F.col("_v")
    found = F.coalesce(
        F.when(_object(v, "article").isNotNull(), F.array(_object(v, "article"))),
        _list(v, "articles"),
        _list(v, "articles.results"),
        _list(v, "results"),
    )
    keep = [c for c in raw.columns if c != payload]
    return _parse(raw, payload).select(*keep, F.posexplode(found).alias("position", "article"))


def split_get_article_response(raw: DataFrame, payload: str = "payload") -> tuple[DataFrame, DataFrame]:
    """Object keyed by uri to (articles, errors); an ``info`` object wins over ``error``."""
    keep = [c for c in raw.columns if c != payload]
    entries = _parse(raw, payload).select(*keep, F.explode(_entries(F.col("_v"))).alias("requested_uri", "_e"))
    info, error = _object(F.col("_e"), "info"), blank_to_null(text_at(F.col("_e"), "error"))
    articles = entries.where(info.isNotNull()).select(*keep, "requested_uri", info.alias("article"))
    errors = entries.where(info.isNull() & error.isNotNull()).select(*keep, "requested_uri", error.alias("error"))
    return articles, errors


def normalize_keyed_event(entries: DataFrame, key: str = "key", value: str = "value",
                          out: str = "event") -> DataFrame:
    """VARIANT event of each keyed entry: outer fields win over those of ``info``, other
    ``info`` fields are kept, the uri is that of ``info`` unless empty, else the key.
    JSON ``null`` counts as absent; a field found nowhere is JSON ``null``."""
    keep = [c for c in entries.columns if c not in (key, value)]
    empty = F.create_map().cast("map<string,variant>")
    # The maps are columns of their own, so each JSON value is taken apart once.
    opened = entries.select(
        *keep, key, _entries(F.col(value)).alias("_outer"),
        F.coalesce(_entries(F.try_variant_get(value, "$.info", "variant")), empty).alias("_info"),
    )
    uri = F.try_element_at("_info", F.lit("uri"))
    inner_uri = F.when(F.schema_of_variant(uri) == "STRING", blank_to_null(F.try_variant_get(uri, "$", "string")))
    names = F.array(*[F.lit(f) for f in EVENT_FIELDS])

    def present(fields: str) -> Column:
        return F.map_filter(fields, lambda k, v: F.array_contains(names, k) & ~F.is_variant_null(v))

    opened = opened.select(
        "*", present("_outer").alias("_o"), present("_info").alias("_i"),
        F.coalesce(inner_uri, F.col(key)).cast("variant").alias("_uri"),
    )
    own = F.map_from_entries(F.transform(names, lambda f: F.struct(
        f, F.coalesce(F.try_element_at("_o", f), F.try_element_at("_i", f), F.parse_json(F.lit("null")))
    )))
    extras = F.map_filter("_info", lambda k, _: ~F.array_contains(names, k) & (k != "uri"))
    whole = F.map_concat(extras, own, F.create_map(F.lit("uri"), F.col("_uri")))
    return opened.select(*keep, F.to_variant_object(whole).alias(out))


def flatten_event_payload(raw: DataFrame, payload: str = "payload") -> DataFrame:
    """API envelope to one VARIANT ``event`` per row; the first shape present wins:
    ``event``, ``events[]``, ``events.results[]``, ``results[]``, else the entries of an
    object keyed by uri (keys with a ``-``)."""
    v = F.col("_v")
    listed = F.coalesce(
        F.when(_object(v, "event").isNotNull(), F.array(_object(v, "event"))),
        _list(v, "events"),
        _list(v, "events.results"),
        _list(v, "results"),
    )
    keep = [c for c in raw.columns if c != payload]
    parsed = _parse(raw, payload).withColumn("_listed", listed)
    plain = parsed.where(F.col("_listed").isNotNull()).select(*keep, F.explode("_listed").alias("event"))
    entries = (
        parsed.where(F.col("_listed").isNull())
        .select(*keep, F.explode(_entries(v)).alias("key", "value"))
        .where(F.col("key").contains("-") & F.schema_of_variant("value").rlike("^(OBJECT|ARRAY)"))
    )
    return plain.unionByName(normalize_keyed_event(entries))


def read_uri_list(values: DataFrame, column: str = "uris") -> DataFrame:
    """JSON array text per row to its trimmed, non-empty, distinct uris in request order.

    A text that is no JSON array, or that holds no uri, fails.
    """
    keep = [c for c in values.columns if c != column]
    parsed = F.try_parse_json(F.col(column))
    uris = F.transform(items(parsed), lambda e: F.trim(F.coalesce(F.try_variant_get(e, "$", "string"), F.lit(""))))
    uris = F.array_distinct(F.filter(uris, lambda u: u != ""))
    checked = (
        F.when(items(parsed).isNull(), F.raise_error(F.lit("uri list must be a JSON array")).cast("array<string>"))
        .when(F.size(uris) == 0, F.raise_error(F.lit("uri list is empty")).cast("array<string>"))
        .otherwise(uris)
    )
    return values.select(*keep, F.posexplode(checked).alias("position", "uri"))
