"""String, null and list expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pressloom.contracts import ERROR_MESSAGE_CHARS


def _c(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def blank_to_null(value: Column | str) -> Column:
    return F.nullif(_c(value), F.lit(""))


def is_populated(value: Column | str) -> Column:
    """True for text that is neither NULL, empty nor the JSON text ``null``."""
    c = _c(value)
    return F.coalesce((c != "") & (c != "null"), F.lit(False))


def parse_flag(value: Column | str) -> Column:
    """Case-insensitive ``true``/``false``; anything else is NULL."""
    low = F.lower(_c(value))
    return F.when(low == "true", F.lit(True)).when(low == "false", F.lit(False))


def fallback_lineage(value: Column | str, manifest_value) -> Column:
    """The row's own value when it has one, else the manifest's."""
    other = manifest_value if isinstance(manifest_value, Column) else F.lit(manifest_value)
    return F.coalesce(blank_to_null(value), other)


def path_safe(value: Column | str) -> Column:
    return F.regexp_replace(_c(value), ":", "-")


def one_line(value: Column | str) -> Column:
    return F.regexp_replace(_c(value), "\r\n|\r|\n", " ")


def error_text(value: Column | str) -> Column:
    return F.substring(_c(value), 1, ERROR_MESSAGE_CHARS)


def clean_items(items: Column | str) -> Column:
    """Trimmed, non-empty, distinct items; the order of first sight is kept."""
    trimmed = F.transform(_c(items), lambda x: F.trim(x))
    return F.array_distinct(F.filter(trimmed, lambda x: x.isNotNull() & (x != "")))


def clean_list(value: Column | str, separator: str = ",") -> Column:
    return clean_items(F.split(_c(value), F.lit(separator)))


def object_key(value: Column | str) -> Column:
    """Percent-decoded object key, ``+`` meaning a blank."""
    return F.url_decode(_c(value))


def storage_bucket(value: Column | str) -> Column:
    return blank_to_null(F.regexp_extract(_c(value), r"^s3://([^/]+)", 1))


def storage_prefix(value: Column | str) -> Column:
    return F.regexp_extract(_c(value), r"^s3://[^/]+/(.*)$", 1)


def csv_cell(value: Column | str, single_line: bool = False) -> Column:
    """One CSV cell: quoted only if it holds a quote, comma, CR or LF; NULL is empty."""
    c = F.coalesce(_c(value).cast("string"), F.lit(""))
    if single_line:
        c = one_line(c)
    quoted = F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(c.rlike('[",\r\n]'), quoted).otherwise(c)


def csv_line(columns: list[str], single_line: bool = False) -> Column:
    return F.concat_ws(",", *[csv_cell(F.col(c), single_line) for c in columns])


def chunk(items: Column | str, size: int) -> Column:
    """Split an array into consecutive pieces of at most ``size`` items."""
    c = _c(items)
    starts = F.sequence(F.lit(1), F.size(c), F.lit(size))
    pieces = F.transform(starts, lambda s: F.slice(c, s, F.lit(size)))
    return F.when(F.size(c) > 0, pieces).otherwise(F.array().cast("array<array<string>>"))
