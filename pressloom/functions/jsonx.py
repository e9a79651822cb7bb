"""JSON expressions on the VARIANT type.

A JSON ``null`` is a value (it is not SQL NULL), an absent key is SQL NULL; the
merge operators depend on that difference, so everything goes through VARIANT and
not through a typed ``from_json``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pressloom.functions.text import _c, blank_to_null, is_populated


def canonical_json(value: Column | str) -> Column:
    """Sorted keys, no blanks, last duplicate key wins; malformed text fails."""
    return F.to_json(F.parse_json(blank_to_null(value)))


def try_canonical_json(value: Column | str) -> Column:
    return F.to_json(F.try_parse_json(blank_to_null(value)))


def parsed(value: Column | str) -> Column:
    """VARIANT of a populated JSON text, NULL for NULL, blank and ``null``."""
    return F.when(is_populated(value), F.parse_json(_c(value)))


_TYPES = {"OBJECT": "object", "ARRAY": "array", "STRING": "string", "BOOLEAN": "boolean", "VOID": "null"}


def json_type(value: Column) -> Column:
    """``object``, ``array``, ``string``, ``number``, ``boolean`` or ``null``."""
    token = F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)
    names = F.create_map(*[F.lit(x) for pair in _TYPES.items() for x in pair])
    return F.when(value.isNotNull(), F.coalesce(F.try_element_at(names, token), F.lit("number")))


def is_object(value: Column) -> Column:
    return F.startswith(F.schema_of_variant(value), F.lit("OBJECT"))


def has_key(value: Column, key: str) -> Column:
    """Object has the key, also when its value is JSON ``null``."""
    return F.coalesce(F.try_variant_get(value, f"$.{key}", "variant").isNotNull(), F.lit(False))


def text_at(value: Column, path: str) -> Column:
    return F.try_variant_get(value, f"$.{path}", "string")


def filled_text_at(value: Column, path: str) -> Column:
    return blank_to_null(text_at(value, path))


def json_at(value: Column, path: str) -> Column:
    """JSON text of a member; JSON ``null`` comes back as the text ``null``."""
    return F.to_json(F.try_variant_get(value, f"$.{path}", "variant"))


def items(value: Column) -> Column:
    """Elements of a JSON array; NULL for every other JSON type."""
    return F.try_variant_get(value, "$", "array<variant>")


def label_at(value: Column, lang: str = "eng") -> Column:
    return text_at(value, f"label.{lang}")


def json_or_null(value: Column | str) -> Column:
    """JSON text of a value, the text ``null`` for an absent one."""
    return F.coalesce(_c(value), F.lit("null"))
