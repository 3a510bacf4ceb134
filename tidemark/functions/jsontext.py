"""JSON text expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def json_map(text: Column) -> Column:
    """JSON object text as ``map<string,string>``; null, empty or bad text is an empty map.

    The text is parsed inside brackets, which turns anything after the first
    value into an error instead of letting it pass unread.
    """
    doc = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    return F.coalesce(
        F.try_variant_get(doc, "$[0]", "map<string,string>"),
        F.create_map().cast("map<string,string>"),
    )


def json_value(mapping: Column, key: str, default: str | None = None) -> Column:
    """Value under ``key``; the default stands in for an absent key, not for a null value."""
    return F.when(F.map_contains_key(mapping, key), F.try_element_at(mapping, F.lit(key))).otherwise(
        F.lit(default)
    )


def config_json(**fields: Column) -> Column:
    """JSON object text; a missing value is written as an empty text."""
    return F.to_json(
        F.struct(*[F.coalesce(value.cast("string"), F.lit("")).alias(key) for key, value in fields.items()])
    )
