from tidemark.functions.dates import (
    instant,
    instant_sql,
    iso_text,
    safe_parse_date,
    safe_parse_date_sql,
    to_millis,
    watermark_text,
)
from tidemark.functions.jsontext import config_json, json_map, json_value

__all__ = [
    "config_json",
    "instant",
    "instant_sql",
    "iso_text",
    "json_map",
    "json_value",
    "safe_parse_date",
    "safe_parse_date_sql",
    "to_millis",
    "watermark_text",
]
