from tidemark.sources.describe import describe_fields
from tidemark.sources.extract import (
    full_extract,
    incremental_extract,
    judged_extract,
    only_referencing,
    project_feed,
    read_landed,
    tenant_extract,
)
from tidemark.sources.metadata import read_metadata
from tidemark.sources.payloads import (
    PUSH_SCHEMA,
    json_records,
    parse_bodies,
    soap_records,
)
from tidemark.sources.records import Landed, field_values, read_records, read_wide, wide_records

__all__ = [
    "Landed",
    "PUSH_SCHEMA",
    "describe_fields",
    "field_values",
    "full_extract",
    "incremental_extract",
    "json_records",
    "judged_extract",
    "only_referencing",
    "parse_bodies",
    "project_feed",
    "read_landed",
    "read_metadata",
    "read_records",
    "read_wide",
    "soap_records",
    "tenant_extract",
    "wide_records",
]
