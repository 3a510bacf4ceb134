from tidemark.operators.conform import (
    conform_payload,
    conform_source,
    split_valid,
    type_rules,
)
from tidemark.operators.custom_fields import (
    assemble_metadata,
    custom_attribute_rows,
    custom_value_rows,
    fields_with_values,
    last_per_key,
    nest_values,
    unnest_values,
    unpivot_values,
    with_values,
)
from tidemark.operators.lookup import enrich_owner, latest_with_fallback
from tidemark.operators.merge import collapse, merge, merge_actions
from tidemark.operators.routing import push_outcomes, route_records, union_labelled

__all__ = [
    "assemble_metadata",
    "collapse",
    "conform_payload",
    "conform_source",
    "custom_attribute_rows",
    "custom_value_rows",
    "enrich_owner",
    "fields_with_values",
    "last_per_key",
    "latest_with_fallback",
    "merge",
    "merge_actions",
    "nest_values",
    "push_outcomes",
    "route_records",
    "split_valid",
    "type_rules",
    "union_labelled",
    "unnest_values",
    "unpivot_values",
    "with_values",
]
