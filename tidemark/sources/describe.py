"""Object descriptions: one JSON document per object, one row per field out."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

DESCRIBE_SCHEMA = "struct<fields: array<struct<name: string, label: string, type: string, inlineHelpText: string>>>"


def describe_fields(docs: DataFrame, object_col: str = "object_name", doc_col: str = "doc") -> DataFrame:
    """Rows ``(object_name, name, label, type, inlineHelpText, pos)``."""
    parsed = F.from_json(F.col(doc_col), DESCRIBE_SCHEMA)
    return docs.select(
        F.col(object_col).alias("object_name"), F.posexplode(parsed["fields"]).alias("pos", "f")
    ).select("object_name", "pos", "f.*")
