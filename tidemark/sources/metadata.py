"""Metadata of custom fields as landed JSON: pages of three feeds, and describe documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.operators.conform import CORRUPT
from tidemark.specs import METADATA_FEEDS, TENANT

#: One describe document per object and tenant.
DESCRIBED = "described"
_FIELDS = "array<struct<name: string, label: string, type: string, inlineHelpText: string>>"


def landing_order(pos: Column) -> Column:
    """The order files landed in, then the place in the file: what "the last row wins" goes by."""
    return F.struct(
        F.col("_metadata.file_modification_time").alias("landed"), F.col("_metadata.file_path").alias("file"), pos.alias("pos")
    )


def read_metadata(spark: SparkSession, folder: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """The feeds ``custom_fields``, ``definitions``, ``particles`` and ``described`` from the subfolders of those names.

    A file holds one JSON value, ``{"CompanyId", "object_name", "records": [...]}`` (``fields`` in a describe document). Rows
    carry ``seq``, the order they landed in. Also returns the files that are no such value: ``feed, file, text``.
    """
    feeds, broken = {}, None
    for name in (*METADATA_FEEDS, DESCRIBED):
        feeds[name], bad = _pages(spark, f"{folder.rstrip('/')}/{name}", name)
        broken = bad if broken is None else broken.unionByName(bad)
    return feeds, broken


def _pages(spark: SparkSession, path: str, name: str) -> tuple[DataFrame, DataFrame]:
    if name == DESCRIBED:
        listed, kind, flags = "fields", _FIELDS, {}
    else:
        spec = METADATA_FEEDS[name]
        inner = ", ".join(f"`{n}`: {k}" for n, k in spec.text_fields.items() if n != TENANT)
        listed, kind, flags = "records", f"array<struct<{inner}>>", spec.types
    schema = f"{TENANT} string, object_name string, {listed} {kind}, {CORRUPT} string"
    pages = spark.read.schema(schema).option("multiLine", True).option("columnNameOfCorruptRecord", CORRUPT).json(path)
    pages = pages.select("*", "_metadata")
    unread = F.col(CORRUPT).isNotNull() | F.col(listed).isNull() | F.col("object_name").isNull() | F.col(TENANT).isNull()
    rows = pages.where(~unread).select(TENANT, "object_name", "_metadata", F.posexplode(listed).alias("pos", "r"))
    rows = rows.select(TENANT, "object_name", landing_order(F.col("pos")).alias("seq"), "r.*")
    rows = rows.withColumns({c: F.col(c).try_cast(k) for c, k in flags.items()}) if flags else rows
    text = F.coalesce(F.col(CORRUPT), F.to_json(F.struct(TENANT, "object_name", listed)))
    return rows, pages.where(unread).select(F.lit(name).alias("feed"), F.col("_metadata.file_path").alias("file"), text.alias("text"))
