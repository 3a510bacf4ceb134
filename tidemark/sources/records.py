"""Records with user-defined fields, of any number of objects in one feed: the fields are a VARIANT."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.operators.conform import CORRUPT
from tidemark.operators.custom_fields import SUFFIX
from tidemark.sources.extract import feed_instant
from tidemark.specs import TENANT

OBJECT, FIELDS, AT = "Object", "fields", "__at"


@dataclass(frozen=True)
class Landed:
    """A wide feed as it lies in files: ``Id``, tenant, time, and a column per field, of which only some are read."""

    path: str | list[str]
    fmt: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)


def read_wide(spark: SparkSession, landed: Landed, names: Sequence[str], ts_col: str) -> DataFrame:
    """The named fields of a landed feed and no others; the names come from the metadata of the run.

    Columnar files are read by their own types, as far as they have the fields; text formats as text.
    """
    reader, heads = spark.read.format(landed.fmt).options(**landed.options), ["Id", TENANT, ts_col]
    if landed.fmt in ("json", "csv"):
        schema = ", ".join(f"`{n}` string" for n in dict.fromkeys([*heads, *names, CORRUPT]))
        return reader.schema(schema).option("columnNameOfCorruptRecord", CORRUPT).load(landed.path)
    df = reader.load(landed.path)
    return df.select(*heads, *[n for n in names if n in df.columns])


def _record(obj: Column, tenant: Column, key: Column, time: Column, at: Column, fields: Column, corrupt: Column) -> list[Column]:
    texts = {OBJECT: obj, TENANT: tenant, "Id": key, "time": time, CORRUPT: corrupt}
    return [*[c.cast("string").alias(n) for n, c in texts.items()], at.alias(AT), fields.alias(FIELDS)]


def wide_records(wide: Mapping[str, DataFrame], names: Mapping[str, Sequence[str]] | None, ts_col: str) -> DataFrame:
    """Wide feeds of several objects as one feed of records.

    ``names`` are the fields to take per object; without it, all columns that end in ``__c``.
    """
    parts = []
    for obj, df in wide.items():
        fields = [c for c in df.columns if c.endswith(SUFFIX) and (names is None or c in names.get(obj, ()))]
        values = F.to_variant_object(F.struct(*[F.col(f"`{c}`").cast("string").alias(c) for c in fields])) if fields else F.parse_json(F.lit("{}"))
        corrupt = F.col(CORRUPT) if CORRUPT in df.columns else F.lit(None)
        parts.append(df.select(*_record(
            F.lit(obj), F.col(TENANT), F.col("Id"), F.col(f"`{ts_col}`"), feed_instant(df, ts_col), values, corrupt
        )))
    return reduce(DataFrame.unionByName, parts)


def read_records(spark: SparkSession, path: str | list[str], ts_col: str) -> DataFrame:
    """Landed JSON lines of any object as records: whatever fields a line has, no schema names them.

    A line is a record or a page ``{"records": [...]}``; a record names its object in ``attributes.type``. A line that is no
    JSON object stays whole in ``_corrupt_record``.
    """
    lines = spark.read.text(path).select("value", F.try_parse_json("value").alias("page"))
    rows = lines.select("value", "page", F.try_variant_get("page", "$.records", "variant").alias("list"))
    each = rows.lateralJoin(spark.tvf.variant_explode_outer(F.col("list").outer()).select(F.col("value").alias("item")))
    # An empty page holds no record; a line without a list is one itself.
    each = each.where("item IS NOT NULL OR list IS NULL").withColumn("r", F.coalesce("item", "page"))
    text = lambda path: F.try_variant_get("r", path, "string")
    sound = F.schema_of_variant("r").startswith("OBJECT")
    each = each.withColumns({"time": text(f"$.{ts_col}"), "sound": F.coalesce(sound, F.lit(False))})
    tenant = F.coalesce(text(f"$.{TENANT}"), F.try_variant_get("page", f"$.{TENANT}", "string"))
    return each.select(*_record(
        text("$.attributes.type"), tenant, text("$.Id"), F.col("time"), feed_instant(each, "time"), F.when(F.col("sound"), F.col("r")),
        F.when(~F.col("sound"), F.col("value")),
    ))


def field_values(records: DataFrame, *keep: str) -> DataFrame:
    """``(keep..., record_id, Name, value)``: a row per custom field that a record carries, NULL values included."""
    each = records.lateralJoin(records.sparkSession.tvf.variant_explode(F.col(FIELDS).outer()))
    return each.where(F.endswith("key", F.lit(SUFFIX))).select(
        *keep, F.col("Id").alias("record_id"), F.col("key").alias("Name"), F.try_variant_get("value", "$", "string").alias("value")
    )
