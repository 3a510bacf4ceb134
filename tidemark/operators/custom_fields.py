"""User-defined fields: metadata assembly, wide rows to long values, nested records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.conform import conform_source
from tidemark.operators.merge import collapse
from tidemark.operators.sizing import measured
from tidemark.specs import CUSTOM_ATTRIBUTES, CUSTOM_VALUES

SUFFIX = "__c"


def last_per_key(df: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """The last row of each key by ``seq``; combines before the shuffle."""
    return collapse(df, keys, [seq], last=[c for c in df.columns if c not in keys])


def assemble_metadata(
    custom_fields: DataFrame,
    definitions: DataFrame,
    particles: DataFrame,
    described: DataFrame,
    *,
    by: Sequence[str] = ("object_name",),
    seq: str = "seq",
) -> DataFrame:
    """Custom fields with their definition, flags and description.

    Every feed carries ``by`` (object, or tenant and object) and ``seq``; the
    last row per name wins. Three left joins on object and API name. A field
    without particle row counts as active and not unique; a particle with a null
    ``IsUnique`` keeps the null.
    """
    by = list(by)

    def side(df: DataFrame, name: Column, *columns: Column) -> DataFrame:
        named = df.select(*by, name.alias("__api"), *columns, F.lit(True).alias("__there"), seq)
        return last_per_key(named, [*by, "__api"], seq).drop(seq)

    cf = last_per_key(
        custom_fields.select(
            *by, "DeveloperName", "Id", "CreatedDate", "CreatedById", "LastModifiedDate",
            "LastModifiedById", seq,
        ),
        [*by, "DeveloperName"],
        seq,
    ).drop(seq)
    cf = cf.withColumn("__api", F.concat("DeveloperName", F.lit(SUFFIX)))
    fd = side(definitions, F.col("QualifiedApiName"), F.col("Description"), F.col("DataType")).drop("__there")
    ep = side(
        particles,
        F.col("FieldDefinition.QualifiedApiName"),
        F.col("IsUnique"),
        F.col("IsDeprecatedAndHidden"),
    )
    d = side(
        described,
        F.col("name"),
        F.col("label").alias("Label"),
        F.col("inlineHelpText").alias("HelpText"),
        F.col("type").alias("FieldType"),
    ).drop("__there")
    on = [*by, "__api"]
    tenant = [c for c in by if c != "object_name"]
    return (
        cf.join(fd, on, "left")
        .join(d, on, "left")
        .join(ep, on, "left")
        .select(
            *tenant,
            F.col("object_name").alias("Object"),
            F.col("Id").alias("CustomFieldId"),
            F.col("__api").alias("Name"),
            "Label",
            "Description",
            "HelpText",
            "FieldType",
            "DataType",
            F.when(F.col("__there").isNull(), F.lit(False)).otherwise(F.col("IsUnique")).alias("IsUnique"),
            (~F.coalesce("IsDeprecatedAndHidden", F.lit(False))).alias("IsActive"),
            F.col("CreatedById").alias("CreatedBy"),
            F.col("LastModifiedById").alias("UpdatedBy"),
            F.col("CreatedDate").alias("CreatedAt"),
            F.col("LastModifiedDate").alias("UpdatedAt"),
        )
    )


def unpivot_values(
    wide: DataFrame,
    *,
    id_col: str = "Id",
    names: Sequence[str] | None = None,
    keep: Sequence[str] = (),
    with_nulls: bool = False,
) -> DataFrame:
    """Wide rows to ``(keep..., record_id, Name, value)``, one per non-null custom field.

    Values of any scalar type become text. ``names`` defaults to the columns that
    end in ``__c``; give the names found in the metadata to read no others.
    """
    names = [c for c in wide.columns if c.endswith(SUFFIX)] if names is None else list(names)
    text = wide.select(
        *keep, F.col(id_col).alias("record_id"), *[F.col(n).cast("string").alias(n) for n in names]
    )
    long = text.unpivot([*keep, "record_id"], names, "Name", "value")
    return long if with_nulls else long.filter(F.col("value").isNotNull())


def fields_with_values(
    metadata: DataFrame, values: DataFrame, by: Sequence[str] = ("Object", "Name")
) -> DataFrame:
    """Metadata of the fields that occur in ``values`` (an incremental run keeps only those)."""
    return metadata.join(values.select(*by).distinct(), list(by), "left_semi")


def nest_values(
    values: DataFrame, by: Sequence[str] = ("Object", "Name"), *, list_size: int = 10_000
) -> DataFrame:
    """``FieldValues array<struct<record_id,value>>`` per field, in parts of about ``list_size``.

    A field of a large object has more values than one row can hold, so it gets
    as many parts as its count calls for, by hash of the record id; the parts
    together are the whole list. Record ids are unique per field.
    """
    by = list(by)
    counted = measured(
        values.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) / F.lit(list_size)).alias("__parts"))
    )
    part = F.pmod(F.xxhash64("record_id"), F.col("__parts")).cast("int")
    return (
        values.join(counted, by)
        .withColumn("part", part)
        .groupBy(*by, "part")
        .agg(F.array_sort(F.collect_list(F.struct("record_id", "value"))).alias("FieldValues"))
    )


def with_values(
    metadata: DataFrame, values: DataFrame, by: Sequence[str] = ("Object", "Name"), *, list_size: int = 10_000
) -> DataFrame:
    """Metadata with ``FieldValues``: left join of the nested lists, so a field without values has one empty list."""
    lists = nest_values(values, by, list_size=list_size)
    empty = F.array().cast(lists.schema["FieldValues"].dataType)
    return metadata.join(lists, list(by), "left").withColumns(
        {"part": F.coalesce("part", F.lit(0)), "FieldValues": F.coalesce("FieldValues", empty)}
    )


def unnest_values(records: DataFrame, by: Sequence[str] = ("Object", "Name")) -> DataFrame:
    """Nested records back to long rows; entries without ``record_id`` are skipped."""
    return (
        records.select(*by, F.explode("FieldValues").alias("v"))
        .select(*by, "v.record_id", "v.value")
        .filter(F.coalesce("record_id", F.lit("")) != "")
    )


def custom_attribute_rows(metadata: DataFrame, *keep: str) -> DataFrame:
    """Assembled metadata as rows of the custom-attributes table."""
    return conform_source(metadata, CUSTOM_ATTRIBUTES, *keep)


def custom_value_rows(
    values: DataFrame, metadata: DataFrame, *keep: str, by: Sequence[str] = ("Object", "Name")
) -> DataFrame:
    """Long values with their field's type and dates, as rows of the custom-values table.

    The metadata is measured first, so that Spark can broadcast it by its true
    size: a join that shuffled the values by field would put each field in one task.
    """
    facts = measured(metadata.select(*by, "DataType", "CreatedAt", "UpdatedAt"))
    usable = values.filter(F.coalesce("record_id", F.lit("")) != "")
    return conform_source(usable.join(facts, list(by)), CUSTOM_VALUES, *keep)
