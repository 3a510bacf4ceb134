"""Custom fields: parts and orders as objects with user-defined fields."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.operators import (
    assemble_metadata,
    custom_attribute_rows,
    custom_value_rows,
    fields_with_values,
    nest_values,
    unnest_values,
    unpivot_values,
    with_values,
)
from tidemark.plans.catalog.registry import Tables, plain, query
from tidemark.plans.catalog.standins import LATE, MID, RUN_TS, sql_ts, ts
from tidemark.plans.custom import upsert_values
from tidemark.sources import describe_fields
from tidemark.specs import CUSTOM_VALUES

# Brands are objects, part names their fields; a name occurs many times per brand.
_API = "replace(p_name, ' ', '_') || '__c'"


def part_metadata(t: Tables) -> DataFrame:
    api = F.concat(F.translate("p_name", " ", "_"), F.lit("__c"))
    obj, seq, size = F.col("p_brand").alias("object_name"), F.col("p_partkey").alias("seq"), F.col("p_size")
    number = F.col("p_partkey").cast("string")
    custom = t.part.select(
        obj, seq, F.translate("p_name", " ", "_").alias("DeveloperName"), F.concat(F.lit("00N"), number).alias("Id"),
        F.lit("2020-01-01T00:00:00.000+0000").alias("CreatedDate"), F.concat(F.lit("005"), number).alias("CreatedById"),
        F.lit("2020-06-01T00:00:00.000+0000").alias("LastModifiedDate"), F.lit("005X").alias("LastModifiedById"),
    )
    definitions = t.part.filter(size > 25).select(
        obj, seq, api.alias("QualifiedApiName"), F.col("p_type").alias("DataType"), number.alias("Description")
    )
    particles = t.part.filter(F.col("p_type") != "SMALL").select(
        obj, seq, F.struct(api.alias("QualifiedApiName")).alias("FieldDefinition"),
        F.when(size % 3 != 0, size % 2 == 0).alias("IsUnique"),
        F.when(size % 5 != 0, size > 40).alias("IsDeprecatedAndHidden"),
    )
    docs = t.part.filter(size <= 45).select(
        obj, seq,
        F.to_json(F.struct(F.array(F.struct(
            api.alias("name"), F.upper("p_name").alias("label"), F.lower("p_type").alias("type"),
            F.when(size % 2 == 0, number).alias("inlineHelpText"),
        )).alias("fields"))).alias("doc"),
    )
    described = describe_fields(docs.withColumn("object_name", F.struct("object_name", "seq"))).select(
        "object_name.object_name", "object_name.seq", "name", "label", "type", "inlineHelpText"
    )
    return assemble_metadata(custom, definitions, particles, described)


def _last(where: str, cols: str, name: str = _API) -> str:
    return (
        f"SELECT * FROM (SELECT p_brand AS o, {name} AS a, {cols}, row_number() OVER "
        f"(PARTITION BY p_brand, {name} ORDER BY p_partkey DESC) AS rn FROM part WHERE {where}) WHERE rn = 1"
    )


METADATA_SQL = f"""
SELECT cf.o AS "ObjectType", cf.id AS "SalesforceId", cf.a AS "Name", d.label AS "Label", fd.des AS "Description",
       d.kind AS "Fieldtype", fd.data_type AS "DataType",
       CAST(CASE WHEN ep.o IS NULL THEN false ELSE ep.is_unique END AS VARCHAR) AS "HasUniqueValue",
       CAST(NOT coalesce(ep.hidden, false) AS VARCHAR) AS "IsActive", cf.created_by AS "CreatedBy", '005X' AS "UpdatedBy",
       TIMESTAMP '2020-01-01' AS "CreatedAt", TIMESTAMP '2020-06-01' AS "UpdatedAt", CAST(NULL AS VARCHAR) AS "CompanyId"
FROM ({_last("true", "'00N' || CAST(p_partkey AS VARCHAR) AS id, '005' || CAST(p_partkey AS VARCHAR) AS created_by")}) cf
LEFT JOIN ({_last("p_size > 25", "p_type AS data_type, CAST(p_partkey AS VARCHAR) AS des")}) fd
  ON cf.o = fd.o AND cf.a = fd.a
LEFT JOIN ({_last("p_size <= 45", "upper(p_name) AS label, lower(p_type) AS kind")}) d ON cf.o = d.o AND cf.a = d.a
LEFT JOIN ({_last("p_type <> 'SMALL'", "CASE WHEN p_size % 3 <> 0 THEN p_size % 2 = 0 END AS is_unique, "
                  "CASE WHEN p_size % 5 <> 0 THEN p_size > 40 END AS hidden")}) ep ON cf.o = ep.o AND cf.a = ep.a
"""


@query(METADATA_SQL)
def custom_field_metadata(t: Tables) -> DataFrame:
    return plain(custom_attribute_rows(part_metadata(t)))


PART_FIELDS = {"p_name": "Title__c", "p_brand": "Brand__c", "p_type": "Kind__c", "p_size": "Size__c",
               "p_retailprice": "Price__c"}


def wide_parts(t: Tables) -> DataFrame:
    """Parts as records with custom fields of several types; some kinds have no size."""
    columns = {old: F.col(old).alias(new) for old, new in PART_FIELDS.items()}
    columns["p_size"] = F.when(F.col("p_type") != "SMALL", F.col("p_size")).alias("Size__c")
    return t.part.select(
        F.col("p_partkey").cast("string").alias("Id"), *columns.values(), (F.col("p_size") > 25).alias("Large__c")
    )


def _values_sql(name: str, expr: str) -> str:
    return f"SELECT CAST(p_partkey AS VARCHAR) AS record_id, '{name}' AS \"Name\", CAST({expr} AS VARCHAR) AS value FROM part"


VALUES_SQL = " UNION ALL ".join(
    [_values_sql(new, "CASE WHEN p_type <> 'SMALL' THEN p_size END" if old == "p_size" else old)
     for old, new in PART_FIELDS.items()]
    + [_values_sql("Large__c", "p_size > 25")]
)


@query(f"SELECT * FROM ({VALUES_SQL}) WHERE value IS NOT NULL")
def custom_field_values(t: Tables) -> DataFrame:
    return unpivot_values(wide_parts(t))


@query(
    f"""
SELECT "Name", count(*) AS n_values, min(record_id) AS first_id, max(record_id) AS last_id,
       sum(length(value)) AS n_chars
FROM ({VALUES_SQL}) WHERE value IS NOT NULL GROUP BY ALL
"""
)
def custom_field_nested(t: Tables) -> DataFrame:
    """Values in lists per field, the lists in parts of bounded size, summed up again."""
    values = unpivot_values(wide_parts(t))
    lists = nest_values(values, ["Name"], list_size=500)
    entries = F.col("FieldValues")
    chars = F.aggregate(entries, F.lit(0).cast("bigint"), lambda acc, e: acc + F.length(e["value"]))
    return (
        lists.select(
            "Name",
            F.size(entries).alias("n"),
            F.array_min(F.transform(entries, lambda e: e["record_id"])).alias("low"),
            F.array_max(F.transform(entries, lambda e: e["record_id"])).alias("high"),
            chars.alias("chars"),
        )
        .groupBy("Name")
        .agg(
            F.sum("n").alias("n_values"), F.min("low").alias("first_id"), F.max("high").alias("last_id"),
            F.sum("chars").alias("n_chars"),
        )
    )


@query(f"SELECT * FROM ({VALUES_SQL}) WHERE value IS NOT NULL")
def custom_field_unnested(t: Tables) -> DataFrame:
    """Nested lists back to rows: nothing is lost on the way."""
    values = unpivot_values(wide_parts(t))
    return unnest_values(nest_values(values, ["Name"], list_size=500), ["Name"])


@query(
    f"""
SELECT p_brand AS "Object", {_API} AS "Name", count(*) FILTER (p_size > 25) AS n_values,
       coalesce(sum(p_partkey) FILTER (p_size > 25), 0) AS id_sum
FROM part GROUP BY ALL
"""
)
def custom_field_lists(t: Tables) -> DataFrame:
    """Every field with the list of its values, those without any included."""
    metadata = part_metadata(t).select("Object", "Name")
    values = t.part.select(
        F.col("p_brand").alias("Object"), F.concat(F.translate("p_name", " ", "_"), F.lit("__c")).alias("Name"),
        F.col("p_partkey").cast("string").alias("record_id"), F.when(F.col("p_size") > 25, F.col("p_type")).alias("value"),
    ).filter("value IS NOT NULL")
    ids = F.aggregate("FieldValues", F.lit(0).cast("bigint"), lambda acc, e: acc + e["record_id"].cast("bigint"))
    return with_values(metadata, values, list_size=500).groupBy("Object", "Name").agg(
        F.sum(F.size("FieldValues")).alias("n_values"), F.sum(ids).alias("id_sum")
    )


# Orders as an object: Early__c has values only before the watermark.

def _order_fields(t: Tables) -> DataFrame:
    date = F.col("o_orderdate")
    return t.orders.select(
        F.col("o_orderkey").cast("string").alias("Id"),
        date.alias("LastModifiedDate"),
        F.col("o_orderstatus").alias("Status__c"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("Buyer__c"),
        F.when(date <= ts(MID), F.col("o_orderpriority")).alias("Early__c"),
    )


def _order_metadata(t: Tables) -> DataFrame:
    """One definition per field, read off the orders so that it grows with them."""
    fields = F.array(*[
        F.struct(F.lit(n).alias("Name"), F.lit(k).alias("DataType"))
        for n, k in (("Status__c", "Text"), ("Buyer__c", "Number"), ("Early__c", "Picklist"), ("Unused__c", "Text"))
    ])
    named = t.orders.select(F.inline(fields), F.col("o_orderdate").alias("at"))
    return named.groupBy("Name", "DataType").agg(
        F.min("at").alias("CreatedAt"), F.max("at").alias("UpdatedAt")
    ).withColumn("Object", F.lit("Opportunity"))


_ORDER_VALUES_SQL = f"""
SELECT CAST(o_orderkey AS VARCHAR) AS record_id, 'Status__c' AS "Name", o_orderstatus AS value, o_orderdate FROM orders
UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'Buyer__c',
  CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey AS VARCHAR) END, o_orderdate FROM orders
UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'Early__c',
  CASE WHEN o_orderdate <= {sql_ts(MID)} THEN o_orderpriority END, o_orderdate FROM orders
"""
_ORDER_META_SQL = """
SELECT unnest(['Status__c', 'Buyer__c', 'Early__c', 'Unused__c']) AS "Name",
       unnest(['Text', 'Number', 'Picklist', 'Text']) AS data_type, low, high
FROM (SELECT min(o_orderdate) AS low, max(o_orderdate) AS high FROM orders)
"""


def _order_value_rows(t: Tables, wide: DataFrame, **options) -> DataFrame:
    metadata = _order_metadata(t)
    values = unpivot_values(wide.withColumn("Object", F.lit("Opportunity")),
                            names=["Status__c", "Buyer__c", "Early__c"],
                            keep=["Object", "LastModifiedDate"], **options)
    return custom_value_rows(values, metadata, "LastModifiedDate")


@query(
    f"""
SELECT DISTINCT m."Name", m.data_type AS "DataType" FROM ({_ORDER_META_SQL}) m
JOIN ({_ORDER_VALUES_SQL}) v ON m."Name" = v."Name" WHERE value IS NOT NULL AND o_orderdate > {sql_ts(MID)}
"""
)
def custom_field_incremental(t: Tables) -> DataFrame:
    """An incremental run keeps the fields that have values."""
    changed = _order_fields(t).filter(F.col("LastModifiedDate") > ts(MID))
    values = unpivot_values(changed.withColumn("Object", F.lit("Opportunity")),
                            names=["Status__c", "Buyer__c", "Early__c"], keep=["Object"])
    return fields_with_values(_order_metadata(t), values).select("Name", "DataType")


@query(
    f"""
SELECT 'Opportunity' AS "ObjectType", record_id AS "ExternalId", m.data_type AS "Type", m."Name", value AS "Value",
       low AS "CreatedAt", high AS "UpdatedAt", CAST(NULL AS VARCHAR) AS "CompanyId"
FROM ({_ORDER_VALUES_SQL}) v JOIN ({_ORDER_META_SQL}) m ON m."Name" = v."Name" WHERE value IS NOT NULL
"""
)
def custom_field_rows(t: Tables) -> DataFrame:
    """Values with their field's type and dates, ready for the long table."""
    return _order_value_rows(t, _order_fields(t)).select(*CUSTOM_VALUES.columns)


_CLEARED_SQL = f"""
WITH old AS (SELECT record_id, "Name", value FROM ({_ORDER_VALUES_SQL}) WHERE value IS NOT NULL
             AND o_orderdate <= {sql_ts(LATE)}),
new AS (SELECT record_id, "Name", CASE WHEN o_orderdate <= {sql_ts(LATE)} AND "Name" = 'Buyer__c' THEN NULL ELSE value END
        AS value FROM ({_ORDER_VALUES_SQL}) WHERE o_orderdate > {sql_ts(MID)})
SELECT coalesce(o.record_id, n.record_id) AS "ExternalId", coalesce(o."Name", n."Name") AS "Name",
       CASE WHEN n.record_id IS NULL THEN o.value ELSE n.value END AS "Value"
FROM old o FULL JOIN new n ON o.record_id = n.record_id AND o."Name" = n."Name"
WHERE o.record_id IS NOT NULL OR n.value IS NOT NULL
"""


@query(_CLEARED_SQL)
def custom_field_clear_nulls(t: Tables) -> DataFrame:
    """On request a value that became null empties its row; it never adds one."""
    wide = _order_fields(t)
    at = F.col("LastModifiedDate")
    stored = _order_value_rows(t, wide.filter(at <= ts(LATE))).select(*CUSTOM_VALUES.columns)
    changed = wide.filter(at > ts(MID)).withColumn(
        "Buyer__c", F.when(at > ts(LATE), F.col("Buyer__c"))
    )
    rows = _order_value_rows(t, changed, with_nulls=True)
    merged = upsert_values(stored, rows, clear_nulls=True, seq=["LastModifiedDate"])
    return merged.select("ExternalId", "Name", "Value")


@query(
    f"""
SELECT 'CrmAttributeValues_' || v.o AS table_name, CAST(n_nationkey AS VARCHAR) AS "CompanyId", 'full' AS sync_type, count(c) AS records
FROM nation CROSS JOIN (VALUES ('Account'), ('Opportunity')) v(o)
LEFT JOIN (SELECT 'Account' AS o, c_nationkey AS c FROM customer
      UNION ALL SELECT 'Opportunity', c_nationkey FROM orders JOIN customer ON o_custkey = c_custkey) r ON r.o = v.o AND c = n_nationkey
GROUP BY ALL
"""
)
def custom_field_sync_report(t: Tables) -> DataFrame:
    """Custom fields of two objects and all tenants in one run: what was read."""
    _, _, _, report = _custom_sync(t)
    return report.select(
        F.col("feed").alias("table_name"), "CompanyId", "sync_type", F.col("records_processed").alias("records")
    )


@query(
    """
SELECT CAST(c_nationkey AS VARCHAR) AS "CompanyId", 'Account' AS "ObjectType", CAST(c_custkey AS VARCHAR) AS "ExternalId",
       'Segment__c' AS "Name", c_mktsegment AS "Value", 'Text' AS "Type" FROM customer
UNION ALL SELECT CAST(c_nationkey AS VARCHAR), 'Account', CAST(c_custkey AS VARCHAR), 'Balance__c',
       CAST(c_acctbal AS VARCHAR), 'Text' FROM customer
UNION ALL SELECT CAST(c_nationkey AS VARCHAR), 'Opportunity', CAST(o_orderkey AS VARCHAR), 'Status__c', o_orderstatus,
       'Text' FROM orders JOIN customer ON o_custkey = c_custkey
"""
)
def custom_field_sync(t: Tables) -> DataFrame:
    """The same run's long table."""
    _, values, _, _ = _custom_sync(t)
    return values.select("CompanyId", "ObjectType", "ExternalId", "Name", "Value", "Type")


def _custom_sync(t: Tables):
    from tidemark.plans.custom import sync_custom_fields
    from tidemark.specs import CUSTOM_ATTRIBUTES, SYNC_LOG

    tenant = F.col("c_nationkey").cast("string").alias("CompanyId")
    at = ts(LATE).alias("LastModifiedDate")
    accounts = t.customer.select(
        tenant, F.col("c_custkey").cast("string").alias("Id"), at,
        F.col("c_mktsegment").alias("Segment__c"), F.col("c_acctbal").alias("Balance__c"),
    )
    orders = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        tenant, F.col("o_orderkey").cast("string").alias("Id"), F.col("o_orderdate").alias("LastModifiedDate"),
        F.col("o_orderstatus").alias("Status__c"),
    )
    companies = t.nation.select(F.col("n_nationkey").cast("string").alias("Id"))
    fields = F.array(*[
        F.struct(F.lit(o).alias("object_name"), F.lit(n).alias("DeveloperName"))
        for o, n in (("Account", "Segment"), ("Account", "Balance"), ("Opportunity", "Status"))
    ])
    base = t.nation.select(F.col("n_nationkey").cast("string").alias("CompanyId"), F.lit(1).alias("seq"), F.inline(fields))
    api = F.concat("DeveloperName", F.lit("__c"))
    text = F.lit(None).cast("string")
    feeds = {
        "custom_fields": base.select(
            "CompanyId", "object_name", "seq", "DeveloperName",
            F.concat_ws("-", "CompanyId", "object_name", "DeveloperName").alias("Id"),
            F.lit("2020-01-01T00:00:00Z").alias("CreatedDate"), text.alias("CreatedById"),
            F.lit("2020-01-01T00:00:00Z").alias("LastModifiedDate"), text.alias("LastModifiedById"),
        ),
        "definitions": base.select("CompanyId", "object_name", "seq", api.alias("QualifiedApiName"),
                                   F.lit("Text").alias("DataType"), text.alias("Description")),
        "particles": base.select("CompanyId", "object_name", "seq",
                                 F.struct(api.alias("QualifiedApiName")).alias("FieldDefinition"),
                                 F.lit(False).alias("IsUnique"), F.lit(False).alias("IsDeprecatedAndHidden")),
        "described": base.select("CompanyId", "object_name", "seq", api.alias("name"), text.alias("label"),
                                 text.alias("type"), text.alias("inlineHelpText")),
    }

    def empty(spec):
        return t.spark.createDataFrame([], spec.schema)

    return sync_custom_fields(
        feeds, {"Account": accounts, "Opportunity": orders}, empty(CUSTOM_ATTRIBUTES),
        empty(CUSTOM_VALUES), empty(SYNC_LOG), companies, run_ts=RUN_TS,
    )
