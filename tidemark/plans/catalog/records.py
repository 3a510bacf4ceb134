"""Custom fields as runs over landed files: records of four objects, their metadata, and what becomes of bad ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.plans.catalog.registry import Tables, companies, plain, query
from tidemark.plans.catalog.standins import EARLY, MID, RUN_TS, sql_ts, ts
from tidemark.plans.custom import run_custom_fields
from tidemark.plans.sync import SyncRun
from tidemark.sinks import shared_folder
from tidemark.sources import Landed, read_metadata, read_records
from tidemark.specs import CUSTOM_ATTRIBUTES, CUSTOM_VALUES

#: Object -> table, key, tenant, fields. Orders take the tenant of their customer.
_OBJECTS = {
    "Account": ("customer", "c_custkey", "c_nationkey", {"Segment__c": "c_mktsegment", "Name__c": "c_name"}),
    "Contact": ("supplier", "s_suppkey", "s_nationkey", {"Name__c": "s_name"}),
    "Opportunity": ("orders", "o_orderkey", "c_nationkey", {"Status__c": "o_orderstatus", "Priority__c": "o_orderpriority"}),
    "User": ("part", "p_partkey", "p_partkey % 25", {"Title__c": "p_name", "Kind__c": "p_type"}),
}
_DAYS = 1000


def _table(t: Tables, obj: str) -> DataFrame:
    df = getattr(t, _OBJECTS[obj][0])
    return df.join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")) if obj == "Opportunity" else df


def _lines(t: Tables, obj: str, prefix: str = "", later: bool | None = None) -> DataFrame:
    """Records of an object as JSON lines; their times run over some years by key. ``later`` takes those after or up to ``MID``."""
    _, key, tenant, fields = _OBJECTS[obj]
    at = ts(EARLY) + F.make_dt_interval(F.expr(f"cast({key} % {_DAYS} AS int)"))
    rows = _table(t, obj).withColumn("at", at)
    rows = rows if later is None else rows.where((F.col("at") > ts(MID)) == F.lit(later))
    values = [F.concat(F.lit(prefix), F.col(c).cast("string")).alias(n) for n, c in fields.items()]
    return rows.select(F.to_json(F.struct(
        F.struct(F.lit(obj).alias("type")).alias("attributes"), F.expr(f"cast({tenant} AS string)").alias("CompanyId"),
        F.expr(f"cast({key} AS string)").alias("Id"), F.concat(F.translate(F.col("at").cast("string"), " ", "T"), F.lit("Z")).alias("LastModifiedDate"),
        *values,
    )).alias("value"))


def _land(lines: list[DataFrame], folder: str) -> None:
    for df in lines:
        df.write.mode("append").text(folder)


def field_metadata(t: Tables, fields: dict[str, list[str]], kind: str = "Text") -> dict[str, DataFrame]:
    """Metadata of the named fields for every tenant."""
    pairs = F.array(*[F.struct(F.lit(o).alias("object_name"), F.lit(n).alias("api")) for o, names in fields.items() for n in names])
    base = t.nation.select(F.col("n_nationkey").cast("string").alias("CompanyId"), F.lit(1).alias("seq"), F.inline(pairs))
    head, text = ["CompanyId", "object_name", "seq"], F.lit(None).cast("string")
    return {
        "custom_fields": base.select(
            *head, F.expr("left(api, length(api) - 3)").alias("DeveloperName"), F.concat_ws("-", "CompanyId", "object_name", "api").alias("Id"),
            F.lit("2020-01-01").alias("CreatedDate"), text.alias("CreatedById"), F.lit("2020-01-01").alias("LastModifiedDate"),
            text.alias("LastModifiedById"),
        ),
        "definitions": base.select(*head, F.col("api").alias("QualifiedApiName"), F.lit(kind).alias("DataType"), text.alias("Description")),
        "particles": base.select(
            *head, F.struct(F.col("api").alias("QualifiedApiName")).alias("FieldDefinition"), F.lit(False).alias("IsUnique"),
            F.lit(False).alias("IsDeprecatedAndHidden"),
        ),
        "described": base.select(*head, F.col("api").alias("name"), text.alias("label"), text.alias("type"), text.alias("inlineHelpText")),
    }


def land_records(t: Tables, folder: str) -> None:
    """All records of the four objects as JSON lines."""
    _land([_lines(t, obj) for obj in _OBJECTS], folder)


ALL_FIELDS = {obj: list(spec[3]) for obj, spec in _OBJECTS.items()}
FIELD_PAIRS = ", ".join(f"('{obj}', '{name}')" for obj, names in ALL_FIELDS.items() for name in names)


def _value_sql(obj: str, name: str, column: str) -> str:
    table, key, tenant, _ = _OBJECTS[obj]
    source = f"{table} JOIN customer ON o_custkey = c_custkey" if obj == "Opportunity" else table
    return (
        f"SELECT CAST({tenant} AS VARCHAR) AS \"CompanyId\", '{obj}' AS \"ObjectType\", CAST({key} AS VARCHAR) AS \"ExternalId\", "
        f"'{name}' AS \"Name\", CAST({column} AS VARCHAR) AS value, {sql_ts(EARLY)} + to_days(CAST({key} % {_DAYS} AS INTEGER)) AS happened FROM {source}"
    )


VALUES_SQL = " UNION ALL ".join(_value_sql(o, n, c) for o, (_, _, _, fields) in _OBJECTS.items() for n, c in fields.items())


@query(
    f"""
SELECT "CompanyId", "ObjectType", "ExternalId", "Name", CASE WHEN happened > {sql_ts(MID)} THEN 'new-' ELSE 'old-' END || value AS "Value"
FROM ({VALUES_SQL})
"""
)
def custom_field_objects(t: Tables) -> DataFrame:
    """Four objects in one landed feed: a full run, then one over all records that takes those after each watermark."""
    root = shared_folder(t.spark, "custom-objects")
    run = SyncRun(t.spark, f"{root}/tables", buckets=8)
    feeds = field_metadata(t, ALL_FIELDS)
    _land([_lines(t, obj, "old-", later=False) for obj in _OBJECTS], f"{root}/first")
    run_custom_fields(run, feeds, read_records(t.spark, f"{root}/first", "LastModifiedDate"), companies(t), run_ts=MID)
    _land([_lines(t, obj, "new-") for obj in _OBJECTS], f"{root}/second")
    run_custom_fields(run, feeds, read_records(t.spark, f"{root}/second", "LastModifiedDate"), companies(t), run_ts=RUN_TS)
    return run.table(CUSTOM_VALUES).read().select("CompanyId", "ObjectType", "ExternalId", "Name", "Value")


_FATE = """CASE WHEN o_orderkey % 11 = 0 THEN 'corrupt' WHEN o_orderkey % 13 = 0 THEN 'bad_time'
     WHEN o_orderkey % 17 = 0 THEN 'missing_tenant' WHEN o_orderkey % 19 = 0 THEN 'unknown_tenant'
     WHEN o_orderkey % 23 = 0 THEN 'missing_Id' WHEN o_orderkey % 29 = 0 THEN 'missing_object'
     WHEN o_orderkey % 31 = 0 THEN 'unknown_object' ELSE 'stored' END"""


@query(f"SELECT fate, count(*) AS n_records FROM (SELECT {_FATE} AS fate FROM orders) GROUP BY fate")
def custom_field_quarantine(t: Tables) -> DataFrame:
    """What becomes of each record with custom fields: stored, or set apart with its reason. Every order is one."""
    root = shared_folder(t.spark, "custom-quarantine")
    fate = F.expr(_FATE)
    kind = F.when(fate == "missing_object", None).when(fate == "unknown_object", "Nothing").otherwise("Opportunity")
    line = F.to_json(F.struct(
        F.struct(kind.alias("type")).alias("attributes"),
        F.when(fate == "missing_tenant", None).when(fate == "unknown_tenant", "nobody").otherwise((F.col("o_custkey") % 25).cast("string")).alias("CompanyId"),
        F.when(fate != "missing_Id", F.col("o_orderkey").cast("string")).alias("Id"),
        F.when(fate == "bad_time", "yesterday").otherwise("2024-01-01T00:00:00Z").alias("LastModifiedDate"),
        F.col("o_orderstatus").alias("Status__c"), F.lit("not a custom field").alias("Status"),
    ))
    t.orders.select(F.when(fate == "corrupt", F.concat(F.lit("{"), line)).otherwise(line).alias("value")).write.text(f"{root}/landed")
    run = SyncRun(t.spark, f"{root}/tables", buckets=8)
    records = read_records(t.spark, f"{root}/landed", "LastModifiedDate")
    run_custom_fields(run, field_metadata(t, {"Opportunity": ["Status__c"]}), records, companies(t), run_ts=RUN_TS)
    bad = t.spark.read.schema("reasons array<string>, row string").json(run.quarantine(CUSTOM_VALUES.name))
    stored = run.table(CUSTOM_VALUES).read().select("ExternalId").distinct().select(F.lit("stored").alias("fate"))
    return bad.select(F.element_at("reasons", 1).alias("fate")).unionByName(stored).groupBy("fate").agg(F.count("*").alias("n_records"))


@query(
    f"""
SELECT CAST(c_nationkey AS VARCHAR) AS "CompanyId", CAST(c_custkey AS VARCHAR) AS "ExternalId", 'Segment__c' AS "Name", c_mktsegment AS "Value"
FROM customer
UNION ALL SELECT CAST(c_nationkey AS VARCHAR), CAST(c_custkey AS VARCHAR), 'Balance__c', CAST(c_acctbal AS VARCHAR) FROM customer
WHERE {sql_ts(EARLY)} + to_days(CAST(c_custkey % {_DAYS} AS INTEGER)) > {sql_ts(MID)}
"""
)
def custom_field_projection(t: Tables) -> DataFrame:
    """A landed wide feed read by its metadata: a column nobody describes is not read; a field is from the run that knows it."""
    root = shared_folder(t.spark, "custom-projection")
    at = ts(EARLY) + F.make_dt_interval(F.expr(f"cast(c_custkey % {_DAYS} AS int)"))
    wide = t.customer.select(
        F.col("c_nationkey").cast("string").alias("CompanyId"), F.col("c_custkey").cast("string").alias("Id"), at.alias("LastModifiedDate"),
        F.col("c_mktsegment").alias("Segment__c"), F.col("c_acctbal").alias("Balance__c"), F.col("c_name").alias("Secret__c"),
    )
    run = SyncRun(t.spark, f"{root}/tables", buckets=8)
    wide.where(F.col("LastModifiedDate") <= ts(MID)).write.parquet(f"{root}/first")
    run_custom_fields(run, field_metadata(t, {"Account": ["Segment__c"]}), {"Account": Landed(f"{root}/first")}, companies(t), run_ts=MID)
    wide.write.parquet(f"{root}/second")
    feeds = field_metadata(t, {"Account": ["Segment__c", "Balance__c", "Gone__c"]})
    run_custom_fields(run, feeds, {"Account": Landed(f"{root}/second")}, companies(t), run_ts=RUN_TS)
    return run.table(CUSTOM_VALUES).read().select("CompanyId", "ExternalId", "Name", "Value")


# Metadata feeds as they land: every part is a custom field of its brand.


def _pages(t: Tables, name: str, rows: DataFrame, record: Column, folder: str) -> None:
    """Rows as JSON pages of some hundred records, a file per page."""
    listed = "fields" if name == "described" else "records"
    page = F.concat_ws("-", "p_brand", F.expr("cast(p_partkey div 5000 AS string)")).alias("page")
    pages = rows.select(page, "p_brand", record.alias("r")).groupBy("page", "p_brand").agg(F.sort_array(F.collect_list("r")).alias("list"))
    body = F.to_json(F.struct(F.lit("7").alias("CompanyId"), F.col("p_brand").alias("object_name"), F.col("list").alias(listed)))
    pages.select("page", body.alias("value")).write.partitionBy("page").mode("append").text(f"{folder}/{name}")


_DEVELOPER = "translate(p_name, ' ', '_') || '_' || cast(p_partkey AS string)"
_DEVELOPER_SQL = "replace(p_name, ' ', '_') || '_' || CAST(p_partkey AS VARCHAR)"


@query(
    f"""
SELECT '7' AS "CompanyId", '00N' || CAST(p_partkey AS VARCHAR) AS "SalesforceId", p_brand AS "ObjectType", {_DEVELOPER_SQL} || '__c' AS "Name",
       upper(p_name) AS "Label", CASE WHEN p_size > 25 THEN 'second' ELSE 'first' END AS "Description", lower(p_type) AS "Fieldtype", p_type AS "DataType",
       CAST(CASE WHEN p_size % 3 = 0 THEN false WHEN p_size % 7 <> 0 THEN p_size % 2 = 0 END AS VARCHAR) AS "HasUniqueValue",
       CAST(NOT (p_size % 3 <> 0 AND p_size > 40) AS VARCHAR) AS "IsActive", TIMESTAMP '2020-01-01' AS "CreatedAt"
FROM part
"""
)
def custom_metadata_landed(t: Tables) -> DataFrame:
    """Pages of the three metadata feeds and describe documents, two landings, into the stored attributes; no record yet."""
    root = shared_folder(t.spark, "custom-metadata")
    api, size = F.expr(f"{_DEVELOPER} || '__c'"), F.col("p_size")
    custom = F.struct(
        F.concat(F.lit("00N"), F.col("p_partkey").cast("string")).alias("Id"), F.expr(_DEVELOPER).alias("DeveloperName"),
        F.lit("2020-01-01T00:00:00.000+0000").alias("CreatedDate"),
    )
    _pages(t, "custom_fields", t.part, custom, f"{root}/landed")
    described = F.struct(api.alias("name"), F.upper("p_name").alias("label"), F.lower("p_type").alias("type"))
    _pages(t, "described", t.part, described, f"{root}/landed")
    flags = F.struct(
        F.struct(api.alias("QualifiedApiName")).alias("FieldDefinition"), F.when(size % 7 != 0, size % 2 == 0).alias("IsUnique"),
        (size > 40).alias("IsDeprecatedAndHidden"),
    )
    _pages(t, "particles", t.part.where(size % 3 != 0), flags, f"{root}/landed")
    for landing, rows in (("first", t.part), ("second", t.part.where(size > 25))):
        definition = F.struct(api.alias("QualifiedApiName"), F.col("p_type").alias("DataType"), F.lit(landing).alias("Description"))
        _pages(t, "definitions", rows, definition, f"{root}/landed")
    feeds, _ = read_metadata(t.spark, f"{root}/landed")
    run = SyncRun(t.spark, f"{root}/tables", buckets=8)
    brands = [r["p_brand"] for r in t.part.select("p_brand").distinct().collect()]  # objects: as many as there are brands
    nothing = t.spark.createDataFrame([], "CompanyId string, Id string, LastModifiedDate string")
    run_custom_fields(run, feeds, {b: nothing for b in brands}, t.spark.createDataFrame([("7",)], "Id string"), run_ts=RUN_TS)
    found = run.table(CUSTOM_ATTRIBUTES).read().select(
        "CompanyId", "SalesforceId", "ObjectType", "Name", "Label", "Description", "Fieldtype", "DataType", "HasUniqueValue", "IsActive", "CreatedAt"
    )
    return plain(found)
