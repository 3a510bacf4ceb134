"""Extracts, watermarks and lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions import iso_text, to_millis, watermark_text
from tidemark.operators import (
    collapse,
    conform_source,
    enrich_owner,
    latest_with_fallback,
    merge,
    split_valid,
    type_rules,
    union_labelled,
)
from tidemark.plans.catalog.registry import Tables, last_rows, plain, query, spec_select
from tidemark.plans.catalog.standins import (
    EVENT_MID,
    HISTORY_COLUMNS_SQL,
    LINE_ORDER,
    MID,
    OPPORTUNITY_FEED_SQL,
    RUN_TS,
    history_feed,
    ident,
    opportunity_feed,
    sql_ident,
    sql_ts,
    task_feed,
    ts,
)
from tidemark.plans.sync import log_updates, watermarks
from tidemark.sources import describe_fields, full_extract, incremental_extract, only_referencing
from tidemark.sources.extract import newer_than
from tidemark.specs import ACTIVITIES, HISTORY, OPPORTUNITIES, SYNC_LOG, USERS


@query(OPPORTUNITY_FEED_SQL, name="full_extract")
def full_extract_feed(t: Tables) -> DataFrame:
    return full_extract(opportunity_feed(t), OPPORTUNITIES)


@query(f"{OPPORTUNITY_FEED_SQL} WHERE o_orderdate > {sql_ts(MID)}", name="incremental_extract")
def incremental_extract_feed(t: Tables) -> DataFrame:
    return incremental_extract(opportunity_feed(t), OPPORTUNITIES, MID)


@query(
    "SELECT * EXCLUDE (%s) FROM (%s)"
    % (
        ", ".join(LINE_ORDER),
        last_rows(
            spec_select(HISTORY, HISTORY_COLUMNS_SQL, f"lineitem WHERE l_shipdate > {sql_ts(MID)}",
                        ", ".join(LINE_ORDER)),
            HISTORY.keys,
            LINE_ORDER,
        ),
    )
)
def incremental_by_created(t: Tables) -> DataFrame:
    new = incremental_extract(history_feed(t), HISTORY, MID, *LINE_ORDER)
    rows = conform_source(new, HISTORY, *LINE_ORDER)
    return plain(collapse(rows, HISTORY.keys, LINE_ORDER, last=HISTORY.update_columns).select(*HISTORY.columns))


@query(
    f"""
SELECT {sql_ident('00T', 'l_orderkey', 'l_linenumber')} AS "Id", {sql_ident('006', 'l_orderkey')} AS "WhatId",
       {sql_ident('005', 'l_suppkey')} AS "OwnerId", l_returnflag AS "Status", l_linestatus AS "Priority",
       CAST(l_extendedprice AS VARCHAR) AS "Subject",
       strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S.') || '000Z' AS "ActivityDate", l_linestatus = 'F' AS "IsClosed"
FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O')
  AND l_shipdate > {sql_ts(MID)}
"""
)
def semi_join_incremental(t: Tables) -> DataFrame:
    parents = t.orders.filter(F.col("o_orderstatus") == "O").select(ident("006", "o_orderkey").alias("Id"))
    tasks = newer_than(task_feed(t), ACTIVITIES.ts_col, MID)
    column, _, parent_key = ACTIVITIES.semi_join
    return full_extract(only_referencing(tasks, column, parents, parent_key), ACTIVITIES)


def _event_log(t: Tables) -> DataFrame:
    """Events as log rows of (event type, user)."""
    return t.events.select(
        F.col("event_type").alias("table_name"),
        F.col("ts").alias("last_sync_time"),
        F.lit(None).cast("timestamp_ntz").alias("created_at"),
        F.col("user_id").cast("string").alias("CompanyId"),
    )


@query(
    """
SELECT event_type AS table_name, CAST(user_id AS VARCHAR) AS "CompanyId", max(ts) AS last_sync
FROM events GROUP BY ALL
"""
)
def watermark_lookup(t: Tables) -> DataFrame:
    return watermarks(_event_log(t))


@query(
    f"""
WITH o AS (SELECT event_type, user_id, max(ts) AS ts FROM events WHERE ts <= {sql_ts(EVENT_MID)} GROUP BY ALL),
n AS (SELECT event_type, user_id, max(ts) AS ts FROM events WHERE ts > {sql_ts(EVENT_MID)} GROUP BY ALL)
SELECT coalesce(n.event_type, o.event_type) AS table_name, coalesce(n.ts, o.ts) AS last_sync_time,
       CASE WHEN n.ts IS NULL THEN {sql_ts(EVENT_MID)} ELSE {sql_ts(RUN_TS)} END AS created_at,
       CAST(coalesce(n.user_id, o.user_id) AS VARCHAR) AS "CompanyId"
FROM o FULL JOIN n ON o.event_type = n.event_type AND o.user_id = n.user_id
"""
)
def watermark_upsert(t: Tables) -> DataFrame:
    at = F.col("last_sync_time")

    def marks(rows: DataFrame, created) -> DataFrame:
        found = watermarks(rows).withColumnRenamed("last_sync", "last_sync_time")
        return found.withColumn("created_at", created).select(*SYNC_LOG.columns)

    log = _event_log(t)
    old = marks(log.filter(at <= ts(EVENT_MID)), ts(EVENT_MID))
    new = marks(log.filter(at > ts(EVENT_MID)), ts(RUN_TS))
    return merge(old, new, SYNC_LOG.keys, null_keys=False)


@query(
    f"""
WITH marks AS (SELECT n_nationkey, CASE WHEN n_regionkey <> 2 THEN {sql_ts(MID)} END AS last_sync FROM nation),
stats AS (SELECT c_nationkey, count(*) AS n, max(o_orderdate) AS newest FROM orders
          JOIN customer ON o_custkey = c_custkey JOIN marks ON c_nationkey = n_nationkey
          WHERE last_sync IS NULL OR o_orderdate > last_sync GROUP BY ALL)
SELECT 'opportunities' AS table_name, coalesce(newest, last_sync) AS last_sync_time,
       {sql_ts(RUN_TS)} AS created_at, CAST(n_nationkey AS VARCHAR) AS "CompanyId"
FROM marks LEFT JOIN stats ON c_nationkey = n_nationkey WHERE n IS NOT NULL OR last_sync IS NOT NULL
"""
)
def watermark_advance(t: Tables) -> DataFrame:
    """New log rows of an incremental run over all tenants, empty ones included."""
    from tidemark.plans.catalog.flows import opportunities_by_tenant, tenant_marks_of
    from tidemark.plans.sync import extract_stats
    from tidemark.sources import tenant_extract

    marks = tenant_marks_of(t)
    read = tenant_extract(opportunities_by_tenant(t), "LastModifiedDate", marks)
    return log_updates(
        "opportunities", extract_stats(read, "LastModifiedDate"), marks, run_ts=RUN_TS, advance_on_empty=True
    )


@query(
    """
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS watermark,
       CAST(date_trunc('millisecond', ts) AS TIMESTAMP) AS cut, regexp_replace(strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'), '\\.0{6}$', '') AS iso
FROM events
"""
)
def watermark_format(t: Tables) -> DataFrame:
    return t.events.select(
        "event_id",
        watermark_text(F.col("ts")).alias("watermark"),
        to_millis(F.col("ts")).alias("cut"),
        iso_text(F.col("ts")).alias("iso"),
    )


@query(
    """
WITH ranked AS (
  SELECT event_id, user_id, ts, event_type, value,
         row_number() OVER (PARTITION BY user_id
                            ORDER BY CASE event_type WHEN 'purchase' THEN 0 ELSE 1 END, ts DESC, event_id DESC) AS rn
  FROM events WHERE event_type IN ('purchase', 'view') AND value <= 100)
SELECT user_id AS "CompanyId", event_id AS "Id", ts AS "ModifiedAt", event_type AS kind FROM ranked WHERE rn = 1
""",
    name="latest_with_fallback",
)
def latest_with_fallback_row(t: Tables) -> DataFrame:
    """Purchases play the preferred config class, views the fallback, dear events the deleted rows."""
    preferred = F.col("event_type") == "purchase"
    fallback = F.col("event_type") == "view"
    rows = t.events.select(
        F.col("user_id").alias("CompanyId"),
        F.col("event_id").alias("Id"),
        F.col("ts").alias("ModifiedAt"),
        F.col("event_type").alias("kind"),
        F.when(preferred, 3).when(fallback, 2).otherwise(1).alias("ProviderName"),
        F.when(preferred, 3).when(fallback, 2).otherwise(1).alias("ServiceType"),
        F.when(F.col("value") > 100, 1).otherwise(0).alias("IsDeleted"),
    )
    return latest_with_fallback(rows).select("CompanyId", "Id", "ModifiedAt", "kind")


@query(
    f"""
SELECT {sql_ident('006', 'o_orderkey')} AS "Id", {sql_ident('005', 'o_custkey')} AS "OwnerId",
       s_name AS owner_name, CASE WHEN s_name IS NOT NULL THEN lower(s_name) || '@example.com' END AS owner_email
FROM orders LEFT JOIN supplier ON s_suppkey = o_custkey
"""
)
def owner_enrich(t: Tables) -> DataFrame:
    """Orders owned by supplier users; most owners are unknown."""
    users = t.supplier.select(
        ident("005", "s_suppkey").alias("Id"),
        F.col("s_name").alias("Name"),
        F.concat(F.lower("s_name"), F.lit("@example.com")).alias("Email"),
    )
    records = t.orders.select(ident("006", "o_orderkey").alias("Id"), ident("005", "o_custkey").alias("OwnerId"))
    return enrich_owner(records, users).select(
        "Id", "OwnerId", F.col("Owner.Name").alias("owner_name"), F.col("Owner.Email").alias("owner_email")
    )


@query(
    """
SELECT event_id,
       CASE WHEN event_type = 'signup' AND value > 50 THEN 'missing_SalesforceId,' ELSE '' END ||
       CASE WHEN event_type = 'error' THEN 'bad_Amount,' ELSE '' END ||
       CASE WHEN event_type = 'view' AND value < 10 THEN 'bad_PushCount,' ELSE '' END AS reasons
FROM events
WHERE (event_type = 'signup' AND value > 50) OR event_type = 'error' OR (event_type = 'view' AND value < 10)
"""
)
def quarantine(t: Tables) -> DataFrame:
    feed = _suspect_feed(t)
    _, bad = split_valid(feed, type_rules(feed, OPPORTUNITIES))
    reasons = F.concat_ws("", F.transform("reasons", lambda r: F.concat(r, F.lit(","))))
    return bad.select("event_id", reasons.alias("reasons"))


@query(
    """
SELECT event_id, value AS "Amount", CAST(json_extract_string(props, '$.k') AS INTEGER) AS "PushCount", ts AS created
FROM events
WHERE NOT ((event_type = 'signup' AND value > 50) OR event_type = 'error' OR (event_type = 'view' AND value < 10))
"""
)
def quarantine_passed(t: Tables) -> DataFrame:
    """The other half: good rows go on, typed."""
    feed = _suspect_feed(t)
    good, _ = split_valid(feed, type_rules(feed, OPPORTUNITIES))
    rows = conform_source(good, OPPORTUNITIES, "event_id")
    return rows.select(
        "event_id", F.col("Amount").cast("double").alias("Amount"), "PushCount", F.col("CreatedDate").alias("created")
    )


def _suspect_feed(t: Tables) -> DataFrame:
    """Events as a text feed with missing ids and values their columns cannot hold."""
    kind, value = F.col("event_type"), F.col("value")
    return t.events.select(
        "event_id",
        F.when(~((kind == "signup") & (value > 50)), ident("006", "event_id")).alias("Id"),
        F.when(kind == "error", "n/a").otherwise(value.cast("string")).alias("Amount"),
        F.when((kind == "view") & (value < 10), "many")
        .otherwise(F.get_json_object("props", "$.k"))
        .alias("PushCount"),
        F.translate(F.col("ts").cast("string"), " ", "T").alias("CreatedDate"),
    )


@query(
    """
SELECT o_orderkey, 0 AS pos, 'Status__c' AS name, o_orderstatus AS label, 'picklist' AS type,
       CAST(NULL AS VARCHAR) AS "inlineHelpText" FROM orders
UNION ALL SELECT o_orderkey, 1, 'Price__c', CAST(o_orderkey AS VARCHAR), 'currency', o_orderpriority FROM orders
"""
)
def describe_explode(t: Tables) -> DataFrame:
    """A description per order, as JSON text, exploded to its fields."""
    def field(name: str, label, kind: str, text):
        return F.struct(
            F.lit(name).alias("name"), label.alias("label"), F.lit(kind).alias("type"), text.alias("inlineHelpText")
        )

    docs = t.orders.select(
        F.col("o_orderkey").alias("object_name"),
        F.to_json(
            F.struct(
                F.array(
                    field("Status__c", F.col("o_orderstatus"), "picklist", F.lit(None).cast("string")),
                    field("Price__c", F.col("o_orderkey").cast("string"), "currency", F.col("o_orderpriority")),
                ).alias("fields"),
                F.lit(True).alias("custom"),
            )
        ).alias("doc"),
    )
    return describe_fields(docs).withColumnRenamed("object_name", "o_orderkey")


@query(
    """
SELECT 'Account' AS "Object", CAST(c_custkey AS VARCHAR) AS "Id", c_name AS "Name" FROM customer
UNION ALL SELECT 'Contact', CAST(event_id AS VARCHAR), event_type FROM events
UNION ALL SELECT 'Opportunity', CAST(o_orderkey AS VARCHAR), o_orderpriority FROM orders
UNION ALL SELECT 'User', CAST(s_suppkey AS VARCHAR), s_name FROM supplier
"""
)
def union_objects(t: Tables) -> DataFrame:
    def part(df: DataFrame, key: str, name: str) -> DataFrame:
        return df.select(F.col(key).cast("string").alias("Id"), F.col(name).alias("Name"))

    return union_labelled(
        {
            "Account": part(t.customer, "c_custkey", "c_name"),
            "Contact": part(t.events, "event_id", "event_type"),
            "Opportunity": part(t.orders, "o_orderkey", "o_orderpriority"),
            "User": part(t.supplier, "s_suppkey", "s_name"),
        }
    )


@query(
    f"""
SELECT {sql_ident('005', 's_suppkey')} AS "Id", s_name AS "Name", CAST(s_nationkey AS VARCHAR) AS "Country" FROM supplier
"""
)
def full_extract_users(t: Tables) -> DataFrame:
    """A second projection over the same reader, with other columns."""
    feed = t.supplier.select(
        ident("005", "s_suppkey").alias("Id"),
        F.col("s_name").alias("Name"),
        F.col("s_nationkey").cast("string").alias("Country"),
        "s_acctbal",
    )
    return full_extract(feed, USERS)
