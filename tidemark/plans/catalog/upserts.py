"""Upserts of every table and every variant of the merge."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions import watermark_text
from tidemark.operators import collapse, conform_source, enrich_owner, merge, merge_actions
from tidemark.plans.catalog.registry import Tables, last_rows, merge_select, plain, query, spec_select
from tidemark.plans.catalog.standins import (
    EARLY,
    EVENT_MID,
    HISTORY_COLUMNS_SQL,
    LATE,
    LINE_ORDER,
    MID,
    TASK_COLUMNS_SQL,
    history_feed,
    ident,
    sql_ident,
    sql_ts,
    task_feed,
    ts,
)
from tidemark.sinks import VersionedTable, shared_folder
from tidemark.specs import ACCOUNTS, ACTIVITIES, CALL_STAGES, CONTACTS, HISTORY, OPPORTUNITIES, USERS, TableSpec

KEY = ("l_orderkey", "l_linenumber")
LINES_TS = "l_shipdate"


def full_merge_sql(spec: TableSpec, target: str, source: str) -> str:
    return f"WITH t AS ({target}), s AS ({source}) " + merge_select(
        spec.keys, spec.update_columns, columns=spec.columns
    )


def plain_merge(spec: TableSpec, target: DataFrame, source: DataFrame, seq: list[str] | None) -> DataFrame:
    return plain(merge(target, source, spec.keys, seq=seq, null_keys=False))


# Accounts: customers; late orders change their customer, suppliers are new accounts.

_ACCOUNT = {
    "SalesForceId": sql_ident("001", "c_custkey"), "Name": "c_name", "Industry": "c_mktsegment",
    "AnnualRevenue": "CAST(c_acctbal AS DECIMAL(18,2))", "BillingCountry": "CAST(c_nationkey AS VARCHAR)",
}
_ACCOUNT_CHANGE = {
    "SalesForceId": sql_ident("001", "o_custkey"), "Name": "o_orderpriority", "Rating": "o_orderstatus",
    "AnnualRevenue": "CAST(o_totalprice AS DECIMAL(18,2))", "LastModifiedDate": "o_orderdate",
    "TradeStyle": "o_orderstatus || '!'", "SLAExpirationDate": "o_orderdate + INTERVAL 30 HOUR",
}
_ACCOUNT_NEW = {
    "SalesForceId": sql_ident("001S", "s_suppkey"), "Name": "s_name",
    "AnnualRevenue": "CAST(s_acctbal AS DECIMAL(18,2))", "BillingCountry": "CAST(s_nationkey AS VARCHAR)",
}


@query(
    full_merge_sql(
        ACCOUNTS,
        spec_select(ACCOUNTS, _ACCOUNT, "customer"),
        last_rows(
            spec_select(ACCOUNTS, _ACCOUNT_CHANGE, "orders",
                        "o_orderdate, o_orderkey")
            + " UNION ALL "
            + spec_select(ACCOUNTS, _ACCOUNT_NEW, "supplier", "NULL, s_suppkey"),
            ACCOUNTS.keys,
            ("o_orderdate", "o_orderkey"),
        ),
    )
)
def upsert_full(t: Tables) -> DataFrame:
    target = conform_source(
        t.customer.select(
            ident("001", "c_custkey").alias("Id"),
            F.col("c_name").alias("Name"),
            F.col("c_mktsegment").alias("Industry"),
            F.col("c_acctbal").alias("AnnualRevenue"),
            F.col("c_nationkey").cast("string").alias("BillingCountry"),
        ),
        ACCOUNTS,
    )
    when = watermark_text(F.col("o_orderdate") + F.expr("INTERVAL 30 HOUR"))
    changes = t.orders.select(
        ident("001", "o_custkey").alias("Id"),
        F.col("o_orderpriority").alias("Name"),
        F.col("o_orderstatus").alias("Rating"),
        F.col("o_totalprice").alias("AnnualRevenue"),
        watermark_text(F.col("o_orderdate")).alias("LastModifiedDate"),
        F.concat("o_orderstatus", F.lit("!")).alias("TradeStyle__c"),
        when.alias("SLAExpirationDate__c"),
        F.col("o_orderdate").alias("at"),
        F.col("o_orderkey").alias("n"),
    )
    new = t.supplier.select(
        ident("001S", "s_suppkey").alias("Id"),
        F.col("s_name").alias("Name"),
        F.col("s_acctbal").alias("AnnualRevenue"),
        F.col("s_nationkey").cast("string").alias("BillingCountry"),
        F.col("s_suppkey").alias("n"),
    )
    source = changes.unionByName(new, allowMissingColumns=True)
    return plain_merge(ACCOUNTS, target, conform_source(source, ACCOUNTS, "at", "n"), ["at", "n"])


# Opportunities: orders with their owner in a struct; a later extract overlaps an earlier one.

_OPPORTUNITY = {
    "SalesforceId": sql_ident("006", "o_orderkey"), "AccountId": sql_ident("001", "o_custkey"),
    "StageName": "o_orderpriority", "Amount": "CAST(o_totalprice AS DECIMAL(18,2))",
    "CloseDate": "CAST(o_orderdate AS DATE)", "LastModifiedDate": "o_orderdate",
}
_OPPORTUNITY_NEW = _OPPORTUNITY | {
    "StageName": "'Closed'", "IsClosed": "o_orderstatus = 'F'", "OwnerId": sql_ident("005", "o_custkey"),
    "OwnerName": "s_name", "OwnerEmail": "CASE WHEN s_name IS NOT NULL THEN lower(s_name) || '@example.com' END",
    "LastReferenceDate": "o_orderdate + INTERVAL 1 HOUR",
}


@query(
    full_merge_sql(
        OPPORTUNITIES,
        spec_select(OPPORTUNITIES, _OPPORTUNITY, f"orders WHERE o_orderdate <= {sql_ts(LATE)}"),
        spec_select(OPPORTUNITIES, _OPPORTUNITY_NEW,
                    "orders LEFT JOIN supplier ON o_custkey = s_suppkey "
                    f"WHERE o_orderdate > {sql_ts(EARLY)}"),
    )
)
def upsert_nested(t: Tables) -> DataFrame:
    def feed(orders: DataFrame) -> DataFrame:
        return orders.select(
            ident("006", "o_orderkey").alias("Id"),
            ident("001", "o_custkey").alias("AccountId"),
            F.col("o_orderpriority").alias("StageName"),
            F.col("o_totalprice").alias("Amount"),
            F.col("o_orderdate").cast("date").cast("string").alias("CloseDate"),
            watermark_text(F.col("o_orderdate")).alias("LastModifiedDate"),
            "o_orderstatus", "o_custkey", "o_orderdate",
        )

    date = F.col("o_orderdate")
    target = conform_source(feed(t.orders.filter(date <= ts(LATE))), OPPORTUNITIES)
    users = t.supplier.select(
        ident("005", "s_suppkey").alias("Id"), F.col("s_name").alias("Name"),
        F.concat(F.lower("s_name"), F.lit("@example.com")).alias("Email"),
    )
    changed = feed(t.orders.filter(date > ts(EARLY))).withColumns({
        "StageName": F.lit("Closed"),
        "IsClosed": F.col("o_orderstatus") == "F",
        "OwnerId": ident("005", "o_custkey"),
        # One hour on, written with an offset that takes it back.
        "LastReferencedDate": F.concat(
            F.translate(F.substring((date + F.expr("INTERVAL 2 HOUR")).cast("string"), 1, 19), " ", "T"),
            F.lit(".000+0100"),
        ),
    })
    source = conform_source(enrich_owner(changed, users), OPPORTUNITIES)
    return plain_merge(OPPORTUNITIES, target, source, None)


# Contacts: customers, changed by events.

_CONTACT = {
    "SalesforceId": sql_ident("003", "c_custkey"), "AccountId": sql_ident("001", "c_custkey"),
    "LastName": "c_name", "Department": "c_mktsegment", "MailingCountry": "CAST(c_nationkey AS VARCHAR)",
}
_CONTACT_CHANGE = {
    "SalesforceId": sql_ident("003", "user_id"), "LastName": "'User ' || CAST(user_id AS VARCHAR)",
    "Title": "event_type", "LastActivityDate": "ts", "IsEmailBounced": "event_type = 'error'",
    "Level__c": "CAST(event_id AS VARCHAR)",
}


@query(
    full_merge_sql(
        CONTACTS,
        spec_select(CONTACTS, _CONTACT, "customer"),
        last_rows(spec_select(CONTACTS, _CONTACT_CHANGE, "events", "ts, event_id"), CONTACTS.keys,
                  ("ts", "event_id")),
    )
)
def upsert_contacts(t: Tables) -> DataFrame:
    target = conform_source(
        t.customer.select(
            ident("003", "c_custkey").alias("Id"), ident("001", "c_custkey").alias("AccountId"),
            F.col("c_name").alias("LastName"), F.col("c_mktsegment").alias("Department"),
            F.col("c_nationkey").cast("string").alias("MailingCountry"),
        ),
        CONTACTS,
    )
    changes = t.events.select(
        ident("003", "user_id").alias("Id"),
        F.concat(F.lit("User "), F.col("user_id").cast("string")).alias("LastName"),
        F.col("event_type").alias("Title"),
        F.translate(F.col("ts").cast("string"), " ", "T").alias("LastActivityDate"),
        (F.col("event_type") == "error").alias("IsEmailBounced"),
        F.col("event_id").cast("string").alias("Level__c"),
        "ts", "event_id",
    )
    source = conform_source(changes, CONTACTS, "ts", "event_id")
    return plain_merge(CONTACTS, target, source, ["ts", "event_id"])


# Tasks and history: line items before and after a date, keys repeated in both.

def _lines_merge_sql(spec: TableSpec, exprs: dict[str, str]) -> str:
    def part(test: str) -> str:
        return last_rows(
            spec_select(spec, exprs, f"lineitem WHERE l_shipdate {test} {sql_ts(MID)}", ", ".join(LINE_ORDER)),
            spec.keys, LINE_ORDER,
        )

    return full_merge_sql(spec, part("<="), part(">"))


def _lines_merge(spec: TableSpec, feed: DataFrame) -> DataFrame:
    date = F.col(LINES_TS)
    old = conform_source(feed.filter(date <= ts(MID)), spec, *LINE_ORDER)
    target = collapse(old, spec.keys, LINE_ORDER, last=spec.update_columns).select(*spec.columns)
    new = conform_source(feed.filter(date > ts(MID)), spec, *LINE_ORDER)
    return plain_merge(spec, target, new, list(LINE_ORDER))


@query(_lines_merge_sql(ACTIVITIES, TASK_COLUMNS_SQL))
def upsert_activities(t: Tables) -> DataFrame:
    return _lines_merge(ACTIVITIES, task_feed(t))


@query(_lines_merge_sql(HISTORY, HISTORY_COLUMNS_SQL))
def upsert_history(t: Tables) -> DataFrame:
    return _lines_merge(HISTORY, history_feed(t))


# Users: suppliers, then customers under the same numbers and more.

_USER = {"Id": sql_ident("005", "s_suppkey"), "Name": "s_name", "Country": "CAST(s_nationkey AS VARCHAR)",
         "IsActive": "s_acctbal > 0"}
_USER_NEW = {"Id": sql_ident("005", "c_custkey"), "Name": "c_name", "Department": "c_mktsegment",
             "Country": "CAST(c_nationkey AS VARCHAR)", "IsActive": "c_acctbal > 0"}


@query(full_merge_sql(USERS, spec_select(USERS, _USER, "supplier"), spec_select(USERS, _USER_NEW, "customer")))
def upsert_users(t: Tables) -> DataFrame:
    target = t.supplier.select(
        ident("005", "s_suppkey").alias("Id"), F.col("s_name").alias("Name"),
        F.col("s_nationkey").cast("string").alias("Country"), (F.col("s_acctbal") > 0).alias("IsActive"),
    )
    source = t.customer.select(
        ident("005", "c_custkey").alias("Id"), F.col("c_name").alias("Name"),
        F.col("c_mktsegment").alias("Department"), F.col("c_nationkey").cast("string").alias("Country"),
        (F.col("c_acctbal") > 0).alias("IsActive"), F.lit(True).alias("ReceivesAdminInfoEmails"),
    )
    return plain_merge(USERS, conform_source(target, USERS), conform_source(source, USERS), None)


# Stages: priorities and market segments, changed by order counts, joined by event types.

@query(
    full_merge_sql(
        CALL_STAGES,
        spec_select(CALL_STAGES,
                    {"SalesforceId": "label", "CallStage": "label", "IsActive": "true", "SortOrder": "0"},
                    "(SELECT DISTINCT o_orderpriority AS label FROM orders "
                    "UNION ALL SELECT DISTINCT c_mktsegment FROM customer)"),
        spec_select(CALL_STAGES,
                    {"SalesforceId": "label", "CallStage": "lower(label)", "IsActive": "false", "SortOrder": "n"},
                    "(SELECT o_orderpriority AS label, count(*) AS n FROM orders GROUP BY ALL "
                    "UNION ALL SELECT event_type, count(*) FROM events GROUP BY ALL)"),
    )
)
def upsert_dimension(t: Tables) -> DataFrame:
    def stages(df: DataFrame, label: str) -> DataFrame:
        counted = df.groupBy(F.col(label).alias("Id")).agg(F.count(F.lit(1)).cast("int").alias("SortOrder"))
        return counted.select("Id", F.lower("Id").alias("MasterLabel"), F.lit(False).alias("IsActive"), "SortOrder")

    def plain_stages(df: DataFrame, label: str) -> DataFrame:
        ids = df.select(F.col(label).alias("Id")).distinct()
        return ids.select("Id", F.col("Id").alias("MasterLabel"), F.lit(True).alias("IsActive"),
                          F.lit(0).alias("SortOrder"))

    target = plain_stages(t.orders, "o_orderpriority").unionByName(plain_stages(t.customer, "c_mktsegment"))
    source = stages(t.orders, "o_orderpriority").unionByName(stages(t.events, "event_type"))
    return plain_merge(CALL_STAGES, conform_source(target, CALL_STAGES), conform_source(source, CALL_STAGES), None)


# Partial updates: the price and date change, quantity and supplier stay as first inserted.

PARTIAL = ("l_extendedprice", "l_shipdate")
FIXED = ("l_quantity", "l_suppkey")


def _first_last_sql(where: str, fixed_prefix: str = "first_") -> str:
    order = f"row({', '.join(LINE_ORDER)})"
    last = ", ".join(f"arg_max({c}, {order}) AS {c}" for c in PARTIAL)
    first = ", ".join(f"arg_min({c}, {order}) AS {fixed_prefix}{c}" for c in FIXED)
    return f"SELECT {', '.join(KEY)}, {last}, {first} FROM lineitem {where} GROUP BY {', '.join(KEY)}"


@query(_first_last_sql("", ""))
def upsert_source_dedup(t: Tables) -> DataFrame:
    """A batch with repeated keys as if its rows came one by one: last update, first insert."""
    return collapse(t.lineitem, KEY, LINE_ORDER, last=PARTIAL, first=FIXED)


def _lines_before_after(t: Tables) -> tuple[DataFrame, DataFrame]:
    date = F.col(LINES_TS)
    old = collapse(t.lineitem.filter(date <= ts(MID)), KEY, LINE_ORDER, last=PARTIAL, first=FIXED)
    return old, t.lineitem.filter(date > ts(MID))


_PARTIAL_CTES = f"""WITH t AS ({_first_last_sql(f"WHERE l_shipdate <= {sql_ts(MID)}", "")}),
s AS ({_first_last_sql(f"WHERE l_shipdate > {sql_ts(MID)}")}) """


@query(_PARTIAL_CTES + merge_select(KEY, PARTIAL, FIXED))
def upsert_partial(t: Tables) -> DataFrame:
    target, source = _lines_before_after(t)
    return merge(target, source, KEY, update=PARTIAL, seq=LINE_ORDER, null_keys=False)


@query(
    _PARTIAL_CTES
    + """, j AS (SELECT t.m AS tm, s.m AS sm FROM (SELECT *, 1 AS m FROM t) t FULL JOIN (SELECT *, 1 AS m FROM s) s
         ON t.l_orderkey = s.l_orderkey AND t.l_linenumber = s.l_linenumber)
SELECT CASE WHEN tm IS NULL THEN 'insert' WHEN sm IS NOT NULL THEN 'update' ELSE 'keep' END AS action,
       count(*) AS n_rows FROM j GROUP BY ALL"""
)
def upsert_actions(t: Tables) -> DataFrame:
    target, source = _lines_before_after(t)
    return merge_actions(target, source, KEY, update=PARTIAL, seq=LINE_ORDER, null_keys=False)


# Composite null-safe key with a partial update, as the custom values have it.

COMPOSITE = ("CompanyId", "ObjectType", "ExternalId", "Type", "Name")


def _composite_sql(test: str, created: str) -> str:
    order = f"row({', '.join(LINE_ORDER)})"
    return f"""
SELECT CAST(l_suppkey % 4 AS VARCHAR) AS "CompanyId", l_returnflag AS "ObjectType",
       CAST(l_orderkey AS VARCHAR) AS "ExternalId", nullif(l_linestatus, 'F') AS "Type",
       CAST(l_linenumber AS VARCHAR) AS "Name",
       arg_max(CAST(l_extendedprice AS VARCHAR), {order}) AS "Value", arg_max(l_shipdate, {order}) AS "UpdatedAt",
       arg_min(l_shipdate, {order}) AS "{created}"
FROM lineitem WHERE l_shipdate {test} {sql_ts(MID)} GROUP BY 1, 2, 3, 4, 5
"""


@query(
    "WITH t AS (" + _composite_sql("<=", "CreatedAt") + "), s AS (" + _composite_sql(">", "first_CreatedAt")
    + ") " + merge_select(COMPOSITE, ("Value", "UpdatedAt"), ("CreatedAt",), null_safe=True)
)
def upsert_composite_partial(t: Tables) -> DataFrame:
    rows = t.lineitem.select(
        F.pmod("l_suppkey", F.lit(4)).cast("string").alias("CompanyId"),
        F.col("l_returnflag").alias("ObjectType"),
        F.col("l_orderkey").cast("string").alias("ExternalId"),
        F.when(F.col("l_linestatus") != "F", F.col("l_linestatus")).alias("Type"),
        F.col("l_linenumber").cast("string").alias("Name"),
        F.col("l_extendedprice").cast("string").alias("Value"),
        F.col("l_shipdate").alias("CreatedAt"),
        F.col("l_shipdate").alias("UpdatedAt"),
        *LINE_ORDER,
    )
    date, update = F.col(LINES_TS), ("Value", "UpdatedAt")
    target = collapse(rows.filter(date <= ts(MID)), COMPOSITE, LINE_ORDER, last=update, first=("CreatedAt",))
    return merge(target, rows.filter(date > ts(MID)), COMPOSITE, update=update, seq=LINE_ORDER, null_safe=True)


@query(
    f"""
WITH t AS (SELECT nullif(l_suppkey, 7) AS k, max(l_extendedprice) AS v FROM lineitem
           GROUP BY ALL),
s AS (SELECT CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS k, o_totalprice AS v, o_orderkey AS n FROM orders),
l AS (SELECT k, arg_max(v, n) AS v FROM s WHERE k IS NOT NULL GROUP BY k)
SELECT coalesce(l.k, t.k) AS k, coalesce(l.v, t.v) AS v FROM t FULL JOIN l ON t.k = l.k
UNION ALL SELECT NULL, v FROM s WHERE k IS NULL
"""
)
def upsert_null_keys(t: Tables) -> DataFrame:
    """A third of the batch has no key: each such row is inserted, spread over the tasks."""
    target = (
        t.lineitem
        .groupBy(F.when(F.col("l_suppkey") != 7, F.col("l_suppkey")).alias("k"))
        .agg(F.max("l_extendedprice").alias("v"))
    )
    source = t.orders.select(
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("k"),
        F.col("o_totalprice").alias("v"),
        F.col("o_orderkey").alias("n"),
    )
    return merge(target, source, ["k"], seq=["n"])


# Event order: returned lines are the table, all others arrive in any order.

_EVENT_COLUMNS = ("l_shipdate", "l_extendedprice")


def _by_event_sql(where: str) -> str:
    order = f"row({', '.join(LINE_ORDER)})"
    cols = ", ".join(f"arg_max({c}, {order}) AS {c}" for c in _EVENT_COLUMNS)
    return f"SELECT {', '.join(KEY)}, {cols} FROM lineitem WHERE {where} GROUP BY {', '.join(KEY)}"


@query(
    f"WITH t AS ({_by_event_sql(chr(39).join(['l_returnflag = ', 'R', '']))}), "
    f"s AS ({_by_event_sql(chr(39).join(['l_returnflag <> ', 'R', '']))}) "
    + merge_select(KEY, _EVENT_COLUMNS,
                   applies="s.m IS NOT NULL AND (t.m IS NULL OR s.l_shipdate >= t.l_shipdate)")
)
def upsert_event_order(t: Tables) -> DataFrame:
    """Rows older than the table's row change nothing."""
    returned = F.col("l_returnflag") == "R"
    target = collapse(t.lineitem.filter(returned), KEY, LINE_ORDER, last=_EVENT_COLUMNS)
    return merge(
        target, t.lineitem.filter(~returned), KEY, seq=LINE_ORDER, event_col="l_shipdate", null_keys=False
    )


# Sparse rows: a column a row does not carry keeps its value.

@query(
    f"""
WITH t AS (SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, c_acctbal AS balance FROM customer),
s AS (SELECT o_custkey AS id,
       count(*) AS m,
       arg_max(o_orderpriority, o_orderkey) FILTER (o_orderstatus <> 'P') AS name,
       count(*) FILTER (o_orderstatus <> 'P') AS has_name,
       arg_max(o_totalprice, o_orderkey) FILTER (o_orderstatus <> 'F') AS balance,
       count(*) FILTER (o_orderstatus <> 'F') AS has_balance
     FROM orders GROUP BY ALL)
SELECT t.id, CASE WHEN s.has_name > 0 THEN s.name ELSE t.name END AS name, t.segment,
       CASE WHEN s.has_balance > 0 THEN s.balance ELSE t.balance END AS balance
FROM t LEFT JOIN s ON t.id = s.id
"""
)
def upsert_present_only(t: Tables) -> DataFrame:
    target = t.customer.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("balance"),
    )
    status = F.col("o_orderstatus")
    source = t.orders.select(
        F.col("o_custkey").alias("id"),
        F.when(status != "P", F.col("o_orderpriority")).alias("name"),
        F.when(status != "F", F.col("o_totalprice")).alias("balance"),
        F.array_compact(
            F.array(F.when(status != "P", "name"), F.when(status != "F", "balance"))
        ).alias("carried"),
        F.col("o_orderkey").alias("n"),
    )
    return merge(target, source, ["id"], seq=["n"], present="carried", null_keys=False)


# The same upsert written to a bucketed table with versions, then read back.

LINE_STATE = TableSpec(
    name="line_state", object="line", keys=KEY, columns=(*KEY, *PARTIAL, *FIXED),
    types={"l_orderkey": "bigint", "l_linenumber": "int", "l_extendedprice": "double",
           "l_shipdate": "timestamp_ntz", "l_quantity": "double", "l_suppkey": "bigint"},
    update=PARTIAL, ts_col=None,
)


@query(_PARTIAL_CTES + merge_select(KEY, PARTIAL, FIXED))
def versioned_upsert(t: Tables) -> DataFrame:
    target, source = _lines_before_after(t)
    table = VersionedTable(t.spark, shared_folder(t.spark, "line-state"), LINE_STATE, buckets=16)
    table.overwrite(target)
    table.upsert(source, seq=LINE_ORDER)
    return table.read()


@query(
    f"""
SELECT user_id, count(*) AS n, max(ts) AS newest FROM events WHERE ts <= {sql_ts(EVENT_MID)} GROUP BY ALL
"""
)
def versioned_time_travel(t: Tables) -> DataFrame:
    """An earlier version stays readable after later upserts."""
    spec = TableSpec(
        name="user_counts", object="user", keys=("user_id",), columns=("user_id", "n", "newest"),
        types={"user_id": "bigint", "n": "bigint", "newest": "timestamp_ntz"}, ts_col=None,
    )

    def counted(rows: DataFrame) -> DataFrame:
        return rows.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.max("ts").alias("newest"))

    table = VersionedTable(t.spark, shared_folder(t.spark, "user-counts"), spec, buckets=8)
    first = table.upsert(counted(t.events.filter(F.col("ts") <= ts(EVENT_MID))))
    table.upsert(counted(t.events))
    return table.read(first)
