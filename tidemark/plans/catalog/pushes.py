"""Pushed bodies: orders and events rendered as messages, parsed back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators import push_outcomes, route_records
from tidemark.plans.catalog.registry import Tables, query
from tidemark.plans.catalog.standins import RUN_TS, ident
from tidemark.plans.sync import SyncRun
from tidemark.sinks import shared_folder
from tidemark.sources import json_records, parse_bodies, soap_records
from tidemark.specs import ACTIVITIES, OPPORTUNITIES
from tidemark.streaming import PushSink, apply_pushed


def escaped(text: Column) -> Column:
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(char), F.lit(entity))
    return text


def element(tag: str, text: Column) -> Column:
    return F.concat(F.lit(f"<sf:{tag}>"), escaped(text.cast("string")), F.lit(f"</sf:{tag}>"))


def notification(*fields: Column, attribute: str = "") -> Column:
    head = f'<Notification><sObject{attribute} xmlns:sf="urn:fields" xmlns:xsi="urn:instance">'
    return F.concat(F.lit(head), *fields, F.lit("</sObject></Notification>"))


def soap_body(*notifications: Column) -> Column:
    return F.concat(
        F.lit('<?xml version="1.0" encoding="UTF-8"?><env:Envelope xmlns:env="urn:envelope"><env:Body>'
              '<notifications xmlns="urn:outbound"><OrganizationId>00D</OrganizationId>'),
        *notifications,
        F.lit("</notifications></env:Body></env:Envelope>"),
    )


def order_soap(t: Tables) -> DataFrame:
    """Two records per order: the order by child type, its account by attribute, with a text to escape."""
    name = F.concat("o_orderpriority", F.lit(" & <"), "o_orderstatus", F.lit(">"))
    body = soap_body(
        notification(element("type", F.lit("Opportunity")), element("Id", F.col("o_orderkey")),
                     element("Name", name), F.lit("<sf:Fax/>")),
        notification(element("Id", F.col("o_custkey")), attribute=' xsi:type="sf:Account"'),
    )
    return t.orders.select("o_orderkey", "o_orderstatus", body.alias("body"))


def exploded(df: DataFrame, key: str) -> DataFrame:
    out = df.select(key, F.posexplode_outer("records").alias("pos", "r"))
    return out.filter(F.col("pos").isNotNull())


@query(
    """
SELECT o_orderkey, 0 AS pos, 'Opportunity' AS type, CAST(o_orderkey AS VARCHAR) AS id,
       o_orderpriority || ' & <' || o_orderstatus || '>' AS name, 3 AS n_fields, 1 AS n_null FROM orders
UNION ALL SELECT o_orderkey, 1, 'Account', CAST(o_custkey AS VARCHAR), NULL, 1, 0 FROM orders
""",
    name="soap_records",
)
def soap_order_records(t: Tables) -> DataFrame:
    values = F.map_values("r.fields")
    return exploded(soap_records(order_soap(t)), "o_orderkey").select(
        "o_orderkey", "pos", F.col("r.type").alias("type"),
        F.try_element_at("r.fields", F.lit("Id")).alias("id"),
        F.try_element_at("r.fields", F.lit("Name")).alias("name"),
        F.size(values).alias("n_fields"),
        F.size(F.filter(values, lambda v: v.isNull())).alias("n_null"),
    )


def order_json(t: Tables) -> DataFrame:
    """Orders in the four envelopes by key: a list of two, ``records``, ``data``, and a single object."""
    one = F.to_json(F.struct(F.col("o_orderkey").alias("Id"), F.col("o_orderpriority").alias("Name"),
                             F.struct(F.col("o_orderstatus").alias("Code")).alias("State")))
    two = F.to_json(F.struct(F.col("o_custkey").cast("string").alias("Id")))
    shape = F.pmod("o_orderkey", F.lit(4))
    body = (
        F.when(shape == 0, F.concat(F.lit("["), one, F.lit(", "), two, F.lit("]")))
        .when(shape == 1, F.concat(F.lit('{"records": ['), one, F.lit("]}")))
        .when(shape == 2, F.concat(F.lit('{"data": ['), one, F.lit("]}")))
        .otherwise(one)
    )
    return t.orders.select("o_orderkey", "o_orderstatus", body.alias("body"))


_JSON_ROWS = """
SELECT o_orderkey, 0 AS pos, CAST(o_orderkey AS VARCHAR) AS id, o_orderpriority AS name,
       '{"Code":"' || o_orderstatus || '"}' AS state FROM orders
UNION ALL SELECT o_orderkey, 1, CAST(o_custkey AS VARCHAR), NULL, NULL FROM orders WHERE o_orderkey % 4 = 0
"""


@query(_JSON_ROWS)
def json_envelope(t: Tables) -> DataFrame:
    return exploded(json_records(order_json(t)), "o_orderkey").select(
        "o_orderkey", "pos",
        F.try_element_at("r.fields", F.lit("Id")).alias("id"),
        F.try_element_at("r.fields", F.lit("Name")).alias("name"),
        F.try_element_at("r.fields", F.lit("State")).alias("state"),
    )


def push(key: str, route: Column, content_type: Column, body: Column) -> list[Column]:
    """Columns of a pushed body; the row's key is its sequence."""
    return [
        F.col(key).cast("bigint").alias("seq"), route.alias("object_type"), content_type.alias("content_type"),
        body.alias("body"), F.lit("c1").alias("company_id"),
        F.lit(None).cast("timestamp_ntz").alias("received_at"),
    ]


@query(
    f"""
SELECT o_orderkey AS seq, CAST(o_orderstatus <> 'O' AS VARCHAR) AS is_xml, 0 AS pos, CAST(o_orderkey AS VARCHAR) AS id
FROM orders
UNION ALL SELECT o_orderkey, 'false', 1, CAST(o_custkey AS VARCHAR) FROM orders
WHERE o_orderkey % 4 = 0 AND o_orderstatus = 'O'
"""
)
def payload_dispatch(t: Tables) -> DataFrame:
    """XML and JSON bodies in one feed, told apart by content type."""
    xml = order_soap(t).filter(F.col("o_orderstatus") != "O")
    js = order_json(t).filter(F.col("o_orderstatus") == "O")
    kind = F.when(F.col("o_orderstatus") == "F", "Text/XML; charset=utf-8").otherwise("application/soap+xml")
    route = F.lit("Opportunities")
    bodies = xml.select(*push("o_orderkey", route, kind, F.col("body"))).unionByName(
        js.select(*push("o_orderkey", route, F.lit("application/json"), F.col("body")))
    )
    records = route_records(parse_bodies(bodies), "seq", "is_xml")
    return records.select(
        "seq", F.col("is_xml").cast("string").alias("is_xml"), "pos",
        F.try_element_at("fields", F.lit("Id")).alias("id"),
    )


# Events as bodies: the event type picks the route, errors go to an unknown one.

_ROUTE = {"click": "accounts", "view": "Contacts", "purchase": "OPPORTUNITIES", "signup": "users", "error": "leads"}
_OBJECT = {"click": "Account", "view": "Contact", "purchase": "Opportunity", "signup": "User", "error": "Lead"}


def _by_type(values: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])[F.col("event_type")]


def event_body() -> Column:
    """A typed list: the event's own record and a record of another object."""
    own = F.struct(
        _by_type(_OBJECT).alias("ObjectType"), F.concat(F.lit("U"), F.col("user_id")).alias("Id"),
        F.concat_ws("/", "event_type", F.col("event_id").cast("string")).alias("Name"),
    )
    other = F.struct(F.lit("Case").alias("ObjectType"), F.lit("X").alias("Id"), F.lit("x").alias("Name"))
    return F.to_json(F.array(own, other))


def event_bodies(events: DataFrame) -> DataFrame:
    return events.select(
        _by_type(_ROUTE).alias("object_type"), F.lit("application/json").alias("content_type"),
        event_body().alias("body"), F.lit("c1").alias("company_id"), F.col("ts").alias("received_at"),
        F.col("event_id").alias("seq"),
    )


@query(
    """
SELECT CASE event_type WHEN 'click' THEN 'accounts' WHEN 'view' THEN 'contacts' WHEN 'purchase' THEN 'opportunities'
       WHEN 'signup' THEN 'users' ELSE 'leads' END AS route,
       CASE WHEN event_type = 'error' THEN 'unsupported_type' ELSE 'accepted' END AS status,
       count(*) AS n_bodies, sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END) AS n_records,
       sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END) AS n_mismatched
FROM events GROUP BY ALL
"""
)
def route_by_object(t: Tables) -> DataFrame:
    parsed = parse_bodies(event_bodies(t.events))
    return parsed.groupBy("route", "status").agg(
        F.count(F.lit(1)).alias("n_bodies"),
        F.sum(F.size("records")).alias("n_records"),
        F.sum(F.size("mismatched")).alias("n_mismatched"),
    )


@query(
    """
SELECT event_id AS seq,
  CASE WHEN event_id % 9 IN (1, 2, 7) THEN 'rejected_empty' WHEN event_id % 9 IN (3, 5, 8) THEN 'rejected_parse'
       WHEN event_type = 'error' THEN 'unsupported_type' ELSE 'accepted' END AS status,
  CASE WHEN event_type = 'error' THEN 0 WHEN event_id % 9 = 0 THEN 1 WHEN event_id % 9 = 4 THEN 2 ELSE 0 END
    AS records_processed
FROM events
"""
)
def push_outcome(t: Tables) -> DataFrame:
    """Good, empty, malformed and unrouted bodies: one outcome each."""
    form = F.pmod("event_id", F.lit(9))
    # The second record has the route's type only in XML bodies of two.
    kind = _by_type(_OBJECT)
    record = notification(element("type", kind), element("Id", F.col("user_id")))
    body = (
        F.when(form == 0, event_body()).when(form == 1, "{}").when(form == 2, "")
        .when(form == 3, F.concat(F.lit("["), event_body())).when(form == 4, soap_body(record, record))
        .when(form == 5, "<broken").when(form == 6, "5").when(form == 7, " [ ] ")
        .otherwise(F.concat(event_body(), F.lit(" tail")))
    )
    content = F.when(form.isin(4, 5), "application/soap+xml").otherwise("application/json")
    bodies = t.events.select(*push("event_id", _by_type(_ROUTE), content, body))
    return push_outcomes(parse_bodies(bodies), "seq").select("seq", "status", "records_processed")


@query(
    """
SELECT DISTINCT 'opportunity_activities' AS route, 'c1' AS "CompanyId", '00T' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS id,
       '006' || CAST(l_orderkey AS VARCHAR) AS label FROM lineitem
UNION ALL SELECT 'opportunities', 'c1', '006' || CAST(o_orderkey AS VARCHAR), first_name
FROM orders LEFT JOIN (SELECT s_nationkey AS k, arg_min(s_name, s_suppkey) AS first_name FROM supplier GROUP BY s_nationkey) ON k = o_custkey % 30
"""
)
def push_activities(t: Tables) -> DataFrame:
    """Tasks and opportunities pushed into stored tables; of several users with one id the first is the owner."""
    task = F.to_json(F.struct(ident("00T", "l_orderkey", "l_linenumber").alias("Id"), ident("006", "l_orderkey").alias("WhatId")))
    deal = F.to_json(F.struct(ident("006", "o_orderkey").alias("Id"), (F.col("o_custkey") % 30).cast("string").alias("OwnerId")))
    columns = [F.lit("application/json").alias("content_type"), F.lit("c1").alias("company_id"), F.lit(None).cast("timestamp_ntz").alias("received_at")]
    bodies = t.lineitem.select(F.lit("Opportunity_Activities").alias("object_type"), task.alias("body"), F.col("l_orderkey").cast("long").alias("seq"), *columns)
    deals = t.orders.select(F.lit("opportunities").alias("object_type"), deal.alias("body"), F.col("o_orderkey").cast("long").alias("seq"), *columns)
    users = t.supplier.select(
        F.col("s_nationkey").cast("string").alias("Id"), F.col("s_name").alias("Name"), F.lit(None).cast("string").alias("Email"), F.col("s_suppkey").alias("seq"),
    )
    run = SyncRun(t.spark, shared_folder(t.spark, "push-activities"), buckets=8)
    apply_pushed(PushSink(run, "pushed", users=lambda: users, run_ts=RUN_TS), bodies.unionByName(deals), 0)
    rows = lambda spec, label: run.table(spec).read().select(
        F.lit(spec.name).alias("route"), "CompanyId", F.col(spec.keys[0]).alias("id"), F.col(label).alias("label")
    )
    return rows(ACTIVITIES, "WhatId").unionByName(rows(OPPORTUNITIES, "OwnerName"))
