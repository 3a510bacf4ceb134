"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions import config_json, json_map, json_value, safe_parse_date
from tidemark.plans.catalog.registry import Tables, query


@query(
    """
SELECT o_orderkey, CASE o_orderkey % 14
  WHEN 0 THEN o_orderdate + INTERVAL '10:30:00' HOUR TO SECOND
  WHEN 1 THEN o_orderdate + to_microseconds(18000123456)
  WHEN 2 THEN o_orderdate + INTERVAL 630 MINUTE
  WHEN 3 THEN o_orderdate + to_microseconds(66600500000)
  WHEN 4 THEN o_orderdate + to_microseconds(37800123000)
  WHEN 5 THEN o_orderdate + INTERVAL 150 MINUTE
  WHEN 6 THEN o_orderdate
  WHEN 7 THEN o_orderdate
  WHEN 12 THEN o_orderdate + to_microseconds(3723000000)
  WHEN 13 THEN o_orderdate + to_microseconds(86399999999 + 3630000000)
  END AS parsed
FROM orders
""".replace("INTERVAL '10:30:00' HOUR TO SECOND", "INTERVAL 630 MINUTE"),
    name="safe_parse_date",
)
def parse_dates(t: Tables) -> DataFrame:
    """Order dates in every accepted text form and in some that must be refused."""
    day = F.substring(F.col("o_orderdate").cast("string"), 1, 10)
    short = F.concat_ws("-", F.year("o_orderdate"), F.month("o_orderdate"), F.day("o_orderdate"))
    form = F.pmod("o_orderkey", F.lit(14))
    tails = {
        0: "T10:30:00.000+0000", 1: "T10:30:00.123456+05:30", 2: "T10:30:00Z", 3: "T10:30:00.5-0800",
        4: "T10:30:00.123", 5: "T02:30:00", 6: "", 9: "\n", 12: "T1:2:3", 13: "T23:59:59.999999-01:00:30",
    }
    text = F.when(form == 7, short).when(form == 8, F.concat(F.substring(day, 1, 8), F.lit("34")))
    text = text.when(form == 10, F.concat(F.lit(" "), day)).when(form == 11, "")
    for number, tail in tails.items():
        text = text.when(form == number, F.concat(day, F.lit(tail)))
    return t.orders.select("o_orderkey", text.alias("text")).select(
        "o_orderkey", safe_parse_date("text").alias("parsed")
    )


@query(
    """
SELECT event_id,
       CASE WHEN event_type IN ('error', 'view', 'signup') THEN 0 ELSE 1 END AS n_keys,
       CASE WHEN event_type IN ('error', 'view', 'signup') THEN 'none' ELSE json_extract_string(props, '$.k') END AS k
FROM events
"""
)
def json_metadata_safe(t: Tables) -> DataFrame:
    """Objects with broken, empty and trailing text among them."""
    kind = F.col("event_type")
    text = (
        F.when(kind == "error", F.concat(F.lit("{"), F.col("props")))
        .when(kind == "view", "")
        .when(kind == "signup", F.concat("props", F.lit(" x")))
        .otherwise(F.col("props"))
    )
    parsed = t.events.select("event_id", json_map(text).alias("m"))
    return parsed.select(
        "event_id", F.size("m").alias("n_keys"), json_value(F.col("m"), "k", "none").alias("k")
    )


@query(
    """
SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS instance, o_orderstatus AS token,
       CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderpriority END AS expires
FROM orders
"""
)
def json_build(t: Tables) -> DataFrame:
    """JSON text from columns, missing ones as empty text, read back by key."""
    text = config_json(
        instance_url=F.col("o_custkey"),
        token_type=F.col("o_orderstatus"),
        expires_in_seconds=F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")),
    )
    built = t.orders.select("o_orderkey", text.alias("doc"))
    return built.select(
        "o_orderkey",
        F.get_json_object("doc", "$.instance_url").alias("instance"),
        F.get_json_object("doc", "$.token_type").alias("token"),
        F.get_json_object("doc", "$.expires_in_seconds").alias("expires"),
    )
