"""CRM feeds made of the given tables, and the same feeds as SQL."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions import watermark_text
from tidemark.plans.catalog.registry import Tables

# Watermarks used throughout.
MID = datetime(1998, 1, 1)
EARLY = datetime(1997, 1, 1)
LATE = datetime(2001, 1, 1)
EVENT_MID = datetime(2024, 1, 15)
RUN_TS = datetime(2024, 2, 1, 12)


def sql_ts(when: datetime) -> str:
    return f"TIMESTAMP '{when:%Y-%m-%d %H:%M:%S}'"


def ts(when: datetime) -> Column:
    return F.lit(f"{when:%Y-%m-%d %H:%M:%S}").cast("timestamp_ntz")


def ident(prefix: str, *parts: str) -> Column:
    """``006`` and the key columns joined with ``-``."""
    return F.concat(F.lit(prefix), F.concat_ws("-", *[F.col(p).cast("string") for p in parts]))


def sql_ident(prefix: str, *parts: str) -> str:
    return f"'{prefix}' || " + " || '-' || ".join(f"CAST({p} AS VARCHAR)" for p in parts)


# Line items repeat their key; this orders the rows of a key totally.
LINE_ORDER = ("l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
              "l_returnflag", "l_linestatus")


def opportunity_feed(t: Tables) -> DataFrame:
    """Orders as opportunities, time columns typed as landed Parquet has them."""
    return t.orders.select(
        ident("006", "o_orderkey").alias("Id"),
        ident("001", "o_custkey").alias("AccountId"),
        F.col("o_orderpriority").alias("StageName"),
        F.col("o_totalprice").alias("Amount"),
        (F.col("o_orderstatus") == "F").alias("IsClosed"),
        F.col("o_orderdate").alias("LastModifiedDate"),
    )


OPPORTUNITY_FEED_SQL = f"""
SELECT {sql_ident('006', 'o_orderkey')} AS "Id", {sql_ident('001', 'o_custkey')} AS "AccountId",
       o_orderpriority AS "StageName", o_totalprice AS "Amount", o_orderstatus = 'F' AS "IsClosed",
       o_orderdate AS "LastModifiedDate"
FROM orders
"""


def task_feed(t: Tables) -> DataFrame:
    """Line items as tasks; dates as the text a remote feed sends."""
    return t.lineitem.select(
        ident("00T", "l_orderkey", "l_linenumber").alias("Id"),
        ident("006", "l_orderkey").alias("WhatId"),
        ident("005", "l_suppkey").alias("OwnerId"),
        F.col("l_returnflag").alias("Status"),
        F.col("l_linestatus").alias("Priority"),
        F.col("l_extendedprice").cast("string").alias("Subject"),
        watermark_text(F.col("l_shipdate")).alias("ActivityDate"),
        (F.col("l_linestatus") == "F").alias("IsClosed"),
        F.col("l_shipdate").alias("LastModifiedDate"),
        *LINE_ORDER,
    )


TASK_COLUMNS_SQL = {
    "SalesforceId": sql_ident("00T", "l_orderkey", "l_linenumber"),
    "WhatId": sql_ident("006", "l_orderkey"),
    "OwnerId": sql_ident("005", "l_suppkey"),
    "Status": "l_returnflag",
    "Priority": "l_linestatus",
    "Subject": "CAST(l_extendedprice AS VARCHAR)",
    "ActivityDate": "l_shipdate",
    "IsClosed": "l_linestatus = 'F'",
}


def history_feed(t: Tables) -> DataFrame:
    """Line items as opportunity history, followed by creation time."""
    return t.lineitem.select(
        ident("008", "l_orderkey", "l_linenumber").alias("Id"),
        ident("006", "l_orderkey").alias("OpportunityId"),
        F.col("l_shipdate").alias("CreatedDate"),
        F.col("l_extendedprice").alias("Amount"),
        F.col("l_discount").alias("Probability"),
        F.col("l_returnflag").alias("StageName"),
        F.col("l_linestatus").alias("ForecastCategory"),
        *LINE_ORDER,
    )


HISTORY_COLUMNS_SQL = {
    "SalesforceId": sql_ident("008", "l_orderkey", "l_linenumber"),
    "OpportunityId": sql_ident("006", "l_orderkey"),
    "CreatedDate": "l_shipdate",
    "Amount": "CAST(l_extendedprice AS DECIMAL(18,2))",
    "Probability": "l_discount",
    "StageName": "l_returnflag",
    "ForecastCategory": "l_linestatus",
}
