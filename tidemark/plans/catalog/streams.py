"""Streams over the events: each runs to the end of what is there and returns the table it built."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.plans.catalog.pushes import event_bodies
from tidemark.plans.catalog.registry import Tables, query
from tidemark.plans.catalog.standins import RUN_TS
from tidemark.plans.sync import SyncRun
from tidemark.sinks import VersionedTable, shared_folder
from tidemark.specs import FEEDS, SYNC_LOG, TableSpec
from tidemark.streaming import PushSink, start_push_stream, start_upsert_stream

USER_STATE = TableSpec(
    name="user_state", object="user", keys=("user_id",),
    columns=("user_id", "event_id", "ts", "event_type", "value"),
    types={"user_id": "bigint", "event_id": "bigint", "ts": "timestamp_ntz", "value": "double"},
    ts_col=None,
)
ENRICHED = TableSpec(
    name="user_owner", object="user", keys=("user_id",), columns=("user_id", "event_id", "owner"),
    types={"user_id": "bigint", "event_id": "bigint"}, ts_col=None,
)


def _latest(columns: str, extra: str = "") -> str:
    return (
        f"SELECT {columns} FROM (SELECT *, row_number() OVER (PARTITION BY user_id{extra} ORDER BY ts DESC, event_id DESC) "
        "AS rn FROM events) e "
    )


@query(_latest("user_id, event_id, ts, event_type, value") + "WHERE rn = 1")
def stream_upsert(t: Tables) -> DataFrame:
    root = shared_folder(t.spark, "stream-upsert")
    table = VersionedTable(t.spark, f"{root}/table", USER_STATE, buckets=8)
    start_upsert_stream(
        table, t.stream("events"), f"{root}/checkpoint", writer="events", seq=["ts", "event_id"], event_col="ts"
    ).awaitTermination()
    return table.read()


@query(_latest("user_id, event_id, s_name AS owner") + "LEFT JOIN supplier ON s_suppkey = user_id WHERE rn = 1")
def stream_enrich(t: Tables) -> DataFrame:
    """Stream-static left join before the upsert."""
    root = shared_folder(t.spark, "stream-enrich")
    table = VersionedTable(t.spark, f"{root}/table", ENRICHED, buckets=8)
    owners = t.supplier.select(F.col("s_suppkey").alias("user_id"), F.col("s_name").alias("owner"))
    rows = t.stream("events").join(owners, "user_id", "left")
    start_upsert_stream(
        table, rows, f"{root}/checkpoint", writer="events", seq=["ts", "event_id"]
    ).awaitTermination()
    return table.read()


def _pushed(t: Tables) -> PushSink:
    root = shared_folder(t.spark, "stream-push")
    users = t.supplier.select(
        F.col("s_suppkey").cast("string").alias("Id"), F.col("s_name").alias("Name"),
        F.lit(None).cast("string").alias("Email"),
    )
    sink = PushSink(SyncRun(t.spark, f"{root}/tables", buckets=8), "pushed", users=lambda: users, run_ts=RUN_TS)
    bodies = event_bodies(t.stream("events"))
    start_push_stream(sink, bodies, f"{root}/checkpoint").awaitTermination()
    return sink


@query(
    "SELECT CASE event_type WHEN 'click' THEN 'accounts' WHEN 'view' THEN 'contacts' WHEN 'purchase' THEN 'opportunities' "
    "ELSE 'users' END AS route, 'U' || CAST(user_id AS VARCHAR) AS id, event_type || '/' || CAST(event_id AS VARCHAR) AS name "
    "FROM (" + _latest("*", ", event_type") + ") WHERE rn = 1 AND event_type <> 'error'"
)
def stream_route(t: Tables) -> DataFrame:
    """One stream of bodies, one table per route."""
    run = _pushed(t).run
    out = None
    for route in ("accounts", "contacts", "opportunities", "users"):
        spec = FEEDS[route]
        part = run.table(spec).read().select(
            F.lit(route).alias("route"), F.col(spec.keys[0]).alias("id"), F.col("Name").alias("name")
        )
        out = part if out is None else out.unionByName(part)
    return out


@query(
    """
SELECT event_id AS seq, CASE WHEN event_type = 'error' THEN 'unsupported_type' ELSE 'accepted' END AS status,
       CASE WHEN event_type = 'error' THEN 0 ELSE 1 END AS records_processed FROM events
"""
)
def stream_outcomes(t: Tables) -> DataFrame:
    """The outcomes the same stream leaves, one per body."""
    sink = _pushed(t)
    return t.spark.read.parquet(sink.outcomes()).select("seq", "status", "records_processed")


@query(
    """
SELECT 'push:' || CASE event_type WHEN 'click' THEN 'accounts' WHEN 'view' THEN 'contacts' WHEN 'purchase' THEN 'opportunities'
       ELSE 'users' END AS table_name, max(ts) AS last_sync_time, 'c1' AS "CompanyId"
FROM events WHERE event_type <> 'error' GROUP BY ALL
"""
)
def stream_watermarks(t: Tables) -> DataFrame:
    """The watermarks the same stream leaves in the log, per route."""
    return _pushed(t).run.table(SYNC_LOG).read().select("table_name", "last_sync_time", "CompanyId")
