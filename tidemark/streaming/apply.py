"""Pushed changes as a stream: parse, route, upsert, record an outcome per body."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import (
    conform_payload,
    enrich_owner,
    push_outcomes,
    route_records,
    split_valid,
    type_rules,
)
from tidemark.plans.sync import SyncRun, instant_literal, row_text, set_apart
from tidemark.sinks import VersionedTable
from tidemark.sources import PUSH_SCHEMA, parse_bodies
from tidemark.specs import FEEDS, OPPORTUNITIES, ROUTES, SYNC_LOG, TENANT
from tidemark.workspace import scratch, staged

# A body's place in the order of arrival.
ARRIVAL = ("received_at", "seq")
#: Bytes of a row group of parsed bodies: maps unfold to many times their size, and every route reads them.
STAGE_GROUP = 32 << 20


def read_bodies(spark: SparkSession, path: str, fmt: str = "json", **options: str) -> DataFrame:
    """Landed bodies as a stream; ``kafka`` carries them as JSON in ``value``."""
    if fmt == "kafka":
        raw = spark.readStream.format("kafka").options(**options).load()
        return raw.select(F.from_json(F.col("value").cast("string"), PUSH_SCHEMA).alias("b")).select("b.*")
    return spark.readStream.schema(PUSH_SCHEMA).format(fmt).options(**options).load(path)


@dataclass
class PushSink:
    """Where pushed changes go. ``writer`` and the query id name the stream in the tables' pointers.

    ``users`` gives the owners of opportunities; a column ``seq`` in it says which of several rows of a user is the first.
    """

    run: SyncRun
    writer: str
    users: Callable[[], DataFrame] | None = None
    run_ts: datetime | None = None
    present_only: bool = False

    def outcomes(self) -> str:
        """Outcomes of every stream that ran under this name, a folder per query."""
        return f"{self.run.root}/outcomes/{self.writer}"


#: Pushes keep a watermark of their own in the log: that of the pulled feed belongs to the pulls.
PUSHED = "push:"


def query_of(batch: DataFrame) -> str:
    """The id of the streaming query a batch belongs to: batch numbers count within it, and a new checkpoint begins a new one."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "direct"


def apply_pushed(sink: PushSink, bodies: DataFrame, batch_id: int) -> None:
    """Apply one batch of bodies. Each write is a no-op or an exact repetition when replayed."""
    run, query = sink.run, query_of(bodies)
    place = f"query={query}/batch={batch_id}"
    with scratch(run.spark):
        # Written once, not kept in memory: packing its columns took more heap than Spark accounts for. A body that becomes records
        # is not read again.
        apart = F.when(F.col("status") == "rejected_tenant", row_text(bodies.columns)).alias("row")
        kept = parse_bodies(bodies).select("route", "object_type", "status", "records", "mismatched", "company_id", *ARRIVAL, apart)
        parsed = staged(kept, "pushed", group=STAGE_GROUP)
        records = route_records(parsed, "company_id", *ARRIVAL)
        # One pass tells what there is to write; at most as many routes as exist reach the driver.
        known = F.when(F.col("route").isin(list(ROUTES)) & (F.size("records") > 0), F.col("route"))
        routes, tenantless, mismatched = parsed.agg(
            F.collect_set(known), F.count_if(F.col("status") == "rejected_tenant"), F.count_if(F.size("mismatched") > 0)
        ).first()
        with ThreadPoolExecutor(len(ROUTES)) as pool:  # routes have tables of their own, so their jobs run side by side
            list(pool.map(
                lambda route: apply_route(sink, route, records.filter(F.col("route") == route), query, batch_id), sorted(routes)
            ))
        push_outcomes(parsed, "company_id", *ARRIVAL).write.mode("overwrite").parquet(
            f"{sink.outcomes()}/{place}"
        )
        if tenantless:
            rows = parsed.filter("status = 'rejected_tenant'").select(F.array(F.lit("missing_tenant")).alias("reasons"), "row")
            rows.write.mode("overwrite").json(f"{run.quarantine('tenantless')}/{sink.writer}/{place}")
        if mismatched:
            rows = parsed.filter("size(mismatched) > 0").select(
                F.array(F.lit("type_mismatch")).alias("reasons"), "route", "company_id", *ARRIVAL, "mismatched"
            )
            set_apart(rows).write.mode("overwrite").json(f"{run.quarantine('pushed')}/{sink.writer}/{place}")
        now = instant_literal(sink.run_ts)
        moved = records.groupBy("route", "company_id").agg(F.max("received_at").alias("newest"))
        run.table(SYNC_LOG).upsert(
            moved.select(
                F.concat(F.lit(PUSHED), "route").alias("table_name"),
                F.coalesce("newest", now).alias("last_sync_time"),
                now.alias("created_at"),
                F.col("company_id").alias("CompanyId"),
            ),
            applied=(f"{sink.writer}/{query}", batch_id),
        )


def apply_route(sink: PushSink, route: str, records: DataFrame, query: str, batch_id: int) -> None:
    spec, writer = FEEDS[route], f"{sink.writer}/{query}"
    table = sink.run.table(spec)
    if table.was_applied(writer, batch_id):
        return
    if route == OPPORTUNITIES.name and sink.users is not None:
        owner = F.try_element_at("fields", F.lit("OwnerId"))
        users = sink.users()
        seq = "seq" if "seq" in users.columns else None
        if seq:  # pushed records have a place of their own under that name
            users, seq = users.withColumnRenamed("seq", "__first"), "__first"
        records = enrich_owner(records.withColumn("OwnerId", owner), users, seq=seq).drop("OwnerId")
    rules = type_rules(records, spec, fields="fields")
    good, bad = split_valid(records, rules)
    order = [*ARRIVAL, "pos"]
    # Bad rows first: a batch whose table is committed is not looked at again.
    if not bad.isEmpty():
        set_apart(bad).write.mode("overwrite").json(
            f"{sink.run.quarantine(spec.name)}/{sink.writer}/query={query}/batch={batch_id}"
        )
    table.upsert(
        conform_payload(good, spec, "company_id", *order).withColumnRenamed("company_id", TENANT),
        seq=order,
        present="present" if sink.present_only else None,
        applied=(writer, batch_id),
        fixed=True,  # the parsed bodies are a stage
    )


def start(
    stream: DataFrame, batch: Callable[[DataFrame, int], None], checkpoint: str, interval: str | None
) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()


def start_push_stream(
    sink: PushSink, bodies: DataFrame, checkpoint: str, *, interval: str | None = None
) -> StreamingQuery:
    """Apply a stream of bodies; without an interval, what is there now and then stop."""
    return start(bodies, lambda df, batch_id: apply_pushed(sink, df, batch_id), checkpoint, interval)


def start_upsert_stream(
    table: VersionedTable,
    rows: DataFrame,
    checkpoint: str,
    *,
    writer: str,
    seq: Sequence[str],
    event_col: str | None = None,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    interval: str | None = None,
) -> StreamingQuery:
    """Upsert a stream of typed rows into one table, each batch once.

    ``prepare`` runs on each batch, for instance a join to a static table as of
    that batch.
    """

    def batch(df: DataFrame, batch_id: int) -> None:
        table.upsert(
            prepare(df) if prepare else df, seq=seq, event_col=event_col,
            applied=(f"{writer}/{query_of(df)}", batch_id),
        )

    return start(rows, batch, checkpoint, interval)
