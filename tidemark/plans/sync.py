"""One feed: extract after each tenant's watermark, set bad rows apart, upsert, log, report.

The tenant is a column throughout, so one job serves every tenant. The flow
comes twice: as a pure function from DataFrames to DataFrames, and as a runner
over versioned tables.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.functions import iso_text
from tidemark.operators import conform_source, merge, type_rules
from tidemark.operators.sizing import measured
from tidemark.sinks import VersionedTable
from tidemark.sources import judged_extract, only_referencing
from tidemark.sources.extract import LANDING, feed_instant
from tidemark.specs import FEEDS, SYNC_LOG, TENANT, TableSpec
from tidemark.workspace import PLACE, compiled, scratch, staged


@dataclass
class Synced:
    """What a flow produces; nothing has run yet."""

    target: DataFrame
    sync_log: DataFrame
    report: DataFrame
    quarantine: DataFrame


def instant_literal(when: datetime | None) -> Column:
    if when is None:
        return F.current_timestamp().cast("timestamp_ntz")
    return F.lit(when.isoformat(sep=" ")).cast("timestamp_ntz")


def check_log(sync_log: DataFrame) -> None:
    """A log whose watermark is no timestamp is refused before anything is read by it."""
    kind = sync_log.schema["last_sync_time"].dataType
    if not isinstance(kind, (T.TimestampNTZType, T.TimestampType)):
        raise TypeError(f"last_sync_time must be a timestamp, not {kind.simpleString()}")


def watermarks(sync_log: DataFrame, table: str | None = None) -> DataFrame:
    """Latest ``last_sync`` per table and tenant (or per tenant of one table)."""
    check_log(sync_log)
    if table is not None:
        sync_log = sync_log.filter(F.col("table_name") == table)
    keys = [TENANT] if table is not None else ["table_name", TENANT]
    return sync_log.groupBy(*keys).agg(F.max("last_sync_time").alias("last_sync"))


def tenant_marks(companies: DataFrame, sync_log: DataFrame, table: str) -> DataFrame:
    """One row per tenant to be read, with its watermark if it has one.

    Measured, because every feed row is joined to it: of unknown size, it would
    make the planner shuffle the feed by tenant.
    """
    ids = companies.select(F.col("Id").alias(TENANT)).distinct()
    return measured(ids.join(watermarks(sync_log, table), TENANT, "left"))


def common_floor(marks: DataFrame) -> datetime | None:
    """The lowest watermark, or None while some tenant has none. One row reaches the driver."""
    low, unread = marks.agg(
        F.min("last_sync"), F.count_if(F.col("last_sync").isNull())
    ).first()
    return None if unread else low


def extract_stats(batch: DataFrame, ts_col: str) -> DataFrame:
    """Rows and newest time per tenant; reads two columns of the batch."""
    return batch.groupBy(TENANT).agg(
        F.count(F.lit(1)).alias("records_processed"), F.max(feed_instant(batch, ts_col)).alias("newest")
    )


def log_updates(
    name: str | Column,
    stats: DataFrame,
    marks: DataFrame,
    *,
    run_ts: datetime | None,
    watermark_mode: str = "source",
    advance_on_empty: bool = False,
    keys: Sequence[str] = (TENANT,),
) -> DataFrame:
    """New log rows: tenants with rows advance, tenants without do so only on request.

    ``source`` advances to the newest row read, ``run_ts`` to the time of the run. A watermark never moves back.
    ``keys`` are those of ``marks`` and ``stats``; a log name made of them makes a row per object, say.
    """
    now = instant_literal(run_ts)
    joined = marks.join(stats, list(keys), "left")
    moved = F.col("records_processed").isNotNull()
    if advance_on_empty:
        moved = moved | F.col("last_sync").isNotNull()
    new = F.greatest(now if watermark_mode == "run_ts" else F.col("newest"), F.col("last_sync"))
    return joined.filter(moved).select(
        (F.lit(name) if isinstance(name, str) else name).alias("table_name"),
        new.alias("last_sync_time"),
        now.alias("created_at"),
        TENANT,
    )


def sync_report(feed: str | Column, stats: DataFrame, marks: DataFrame, keys: Sequence[str] = (TENANT,)) -> DataFrame:
    """One row per tenant: feed, sync type, rows, previous watermark as text, success."""
    return marks.join(stats, list(keys), "left").select(
        (F.lit(feed) if isinstance(feed, str) else feed).alias("feed"),
        TENANT,
        F.when(F.col("last_sync").isNull(), "full").otherwise("incremental").alias("sync_type"),
        F.coalesce("records_processed", F.lit(0)).cast("bigint").alias("records_processed"),
        iso_text(F.col("last_sync")).alias("last_sync"),
        F.lit(True).alias("success"),
    )


def sync(
    spec: TableSpec,
    source: DataFrame,
    target: DataFrame,
    sync_log: DataFrame,
    companies: DataFrame,
    *,
    run_ts: datetime | None = None,
    related: DataFrame | None = None,
    seq: Sequence[str] | None = None,
    watermark_mode: str = "source",
    overlap: timedelta | None = None,
    null_keys: bool = False,
) -> Synced:
    """One feed for all tenants: extract after each watermark, set bad rows apart, upsert, log.

    ``related`` holds the parents of a feed with a semi-join. ``seq`` orders the
    rows of the feed (default: its time column, then the tenant).
    """
    marks = tenant_marks(companies, sync_log, spec.log_key)
    judged = judge(spec, source, marks, overlap=overlap)
    batch, good, bad = extract_batch(spec, judged, related=related)
    stats = extract_stats(batch, spec.ts_col)
    rows, order = batch_rows(spec, good, seq)
    new_target = merge(
        target, rows, spec.keys, update=spec.update_columns, seq=order,
        null_safe=spec.null_safe, null_keys=null_keys,
    )
    new_log = merge(
        sync_log,
        log_updates(spec.log_key, stats, marks, run_ts=run_ts, watermark_mode=watermark_mode,
                    advance_on_empty=spec.advance_on_empty),
        SYNC_LOG.keys,
        null_keys=False,
    )
    return Synced(new_target, new_log, sync_report(spec.name, stats, marks), bad)


def judge(spec: TableSpec, source: DataFrame, marks: DataFrame, *, overlap: timedelta | None = None) -> DataFrame:
    """The rows of a run with the reasons against them, before any join can drop one."""
    rules = {reason: test for reason, test in type_rules(source, spec).items() if reason != f"missing_{TENANT}"}
    return judged_extract(source, spec, marks, rules, floor=common_floor(marks), overlap=overlap)


def extract_batch(
    spec: TableSpec, judged: DataFrame, *, related: DataFrame | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The batch (rows of a known tenant and time that pass the feed's semi-join), its good rows, and all bad rows."""
    batch = judged.filter("placed")
    if spec.semi_join and related is not None:
        column, _, parent_key = spec.semi_join
        batch = only_referencing(batch, column, related, parent_key)
    bad = batch.filter(F.size("reasons") > 0).unionByName(judged.filter("NOT placed")).drop("placed")
    return batch, batch.filter(F.size("reasons") == 0).drop("reasons", "placed"), bad


def batch_rows(
    spec: TableSpec, good: DataFrame, seq: Sequence[str] | None
) -> tuple[DataFrame, list[str]]:
    """Target rows plus the columns that order them."""
    ordered = good.withColumn("__at", feed_instant(good, spec.ts_col))
    order = list(seq or ())
    rows = conform_source(ordered, spec, TENANT, "__at", *order)
    return rows, ["__at", TENANT, *order]


@dataclass
class SyncRun:
    """Versioned tables of a deployment, opened by spec under one folder."""

    spark: SparkSession
    root: str
    buckets: int = 64

    def __post_init__(self) -> None:
        compiled(self.spark)

    def table(self, spec: TableSpec) -> VersionedTable:
        """A stored table. Feeds are kept with their tenant, whether pulled or pushed."""
        spec = spec.with_tenant() if spec.name in FEEDS else spec
        buckets = 1 if spec.name == SYNC_LOG.name else self.buckets
        return VersionedTable(self.spark, f"{self.root}/{spec.name}", spec, buckets)

    def quarantine(self, name: str) -> str:
        return f"{self.root}/quarantine/{name}"

    def report(self, name: str, run_ts: datetime) -> str:
        return f"{self.root}/reports/{name}/run={stamp(run_ts)}"


def stamp(when: datetime) -> str:
    """A run's name in folders."""
    return when.strftime("%Y%m%dT%H%M%S%f")


def kept_report(run: SyncRun, name: str, run_ts: datetime, report: DataFrame) -> DataFrame:
    """The report of a run, stored beside its tables; it outlives the run's stages."""
    path = run.report(name, run_ts)
    report.write.mode("overwrite").parquet(path)
    return run.spark.read.schema(report.schema).parquet(path)


def run_feed(
    run: SyncRun,
    spec: TableSpec,
    source: DataFrame,
    companies: DataFrame,
    *,
    run_ts: datetime,
    related: DataFrame | None = None,
    seq: Sequence[str] | None = None,
    watermark_mode: str = "source",
    overlap: timedelta | None = None,
) -> DataFrame:
    """Run one feed against its tables and return the report.

    The source is read and judged once, into the shared folder: rows, bad rows,
    counts and watermark all come from there, whatever arrives meanwhile; the
    folder is emptied when the run ends. Rows of one key and time are applied by
    ``seq`` (default: the order landed files came in), then in the order they
    were read in. Order matters for a restart:
    rows, then the bad rows, then the log. A run that dies before the log is read
    again from the old watermark, and the keyed merge makes the repetition
    harmless.
    """
    log, spec = run.table(SYNC_LOG), spec.with_tenant()
    with scratch(run.spark):
        marks = tenant_marks(companies, log.read(), spec.log_key)
        judged = staged(judge(spec, source, marks, overlap=overlap), f"feed-{spec.name}", place=True)
        batch, good, bad = extract_batch(spec, judged, related=related)
        rows, order = batch_rows(spec, good, read_order(source, seq))
        run.table(spec).upsert(rows, seq=order, fixed=True)
        set_apart(bad).write.mode("overwrite").json(f"{run.quarantine(spec.name)}/run={stamp(run_ts)}")
        stats = staged(extract_stats(batch, spec.ts_col), "stats")
        report = kept_report(run, spec.name, run_ts, sync_report(spec.name, stats, marks))
        log.upsert(log_updates(spec.log_key, stats, marks, run_ts=run_ts, watermark_mode=watermark_mode,
                               advance_on_empty=spec.advance_on_empty))
    return report


def read_order(source: DataFrame, seq: Sequence[str] | None = None) -> list[str]:
    """Columns that order rows of one key and time in a stage of ``source``."""
    return [*(seq or [c for c in (LANDING,) if c in source.columns]), PLACE]


def event_column(spec: TableSpec) -> str | None:
    """The target column that holds a row's own time, if the table keeps it."""
    return next((c for c in spec.columns if spec.source_of(c) == spec.ts_col and c in spec.dates), None)


def row_text(columns: Sequence[str]) -> Column:
    """A bad row as JSON text, without what a run added to it."""
    return F.to_json(F.struct(*[c for c in columns if c not in ("reasons", PLACE, LANDING)]))


def set_apart(bad: DataFrame) -> DataFrame:
    """Bad rows as stored for replay: reasons, and the row as JSON text."""
    return bad.select("reasons", row_text(bad.columns).alias("row"))
