"""Landed feeds as a stream: a run reads the files that landed since the last one, each once, and opens no other."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.plans.sync import (
    SyncRun,
    batch_rows,
    event_column,
    extract_batch,
    extract_stats,
    judge,
    log_updates,
    read_order,
    set_apart,
    sync_report,
    tenant_marks,
)
from tidemark.specs import SYNC_LOG, TableSpec
from tidemark.streaming.apply import query_of, start
from tidemark.workspace import scratch, staged


def apply_landed(
    run: SyncRun,
    spec: TableSpec,
    rows: DataFrame,
    batch_id: int,
    companies: Callable[[], DataFrame],
    *,
    writer: str,
    run_ts: datetime | None = None,
    related: Callable[[], DataFrame] | None = None,
) -> None:
    """Apply the rows of newly landed files: judge, upsert, set apart, report, log. A replayed batch changes nothing.

    What is new is known by the files, so no row is left out for being older than the watermark, as one that lands late or
    in a later batch of the same run may be; it only changes nothing where the table holds a newer row of its key (by the
    feed's own time, if the table keeps it). The watermark moves to the newest row and tells full from incremental runs.
    """
    spec, query = spec.with_tenant(), query_of(rows)
    name, applied = f"{writer}-{query}-{batch_id:012d}", (f"{writer}/{query}", batch_id)
    log = run.table(SYNC_LOG)
    if log.was_applied(*applied):
        return
    with scratch(run.spark):
        marks = tenant_marks(companies(), log.read(), spec.log_key)
        everything = marks.withColumn("last_sync", F.lit(None).cast("timestamp_ntz"))
        judged = staged(judge(spec, rows, everything), f"landed-{spec.name}", place=True)
        batch, good, bad = extract_batch(spec, judged, related=related() if related else None)
        target, order = batch_rows(spec, good, read_order(rows))
        run.table(spec).upsert(target, seq=order, event_col=event_column(spec), applied=applied, fixed=True)
        set_apart(bad).write.mode("overwrite").json(f"{run.quarantine(spec.name)}/run={name}")
        stats = staged(extract_stats(batch, spec.ts_col), "stats")
        sync_report(spec.name, stats, marks).write.mode("overwrite").parquet(f"{run.root}/reports/{spec.name}/run={name}")
        log.upsert(log_updates(spec.log_key, stats, marks, run_ts=run_ts), applied=applied)


def start_feed_stream(
    run: SyncRun,
    spec: TableSpec,
    rows: DataFrame,
    companies: Callable[[], DataFrame],
    checkpoint: str,
    *,
    writer: str,
    interval: str | None = None,
    **options,
) -> StreamingQuery:
    """Run a feed over a stream of landed rows (``read_landed(..., stream=True)``).

    Without an interval, what has landed by now and then stop: an hourly job. The checkpoint remembers the files.
    """
    return start(
        rows, lambda df, batch_id: apply_landed(run, spec, df, batch_id, companies, writer=writer, **options), checkpoint, interval
    )
