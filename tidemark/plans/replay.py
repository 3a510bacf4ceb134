"""The quarantine read back: rows set apart by earlier runs are restored, judged again, and stored once they are sound.

A row of the quarantine is known by its run and the digest of its text. Rows that were stored are marked as settled in a keyed
table, after they were stored: a replay that dies in between stores them again, which the keyed merge makes harmless, and a
settled row is never looked at again. The quarantine itself is not changed.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.conform import CORRUPT
from tidemark.operators.sizing import measured
from tidemark.plans.sync import SyncRun, batch_rows, event_column, extract_batch, instant_literal, judge, kept_report
from tidemark.specs import SETTLED, TENANT, TableSpec
from tidemark.workspace import scratch, staged

ROW = ("run", "digest")


def set_apart_rows(run: SyncRun, name: str) -> DataFrame:
    """``run, digest, reasons, row`` of everything the runs of a feed set apart; equal rows of a run once."""
    base, schema = run.quarantine(name), "reasons array<string>, row string"
    path = run.spark._jvm.org.apache.hadoop.fs.Path(f"{base}/run=*")
    if not path.getFileSystem(run.spark._jsc.hadoopConfiguration()).globStatus(path):
        return run.spark.createDataFrame([], f"run string, digest string, {schema}")
    found = run.spark.read.schema(f"{schema}, run string").option("basePath", base).json(f"{base}/run=*")
    return found.select("run", F.sha2("row", 256).alias("digest"), "reasons", "row").dropDuplicates(list(ROW))


def pending(run: SyncRun, name: str) -> DataFrame:
    """Rows set apart and not settled yet."""
    settled = run.table(SETTLED).read().where(F.col("feed") == name).select(*ROW)
    return set_apart_rows(run, name).join(settled, list(ROW), "left_anti")


def restore(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows of the quarantine as the feed had them, every field as text, with ``run`` and ``digest``.

    A field may stand under the name of the feed or of the target column.
    """
    names = {c: spec.source_of(c) for c in spec.columns if "." not in spec.source_of(c)}
    flat = dict.fromkeys([*names, *names.values(), CORRUPT], "string")
    fields = flat | {n: k for n, k in spec.text_fields.items() if k != "string"} | {spec.ts_col: "string", TENANT: "string"}
    schema = "struct<" + ", ".join(f"`{n}`: {k}" for n, k in fields.items()) + ">"
    read = rows.select(*ROW, F.from_json("row", schema).alias("r"))
    other = {source: c for c, source in names.items() if source != c}
    columns = [
        F.coalesce(F.col("r")[n], F.col("r")[other[n]]).alias(n) if n in other else F.col("r")[n].alias(n)
        for n in fields if n not in names or names[n] == n or n in other
    ]
    return read.select(*ROW, *columns)


def replay(
    run: SyncRun,
    spec: TableSpec,
    companies: DataFrame,
    *,
    run_ts: datetime,
    repair: Callable[[DataFrame], DataFrame] | None = None,
    related: DataFrame | None = None,
) -> DataFrame:
    """Judge a feed's quarantined rows again and store the sound ones; returns ``run, pending, stored`` per run.

    ``repair`` may change the restored rows (all text; it has to keep ``run`` and ``digest``). A tenant that is known by now, or
    a parent that has arrived (``related``), also makes a row sound. Rows are judged whatever the watermark, which does not move.
    A stored row that is newer by the feed's own time stays; tables that keep no such time take the replayed row.
    """
    spec, name = spec.with_tenant(), spec.name
    with scratch(run.spark):
        waiting = staged(pending(run, name), "pending")
        rows = restore(waiting, spec)
        rows = repair(rows) if repair else rows
        marks = measured(companies.select(F.col("Id").alias(TENANT)).distinct().withColumn("last_sync", F.lit(None).cast("timestamp_ntz")))
        judged = staged(judge(spec, rows, marks), f"replay-{name}")
        _, good, _ = extract_batch(spec, judged, related=related)
        target, order = batch_rows(spec, good, ROW)
        run.table(spec).upsert(target, seq=order, event_col=event_column(spec))
        settled = good.select(
            F.lit(name).alias("feed"), *ROW, F.lit("stored").alias("outcome"), instant_literal(run_ts).alias("settled_at")
        )
        run.table(SETTLED).upsert(settled)
        stored = good.groupBy("run").agg(F.count("*").alias("stored"))
        report = waiting.groupBy("run").agg(F.count("*").alias("pending")).join(stored, "run", "left").select(
            "run", (F.col("pending") - F.coalesce("stored", F.lit(0))).alias("pending"), F.coalesce("stored", F.lit(0)).alias("stored")
        )
        return kept_report(run, f"replay-{name}", run_ts, report)
