"""Custom fields of all objects and tenants: one feed of records, read and judged once, each object after its own watermark."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions import to_millis
from tidemark.operators import assemble_metadata, custom_attribute_rows, custom_value_rows, fields_with_values, merge
from tidemark.operators.conform import CORRUPT, reasons_of
from tidemark.operators.sizing import measured
from tidemark.plans.sync import SyncRun, kept_report, log_updates, set_apart, stamp, sync_report, watermarks
from tidemark.sources.records import AT, OBJECT, Landed, field_values, read_wide, wide_records
from tidemark.specs import CUSTOM_ATTRIBUTES, CUSTOM_FIELD_OBJECTS, CUSTOM_VALUES, SYNC_LOG, TENANT, custom_values_log_key
from tidemark.workspace import PLACE, scratch, staged

KEYS = (TENANT, OBJECT)
BY = (TENANT, OBJECT, "Name")


def _log_name() -> Column:
    return F.concat(F.lit(custom_values_log_key("")), F.col(OBJECT))


def object_marks(companies: DataFrame, sync_log: DataFrame, objects: Sequence[str]) -> DataFrame:
    """One row per tenant and object to be read, with its watermark if it has one; measured, as every record meets it."""
    ids = companies.select(F.col("Id").alias(TENANT)).distinct()
    each = ids.select(TENANT, F.explode(F.array(*[F.lit(o) for o in objects])).alias(OBJECT))
    return measured(
        each.withColumn("table_name", _log_name()).join(watermarks(sync_log), ["table_name", TENANT], "left").drop("table_name")
    )


def judge_records(records: DataFrame, marks: DataFrame) -> DataFrame:
    """The records a run has to answer for, with ``reasons``: what is wrong with each (none: empty).

    These are the records newer than the watermark of their object and tenant, and all whose time, object or tenant cannot be
    told. ``placed`` is true where they can. The lowest watermark of each object is a literal, so on a typed column of a feed of
    one object it reaches the scan.
    """
    low = marks.groupBy(OBJECT).agg(F.min("last_sync").alias("low"), F.count_if(F.col("last_sync").isNull()).alias("open")).collect()
    floors = F.lit(None).cast("timestamp_ntz")
    for r in low:  # as many as there are objects
        if not r["open"]:
            cut = r["low"].replace(microsecond=r["low"].microsecond // 1000 * 1000)
            floors = F.when(F.col(OBJECT) == r[OBJECT], F.lit(cut.isoformat(sep=" ")).cast("timestamp_ntz")).otherwise(floors)
    objects = [r[OBJECT] for r in low]
    untold = F.col(AT).isNull() | F.col(TENANT).isNull() | F.col(OBJECT).isNull()
    read = records.where(untold | floors.isNull() | (F.col(AT) > floors))
    joined = read.join(marks.withColumn("__known", F.lit(True)), list(KEYS), "left")
    known = F.col("__known").isNotNull()
    listed = F.col(OBJECT).isin(objects) if objects else F.lit(False)
    tests = {
        "corrupt": F.col(CORRUPT).isNotNull(),
        "missing_Id": F.coalesce("Id", F.lit("")) == "",
        "bad_time": F.col(AT).isNull(),
        "missing_object": F.col(OBJECT).isNull(),
        "unknown_object": F.col(OBJECT).isNotNull() & ~listed,
        "missing_tenant": F.col(TENANT).isNull(),
        "unknown_tenant": F.col(TENANT).isNotNull() & listed & ~known,
    }
    new = F.col("last_sync").isNull() | (F.col(AT) > to_millis(F.col("last_sync")))
    return (
        joined.where(F.col(AT).isNull() | ~known | new)
        .withColumns({"reasons": reasons_of(tests), "placed": F.col(AT).isNotNull() & known}).drop("__known", "last_sync")
    )


def metadata_names(metadata: DataFrame) -> dict[str, list[str]]:
    """Names of the custom fields per object, over all tenants: as many as there are fields."""
    rows = metadata.groupBy(OBJECT).agg(F.sort_array(F.collect_set("Name")).alias("names")).collect()
    return {r[OBJECT]: r["names"] for r in rows}


def records_of(
    run_spark, wide: Mapping[str, DataFrame | Landed] | DataFrame, names: Mapping[str, Sequence[str]], ts_col: str
) -> DataFrame:
    """Records of whatever form the feed has; of wide feeds, only the fields the metadata names are read."""
    if isinstance(wide, DataFrame):
        return wide
    frames = {o: read_wide(run_spark, w, names.get(o, ()), ts_col) if isinstance(w, Landed) else w for o, w in wide.items()}
    return wide_records(frames, names, ts_col)


def objects_of(wide: Mapping[str, DataFrame | Landed] | DataFrame, objects: Sequence[str] | None) -> list[str]:
    return list(objects or (CUSTOM_FIELD_OBJECTS if isinstance(wide, DataFrame) else wide))


def kept_fields(metadata: DataFrame, values: DataFrame, marks: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """Metadata after a run: a full one keeps every field, an incremental one those with values."""
    scope = [c for c in by if c != "Name"]
    judged = metadata.join(marks.select(*scope, F.col("last_sync").isNull().alias("__full")), scope)
    full, incremental = marks.agg(F.count_if(F.col("last_sync").isNull()), F.count_if(F.col("last_sync").isNotNull())).first()
    kept = judged.filter("__full")
    if incremental:
        # Looks through the values, so only if some object or tenant asks for it.
        found = fields_with_values(judged.filter("not __full"), values, by)
        kept = kept.unionByName(found) if full else found
    return kept.drop("__full")


@dataclass
class CustomChanges:
    """Rows to upsert after custom fields were read, and the records set apart."""

    attributes: DataFrame
    values: DataFrame
    sync_log: DataFrame
    report: DataFrame
    quarantine: DataFrame


def changes_of(
    judged: DataFrame,
    metadata: DataFrame,
    marks: DataFrame,
    *,
    run_ts: datetime | None,
    watermark_mode: str = "source",
    clear_nulls: bool = False,
    keep: Sequence[str] = (),
) -> CustomChanges:
    """What judged records and assembled metadata change. Value rows carry ``__at``, the time of their record, and ``keep``."""
    batch = judged.where("placed")
    bad = batch.where(F.size("reasons") > 0).unionByName(judged.where("NOT placed")).drop("placed")
    good = batch.where(F.size("reasons") == 0)
    values = field_values(good, *KEYS, AT, *keep)
    if not clear_nulls:
        values = values.where(F.col("value").isNotNull())
    stats = batch.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("records_processed"), F.max(AT).alias("newest"))
    kept = kept_fields(metadata, values.where(F.col("value").isNotNull()) if clear_nulls else values, marks)
    return CustomChanges(
        custom_attribute_rows(kept),
        custom_value_rows(values, metadata, AT, *keep, by=list(BY)),
        log_updates(_log_name(), stats, marks, run_ts=run_ts, watermark_mode=watermark_mode,
                    advance_on_empty=CUSTOM_VALUES.advance_on_empty, keys=KEYS),
        sync_report(_log_name(), stats, marks, KEYS),
        bad,
    )


def assembled(feeds: Mapping[str, DataFrame]) -> DataFrame:
    """One row per tenant, object and custom field."""
    return assemble_metadata(
        feeds["custom_fields"], feeds["definitions"], feeds["particles"], feeds["described"], by=[TENANT, "object_name"]
    )


def custom_changes(
    feeds: Mapping[str, DataFrame],
    wide: Mapping[str, DataFrame | Landed] | DataFrame,
    sync_log: DataFrame,
    companies: DataFrame,
    *,
    run_ts: datetime | None = None,
    ts_col: str = "LastModifiedDate",
    objects: Sequence[str] | None = None,
    **options,
) -> CustomChanges:
    """Read the custom fields of all objects and tenants, each object after its own watermark.

    ``wide`` maps an object to its records (``Id``, tenant, time column, one column per custom field), as a DataFrame or where it
    lies; or it is one feed of records of all objects. Metadata feeds carry ``object_name`` and the tenant.
    """
    metadata = measured(assembled(feeds))
    marks = object_marks(companies, sync_log, objects_of(wide, objects))
    records = records_of(companies.sparkSession, wide, metadata_names(metadata), ts_col)
    return changes_of(judge_records(records, marks), metadata, marks, run_ts=run_ts, **options)


def upsert_values(target: DataFrame, rows: DataFrame, *, clear_nulls: bool = False, **options) -> DataFrame:
    """Merge long values. ``clear_nulls`` lets a null value empty an existing row; it never adds one."""
    if not clear_nulls:
        rows = rows.filter(F.col("Value").isNotNull())
    merged = merge(
        target, rows, CUSTOM_VALUES.keys, update=CUSTOM_VALUES.update_columns, null_safe=True,
        action="__action", **options,
    )
    return merged.filter((F.col("__action") != "insert") | F.col("Value").isNotNull()).drop("__action")


def sync_custom_fields(
    feeds: Mapping[str, DataFrame],
    wide: Mapping[str, DataFrame | Landed] | DataFrame,
    attributes: DataFrame,
    stored: DataFrame,
    sync_log: DataFrame,
    companies: DataFrame,
    *,
    clear_nulls: bool = False,
    **options,
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Custom fields upserted; returns attributes, values, log and report."""
    new = custom_changes(feeds, wide, sync_log, companies, clear_nulls=clear_nulls, **options)
    return (
        merge(attributes, new.attributes, CUSTOM_ATTRIBUTES.keys, null_keys=False),
        upsert_values(stored, new.values, clear_nulls=clear_nulls, seq=[AT, "Value"]),
        merge(sync_log, new.sync_log, SYNC_LOG.keys, null_keys=False),
        new.report,
    )


def run_custom_fields(
    run: SyncRun,
    feeds: Mapping[str, DataFrame],
    wide: Mapping[str, DataFrame | Landed] | DataFrame,
    companies: DataFrame,
    *,
    run_ts: datetime,
    ts_col: str = "LastModifiedDate",
    objects: Sequence[str] | None = None,
    clear_nulls: bool = False,
    **options,
) -> DataFrame:
    """Custom fields of all objects against their tables; returns the report.

    The records are read and judged once, into the shared folder: values, bad records, counts and watermarks come from there.
    Of one record and time, the row read last counts. Bad records go to the quarantine before the log moves.
    """
    log, name = run.table(SYNC_LOG), CUSTOM_VALUES.name
    with scratch(run.spark):
        metadata = measured(assembled(feeds))
        marks = object_marks(companies, log.read(), objects_of(wide, objects))
        records = records_of(run.spark, wide, metadata_names(metadata), ts_col)
        judged = staged(judge_records(records, marks), name, place=True)
        new = changes_of(judged, metadata, marks, run_ts=run_ts, clear_nulls=clear_nulls, keep=[PLACE], **options)
        run.table(CUSTOM_ATTRIBUTES).upsert(new.attributes)
        values = run.table(CUSTOM_VALUES)
        rows = emptying_only(values.read(), new.values) if clear_nulls else new.values
        values.upsert(rows, seq=[AT, PLACE], fixed=True)
        set_apart(new.quarantine).write.mode("overwrite").json(f"{run.quarantine(name)}/run={stamp(run_ts)}")
        report = kept_report(run, name, run_ts, new.report)
        log.upsert(new.sync_log)
    return report


def emptying_only(target: DataFrame, rows: DataFrame) -> DataFrame:
    """Long values without the NULLs that would add a row: a NULL may only empty a value that is there, or comes with it."""
    keys = list(CUSTOM_VALUES.keys)
    filled = rows.filter(F.col("Value").isNotNull())
    there = target.select(*keys).unionByName(filled.select(*keys))
    on = [F.col(f"r.{k}").eqNullSafe(F.col(f"t.{k}")) for k in keys]
    empty = rows.filter(F.col("Value").isNull()).alias("r").join(there.alias("t"), on, "left_semi")
    return filled.unionByName(empty)
