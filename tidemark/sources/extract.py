"""Reading landed extracts: full, incremental, per tenant, and on top of a semi-join."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions import instant, to_millis
from tidemark.operators.conform import reasons_of
from tidemark.specs import TENANT, TableSpec

CORRUPT = "_corrupt_record"
#: Order of landed rows: time and name of their file, place of their block in it.
LANDING = "landing"


def read_landed(
    spark: SparkSession,
    path: str | list[str],
    spec: TableSpec,
    fmt: str = "parquet",
    *,
    stream: bool = False,
    **options: str,
) -> DataFrame:
    """Every landed page of a feed, with the feed's own schema (nothing is inferred).

    Parquet, ORC and Avro carry typed columns, so their schema is taken from the
    files; ``jdbc`` takes its connection from the options. In text formats every
    field is read as text, and a line that cannot be read stays whole in
    ``_corrupt_record``, so that nothing is lost before it is judged. A JSON page
    may be a response as it came: ``{"records": [...]}`` gives its records.
    ``landing`` is the order files landed in, which decides between rows of one
    key and time. ``stream`` reads files as they land, each once.
    """
    reader = (spark.readStream if stream else spark.read).format(fmt).options(**options)
    if fmt == "jdbc":
        return reader.load()
    if fmt not in ("json", "csv", "xml"):
        if stream:  # a stream has to be told; the files there now tell it
            reader = reader.schema(spark.read.format(fmt).options(**options).load(path).schema)
        return reader.load(path).select("*", _landing())
    fields = {n: k for n, k in spec.text_fields.items() if fmt != "csv" or k == "string"}
    schema = ", ".join(f"`{n}` {k}" for n, k in fields.items())
    reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    if fmt != "json":
        return reader.schema(f"{schema}, {CORRUPT} string").load(path).select("*", _landing())
    inner = ", ".join(f"`{n}`: {k}" for n, k in fields.items())
    pages = reader.schema(f"{schema}, records array<struct<{inner}>>, {CORRUPT} string").load(path).select("*", _landing())
    own = F.struct(*[F.col(f"`{n}`") for n in fields])
    rows = F.explode(F.when(F.col("records").isNotNull(), F.col("records")).otherwise(F.array(own)))
    tenant = F.coalesce(F.col("r")[TENANT], F.col("page")).alias(TENANT)
    return pages.select(rows.alias("r"), F.col(TENANT).alias("page"), CORRUPT, LANDING).select(
        *[F.col("r")[n].alias(n) for n in fields if n != TENANT], tenant, CORRUPT, LANDING
    )


def _landing() -> Column:
    return F.struct(
        F.col("_metadata.file_modification_time").alias("landed"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    ).alias(LANDING)


def project_feed(df: DataFrame, spec: TableSpec, *extra: str) -> DataFrame:
    """The feed's fixed projection, as far as the source has the columns."""
    heads = dict.fromkeys(name.split(".")[0] for name in (*spec.extract, *extra))
    return df.select(*[name for name in heads if name in df.columns])


def feed_instant(df: DataFrame, name: str) -> Column:
    """A feed's time column as naive UTC, parsed only when it is text."""
    return instant(f"`{name}`", df.schema[name].dataType)


def full_extract(df: DataFrame, spec: TableSpec, *keep: str, ordered: bool = False) -> DataFrame:
    """All rows of a feed. Sorted only for a writer that asks for it."""
    if ordered and spec.ts_col:
        df = df.orderBy(feed_instant(df, spec.ts_col))
    return project_feed(df, spec, *keep)


def newer_than(df: DataFrame, ts_col: str, watermark: datetime | None) -> DataFrame:
    """Rows strictly after the watermark; no watermark keeps every row.

    The watermark is a literal, so on a typed column the test reaches the scan.
    """
    if watermark is None:
        return df
    cut = watermark.replace(microsecond=watermark.microsecond // 1000 * 1000)
    bound = F.lit(cut.isoformat(sep=" ")).cast("timestamp_ntz")
    return df.filter(feed_instant(df, ts_col) > bound)


def incremental_extract(
    df: DataFrame, spec: TableSpec, watermark: datetime | None, *keep: str, ordered: bool = False
) -> DataFrame:
    """Rows of a feed modified (or created, by ``ts_col``) after the watermark.

    The filter runs before the projection, as some feeds do not carry their
    watermark column into the projection.
    """
    return full_extract(newer_than(df, spec.ts_col, watermark), spec, *keep, ordered=ordered)


def only_referencing(df: DataFrame, column: str, parents: DataFrame, parent_key: str) -> DataFrame:
    """Left semi-join: rows whose ``column`` is the key of some parent row.

    No hint: Spark broadcasts the parents if they are small enough and splits
    hot references under the adaptive planner if they are not.
    """
    ids = parents.select(F.col(parent_key).alias("__parent"))
    return df.join(ids, df[column] == ids["__parent"], "left_semi")


def tenant_extract(
    df: DataFrame,
    ts_col: str,
    watermarks: DataFrame,
    *,
    tenant: str = "CompanyId",
    floor: datetime | None = None,
    overlap: timedelta | None = None,
) -> DataFrame:
    """Rows of all tenants, each after its own watermark.

    ``watermarks`` has one row per tenant to be read (tenant, ``last_sync``; a
    null ``last_sync`` reads everything) and so also decides which tenants are
    read. ``floor`` is a lower bound of all watermarks: a literal that reaches
    the scan, where the join's test cannot. ``overlap`` re-reads a little before
    each watermark, which the keyed merge makes harmless.
    """
    back = overlap or timedelta(0)
    if floor is not None:
        df = newer_than(df, ts_col, floor - back)
    marks = watermarks.select(F.col(tenant).alias("__tenant"), F.col("last_sync").alias("__last_sync"))
    bound = to_millis(F.col("__last_sync")) - F.lit(back)
    return (
        df.join(marks, df[tenant] == marks["__tenant"])
        .filter(F.col("__last_sync").isNull() | (feed_instant(df, ts_col) > bound))
        .drop("__tenant", "__last_sync")
    )


def judged_extract(
    df: DataFrame, spec: TableSpec, watermarks: DataFrame, rules: Mapping[str, str], *, floor: datetime | None = None,
    overlap: timedelta | None = None, tenant: str = TENANT,
) -> DataFrame:
    """The rows a run has to answer for, with ``reasons``: what is wrong with each (none: empty).

    These are the rows newer than their tenant's watermark, and all whose time or tenant cannot be told (``bad_<time>``,
    ``missing_tenant``, ``unknown_tenant``): they are judged before the tenant join could drop them. ``rules`` are those
    of the feed's other columns. ``placed`` is true where time and tenant are known.
    """
    if df.schema[spec.ts_col].dataType.typeName() not in ("string", "timestamp_ntz", "date", "timestamp"):
        raise TypeError(f"{spec.ts_col} cannot be read as a time: {df.schema[spec.ts_col].dataType.simpleString()}")
    back = overlap or timedelta(0)
    at = feed_instant(df, spec.ts_col)
    if floor is not None:
        cut = floor - back
        bound = F.lit(cut.replace(microsecond=cut.microsecond // 1000 * 1000).isoformat(sep=" ")).cast("timestamp_ntz")
        df = df.filter(at.isNull() | (at > bound) | F.col(tenant).isNull())
    marks = watermarks.select(F.col(tenant).alias("__tenant"), F.col("last_sync").alias("__last_sync"))
    joined = df.join(marks, df[tenant] == marks["__tenant"], "left")
    at, known = feed_instant(joined, spec.ts_col), F.col("__tenant").isNotNull()
    new = F.col("__last_sync").isNull() | (at > to_millis(F.col("__last_sync")) - F.lit(back))
    tests = {
        **{reason: F.expr(test) for reason, test in rules.items()},
        f"bad_{spec.ts_col}": at.isNull(),
        "missing_tenant": F.col(tenant).isNull(),
        "unknown_tenant": F.col(tenant).isNotNull() & ~known,
    }
    return (
        joined.filter(at.isNull() | ~known | new)
        .withColumns({"reasons": reasons_of(tests), "placed": at.isNotNull() & known}).drop("__tenant", "__last_sync")
    )
