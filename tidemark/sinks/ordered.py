"""Extracts in order without a global sort: files of consecutive ranges, and a manifest that says which rows each holds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

#: A row's place in the whole extract, from 0.
POSITION = "position"


def write_ordered(rows: DataFrame, path: str, by: Sequence[str], files: int | None = None) -> DataFrame:
    """Write rows by ascending ``by`` (NULL first) and return the manifest: ``part, file, n_rows, first, last, start``.

    One shuffle by sampled ranges. ``by`` should end in the key, so that a value many rows share is split too. ``first`` and
    ``last`` are structs of ``by``; ``start`` is the position of a file's first row. The manifest has a row per file.
    """
    spark = rows.sparkSession
    count = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    data = f"{path.rstrip('/')}/data"
    rows.repartitionByRange(count, *by).sortWithinPartitions(*by).write.parquet(data)
    # Only the columns of the order are read back. Files are numbered by their range.
    key = F.struct(*by)
    part = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("int")
    found = spark.read.schema(rows.schema).parquet(data).groupBy(part.alias("part"), F.col("_metadata.file_path").alias("file")).agg(
        F.count("*").alias("n_rows"), F.min(key).alias("first"), F.max(key).alias("last")
    )
    before = F.sum("n_rows").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    found.withColumn("start", F.coalesce(before, F.lit(0))).write.parquet(f"{path.rstrip('/')}/manifest")
    return manifest(spark, path)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path.rstrip('/')}/manifest")


def read_ordered(spark: SparkSession, path: str, low: dict | None = None, high: dict | None = None) -> DataFrame:
    """The rows with their ``position``; nothing is sorted.

    ``low`` and ``high`` (values of the leading columns of the order) keep the files whose ranges can hold such rows; others are
    not opened. Rows of those files outside the bounds are left out.
    """
    listed = manifest(spark, path)
    by = listed.schema["first"].dataType.names
    for bound, column, test in ((low, "last", "__ge__"), (high, "first", "__le__")):
        if bound:
            names = by[:len(bound)]
            listed = listed.where(getattr(F.struct(*[F.col(column)[n] for n in names]), test)(_bound(listed, bound, names)))
    files = [r["file"] for r in listed.select("file").collect()]  # a row per file
    whole = spark.read.parquet(f"{path.rstrip('/')}/data").schema
    if not files:
        return spark.createDataFrame([], whole).withColumn(POSITION, F.lit(0).cast("long"))
    rows = spark.read.schema(whole).parquet(*files).select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row"))
    starts = listed.select(F.col("file").alias("__file"), "start")
    rows = rows.join(starts, "__file").withColumn(POSITION, F.col("start") + F.col("__row")).drop("__file", "__row", "start")
    for bound, test in ((low, "__ge__"), (high, "__le__")):
        if bound:
            names = by[:len(bound)]
            rows = rows.where(getattr(F.struct(*names), test)(_bound(listed, bound, names)))
    return rows


def _bound(listed: DataFrame, bound: dict, names: Sequence[str]):
    kinds = listed.schema["first"].dataType
    return F.struct(*[F.lit(str(bound[n])).cast(kinds[n].dataType).alias(n) for n in names])
