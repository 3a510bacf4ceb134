"""Where tables, checkpoints and stages of a run are written."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"
METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
#: Column with a row's place in a stage: the task that wrote it, then its row.
PLACE = "__place"

_OPEN: ContextVar[list[str] | None] = ContextVar("stages of the run", default=None)


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the one the cluster names in ``spark.checkpoint.dir``.

    Every session has to name a folder there that all its executors can reach.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if not base:
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def compiled(spark: SparkSession) -> None:
    """Let Spark split up generated code that the JVM would not compile (methods over 8,000 bytes), as wide rows make it.

    What the session says itself stands.
    """
    if spark.conf.get(METHOD_LIMIT) == "65535":
        spark.conf.set(METHOD_LIMIT, "8000")


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete the stages made within, however the block ends. What is returned from it must not read them."""
    token = _OPEN.set([])
    try:
        yield
    finally:
        for path in _OPEN.get():
            removed(spark, path)
        _OPEN.reset(token)


def removed(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def staged(df: DataFrame, purpose: str, *, place: bool = False, group: int | None = None) -> DataFrame:
    """The rows written once to the shared folder and read back: fixed content of known size, for any number of readers.

    ``place`` adds the column ``__place``, by which rows stand in the order they were read in. ``group`` bounds the bytes
    of a row group, which a task that writes or reads the stage holds.
    """
    path = shared_folder(df.sparkSession, purpose)
    if (stages := _OPEN.get()) is not None:
        stages.append(path)
    (df.write.option("parquet.block.size", str(group)) if group else df.write).parquet(path)
    rows = df.sparkSession.read.schema(df.schema).parquet(path)
    return rows.select("*", _place().alias(PLACE)) if place else rows


def _place() -> Column:
    task = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("int")
    return F.struct(task.alias("task"), F.col("_metadata.row_index").alias("row"))
