"""Folders, stored steps and row streams shared by the operators."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder all executors reach, under ``spark.checkpoint.dir``, which every session has to name."""
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if not base:
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows written once to the shared folder and read back: later readers neither compute
    them again nor lose them with an executor."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, path: str) -> None:
    """Delete a stored step that nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def reachable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did, unless the job says where it is."""
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH")]))


def lanes(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone (NULL text: empty); other columns, of any name, stay out of the way."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


def table(sf_dir: str, name: str, spark: SparkSession) -> DataFrame:
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512, size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that one holds at most ``rows`` rows and, but for a single long row, ``size`` bytes."""
    for batch in batches:
        start = 0
        while start < batch.num_rows:
            n = min(rows, batch.num_rows - start)
            while n > 1 and batch.slice(start, n).get_total_buffer_size() > 0 and _bytes(batch, start, n) > size:
                n //= 2
            yield batch.slice(start, n)
            start += n


def _bytes(batch: pa.RecordBatch, start: int, n: int) -> int:
    return batch.slice(start, n).nbytes


def blocks_by_key(
    batches: Iterator[pa.RecordBatch], keys: list[str]
) -> Iterator[tuple[bool, dict[str, np.ndarray]]]:
    """Runs of equal keys in a stream sorted by them; ``True`` opens a new key.

    A long run comes in several pieces, so no run has to fit into memory.
    """
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = {f.name: batch.column(i).to_numpy(zero_copy_only=False) for i, f in enumerate(batch.schema)}
        change = np.zeros(batch.num_rows, bool)
        for k in keys:
            change[1:] |= cols[k][1:] != cols[k][:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            key = tuple(cols[k][a] for k in keys)
            yield key != last, {n: c[a:b] for n, c in cols.items()}
            last = key
