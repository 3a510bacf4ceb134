"""The session tests and benchmarks run in."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(zone: str = "UTC", cpus: str | int | None = None) -> SparkSession:
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tidemark")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", zone)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", os.environ.get("TIDEMARK_SHARED") or tempfile.mkdtemp(prefix="tidemark-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
