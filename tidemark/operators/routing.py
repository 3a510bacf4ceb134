"""Pushed bodies to records per route, and one outcome per body."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from tidemark.specs import ROUTES


def route_records(parsed: DataFrame, *keep: str) -> DataFrame:
    """One row per accepted record: ``route``, ``pos`` in its body, ``fields``, and ``keep``.

    Bodies without records are removed after the explode: a filter before it
    would be pushed below the parse and make it run twice.
    """
    exploded = parsed.select("route", *keep, F.posexplode_outer("records").alias("pos", "r"))
    return exploded.filter(F.col("pos").isNotNull()).select(
        "route", *keep, "pos", F.col("r.fields").alias("fields")
    )


def push_outcomes(parsed: DataFrame, *keep: str) -> DataFrame:
    """One row per body: status, success, count and error. Counted inside the body's row."""
    supported = ", ".join(ROUTES)
    error = (
        F.when(F.col("status") == "unsupported_type",
               F.concat(F.lit("Unsupported object type: "), F.col("object_type"),
                        F.lit(f"; supported: {supported}")))
        .when(F.col("status") == "rejected_empty", "Empty payload")
        .when(F.col("status") == "rejected_parse", "Payload cannot be parsed")
        .when(F.col("status") == "rejected_tenant", "No tenant given")
    )
    return parsed.select(
        *keep,
        "object_type",
        "status",
        (F.col("status") == "accepted").alias("success"),
        F.size("records").alias("records_processed"),
        error.alias("error"),
    )


def union_labelled(parts: Mapping[str, DataFrame], label: str = "Object") -> DataFrame:
    """Append the rows of several objects, each with its name in a constant column."""
    frames = [df.withColumn(label, F.lit(name)) for name, df in parts.items()]
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out
