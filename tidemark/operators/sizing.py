"""Let Spark know how large a derived join side really is."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.workspace import staged


def measured(side: DataFrame) -> DataFrame:
    """Write a derived join side once and read it back, so the planner sees its true size.

    The planner guesses the size of an aggregate or a join from its inputs and would shuffle the large side by a handful of
    keys. Files have exact sizes: below ``spark.sql.autoBroadcastJoinThreshold`` the side is broadcast, above it the join
    stays a shuffle join. Nothing is cached, so a later plan over the same inputs reads them anew, and a lost executor
    loses nothing.
    """
    return staged(side, "measured")
