"""Registry of queries and small helpers shared by them."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


@dataclass(frozen=True)
class Entry:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


CATALOG: dict[str, Entry] = {}


class Tables:
    """The given tables by attribute."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, str(sf_dir).rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def stream(self, name: str) -> DataFrame:
        schema = getattr(self, name).schema
        return (
            self.spark.readStream.schema(schema)
            .option("pathGlobFilter", f"{name}.parquet")
            .parquet(self.sf_dir)
        )


def query(sql: str | None = None, name: str | None = None):
    """Register a function of the tables as a query (of its own name by default)."""

    def register(fn: Callable[[Tables], DataFrame]):
        CATALOG[name or fn.__name__] = Entry(lambda spark, sf_dir: fn(Tables(spark, sf_dir)), sql)
        return fn

    return register


def companies(t: Tables) -> DataFrame:
    """Nations as tenants."""
    return t.nation.select(F.col("n_nationkey").cast("string").alias("Id"))


def plain(df: DataFrame) -> DataFrame:
    """Output types every engine compares alike: decimals as doubles, flags and days as text."""

    def cast(f: T.StructField):
        if isinstance(f.dataType, T.DecimalType):
            return F.col(f.name).cast("double").alias(f.name)
        if isinstance(f.dataType, (T.BooleanType, T.DateType)):
            return F.col(f.name).cast("string").alias(f.name)
        return F.col(f.name)

    return df.select(*[cast(f) for f in df.schema])


# SQL text ---------------------------------------------------------------------

_PLAIN_SQL = {"string": "VARCHAR", "boolean": "VARCHAR", "date": "VARCHAR", "int": "INTEGER",
              "double": "DOUBLE", "decimal(18,2)": "DOUBLE", "timestamp_ntz": "TIMESTAMP"}


def spec_select(spec, exprs: dict[str, str], source: str, extra: str = "") -> str:
    """``SELECT`` of a spec's columns: given expressions, NULL for the rest."""
    cols = ", ".join(
        f"CAST({exprs.get(c, 'NULL')} AS {_PLAIN_SQL[spec.type_of(c)]}) AS \"{c}\"" for c in spec.columns
    )
    return f"SELECT {cols}{', ' + extra if extra else ''} FROM {source}"


def merge_select(
    keys: Sequence[str],
    update: Sequence[str],
    fixed: Sequence[str] = (),
    *,
    null_safe: bool = False,
    applies: str = "s.m IS NOT NULL",
    columns: Sequence[str] | None = None,
) -> str:
    """Upsert of CTE ``s`` (``first_<c>`` for fixed columns) into CTE ``t``."""
    eq = "IS NOT DISTINCT FROM" if null_safe else "="
    on = " AND ".join(f't."{k}" {eq} s."{k}"' for k in keys)
    exprs = {k: f'CASE WHEN t.m IS NOT NULL THEN t."{k}" ELSE s."{k}" END' for k in keys}
    exprs |= {c: f'CASE WHEN {applies} THEN s."{c}" ELSE t."{c}" END' for c in update}
    exprs |= {c: f'CASE WHEN t.m IS NOT NULL THEN t."{c}" ELSE s."first_{c}" END' for c in fixed}
    cols = ", ".join(f'{exprs[c]} AS "{c}"' for c in (columns or exprs))
    return (
        f"SELECT {cols} FROM (SELECT *, 1 AS m FROM t) t FULL JOIN (SELECT *, 1 AS m FROM s) s ON {on}"
    )


def last_rows(select: str, keys: Sequence[str], order: Sequence[str]) -> str:
    """The last row per key of a select."""
    by = ", ".join(f'"{k}"' for k in keys)
    desc = ", ".join(f"{o} DESC" for o in order)
    return (
        f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY {desc}) AS rn "
        f"FROM ({select})) WHERE rn = 1"
    )
