"""Shape feed rows and pushed records to a target's columns; set bad rows apart."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions import instant_sql, safe_parse_date_sql
from tidemark.specs import TableSpec

# Where a reader keeps the text of a line it cannot read.
CORRUPT = "_corrupt_record"

# Wide tables: the projections below are built as SQL text, one call per table
# instead of some calls per column.


def _quoted(path: str) -> str:
    return ".".join(f"`{part}`" for part in path.split("."))


def _field(df: DataFrame, path: str) -> tuple[str, T.DataType] | None:
    """SQL and type of a possibly dotted source path; None if the source lacks it."""
    schema: T.DataType = df.schema
    for part in path.split("."):
        if not isinstance(schema, T.StructType) or part not in schema.names:
            return None
        schema = schema[part].dataType
    return _quoted(path), schema


def _typed(column: str, data_type: T.DataType, kind: str, is_date: bool) -> str:
    if is_date:
        return instant_sql(column, data_type)
    if data_type.simpleString() == kind:
        return column
    # Not the same expression as in type_rules: the optimizer would note every
    # rule once with and once without each alias of a part of it, which doubles
    # the facts it carries per typed column.
    return f"CASE WHEN {column} IS NOT NULL THEN try_cast({column} AS {kind}) END"


def conform_source(df: DataFrame, spec: TableSpec, *keep: str) -> DataFrame:
    """Feed rows as target rows: renamed, flattened, typed, dates parsed.

    A column the source lacks is NULL, and a null struct gives null fields.
    ``keep`` carries further source columns along (sequence, tenant).
    """
    out = []
    for c in spec.columns:
        found = _field(df, spec.source_of(c)) or _field(df, c)
        kind = spec.type_of(c)
        value = f"CAST(NULL AS {kind})" if found is None else _typed(*found, kind, c in spec.dates)
        out.append(f"{value} AS `{c}`")
    return df.selectExpr(*out, *[f"`{k}`" for k in keep if k not in spec.columns])


def conform_payload(df: DataFrame, spec: TableSpec, *keep: str, fields: str = "fields") -> DataFrame:
    """Pushed records (a map column) as target rows, plus ``present``: the columns each one carries.

    A dotted source reads a struct column of that name if there is one (an
    enriched owner), else JSON text in the record.
    """
    texts, present = [], []
    for c in spec.columns:
        head, _, leaf = spec.source_of(c).partition(".")
        carried = f"map_contains_key(`{fields}`, '{head}')"
        if leaf and head in df.columns:
            text = f"CAST(`{head}`.`{leaf}` AS string)"
            carried = f"({carried} OR `{head}` IS NOT NULL)"
        elif leaf:
            text = f"try_variant_get(try_parse_json(try_element_at(`{fields}`, '{head}')), '$.{leaf}', 'string')"
        else:
            text = f"try_element_at(`{fields}`, '{head}')"
        texts.append(f"{text} AS `{c}`")
        present.append(f"CASE WHEN {carried} THEN '{c}' END")
    others = [f"`{k}`" for k in keep if k not in spec.columns]
    named = df.selectExpr(*texts, f"array_compact(array({', '.join(present)})) AS present", *others)
    typed = [
        f"{safe_parse_date_sql(f'`{c}`')} AS `{c}`" if c in spec.dates
        else _typed(f"`{c}`", T.StringType(), spec.type_of(c), False) + f" AS `{c}`"
        for c in spec.columns
    ]
    return named.selectExpr(*typed, "present", *others)


def type_rules(df: DataFrame, spec: TableSpec, fields: str | None = None) -> dict[str, str]:
    """Rules (SQL) that name a bad row: no key, or a text its column cannot hold.

    Dates are not among them: the date parser turns bad text into NULL. ``fields``
    names a map column to look in instead of the feed's own columns.
    """
    rules: dict[str, str] = {}
    if CORRUPT in df.columns:
        rules["corrupt"] = f"`{CORRUPT}` IS NOT NULL"
    for c in spec.columns:
        path = spec.source_of(c)
        if fields is not None:
            found = (f"`{fields}`['{path}']", T.StringType())
        else:
            found = _field(df, path)
        if found is None:
            if c in spec.keys and not spec.null_safe:
                rules[f"missing_{c}"] = "true"
            continue
        raw, kind = found
        if c in spec.keys and not spec.null_safe:
            rules[f"missing_{c}"] = f"{raw} IS NULL"
        if isinstance(kind, T.StringType) and c not in spec.dates and spec.type_of(c) != "string":
            rules[f"bad_{c}"] = f"{raw} IS NOT NULL AND try_cast({raw} AS {spec.type_of(c)}) IS NULL"
    return rules


def reasons_of(tests: Mapping[str, Column]) -> Column:
    """The names of the tests a row meets, in their order. Named only where some test is met: the list is not compiled, the tests are."""
    none = F.array().cast("array<string>")
    if not tests:
        return none
    named = F.array_compact(F.array(*[F.when(test, F.lit(reason)) for reason, test in tests.items()]))
    return F.when(reduce(lambda a, b: a | b, tests.values()), named).otherwise(none)


def split_valid(df: DataFrame, rules: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """Good rows, and bad rows with ``reasons``: every rule they break, in rule order.

    Nothing is dropped: the two parts together are the input.
    """
    judged = df.withColumn("reasons", reasons_of({reason: F.expr(test) for reason, test in rules.items()}))
    good = judged.filter(F.size("reasons") == 0).drop("reasons")
    bad = judged.filter(F.size("reasons") > 0)
    return good, bad
