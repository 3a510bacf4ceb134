"""Set-based keyed upsert.

A batch is applied as if its rows came one by one, but in two steps: the batch
is collapsed to one row per key, then joined to the target once.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

APART = "__apart"


def any_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def collapse(
    source: DataFrame,
    keys: Sequence[str],
    seq: Sequence[str],
    *,
    last: Sequence[str] = (),
    first: Sequence[str] = (),
    event_col: str | None = None,
    present: str | None = None,
) -> DataFrame:
    """One row per key: ``last`` columns from the last row by ``seq``, ``first`` from the first.

    A key that holds a large part of the batch sends one row per task: the ranked
    window is limited, and the aggregates combine, before the shuffle. ``seq`` must
    order the rows of a key totally (a NULL comes first). With ``event_col`` the
    last row is the newest by event time (arrival breaks ties; a NULL event time
    counts as oldest). With ``present``, an array column naming the columns a row
    really carries, each ``last`` column comes from the last row that carries it
    and is a struct ``(value)``, NULL if no row does.
    """
    newest = [event_col, *seq] if event_col else list(seq)
    if last and not first and not present:
        # Only last rows: a limited window is cheaper than packing rows into an aggregate.
        ranked = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in newest])
        top = source.withColumn("__rank", F.row_number().over(ranked)).filter("__rank = 1")
        return top.selectExpr(*[f"`{c}`" for c in (*keys, *last)])
    aggregates = []
    if present and last:
        order_sql = f"struct({', '.join(f'`{c}`' for c in seq)})"
        aggregates += [
            F.expr(
                f"max_by(struct(`{c}` AS value), {order_sql}) FILTER (WHERE array_contains(`{present}`, '{c}')) AS `{c}`"
            )
            for c in last
        ]
    elif last:
        aggregates.append(F.max_by(F.struct(*last), F.struct(*newest)).alias("__last"))
    if first:
        aggregates.append(F.min_by(F.struct(*first), F.struct(*seq)).alias("__first"))
    grouped = source.groupBy(*keys)
    if not aggregates:
        return source.select(*keys).distinct()
    packed = grouped.agg(*aggregates)
    out = [f"`{k}`" for k in keys]
    if last:
        out += [f"`{c}`" if present else f"__last.`{c}`" for c in last]
    out += [f"__first.`{c}`" for c in first]
    return packed.selectExpr(*out)


def merge(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    *,
    update: Sequence[str] | None = None,
    seq: Sequence[str] | None = None,
    null_safe: bool = False,
    event_col: str | None = None,
    present: str | None = None,
    null_keys: bool = True,
    action: str | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """Upsert ``source`` into ``target`` and return the new table, with the target's columns.

    - A match sets the ``update`` columns (default: all but the key) from the
      last row of its key; an insert takes the other columns from the first.
      A target column the source lacks counts as NULL.
    - ``seq`` orders the batch; leave it out only if keys are unique in it.
    - Keys match by equality, so a row with a NULL key part is always inserted;
      ``null_safe=True`` matches NULL with NULL. ``null_keys=False`` states that
      no key part of the batch or the table is NULL.
    - ``event_col`` makes the merge follow event time: a source row older than
      the target's row changes nothing. Without it, arrival decides.
    - ``present`` names an array column with the columns each row carries;
      a match then keeps the target's value where no row carries the column.
    - ``action`` adds a column ``insert`` / ``update`` / ``keep``.
    - ``tasks`` joins in that many tasks by the hash of the key, whatever the
      session says; not with ``null_safe``. A collapsed batch is shuffled again.
    """
    if event_col and present:
        raise ValueError("event order needs whole rows: it cannot be combined with sparse ones")
    keys = list(keys)
    columns = target.columns
    update = [c for c in columns if c not in keys] if update is None else list(update)
    fixed = [c for c in columns if c not in keys and c not in update]

    # A NULL key never matches and never joins a group: such rows get a part of
    # their own in the key, unique per row, which also spreads them over tasks.
    apart = null_keys and not null_safe
    kinds = {f.name: f.dataType.simpleString() for f in target.schema}
    given = {f.name: f.dataType.simpleString() for f in source.schema}

    def column(c: str) -> str:
        if given.get(c) == kinds[c]:
            return f"`{c}`"
        return f"CAST({f'`{c}`' if c in given else 'NULL'} AS {kinds[c]}) AS `{c}`"

    extras = dict.fromkeys(c for c in (*(seq or ()), present, event_col) if c in given and c not in kinds)
    aligned = source.selectExpr(*map(column, columns), *[f"`{c}`" for c in extras])
    group = list(keys)
    if apart:
        unique = F.struct(*(seq or columns))
        aligned = aligned.withColumn(APART, F.when(any_null(keys), F.to_json(F.struct(unique.alias("r")))))
        aligned = aligned.withColumn(APART, F.coalesce(APART, F.lit("")))
        group.append(APART)
    if seq:
        aligned = collapse(
            aligned, group, seq, last=update, first=fixed, event_col=event_col, present=present
        )
    elif present:
        aligned = aligned.selectExpr(
            *[f"`{c}`" for c in (*group, *fixed)],
            *[f"CASE WHEN array_contains(`{present}`, '{c}') THEN struct(`{c}` AS value) END AS `{c}`" for c in update],
        )

    t, s = target.withColumn("__t", F.lit(True)), aligned.withColumn("__s", F.lit(True))
    if apart:
        t = t.withColumn(
            APART, F.when(any_null(keys), F.to_json(F.struct(*columns))).otherwise(F.lit(""))
        )
    if tasks and not null_safe:
        t, s = t.repartition(tasks, *group), s.repartition(tasks, *group)
    equal = "<=>" if null_safe else "="
    on = " AND ".join(f"t.`{k}` {equal} s.`{k}`" for k in group)
    joined = t.alias("t").join(s.alias("s"), F.expr(on), "full_outer")

    in_target, applies = "t.__t IS NOT NULL", "s.__s IS NOT NULL"
    if event_col:
        new, old = f"s.`{event_col}`", f"t.`{event_col}`"
        stale = f"{in_target} AND {old} IS NOT NULL AND coalesce({new} < {old}, true)"
        applies = f"{applies} AND NOT ({stale})"

    def pick(c: str) -> str:
        if c in keys or c in fixed:
            return f"CASE WHEN {in_target} THEN t.`{c}` ELSE s.`{c}` END AS `{c}`"
        if present:
            return f"CASE WHEN {applies} AND s.`{c}` IS NOT NULL THEN s.`{c}`.value ELSE t.`{c}` END AS `{c}`"
        return f"CASE WHEN {applies} THEN s.`{c}` ELSE t.`{c}` END AS `{c}`"

    out = [pick(c) for c in columns]
    if action:
        out.append(
            f"CASE WHEN NOT ({in_target}) THEN 'insert' WHEN {applies} THEN 'update' ELSE 'keep' END AS `{action}`"
        )
    return joined.selectExpr(*out)


def merge_actions(target: DataFrame, source: DataFrame, keys: Sequence[str], **options) -> DataFrame:
    """How many rows a merge inserts, updates and keeps. Reads the key columns only."""
    merged = merge(target, source, keys, action="action", **options)
    return merged.groupBy("action").agg(F.count(F.lit(1)).alias("n_rows"))
