"""Lookups: the owner of a record, the config row in force."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.merge import collapse
from tidemark.specs import CONFIG_CLASSES


def enrich_owner(
    records: DataFrame,
    users: DataFrame,
    *,
    owner_id: str = "OwnerId",
    user_id: str = "Id",
    fields: Sequence[str] = ("Name", "Email"),
    seq: str | None = None,
) -> DataFrame:
    """Add ``Owner struct<Name,Email>`` by one left join instead of a query per record.

    An owner that is not found gives null fields; a record without an owner id
    gets a null struct. ``seq`` picks the first of several rows of a user; without
    it user ids must be unique. No hint: the users are broadcast if Spark knows
    them to be small, and otherwise a hot owner is split by the adaptive planner,
    which can split the left side of a left join.
    """
    found = users.select(F.col(user_id).alias("__user"), F.struct(*fields).alias("__owner"), *([seq] if seq else []))
    if seq:
        found = collapse(found, ["__user"], [seq], first=["__owner"])
    joined = records.join(found, records[owner_id] == found["__user"], "left")
    owner = F.when(
        F.coalesce(F.col(owner_id).cast("string"), F.lit("")) != "",
        F.struct(*[F.col("__owner")[f].alias(f) for f in fields]),
    )
    return joined.withColumn("Owner", owner).drop("__user", "__owner")


def latest_with_fallback(
    rows: DataFrame,
    by: str = "CompanyId",
    *,
    provider: str = "ProviderName",
    service: str = "ServiceType",
    deleted: str = "IsDeleted",
    modified: str = "ModifiedAt",
    tie: str = "Id",
    classes: Sequence[tuple[int, int]] = CONFIG_CLASSES,
) -> DataFrame:
    """Per tenant the newest live row of the preferred class, else of the next class.

    The ranked window is limited before the shuffle, so a tenant with very many
    rows sends one per task.
    """
    rank = F.lit(None).cast("int")
    for position, (p, s) in reversed(list(enumerate(classes))):
        rank = F.when((F.col(provider) == p) & (F.col(service) == s), position).otherwise(rank)
    live = rows.filter(F.col(deleted) == 0).withColumn("__rank", rank).filter("__rank is not null")
    best = collapse(live.withColumn("__rank", -F.col("__rank")), [by], ["__rank", modified, tie],
                    last=[c for c in rows.columns if c != by])
    return best.select(*rows.columns)
