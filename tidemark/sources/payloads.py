"""Pushed change bodies: SOAP or JSON text in, arrays of records out.

A record is ``struct<fields: map<string,string>, type: string>``: the map keeps
an absent field apart from a null one. Everything stays inside the body's own
row, so a body needs no shuffle to be parsed, judged or counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.specs import ROUTES

PUSH_SCHEMA = (
    "object_type string, content_type string, body string, company_id string, "
    "received_at timestamp_ntz, seq bigint"
)

RECORDS = "array<struct<fields: map<string,string>, type: string>>"

_XML_OPTIONS = {"ignoreNamespace": "true", "ignoreSurroundingSpaces": "false"}

# JSON values a caller would call empty.
_EMPTY_JSON = r'^\s*(?:\[\s*\]|\{\s*\}|""|null|false|-?0(?:\.0+)?(?:[eE][+-]?\d+)?)\s*\z'


def _sobjects(body: Column, sobject: str) -> Column:
    """All ``sObject`` elements of a SOAP body, read as ``sobject``."""
    schema = f"Body struct<notifications: struct<Notification: array<struct<sObject: array<{sobject}>>>>>"
    notifications = F.from_xml(body, schema, _XML_OPTIONS)["Body"]["notifications"]["Notification"]
    return F.flatten(F.transform(notifications, lambda n: n["sObject"]))


# The functions below take and give DataFrames and name each costly parse in a
# step of its own: the optimizer keeps a step whose columns are used more than
# once, where a nested expression would be evaluated at each use.


def soap_records(df: DataFrame, body: str = "body", into: str = "records") -> DataFrame:
    """Add the records of all notifications of a SOAP body; NULL if there is none or it is malformed.

    The object type is the child element ``type``, else the ``type`` attribute
    without its prefix; a body whose records all have the child is not read a
    second time for attributes. An empty element is a null value.
    """
    kept = df.columns
    staged = df.withColumn("__fields", _sobjects(F.col(body), "map<string,string>"))
    untyped = F.exists("__fields", lambda f: ~F.map_contains_key(f, "type"))
    staged = staged.withColumn(
        "__pairs",
        F.arrays_zip(
            F.col("__fields").alias("fields"),
            F.when(untyped, _sobjects(F.col(body), "struct<_type: string>"))
            .otherwise(F.array().cast("array<struct<_type: string>>"))
            .alias("attributes"),
        ),
    )

    def record(pair: Column) -> Column:
        child = F.try_element_at(pair["fields"], F.lit("type"))
        attribute = F.substring_index(pair["attributes"]["_type"], ":", -1)
        return F.struct(
            F.transform_values(
                F.map_filter(pair["fields"], lambda k, _: k != "type"), lambda _, v: F.when(v != "", v)
            ).alias("fields"),
            F.coalesce(F.when(child != "", child), attribute).alias("type"),
        )

    found = F.when(F.size("__pairs") > 0, F.transform("__pairs", record))
    return staged.select(*kept, found.alias(into))


def json_records(df: DataFrame, body: str = "body", into: str = "records") -> DataFrame:
    """Add the records of a JSON envelope: a list, ``records``, ``data`` or one object.

    NULL unless the body is exactly one JSON value: it is parsed inside brackets,
    so that anything after the first value is an error. Nested values stay JSON
    text. A list entry that is no object gives a record without fields, a bare
    scalar no record.
    """
    kept = df.columns
    none = F.array().cast("array<variant>")
    # The first character of valid JSON tells its shape.
    shape = F.substring(F.ltrim(body, F.lit(" \t\r\n")), 1, 1)
    staged = df.withColumns({
        "__doc": F.try_parse_json(F.concat(F.lit("["), body, F.lit("]"))),
        "__shape": shape,
    })

    def items(path: str) -> Column:
        return F.coalesce(F.try_variant_get("__doc", path, "array<variant>"), none)

    def holds(key: str) -> Column:
        return F.try_variant_get("__doc", f"$[0].{key}", "variant").isNotNull()

    single = F.try_variant_get("__doc", "$[1]", "variant").isNull()
    listed = (
        F.when(F.col("__shape") == "[", items("$[0]"))
        .when(F.col("__shape") != "{", none)
        .when(holds("records"), items("$[0].records"))
        .when(holds("data"), items("$[0].data"))
        .otherwise(F.array(F.try_variant_get("__doc", "$[0]", "variant")))
    )
    staged = staged.select(
        *kept, F.when(F.col("__doc").isNotNull() & single, listed).alias("__items")
    )
    fields = F.transform("__items", lambda item: F.try_variant_get(item, "$", "map<string,string>"))
    staged = staged.select(*kept, fields.alias("__fields"))

    def record(values: Column) -> Column:
        return F.struct(
            values.alias("fields"), F.try_element_at(values, F.lit("ObjectType")).alias("type")
        )

    return staged.select(*kept, F.transform("__fields", record).alias(into))


def parse_bodies(bodies: DataFrame) -> DataFrame:
    """Parse each pushed body by its content type.

    Adds ``route``, ``object`` (NULL for an unknown route), ``is_xml``, ``status``
    and ``records``. The status is ``accepted``, ``rejected_empty``,
    ``rejected_parse``, ``unsupported_type`` or ``rejected_tenant``, judged in this
    order: body, then route, then tenant (where bodies carry ``company_id``). If the first record of a list or SOAP body names its type, the body is
    typed: then only records of the route's own object count, and the others are
    kept in ``mismatched``.
    """
    content_type = F.lower(F.coalesce("content_type", F.lit("")))
    is_xml = F.contains(content_type, F.lit("xml")) | F.contains(content_type, F.lit("soap"))
    routes = F.create_map(*[F.lit(x) for pair in ROUTES.items() for x in pair])
    route = F.lower("object_type")

    staged = bodies.withColumns({
        "route": route, "object": F.try_element_at(routes, route), "is_xml": is_xml,
    })
    # Each parser sees only its own bodies; a NULL is not parsed.
    staged = staged.withColumns({
        "__xml": F.when(F.col("is_xml") & (F.col("body") != ""), F.col("body")),
        "__json": F.when(~F.col("is_xml") & (F.col("body") != ""), F.col("body")),
    })
    staged = json_records(soap_records(staged, "__xml", "__soap_records"), "__json", "__json_records")
    staged = staged.withColumn(
        "__all", F.when(F.col("is_xml"), F.col("__soap_records")).otherwise(F.col("__json_records"))
    ).withColumn(
        "__typed",
        F.try_element_at(F.col("__all"), F.lit(1))["type"].isNotNull()
        & (F.col("is_xml") | F.startswith(F.ltrim("body", F.lit(" \t\r\n")), F.lit("["))),
    )
    empty = (F.coalesce("body", F.lit("")) == "") | F.coalesce(
        ~F.col("is_xml") & F.col("__all").isNotNull() & F.rlike("body", F.lit(_EMPTY_JSON)), F.lit(False)
    )
    staged = staged.withColumn(
        "status",
        F.when(empty, "rejected_empty")
        .when(F.col("__all").isNull(), "rejected_parse")
        .when(F.col("object").isNull(), "unsupported_type")
        .when(F.col("company_id").isNull() if "company_id" in bodies.columns else F.lit(False), "rejected_tenant")
        .otherwise("accepted"),
    )

    def own(record: Column) -> Column:
        return F.coalesce(record["type"] == F.col("object"), F.lit(False))

    accepted, none = F.col("status") == "accepted", F.array().cast(RECORDS)
    typed = F.coalesce("__typed", F.lit(False))
    return staged.select(
        *bodies.columns, "route", "object", "is_xml", "status",
        F.when(~accepted, none).when(typed, F.filter("__all", own)).otherwise(F.col("__all")).alias("records"),
        F.when(accepted & typed, F.filter("__all", lambda r: ~own(r))).otherwise(none).alias("mismatched"),
    )
