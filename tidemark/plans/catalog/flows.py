"""Whole flows over all tenants."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.operators import conform_source
from tidemark.operators.sizing import measured
from tidemark.plans.catalog.registry import Tables, companies, plain, query
from tidemark.plans.catalog.records import ALL_FIELDS, FIELD_PAIRS, VALUES_SQL, field_metadata, land_records
from tidemark.plans.catalog.standins import LATE, MID, RUN_TS, ident, sql_ident, sql_ts, ts
from tidemark.plans.replay import pending, replay
from tidemark.plans.sync import SyncRun, extract_stats, run_feed, sync, sync_report, tenant_marks, watermarks
from tidemark.plans.together import FeedSource, sync_all as run_all
from tidemark.sinks import read_ordered, shared_folder, write_ordered
from tidemark.sources import read_landed, read_records, tenant_extract
from tidemark.specs import (
    ACCOUNTS,
    ACTIVITIES,
    CALL_STAGES,
    CONTACTS,
    CUSTOM_ATTRIBUTES,
    CUSTOM_VALUES,
    HISTORY,
    OPPORTUNITIES,
    SYNC_LOG,
    USERS,
)
from tidemark.streaming import PushSink, apply_pushed, start_feed_stream


def sync_log(t: Tables, *tables: str) -> DataFrame:
    """A log with a watermark for every nation outside one region."""
    names = F.explode(F.array(*[F.lit(x) for x in tables]))
    return t.nation.filter(F.col("n_regionkey") != 2).select(
        names.alias("table_name"),
        ts(MID).alias("last_sync_time"),
        ts(MID).alias("created_at"),
        F.col("n_nationkey").cast("string").alias("CompanyId"),
    )


def tenant_marks_of(t: Tables, table: str = "opportunities") -> DataFrame:
    return tenant_marks(companies(t), sync_log(t, "opportunities"), table)


def opportunities_by_tenant(t: Tables) -> DataFrame:
    """Orders as opportunities of the tenant their customer belongs to."""
    owners = t.customer.select("c_custkey", F.col("c_nationkey").cast("string").alias("CompanyId"))
    return t.orders.join(owners, F.col("o_custkey") == F.col("c_custkey")).select(
        ident("006", "o_orderkey").alias("Id"),
        "CompanyId",
        F.col("o_orderpriority").alias("StageName"),
        F.col("o_totalprice").alias("Amount"),
        F.col("o_orderdate").alias("LastModifiedDate"),
    )


def accounts_by_tenant(t: Tables) -> DataFrame:
    return t.customer.select(
        ident("001", "c_custkey").alias("Id"), F.col("c_name").alias("Name"),
        F.col("c_nationkey").cast("string").alias("CompanyId"), ts(LATE).alias("LastModifiedDate"),
    )


def users_by_tenant(t: Tables) -> DataFrame:
    return t.supplier.select(
        ident("005", "s_suppkey").alias("Id"), F.col("s_name").alias("Name"),
        F.col("s_nationkey").cast("string").alias("CompanyId"), ts(LATE).alias("LastModifiedDate"),
    )


_MARKS = f"SELECT n_nationkey, CASE WHEN n_regionkey <> 2 THEN {sql_ts(MID)} END AS last_sync FROM nation"
_READ_ORDERS = f"""
SELECT o.*, c_nationkey FROM orders o JOIN customer ON o_custkey = c_custkey JOIN ({_MARKS}) ON c_nationkey = n_nationkey
WHERE last_sync IS NULL OR o_orderdate > last_sync
"""


def _reports(t: Tables) -> DataFrame:
    log = sync_log(t, "opportunities")
    out = None
    for spec, feed in (
        (ACCOUNTS, accounts_by_tenant(t)), (OPPORTUNITIES, opportunities_by_tenant(t)), (USERS, users_by_tenant(t))
    ):
        marks = tenant_marks(companies(t), log, spec.log_key)
        stats = extract_stats(tenant_extract(feed, spec.ts_col, marks), spec.ts_col)
        part = sync_report(spec.name, stats, marks)
        out = part if out is None else out.unionByName(part)
    return out


_COUNTS = f"""
SELECT 'accounts' AS feed, n_nationkey AS tenant, CAST(NULL AS TIMESTAMP) AS last_sync,
       (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey) AS n FROM nation
UNION ALL SELECT 'opportunities', m.n_nationkey, last_sync, count(r.o_orderkey)
  FROM ({_MARKS}) m LEFT JOIN ({_READ_ORDERS}) r ON r.c_nationkey = m.n_nationkey GROUP BY m.n_nationkey, last_sync
UNION ALL SELECT 'users', n_nationkey, NULL, (SELECT count(*) FROM supplier WHERE s_nationkey = n_nationkey) FROM nation
"""


@query(f'SELECT feed, CAST(tenant AS VARCHAR) AS "CompanyId", n AS records_processed FROM ({_COUNTS})')
def tenant_sync_counts(t: Tables) -> DataFrame:
    """What each feed reads for each tenant, in one job per feed."""
    return _reports(t).select("feed", "CompanyId", "records_processed")


@query(
    f"""
SELECT coalesce(feed, 'total') AS feed, coalesce(sync_type, 'all') AS sync_type, n_tenants, records_processed, last_sync
FROM (SELECT feed, CASE WHEN last_sync IS NULL THEN 'full' ELSE 'incremental' END AS sync_type, count(*) AS n_tenants,
             sum(n) AS records_processed, max(strftime(last_sync, '%Y-%m-%dT%H:%M:%S')) AS last_sync
      FROM ({_COUNTS}) GROUP BY ROLLUP (feed, sync_type))
""",
    name="sync_report",
)
def report_with_totals(t: Tables) -> DataFrame:
    """Rows read per feed and sync type, with totals."""
    totals = _reports(t).rollup("feed", "sync_type").agg(
        F.count(F.lit(1)).alias("n_tenants"),
        F.sum("records_processed").alias("records_processed"),
        F.max("last_sync").alias("last_sync"),
    )
    return totals.select(
        F.coalesce("feed", F.lit("total")).alias("feed"),
        F.coalesce("sync_type", F.lit("all")).alias("sync_type"),
        "n_tenants", "records_processed", "last_sync",
    )


_BEFORE = {"StageName": "o_orderstatus", "Amount": "0.0"}


def opportunities_before(t: Tables) -> DataFrame:
    """The table before the run: orders up to a date, with other values."""
    feed = opportunities_by_tenant(t).filter(F.col("LastModifiedDate") <= ts(LATE))
    old = feed.withColumns({"StageName": F.lit("Old"), "Amount": F.lit(0.0)})
    return conform_source(old, OPPORTUNITIES.with_tenant())


END_TO_END_SQL = f"""
WITH b AS (SELECT o_orderkey, c_nationkey, o_orderdate FROM orders JOIN customer ON o_custkey = c_custkey
           WHERE o_orderdate <= {sql_ts(LATE)}),
r AS ({_READ_ORDERS}),
w AS (SELECT c_nationkey AS k, max(o_orderdate) AS newest, count(*) AS n FROM r GROUP BY ALL)
SELECT {sql_ident('006', 'coalesce(r.o_orderkey, b.o_orderkey)')} AS id,
       CAST(coalesce(r.c_nationkey, b.c_nationkey) AS VARCHAR) AS "CompanyId",
       CASE WHEN r.o_orderkey IS NULL THEN 'Old' ELSE r.o_orderpriority END AS stage,
       CASE WHEN r.o_orderkey IS NULL THEN 0.0 ELSE r.o_totalprice END AS amount,
       coalesce(r.o_orderdate, b.o_orderdate) AS modified,
       w.newest AS watermark, CASE WHEN n_regionkey <> 2 THEN 'incremental' ELSE 'full' END AS sync_type,
       w.n AS records_processed
FROM b FULL JOIN r ON b.o_orderkey = r.o_orderkey
JOIN w ON w.k = coalesce(r.c_nationkey, b.c_nationkey) JOIN nation ON n_nationkey = w.k
"""


def _with_outcome(table: DataFrame, log: DataFrame, report: DataFrame) -> DataFrame:
    """The table's rows with their tenant's new watermark and report."""
    marks = watermarks(log, OPPORTUNITIES.log_key).withColumnRenamed("last_sync", "watermark")
    counts = report.select("CompanyId", "sync_type", "records_processed")
    rows = table.select(
        F.col(OPPORTUNITIES.keys[0]).alias("id"), "CompanyId", F.col("StageName").alias("stage"),
        F.col("Amount").alias("amount"), F.col("LastModifiedDate").alias("modified"),
    )
    # Measured, so that the table is not shuffled by tenant for it.
    return plain(rows.join(measured(marks.join(counts, "CompanyId")), "CompanyId"))


@query(END_TO_END_SQL)
def sync_end_to_end(t: Tables) -> DataFrame:
    """One run for all tenants: extract after each watermark, upsert, new watermarks, report."""
    spec = OPPORTUNITIES.with_tenant()
    done = sync(
        spec, opportunities_by_tenant(t), opportunities_before(t), sync_log(t, spec.log_key), companies(t),
        run_ts=RUN_TS,
    )
    return _with_outcome(done.target, done.sync_log, done.report)


@query(END_TO_END_SQL)
def sync_stored(t: Tables) -> DataFrame:
    """The same run against stored tables, read back."""
    spec = OPPORTUNITIES.with_tenant()
    run = SyncRun(t.spark, shared_folder(t.spark, "sync"), buckets=16)
    run.table(spec).overwrite(opportunities_before(t))
    run.table(SYNC_LOG).overwrite(sync_log(t, spec.log_key))
    report = run_feed(run, spec, opportunities_by_tenant(t), companies(t), run_ts=RUN_TS)
    return _with_outcome(run.table(spec).read(), run.table(SYNC_LOG).read(), report)


# Nothing read is lost: a landed feed with times that do not parse, missing and unknown tenants, broken lines and values
# that do not fit. Every order is one line of it.

_FATE = """CASE WHEN o_orderkey % 11 = 0 THEN 'corrupt' WHEN o_orderkey % 13 = 0 THEN 'bad_LastModifiedDate'
     WHEN o_orderkey % 17 = 0 THEN 'missing_tenant' WHEN o_orderkey % 19 = 0 THEN 'unknown_tenant'
     WHEN o_orderkey % 23 = 0 THEN 'bad_Amount' ELSE 'stored' END"""


@query(
    f"""
SELECT fate, count(*) AS n_rows FROM (SELECT {_FATE} AS fate FROM orders) GROUP BY fate
"""
)
def feed_quarantine(t: Tables) -> DataFrame:
    """What becomes of each line of a landed feed: stored, or set apart with its reason."""
    root = shared_folder(t.spark, "feed-quarantine")
    fate = F.expr(_FATE)
    line = F.to_json(F.struct(
        ident("006", "o_orderkey").alias("Id"),
        F.when(fate == "missing_tenant", None).when(fate == "unknown_tenant", "nobody").otherwise((F.col("o_custkey") % 25).cast("string")).alias("CompanyId"),
        F.when(fate == "bad_Amount", "n/a").otherwise(F.col("o_totalprice").cast("string")).alias("Amount"),
        F.when(fate == "bad_LastModifiedDate", "2024-01-01 00:00:00").otherwise("2024-01-01T00:00:00Z").alias("LastModifiedDate"),
    ))
    t.orders.select(F.when(fate == "corrupt", F.concat(F.lit("{"), line)).otherwise(line).alias("value")).write.text(f"{root}/landed")
    run = SyncRun(t.spark, f"{root}/tables", buckets=8)
    landed = read_landed(t.spark, f"{root}/landed", OPPORTUNITIES, "json")
    run_feed(run, OPPORTUNITIES, landed, companies(t), run_ts=RUN_TS)
    bad = t.spark.read.schema("reasons array<string>, row string").json(run.quarantine(OPPORTUNITIES.name))
    reason = F.when(F.array_contains("reasons", "corrupt"), "corrupt").otherwise(F.element_at("reasons", 1))
    fates = bad.select(reason.alias("fate")).unionByName(run.table(OPPORTUNITIES).read().select(F.lit("stored").alias("fate")))
    return fates.groupBy("fate").agg(F.count("*").alias("n_rows"))


def _broken_lines(t: Tables, folder: str) -> None:
    """Every order as a landed line, some of them broken as ``_FATE`` says."""
    fate = F.expr(_FATE)
    line = F.to_json(F.struct(
        ident("006", "o_orderkey").alias("Id"),
        F.when(fate == "missing_tenant", None).when(fate == "unknown_tenant", "nobody").otherwise((F.col("o_custkey") % 25).cast("string")).alias("CompanyId"),
        F.concat(F.when(fate == "bad_Amount", "about ").otherwise(""), F.col("o_totalprice").cast("string")).alias("Amount"),
        F.when(fate == "bad_LastModifiedDate", "2024-01-01 00:00:00").otherwise("2024-01-01T00:00:00Z").alias("LastModifiedDate"),
        F.struct(F.col("o_clerk").alias("Name")).alias("Owner"),
    ))
    t.orders.withColumn("o_clerk", F.col("o_orderpriority")).select(
        F.when(fate == "corrupt", F.concat(line, F.lit("]"))).otherwise(line).alias("value")
    ).write.text(folder)


def repaired(rows: DataFrame) -> DataFrame:
    """What an operator would do to the broken orders: cut lines, amounts, times, and tenants looked up elsewhere."""
    line = F.from_json(F.regexp_replace("_corrupt_record", r"\]$", ""), "Id string, CompanyId string, Amount string, LastModifiedDate string, Owner struct<Name: string, Email: string>")
    rows = rows.withColumn("line", line)
    rows = rows.withColumns({c: F.coalesce(F.col(f"line.{c}"), F.col(c)) for c in ("Id", "CompanyId", "Amount", "LastModifiedDate", "Owner")})
    return rows.withColumns({
        "_corrupt_record": F.lit(None).cast("string"),
        "Amount": F.regexp_replace("Amount", "^about ", ""),
        "LastModifiedDate": F.translate("LastModifiedDate", " ", "T"),
        "CompanyId": F.coalesce("CompanyId", F.lit("0")),
    }).drop("line")


@query(
    f"""
SELECT CASE WHEN o_orderkey % 11 = 0 OR o_orderkey % 13 = 0 OR ({_FATE}) NOT IN ('missing_tenant', 'unknown_tenant') THEN CAST(o_custkey % 25 AS VARCHAR)
            WHEN ({_FATE}) = 'missing_tenant' THEN '0' ELSE 'nobody' END AS "CompanyId",
       {sql_ident('006', 'o_orderkey')} AS id, o_totalprice AS amount, o_orderpriority AS owner,
       0 AS left_pending, 0 AS stored_again, 1 AS n_rows
FROM orders
"""
)
def quarantine_replay(t: Tables) -> DataFrame:
    """A feed with broken lines; the quarantine repaired and replayed, twice: every order stored once, nothing left."""
    root, spec = shared_folder(t.spark, "quarantine-replay"), OPPORTUNITIES
    _broken_lines(t, f"{root}/landed")
    run = SyncRun(t.spark, f"{root}/tables", buckets=8)
    run_feed(run, spec, read_landed(t.spark, f"{root}/landed", spec, "json"), companies(t), run_ts=RUN_TS)
    known = companies(t).unionByName(t.spark.createDataFrame([("nobody",)], "Id string"))
    replay(run, spec, known, run_ts=RUN_TS, repair=repaired)
    again = replay(run, spec, known, run_ts=LATE, repair=repaired)
    left, twice = pending(run, spec.name).count(), again.agg(F.coalesce(F.sum("stored"), F.lit(0))).first()[0]
    rows = run.table(spec).read().groupBy("CompanyId", F.col("SalesforceId").alias("id")).agg(
        F.max("Amount").alias("amount"), F.max("OwnerName").alias("owner"), F.count("*").alias("n_rows")
    )
    return plain(rows.withColumns({"left_pending": F.lit(left), "stored_again": F.lit(twice)}))


@query(
    f"""
WITH r AS (SELECT l_orderkey, max(l_shipdate) AS modified FROM lineitem GROUP BY ALL)
SELECT CAST(l_orderkey % 25 AS VARCHAR) AS "CompanyId", {sql_ident('006', 'l_orderkey')} AS id, modified, max(modified) OVER (PARTITION BY l_orderkey % 25) AS watermark
FROM r
"""
)
def stream_feed(t: Tables) -> DataFrame:
    """A feed that lands three times, out of order; a run after each landing. Equal to one run over all lines."""
    root, spec = shared_folder(t.spark, "stream-feed"), OPPORTUNITIES
    run = SyncRun(t.spark, f"{root}/tables", buckets=8)
    line = F.to_json(F.struct(
        ident("006", "l_orderkey").alias("Id"), (F.col("l_orderkey") % 25).cast("string").alias("CompanyId"),
        F.col("l_returnflag").alias("StageName"), F.concat(F.translate(F.col("l_shipdate").cast("string"), " ", "T"), F.lit("Z")).alias("LastModifiedDate"),
    ))
    for landing in (2, 0, 1):
        # A landing is a bounded number of files, as a batch is: with files of fixed size a run would take more batches the
        # larger the feed is, each of them over a table that is larger too.
        t.lineitem.where(F.col("l_linenumber") % 3 == landing).select(line.alias("value")).coalesce(12).write.mode("append").text(f"{root}/landed")
        rows = read_landed(t.spark, f"{root}/landed", spec, "json", stream=True, maxFilesPerTrigger="4")
        start_feed_stream(run, spec, rows, lambda: companies(t), f"{root}/checkpoint", writer="hourly", run_ts=RUN_TS).awaitTermination()
    marks = watermarks(run.table(SYNC_LOG).read(), spec.log_key).select("CompanyId", F.col("last_sync").alias("watermark"))
    table = run.table(spec).read().select("CompanyId", F.col("SalesforceId").alias("id"), F.col("LastModifiedDate").alias("modified"))
    return table.join(marks, "CompanyId", "left")


@query(
    f"""
WITH a AS (SELECT c_custkey AS k, c_nationkey AS tenant, c_name AS name FROM customer),
p AS (SELECT s_suppkey AS k, s_nationkey AS tenant, s_name AS name FROM supplier)
SELECT CAST(coalesce(p.tenant, a.tenant) AS VARCHAR) AS "CompanyId", '001' || CAST(coalesce(p.k, a.k) AS VARCHAR) AS id,
       coalesce(p.name, a.name) AS name, w.pulled
FROM a FULL JOIN p ON a.k = p.k AND a.tenant = p.tenant
LEFT JOIN (SELECT DISTINCT tenant, {sql_ts(LATE)} AS pulled FROM a) w ON w.tenant = coalesce(p.tenant, a.tenant)
"""
)
def stream_after_batch(t: Tables) -> DataFrame:
    """A pull of accounts, then pushes of suppliers on the same tables: tenants stay apart, the pull's watermark stays."""
    run = SyncRun(t.spark, shared_folder(t.spark, "stream-after-batch"), buckets=8)
    run_feed(run, ACCOUNTS, accounts_by_tenant(t), companies(t), run_ts=RUN_TS)
    body = F.to_json(F.struct(ident("001", "s_suppkey").alias("Id"), F.col("s_name").alias("Name")))
    pushed = t.supplier.select(
        F.lit("accounts").alias("object_type"), F.lit("application/json").alias("content_type"), body.alias("body"),
        F.col("s_nationkey").cast("string").alias("company_id"), ts(RUN_TS).alias("received_at"), F.col("s_suppkey").alias("seq"),
    )
    apply_pushed(PushSink(run, "pushed", run_ts=RUN_TS), pushed, 0)
    marks = watermarks(run.table(SYNC_LOG).read(), ACCOUNTS.log_key).select("CompanyId", F.col("last_sync").alias("pulled"))
    rows = run.table(ACCOUNTS).read().select("CompanyId", F.col(ACCOUNTS.keys[0]).alias("id"), F.col("Name").alias("name"))
    return rows.join(marks, "CompanyId", "left")


_ALL = {
    "accounts": "SELECT c_nationkey AS tenant FROM customer",
    "opportunities": "SELECT c_nationkey FROM orders JOIN customer ON o_custkey = c_custkey",
    ACTIVITIES.name: "SELECT c_nationkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey",
    HISTORY.name: "SELECT c_nationkey FROM orders JOIN customer ON o_custkey = c_custkey",
    USERS.name: "SELECT s_nationkey FROM supplier",
    CALL_STAGES.name: "SELECT p_partkey % 25 FROM part",
}
_ALL_SQL = " UNION ALL ".join(f"SELECT '{name}' AS feed, tenant FROM ({sql}) AS f(tenant)" for name, sql in _ALL.items())


@query(
    f"""
WITH feeds AS ({' UNION ALL '.join(f"SELECT '{name}' AS feed" for name in _ALL)}), rows_read AS ({_ALL_SQL})
SELECT f.feed, CAST(n_nationkey AS VARCHAR) AS "CompanyId", 'full' AS sync_type, count(r.tenant) AS records_processed, 'true' AS success
FROM feeds f CROSS JOIN nation LEFT JOIN rows_read r ON r.feed = f.feed AND r.tenant = n_nationkey GROUP BY ALL
UNION ALL SELECT 'contacts', NULL, NULL, 0, 'false'
"""
)
def sync_all(t: Tables) -> DataFrame:
    """All feeds of all tenants in one run; one feed fails and is reported, the others go on."""
    run = SyncRun(t.spark, shared_folder(t.spark, "sync-all"), buckets=8)
    orders = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    tenant, late = F.col("c_nationkey").cast("string").alias("CompanyId"), ts(LATE).alias("LastModifiedDate")
    whole = F.struct(*t.lineitem.columns).alias("line")
    lines = t.lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        ident("00T", "l_orderkey", "l_linenumber").alias("Id"), ident("006", "l_orderkey").alias("WhatId"), tenant,
        F.col("l_returnflag").alias("Status"), F.col("l_shipdate").alias("LastModifiedDate"), whole,
    )
    history = orders.select(
        ident("008", "o_orderkey").alias("Id"), ident("006", "o_orderkey").alias("OpportunityId"), tenant,
        F.col("o_orderdate").alias(HISTORY.ts_col),
    )
    broken = accounts_by_tenant(t).select("Id", "CompanyId", "LastModifiedDate", F.raise_error(F.lit("the feed is gone")).cast("string").alias("LastName"))
    stages = t.part.select(
        ident("01J", "p_partkey").alias("Id"), F.col("p_name").alias("MasterLabel"), (F.col("p_partkey") % 25).cast("string").alias("CompanyId"), late,
    )
    feeds = [
        FeedSource(ACCOUNTS, accounts_by_tenant(t)), FeedSource(OPPORTUNITIES, opportunities_by_tenant(t)), FeedSource(CONTACTS, broken),
        FeedSource(ACTIVITIES, lines, related=OPPORTUNITIES.name, seq=("line",)), FeedSource(HISTORY, history),
        FeedSource(USERS, users_by_tenant(t)), FeedSource(CALL_STAGES, stages),
    ]
    report = run_all(run, feeds, companies(t), run_ts=RUN_TS)
    return report.select("feed", "CompanyId", "sync_type", "records_processed", F.col("success").cast("string").alias("success"))


_ORDER_KEY = "CompanyId, LastModifiedDate, Id"


@query(
    f"""
SELECT {sql_ident('006', 'o_orderkey')} AS "Id", o_orderdate AS "LastModifiedDate",
       row_number() OVER (ORDER BY CAST(c_nationkey AS VARCHAR), o_orderdate, {sql_ident('006', 'o_orderkey')}) - 1 AS position
FROM orders JOIN customer ON o_custkey = c_custkey
"""
)
def ordered_extract(t: Tables) -> DataFrame:
    """A full extract in order of tenant and time, written as consecutive ranges and read back by position, without a sort."""
    path = shared_folder(t.spark, "ordered-extract")
    write_ordered(opportunities_by_tenant(t), path, _ORDER_KEY.split(", "))
    return read_ordered(t.spark, path).select("Id", "LastModifiedDate", "position")


@query(
    f"""
SELECT {sql_ident('006', 'o_orderkey')} AS "Id", row_number() OVER (ORDER BY CAST(c_nationkey AS VARCHAR), o_orderdate, {sql_ident('006', 'o_orderkey')}) - 1 AS position
FROM orders JOIN customer ON o_custkey = c_custkey QUALIFY c_nationkey = 7
"""
)
def ordered_range(t: Tables) -> DataFrame:
    """One tenant of the same extract: only the files whose ranges can hold it are opened."""
    path = shared_folder(t.spark, "ordered-range")
    write_ordered(opportunities_by_tenant(t), path, _ORDER_KEY.split(", "))
    return read_ordered(t.spark, path, {"CompanyId": "7"}, {"CompanyId": "7"}).select("Id", "position")


@query(
    f"""
WITH a AS (SELECT o_orderkey, CASE WHEN o_orderdate <= {sql_ts(LATE)} THEN 1 END AS old FROM orders),
b AS (SELECT o_orderkey, CASE WHEN o_orderdate > {sql_ts(MID)} THEN 1 END AS new FROM orders)
SELECT 1 AS version, -1 AS inserted, -1 AS updated
UNION ALL SELECT 2, count(*) FILTER (old IS NULL), count(*) FILTER (old IS NOT NULL) FROM a JOIN b USING (o_orderkey) WHERE new IS NOT NULL
UNION ALL SELECT 3, 0, count(*) FROM a
"""
)
def stored_actions(t: Tables) -> DataFrame:
    """Rows inserted and updated by each write of a stored table, counted by the writes; a version that was no merge has none."""
    spec = OPPORTUNITIES.with_tenant()
    table = SyncRun(t.spark, shared_folder(t.spark, "stored-actions"), buckets=8).table(OPPORTUNITIES)
    feed = conform_source(opportunities_by_tenant(t), spec)
    table.overwrite(feed.where(F.col("LastModifiedDate") <= ts(LATE)))
    table.upsert(feed.where(F.col("LastModifiedDate") > ts(MID)))
    table.upsert(feed)
    return table.actions().fillna(-1)


_EVERYTHING = {
    "accounts": ("'001' || CAST(c_custkey AS VARCHAR)", "c_nationkey", "c_name", "customer"),
    "contacts": ("'003' || CAST(c_custkey AS VARCHAR)", "c_nationkey", "c_mktsegment", "customer"),
    "opportunities": ("'006' || CAST(o_orderkey AS VARCHAR)", "c_nationkey", "o_orderpriority", "orders JOIN customer ON o_custkey = c_custkey"),
    HISTORY.name: ("'008' || CAST(o_orderkey AS VARCHAR)", "c_nationkey", "o_orderstatus", "orders JOIN customer ON o_custkey = c_custkey"),
    CALL_STAGES.name: ("'01J' || CAST(p_partkey AS VARCHAR)", "p_partkey % 25", "p_name", "part"),
}
_EVERYTHING_SQL = " UNION ALL ".join(
    f"SELECT '{feed}' AS feed, CAST({tenant} AS VARCHAR) AS \"CompanyId\", {key} AS id, {label} AS label FROM {source}"
    for feed, (key, tenant, label, source) in _EVERYTHING.items()
)


@query(
    f"""
{_EVERYTHING_SQL}
UNION ALL SELECT '{ACTIVITIES.name}', CAST(any_value(c_nationkey) AS VARCHAR), '00T' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR), '006' || CAST(l_orderkey AS VARCHAR)
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey GROUP BY l_orderkey, l_linenumber
UNION ALL SELECT 'custom_values', "CompanyId", "ObjectType" || '/' || "ExternalId" || '/' || "Name", value FROM ({VALUES_SQL})
UNION ALL SELECT 'custom_attributes', CAST(n_nationkey AS VARCHAR), o || '/' || a, 'Text' FROM nation CROSS JOIN (VALUES {FIELD_PAIRS}) f(o, a)
UNION ALL SELECT 'failed', NULL, '{USERS.name}', 'the feed is gone'
"""
)
def sync_everything(t: Tables) -> DataFrame:
    """All eight feeds of all tenants in one run, custom fields of four objects among them: the rows of every table. One feed fails."""
    root = shared_folder(t.spark, "sync-everything")
    run = SyncRun(t.spark, f"{root}/tables", buckets=8)
    orders = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    tenant, late = F.col("c_nationkey").cast("string").alias("CompanyId"), ts(LATE).alias("LastModifiedDate")
    lines = t.lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        ident("00T", "l_orderkey", "l_linenumber").alias("Id"), ident("006", "l_orderkey").alias("WhatId"), tenant, F.col("l_shipdate").alias("LastModifiedDate"),
    )
    history = orders.select(
        ident("008", "o_orderkey").alias("Id"), F.col("o_orderstatus").alias("StageName"), tenant, F.col("o_orderdate").alias(HISTORY.ts_col)
    )
    contacts = t.customer.select(ident("003", "c_custkey").alias("Id"), F.col("c_mktsegment").alias("LastName"), tenant, late)
    broken = users_by_tenant(t).withColumn("Name", F.raise_error(F.lit("the feed is gone")).cast("string"))
    stages = t.part.select(
        ident("01J", "p_partkey").alias("Id"), F.col("p_name").alias("MasterLabel"), (F.col("p_partkey") % 25).cast("string").alias("CompanyId"), late,
    )
    feeds = [
        FeedSource(ACCOUNTS, accounts_by_tenant(t)), FeedSource(OPPORTUNITIES, opportunities_by_tenant(t)), FeedSource(CONTACTS, contacts),
        FeedSource(ACTIVITIES, lines, related=OPPORTUNITIES.name), FeedSource(HISTORY, history), FeedSource(USERS, broken),
        FeedSource(CALL_STAGES, stages),
    ]
    land_records(t, f"{root}/records")
    custom = (field_metadata(t, ALL_FIELDS), read_records(t.spark, f"{root}/records", "LastModifiedDate"))
    report = run_all(run, feeds, companies(t), run_ts=RUN_TS, custom=custom)
    labels = [
        (ACCOUNTS, "Name"), (CONTACTS, "LastName"), (OPPORTUNITIES, "StageName"), (HISTORY, "StageName"), (CALL_STAGES, "CallStage"),
        (ACTIVITIES, "WhatId"), (USERS, "Name"),
    ]
    out = report.where("NOT success").select(
        F.lit("failed").alias("feed"), "CompanyId", F.col("feed").alias("id"), F.regexp_extract("error", "the feed is gone", 0).alias("label")
    )
    for spec, label in labels:
        out = out.unionByName(run.table(spec).read().select(F.lit(spec.name).alias("feed"), "CompanyId", F.col(spec.keys[0]).alias("id"), F.col(label).alias("label")))
    values = run.table(CUSTOM_VALUES).read().select(
        F.lit("custom_values").alias("feed"), "CompanyId", F.concat_ws("/", "ObjectType", "ExternalId", "Name").alias("id"), F.col("Value").alias("label")
    )
    attributes = run.table(CUSTOM_ATTRIBUTES).read().select(
        F.lit("custom_attributes").alias("feed"), "CompanyId", F.concat_ws("/", "ObjectType", "Name").alias("id"), F.col("DataType").alias("label")
    )
    return out.unionByName(values).unionByName(attributes)
