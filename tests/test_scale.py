"""Plans: what reaches the scan, what is shuffled, and what happens to hot keys."""

import re
import time
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import (
    collapse,
    conform_payload,
    conform_source,
    custom_value_rows,
    enrich_owner,
    latest_with_fallback,
    merge,
    nest_values,
    route_records,
    split_valid,
    type_rules,
    unnest_values,
)
from tidemark.operators.merge import APART
from tidemark.plans.catalog.registry import Tables
from tidemark.plans.catalog.standins import opportunity_feed
from tidemark.sources import incremental_extract, only_referencing, parse_bodies
from tidemark.plans.catalog.pushes import event_bodies
from tidemark.specs import OPPORTUNITIES

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture
def conf(spark):
    """Set options for one test."""
    before = {}

    def put(**options):
        for name, value in options.items():
            key = name.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield put
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_watermark_and_columns_reach_the_scan(spark):
    df = incremental_extract(opportunity_feed(Tables(spark, SF_DIR)), OPPORTUNITIES, datetime(1998, 1, 1, 0, 0, 0, 999))
    text = plan(df.select("Id", "Amount"))
    assert "GreaterThan(o_orderdate,1998-01-01T00:00" in text
    read = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert {c.split(":")[0] for c in read.split(",")} == {"o_orderkey", "o_totalprice", "o_orderdate"}


def test_merge_shuffles_each_side_once(spark):
    t = Tables(spark, SF_DIR)
    key = ["l_orderkey", "l_linenumber"]
    target = t.lineitem.dropDuplicates(key).select(*key, "l_extendedprice")
    source = t.lineitem.withColumn("n", F.col("l_partkey"))
    text = plan(merge(target, source, key, seq=["n", "l_suppkey"], null_keys=False))
    assert text.count("Exchange") == 2  # the collapsed batch is not shuffled again
    assert "FullOuter" in text and "CartesianProduct" not in text and "BroadcastNestedLoop" not in text


def test_collapse_combines_before_the_shuffle(spark):
    hot = spark.range(0, 40_000, 1, 8).select(F.when(F.col("id") >= 0, "hot").alias("k"), F.col("id").alias("n"), F.lit("v").alias("v"))
    last = collapse(hot, ["k"], ["n"], last=["v", "n"])
    both = collapse(hot, ["k"], ["n"], last=["n"], first=["v"])
    # In a plan text the lower line runs first.
    assert plan(last).rindex("WindowGroupLimit") > plan(last).index("Exchange")
    assert plan(both).index("partial_max_by") > plan(both).index("Exchange")
    assert last.first().n == both.first().n == 39_999


def test_rows_without_key_are_spread(spark):
    """A third of the batch has no key; the join key of those rows differs."""
    source = spark.range(30_000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("k"), F.col("id").alias("v"))
    target = spark.range(0).select(F.col("id").alias("k"), F.col("id").alias("v"))
    merged = merge(target, source, ["k"], seq=["v"])
    assert merged.count() == 30_000
    assert merged.filter("k is null").count() == 10_000
    sizes = Counter(r.p for r in merged.filter("k is null").select(F.spark_partition_id().alias("p")).collect())
    assert APART in plan(merged)
    assert len(sizes) > 1 or spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled") == "true"


def test_hot_owner_is_split(spark, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
    )
    records = spark.range(0, 200_000, 1, 8).select(
        F.col("id").cast("string").alias("Id"), F.when(F.col("id") % 3 == 0, "u1").otherwise(F.concat(F.lit("u"), "id")).alias("OwnerId")
    )
    users = spark.range(1000).select(
        F.concat(F.lit("u"), "id").alias("Id"), F.lit("n").alias("Name"), F.lit("e").alias("Email")
    )
    for df in (enrich_owner(records, users), only_referencing(records, "OwnerId", users, "Id")):
        df.write.format("noop").mode("overwrite").save()
        executed = df._jdf.queryExecution()
        df.collect()
        assert "skew=true" in executed.executedPlan().toString()


def test_latest_row_combines_before_the_shuffle(spark):
    rows = spark.range(0, 10_000, 1, 8).select(
        F.when(F.col("id") >= 0, "hot").alias("CompanyId"), F.col("id").alias("Id"), F.lit(2).alias("ProviderName"),
        F.lit(2).alias("ServiceType"), F.lit(0).alias("IsDeleted"),
        F.when(F.col("id") < 9_000, F.lit("2024-01-01").cast("timestamp_ntz")).alias("ModifiedAt"),
    )
    df = latest_with_fallback(rows)
    assert plan(df).rindex("WindowGroupLimit") > plan(df).index("Exchange")
    assert df.first().Id == 8_999  # no time counts as oldest


def test_lists_have_a_bounded_size_and_lose_nothing(spark):
    values = spark.range(20_000).select(
        F.lit("Account").alias("Object"), F.lit("A__c").alias("Name"), F.col("id").cast("string").alias("record_id"),
        F.col("id").cast("string").alias("value"),
    )
    nested = nest_values(values, list_size=1000).persist()
    sizes = [r.n for r in nested.select(F.size("FieldValues").alias("n")).collect()]
    assert len(sizes) == 20 and max(sizes) < 1300
    assert unnest_values(nested).exceptAll(values).count() == 0
    assert values.exceptAll(unnest_values(nested)).count() == 0


def test_value_rows_broadcast_measured_metadata_only_below_the_threshold(spark, conf):
    values = spark.range(1000).select(
        F.lit("Account").alias("Object"), F.concat(F.lit("A__c"), F.col("id") % 3).alias("Name"),
        F.col("id").cast("string").alias("record_id"), F.lit("x").alias("value"),
    )
    metadata = values.select("Object", "Name").distinct().select(
        "*", F.lit("Text").alias("DataType"), F.lit("2024-01-01").alias("CreatedAt"), F.lit("2024-01-01").alias("UpdatedAt")
    )
    assert "BroadcastHashJoin" in plan(custom_value_rows(values, metadata))
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    text = plan(custom_value_rows(values, metadata))
    assert "BroadcastHashJoin" not in text and "SortMergeJoin" in text


def test_bodies_are_parsed_once(spark):
    records = route_records(parse_bodies(event_bodies(Tables(spark, SF_DIR).events)), "seq")
    text = optimized(records)
    assert text.count("parseJson") + text.count("parse_json") <= 2  # once named, at most once more in its argument
    assert text.count("from_xml") <= 2  # text and attributes
    assert "Exchange" not in plan(records)


def test_no_python_in_plans(spark):
    import __spark_entry__ as entry

    for name in ("upsert_full", "payload_dispatch", "safe_parse_date", "custom_field_nested", "sync_end_to_end"):
        text = plan(entry.queries()[name](spark, SF_DIR))
        assert "Python" not in text and "CartesianProduct" not in text, name


def test_text_feeds_of_wide_tables_are_planned_quickly(spark):
    """Validity rules must not multiply in the optimizer."""
    columns = {OPPORTUNITIES.source_of(c).split(".")[0] for c in OPPORTUNITIES.columns}
    feed = spark.range(10).select(*[F.col("id").cast("string").alias(c) for c in sorted(columns)])
    record = spark.range(10).select(F.create_map(F.lit("Id"), F.col("id").cast("string")).alias("fields"), "id")
    good, _ = split_valid(feed, type_rules(feed, OPPORTUNITIES))
    pushed, _ = split_valid(record, type_rules(record, OPPORTUNITIES, "fields"))
    start = time.time()
    for rows in (conform_source(good, OPPORTUNITIES), conform_payload(pushed, OPPORTUNITIES)):
        plan(collapse(rows, OPPORTUNITIES.keys, ["Name"], last=OPPORTUNITIES.update_columns))
    assert time.time() - start < 20


def test_fixed_batches_are_not_packed_and_wide_rows_compile(spark, tmp_path, monkeypatch):
    from pyspark.sql import DataFrame

    from tidemark.operators.conform import reasons_of
    from tidemark.sinks import VersionedTable
    from tidemark.specs import OPPORTUNITIES

    spark.conf.unset("spark.sql.codegen.hugeMethodLimit")
    kept = []
    monkeypatch.setattr(type(spark.range(0)), "persist", lambda self, *a: kept.append(1) or self)
    table = VersionedTable(spark, f"{tmp_path}/t", OPPORTUNITIES, 2)
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000" and issubclass(type(spark.range(0)), DataFrame)
    rows = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), (None, "z", 3)], "SalesforceId string, Name string, n int")
    table.upsert(rows, seq=["n"], fixed=True)
    assert not kept and [(r.SalesforceId, r.Name) for r in table.read().collect()] == [("a", "y")] and table.keyless().count() == 1
    tests = {"none": F.lit(None).cast("boolean"), "one": F.col("n") == 1, "odd": F.col("n") % 2 == 1}
    assert {r.n: r.reasons for r in rows.select("n", reasons_of(tests).alias("reasons")).collect()} == {1: ["one", "odd"], 2: [], 3: ["odd"]}


def test_pushed_bodies_are_staged_and_not_kept_in_memory(spark, tmp_path, monkeypatch):
    import json
    import os

    from tidemark.plans.sync import SyncRun
    from tidemark.specs import ACCOUNTS
    from tidemark.streaming import PushSink, apply, apply_pushed

    kept, stages = [], []
    monkeypatch.setattr(type(spark.range(0)), "persist", lambda self, *a: kept.append(self.columns) or self)
    monkeypatch.setattr(apply, "staged", raising=False, value=lambda *a, f=getattr(apply, "staged", None), **b: (df := f(*a, **b), stages.append((df.columns, df.collect(), df.inputFiles())))[0])
    sink = PushSink(SyncRun(spark, str(tmp_path), 2), "push", run_ts=datetime(2024, 2, 1))
    at = datetime(2024, 1, 1)
    record = {"ObjectType": "Account", "Id": "a", "Name": "x"}
    rows = [("accounts", "json", json.dumps([record, {"ObjectType": "Case", "Id": "b"}]), "c", at, 1, None, 5),
            ("accounts", "json", json.dumps([{"Id": "t"}]), None, at, 2, None, 6), ("leads", "json", "{}", "c", at, 3, None, 7)]
    bodies = spark.createDataFrame(
        rows, "object_type string, content_type string, body string, company_id string, received_at timestamp_ntz, seq bigint, void void, n int"
    )
    apply_pushed(sink, bodies, 0)
    assert not [c for c in kept if "records" in c]
    (columns, staged, files), = stages
    assert "body" not in columns and {r.seq for r in staged if r.row} == {2}
    assert files and not any(os.path.exists(f.removeprefix("file://")) for f in files)  # deleted with the run
    assert [(r[ACCOUNTS.keys[0]], r.Name) for r in sink.run.table(ACCOUNTS).read().collect()] == [("a", "x")]
    outcomes = spark.read.parquet(sink.outcomes())
    assert {r.seq: r.status for r in outcomes.collect()} == {1: "accepted", 2: "rejected_tenant", 3: "rejected_empty"}
    (apart,), (other,) = (spark.read.json(sink.run.quarantine(q), recursiveFileLookup=True).collect() for q in ("tenantless", "pushed"))
    assert apart.reasons == ["missing_tenant"] and other.reasons == ["type_mismatch"]
    row = json.loads(apart.row)
    assert (json.loads(row["body"]), row["n"], row["seq"]) == ([{"Id": "t"}], 6, 2) and "company_id" not in row
    assert json.loads(other.row)["mismatched"][0]["fields"]["Id"] == "b"
