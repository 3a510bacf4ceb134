"""Landed files: records of many objects, metadata pages, the quarantine read back, feeds as a stream, and what a run leaves."""

import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.test_tables import feed, metadata, rows
from tidemark.plans import SyncRun, pending, replay, run_custom_fields, run_feed
from tidemark.plans.custom import judge_records, object_marks
from tidemark.sources import Landed, read_landed, read_metadata, read_records, read_wide, wide_records
from tidemark.specs import ACCOUNTS, ACTIVITIES, CALL_STAGES, CUSTOM_ATTRIBUTES, CUSTOM_VALUES, SYNC_LOG
from tidemark.streaming import apply_landed, start_feed_stream

DAY = datetime(2024, 3, 1)


def tenants(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "Id string")


def lines(path, *docs):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join((d if isinstance(d, str) else json.dumps(d)) + "\n" for d in docs))


def record(obj, key, time, tenant="1", **fields):
    return {"attributes": {"type": obj}, "CompanyId": tenant, "Id": key, "LastModifiedDate": time, **fields}


def plan_of(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def values_of(run):
    return {(r.CompanyId, r.ObjectType, r.ExternalId, r.Name): r.Value for r in run.table(CUSTOM_VALUES).read().collect()}


def all_metadata(spark, *pairs):
    """Metadata of (object, field) pairs of tenant 1."""
    one = metadata(spark, *[name for _, name in pairs])
    objects = F.element_at(F.create_map(*[F.lit(x) for i, (o, _) in enumerate(pairs) for x in (i, o)]), F.col("seq"))
    return {k: v.withColumn("object_name", objects) for k, v in one.items()}


# Records ----------------------------------------------------------------------


def test_wide_records_lost_nothing(spark, tmp_path):
    """Of a good record, one without tenant, one of an unknown tenant and one whose time does not parse, all are accounted for."""
    run = SyncRun(spark, str(tmp_path), buckets=2)
    wide = spark.createDataFrame(
        [("1", "good", "2024-01-01", "x"), (None, "lost", "2024-01-01", "x"), ("9", "other", "2024-01-01", "x"), ("1", "when", "?", "x"),
         ("1", None, "2024-01-01", "x")],
        "CompanyId string, Id string, LastModifiedDate string, A__c string",
    )
    for day in (1, 2):  # a full run, then an incremental one
        new = wide.withColumn("LastModifiedDate", F.regexp_replace("LastModifiedDate", "-01$", f"-0{day}"))
        run_custom_fields(run, metadata(spark, "A"), {"Account": new}, tenants(spark, "1"), run_ts=datetime(2024, 2, day))
        bad = spark.read.json(f"{run.quarantine(CUSTOM_VALUES.name)}/run=202402{day:02d}*").collect()
        assert sorted((r.reasons, json.loads(r.row).get("Id")) for r in bad) == [
            (["bad_time"], "when"), (["missing_Id"], None), (["missing_tenant"], "lost"), (["unknown_tenant"], "other"),
        ]
        assert list(values_of(run)) == [("1", "Account", "good", "A__c")]


def test_records_of_any_object_in_any_lines(spark, tmp_path):
    run = SyncRun(spark, str(tmp_path / "t"), buckets=2)
    page = {"CompanyId": "1", "records": [record("Contact", "c1", "2024-01-01", None, B__c=1.5), record("Lead", "l1", "2024-01-01", B__c=1)]}
    lines(tmp_path / "in" / "a.json", record("Account", "a1", "2024-01-01", A__c="007", Z__c="nobody describes it", Plain="x"), page,
          {"CompanyId": "1", "records": []}, '{"broken', "[1, 2]", record("Account", "a2", "2024-01-02", A__c=None), record("Account", "a3", "2024-01-02", A__c={"k": [1]}))
    feeds = all_metadata(spark, ("Account", "A"), ("Contact", "B"))
    report = run_custom_fields(run, feeds, read_records(spark, str(tmp_path / "in"), "LastModifiedDate"), tenants(spark, "1"), run_ts=DAY)
    assert values_of(run) == {("1", "Account", "a1", "A__c"): "007", ("1", "Contact", "c1", "B__c"): "1.5", ("1", "Account", "a3", "A__c"): '{"k":[1]}'}
    assert {r.feed: r.records_processed for r in report.collect()} == {
        "CrmAttributeValues_Account": 3, "CrmAttributeValues_Contact": 1, "CrmAttributeValues_Opportunity": 0, "CrmAttributeValues_User": 0,
    }
    bad = spark.read.json(run.quarantine(CUSTOM_VALUES.name)).collect()
    assert sorted(r.reasons[0] for r in bad) == ["corrupt", "corrupt", "unknown_object"]
    texts = {json.loads(r.row).get("_corrupt_record") for r in bad}
    assert texts == {'{"broken', "[1, 2]", None}
    assert {r.table_name: str(r.last_sync_time) for r in run.table(SYNC_LOG).read().collect()} == {
        "CrmAttributeValues_Account": "2024-01-02 00:00:00", "CrmAttributeValues_Contact": "2024-01-01 00:00:00",
    }


def test_any_number_of_objects_is_one_scan(spark, tmp_path):
    lines(tmp_path / "a.json", record("Account", "a", "2024-01-01", A__c=1))
    log = spark.createDataFrame([("CrmAttributeValues_Account", datetime(2023, 1, 1), None, "1")], "table_name string, last_sync_time timestamp_ntz, created_at timestamp_ntz, CompanyId string")
    marks = object_marks(tenants(spark, "1"), log, ["Account", "Contact", "Opportunity", "User"])
    plan = plan_of(judge_records(read_records(spark, str(tmp_path), "LastModifiedDate"), marks))
    assert plan.count("Scan text") == 2  # in the tree and in the list below it: one scan
    assert marks.count() == 4 and [r.Object for r in marks.where("last_sync IS NOT NULL").collect()] == ["Account"]


def test_watermarks_of_objects_reach_the_scan_of_a_wide_feed(spark, tmp_path):
    spark.createDataFrame([("1", "a", datetime(2024, 1, 1), "x")], "CompanyId string, Id string, LastModifiedDate timestamp_ntz, A__c string").write.parquet(f"{tmp_path}/w")
    log = spark.createDataFrame([("CrmAttributeValues_Account", datetime(2023, 1, 1), None, "1")], "table_name string, last_sync_time timestamp_ntz, created_at timestamp_ntz, CompanyId string")
    marks = object_marks(tenants(spark, "1"), log, ["Account"])
    wide = read_wide(spark, Landed(f"{tmp_path}/w"), ["A__c"], "LastModifiedDate")
    assert "GreaterThan(LastModifiedDate,2023-01-01" in plan_of(judge_records(wide_records({"Account": wide}, None, "LastModifiedDate"), marks))


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_only_described_fields_are_read(spark, tmp_path, fmt):
    wide = spark.createDataFrame(
        [("1", "a", "2024-01-01", "x", "y", "secret")], "CompanyId string, Id string, LastModifiedDate string, A__c string, B__c string, S__c string"
    )
    wide.write.format(fmt).save(f"{tmp_path}/w")
    plan = plan_of(read_wide(spark, Landed(f"{tmp_path}/w", fmt), ["A__c", "Gone__c"], "LastModifiedDate"))
    schema = plan[plan.index("ReadSchema"):].splitlines()[0]
    assert "A__c" in schema and "S__c" not in schema and "B__c" not in schema
    run = SyncRun(spark, str(tmp_path / "t"), buckets=2)
    landed = {"Account": Landed(f"{tmp_path}/w", fmt)}
    run_custom_fields(run, metadata(spark, "A", "Gone"), landed, tenants(spark, "1"), run_ts=DAY)
    assert values_of(run) == {("1", "Account", "a", "A__c"): "x"}
    wide.withColumn("LastModifiedDate", F.lit("2024-01-02")).write.mode("overwrite").format(fmt).save(f"{tmp_path}/w")
    run_custom_fields(run, metadata(spark, "A", "B"), landed, tenants(spark, "1"), run_ts=datetime(2024, 3, 2))
    assert values_of(run) == {("1", "Account", "a", "A__c"): "x", ("1", "Account", "a", "B__c"): "y"}


def test_the_last_of_equal_times_counts(spark, tmp_path):
    run = SyncRun(spark, str(tmp_path / "t"), buckets=2)
    lines(tmp_path / "in" / "a.json", *[record("Account", "a", "2024-01-01", A__c=str(i)) for i in range(50)])
    run_custom_fields(run, metadata(spark, "A"), read_records(spark, str(tmp_path / "in"), "LastModifiedDate"), tenants(spark, "1"), run_ts=DAY)
    assert list(values_of(run).values()) == ["49"]
    for n, names in enumerate((("b", "a"), ("a", "b"))):  # files count by the time they landed, not by their names
        folder = tmp_path / f"feed{n}"
        for t, name in enumerate(names):
            lines(folder / f"{name}.json", {"Id": "k", "CompanyId": "1", "Name": name, "LastModifiedDate": f"2024-01-0{n + 1}"})
            os.utime(folder / f"{name}.json", (1_700_000_000 + t,) * 2)
        run_feed(run, ACCOUNTS, read_landed(spark, str(folder), ACCOUNTS, "json"), tenants(spark, "1"), run_ts=datetime(2024, 3, 2 + n))
        assert [r.Name for r in run.table(ACCOUNTS).read().collect()] == [names[1]]


def test_a_run_leaves_no_stages(spark, tmp_path):
    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(shared))
    run = SyncRun(spark, str(tmp_path), buckets=2)
    report = run_feed(run, ACCOUNTS, feed(spark, ("a", "1", "A", None, "2024-01-01")), tenants(spark, "1"), run_ts=DAY)
    wide = spark.createDataFrame([("1", "r", "2024-01-01", "x")], "CompanyId string, Id string, LastModifiedDate string, A__c string")
    custom = run_custom_fields(run, metadata(spark, "A"), {"Account": wide}, tenants(spark, "1"), run_ts=DAY)
    broken = feed(spark, ("a", "1", "A", None, "2024-01-02")).withColumn("Name", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        run_feed(run, ACCOUNTS, broken, tenants(spark, "1"), run_ts=datetime(2024, 3, 2))
    assert set(os.listdir(shared)) == before
    assert report.first().records_processed == custom.first().records_processed == 1  # the reports are still there


# Metadata ---------------------------------------------------------------------


def test_metadata_pages(spark, tmp_path):
    def page(feed_name, file, landed, doc):
        path = tmp_path / "m" / feed_name / file
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(doc if isinstance(doc, str) else json.dumps({"CompanyId": "1", "object_name": "Account", **doc}, indent=1))
        os.utime(path, (1_700_000_000 + landed,) * 2)

    fields = [{"Id": "f1", "DeveloperName": "A"}, {"Id": "f2", "DeveloperName": "B"}, {"Id": "f3", "DeveloperName": "A"}]
    page("custom_fields", "1.json", 0, {"records": fields})
    page("definitions", "2.json", 1, {"records": [{"QualifiedApiName": "A__c", "DataType": "old"}]})
    page("definitions", "1.json", 2, {"records": [{"QualifiedApiName": "A__c", "DataType": "new"}]})
    page("definitions", "0.json", 3, '{"CompanyId": "1", "object_name"')
    page("definitions", "3.json", 4, json.dumps({"records": []}))
    page("particles", "1.json", 0, {"records": [{"FieldDefinition": {"QualifiedApiName": "A__c"}, "IsUnique": True, "IsDeprecatedAndHidden": None}]})
    page("described", "1.json", 0, {"fields": [{"name": "A__c", "label": "Label", "type": "text"}], "other": 1})
    feeds, broken = read_metadata(spark, str(tmp_path / "m"))
    run = SyncRun(spark, str(tmp_path / "t"), buckets=2)
    wide = spark.createDataFrame([], "CompanyId string, Id string, LastModifiedDate string")
    run_custom_fields(run, feeds, {"Account": wide}, tenants(spark, "1"), run_ts=DAY)
    got = run.table(CUSTOM_ATTRIBUTES).read().select("SalesforceId", "Name", "Label", "DataType", "HasUniqueValue", "IsActive")
    assert rows(got.fillna("-")) == [("f2", "B__c", "-", "-", False, True), ("f3", "A__c", "Label", "new", True, True)]
    assert sorted((r.feed, r.file.rpartition("/")[2]) for r in broken.collect()) == [("definitions", "0.json"), ("definitions", "3.json")]


# Replay -----------------------------------------------------------------------


def test_replay_stores_each_row_once(spark, tmp_path):
    run = SyncRun(spark, str(tmp_path), buckets=2)
    source = feed(
        spark, ("good", "1", "A", "1.5", "2024-01-01"), ("amount", "1", "B", "x", "2024-01-02"), ("when", "1", "C", None, "never"),
        ("other", "2", "D", "2", "2024-01-01"), ("newer", "1", "old", "x", "2024-01-01"), ("amount", "1", "B", "x", "2024-01-02"),
    )
    run_feed(run, ACCOUNTS, source, tenants(spark, "1"), run_ts=DAY)
    run_feed(run, ACCOUNTS, feed(spark, ("newer", "1", "new", "7", "2024-01-05")), tenants(spark, "1"), run_ts=datetime(2024, 3, 2))
    assert pending(run, "accounts").count() == 4  # equal rows of a run once
    report = replay(run, ACCOUNTS, tenants(spark, "1", "2"), run_ts=datetime(2024, 3, 3))
    assert [(r.pending, r.stored) for r in report.collect()] == [(3, 1)]  # the tenant is known now

    def repair(df):
        return df.withColumn("AnnualRevenue", F.when(F.col("AnnualRevenue") != "x", F.col("AnnualRevenue")))

    report = replay(run, ACCOUNTS, tenants(spark, "1", "2"), run_ts=datetime(2024, 3, 4), repair=repair)
    assert [(r.pending, r.stored) for r in report.collect()] == [(1, 2)]
    assert [json.loads(r.row)["Id"] for r in pending(run, "accounts").collect()] == ["when"]
    before = run.table(ACCOUNTS).version
    report = replay(run, ACCOUNTS, tenants(spark, "1", "2"), run_ts=datetime(2024, 3, 5), repair=repair)
    assert [(r.pending, r.stored) for r in report.collect()] == [(1, 0)]
    got = {(r.CompanyId, r.SalesForceId): (r.Name, r.AnnualRevenue and float(r.AnnualRevenue)) for r in run.table(ACCOUNTS).read().collect()}
    assert got == {("1", "good"): ("A", 1.5), ("1", "amount"): ("B", None), ("2", "other"): ("D", 2.0), ("1", "newer"): ("new", 7.0)}
    assert run.table(ACCOUNTS).version <= before + 1
    marks = {r.CompanyId: str(r.last_sync_time) for r in run.table(SYNC_LOG).read().collect()}
    assert marks == {"1": "2024-01-05 00:00:00"}  # a replay moves no watermark


def test_replay_waits_for_parents_and_restores_target_names(spark, tmp_path):
    run = SyncRun(spark, str(tmp_path), buckets=2)
    tasks = spark.createDataFrame([("t1", "o1", None, "2024-01-01"), ("t2", "o2", None, "2024-01-01")], "Id string, WhatId string, CompanyId string, LastModifiedDate string")
    run_feed(run, ACTIVITIES, tasks, tenants(spark, "1"), run_ts=DAY)
    fill = lambda df: df.withColumn("CompanyId", F.lit("1"))
    replay(run, ACTIVITIES, tenants(spark, "1"), run_ts=DAY, repair=fill, related=tenants(spark, "o1"))
    assert [r.SalesforceId for r in run.table(ACTIVITIES).read().collect()] == ["t1"] and pending(run, ACTIVITIES.name).count() == 1
    replay(run, ACTIVITIES, tenants(spark, "1"), run_ts=datetime(2024, 3, 2), repair=fill, related=tenants(spark, "o1", "o2"))
    assert run.table(ACTIVITIES).read().count() == 2 and pending(run, ACTIVITIES.name).count() == 0
    stages = spark.createDataFrame([("s1", "Won", "first", "2024-01-01", "1")], "Id string, CallStage string, SortOrder string, LastModifiedDate string, CompanyId string")
    run_feed(run, CALL_STAGES, stages, tenants(spark, "1"), run_ts=DAY)
    replay(run, CALL_STAGES, tenants(spark, "1"), run_ts=DAY, repair=lambda df: df.withColumn("SortOrder", F.lit("1")))
    assert [(r.CallStage, r.SortOrder) for r in run.table(CALL_STAGES).read().collect()] == [("Won", 1)]
    assert pending(run, "opportunities").count() == 0  # a feed that never set a row apart


# Feeds as a stream --------------------------------------------------------------


def account(key, time, name, tenant="1"):
    return {"Id": key, "CompanyId": tenant, "Name": name, "LastModifiedDate": time}


def test_each_landed_file_is_read_once(spark, tmp_path):
    run, landed = SyncRun(spark, str(tmp_path / "t"), buckets=2), tmp_path / "in"

    def go():
        stream = read_landed(spark, str(landed), ACCOUNTS, "json", stream=True)
        query = start_feed_stream(run, ACCOUNTS, stream, lambda: tenants(spark, "1", "2"), str(tmp_path / "c"), writer="hourly", run_ts=DAY)
        query.awaitTermination()
        return sum(p["numInputRows"] for p in query.recentProgress)

    lines(landed / "1.json", account("a", "2024-01-03", "new"), account("b", "2024-01-01", "b", "2"), account("x", "2024-01-01", "x", "9"), "{")
    assert go() == 4
    lines(landed / "2.json", {"CompanyId": "1", "records": [account("a", "2024-01-01", "late and old"), account("c", "2024-01-02", "late")]})
    (landed / "1.json").write_text("not to be opened again\n" * 4)
    os.utime(landed / "1.json", (1_700_000_000,) * 2)
    assert go() == 1 and go() == 0
    assert {r.SalesForceId: r.Name for r in run.table(ACCOUNTS).read().collect()} == {"a": "new", "b": "b", "c": "late"}
    marks = {r.CompanyId: str(r.last_sync_time) for r in run.table(SYNC_LOG).read().collect()}
    assert marks == {"1": "2024-01-03 00:00:00", "2": "2024-01-01 00:00:00"}
    assert sorted(r.reasons[0] for r in pending(run, "accounts").collect()) == ["corrupt", "unknown_tenant"]
    reports = spark.read.parquet(f"{run.root}/reports/accounts").where("records_processed > 0")
    assert sorted((r.CompanyId, r.sync_type, r.records_processed) for r in reports.collect()) == [("1", "full", 1), ("1", "incremental", 2), ("2", "full", 1)]


def test_a_landed_batch_is_applied_once(spark, tmp_path, monkeypatch):
    run = SyncRun(spark, str(tmp_path / "t"), buckets=2)
    batch = feed(spark, ("a", "1", "A", "x", "2024-01-01"), ("b", "1", "B", "1", "2024-01-01"))
    apply = lambda: apply_landed(run, ACCOUNTS, batch, 0, lambda: tenants(spark, "1"), writer="w", run_ts=DAY)
    import tidemark.streaming.feeds as module

    with monkeypatch.context() as m:  # dies after the rows, before the log
        m.setattr(module, "log_updates", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            apply()
    apply()
    version = run.table(ACCOUNTS).version
    apply()
    assert run.table(ACCOUNTS).version == version == 1 and run.table(ACCOUNTS).read().count() == 1
    assert pending(run, "accounts").count() == 1 and run.table(SYNC_LOG).read().count() == 1


# Ordered extracts ---------------------------------------------------------------


def test_ordered_files_and_their_manifest(spark, tmp_path):
    from tidemark.sinks import read_ordered, write_ordered

    values = [None, 1, 2, 2, 2, 5, 9]
    df = spark.range(3000).select(F.element_at(F.array(*[F.lit(v) for v in values]), (F.col("id") % 7 + 1).cast("int")).alias("t"), F.concat(F.lit("k"), "id").alias("k"))
    listed = write_ordered(df, str(tmp_path / "o"), ["t", "k"], files=8)
    want = sorted(((r.t, r.k) for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    got = read_ordered(spark, str(tmp_path / "o"))
    assert [(r.t, r.k) for r in sorted(got.collect(), key=lambda r: r.position)] == want
    assert sorted(r.position for r in got.collect()) == list(range(3000)) and "Sort [" not in got._jdf.queryExecution().optimizedPlan().toString()
    files = listed.orderBy("part").collect()
    assert sum(f.n_rows for f in files) == 3000 and max(f.n_rows for f in files) < 1000  # the hot value is split
    assert all(tuple(a["last"])[1] is not None and (a["last"]["t"] or 0, a["last"]["k"]) < (b["first"]["t"] or 0, b["first"]["k"]) for a, b in zip(files, files[1:]))
    some = read_ordered(spark, str(tmp_path / "o"), {"t": 2}, {"t": 5})
    assert sorted((r.position, r.t) for r in some.collect()) == [(i, t) for i, (t, _) in enumerate(want) if t in (2, 5)]
    opened = {f.rpartition("/")[2] for f in some.inputFiles() if "/data/" in f}
    assert opened == {f.file.rpartition("/")[2] for f in files if f["last"]["t"] is not None and f["last"]["t"] >= 2 and (f["first"]["t"] or 0) <= 5}
    assert read_ordered(spark, str(tmp_path / "o"), {"t": 100}).count() == 0
    write_ordered(df.limit(0), str(tmp_path / "e"), ["t", "k"])
    assert read_ordered(spark, str(tmp_path / "e")).count() == 0


def test_a_user_with_several_rows_gives_the_first(spark, tmp_path):
    from tidemark.specs import OPPORTUNITIES
    from tidemark.streaming import PushSink, apply_pushed

    users = spark.createDataFrame([("u", "second", None, 2), ("u", "first", None, 1)], "Id string, Name string, Email string, seq int")
    sink = PushSink(SyncRun(spark, str(tmp_path), 2), "push", users=lambda: users, run_ts=DAY)
    body = json.dumps({"Id": "o", "OwnerId": "u"})
    apply_pushed(sink, spark.createDataFrame([("opportunities", "json", body, "1", DAY, 1)], "object_type string, content_type string, body string, company_id string, received_at timestamp_ntz, seq bigint"), 0)
    assert [r.OwnerName for r in sink.run.table(OPPORTUNITIES).read().collect()] == ["first"]
