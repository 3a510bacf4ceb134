"""Versioned tables, whole runs over them, and streams into them."""

import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import merge
from tidemark.plans import SyncRun, run_custom_fields, run_feed, sync
from tidemark.plans.sync import check_log
from tidemark.plans.together import FeedSource, sync_all
from tidemark.sinks import VersionedTable, shared_folder, versioned
from tidemark.sources import read_landed
from tidemark.specs import (
    ACCOUNTS,
    ACTIVITIES,
    CALL_STAGES,
    CONTACTS,
    CUSTOM_ATTRIBUTES,
    CUSTOM_VALUES,
    OPPORTUNITIES,
    SYNC_LOG,
    TableSpec,
)
from tidemark.streaming import PushSink, apply_pushed, read_bodies, start_push_stream, start_upsert_stream

SPEC = TableSpec(
    name="t", object="t", keys=("k",), columns=("k", "v", "at"), types={"k": "bigint", "at": "bigint"}, ts_col=None
)


def table(spark, tmp_path, buckets=8, spec=SPEC):
    return VersionedTable(spark, str(tmp_path / "t"), spec, buckets)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def numbers(spark, start, stop, value):
    return spark.range(start, stop).select(F.col("id").alias("k"), F.lit(value).alias("v"), F.col("id").alias("at"))


def data_files(path, write):
    found = {}
    for folder, _, files in os.walk(path / "t" / "data" / write):
        n = sum(f.endswith(".parquet") for f in files)
        if n:
            found[os.path.basename(folder)] = n
    return found


def test_versions_and_time_travel(spark, tmp_path):
    t = table(spark, tmp_path)
    assert (t.version, t.read().count()) == (0, 0)
    t.overwrite(numbers(spark, 0, 100, "a"))
    t.upsert(numbers(spark, 90, 110, "b"))
    assert t.version == 2
    assert rows(t.read().groupBy("v").count()) == [("a", 90), ("b", 20)]
    assert t.read(1).count() == 100
    with pytest.raises(ValueError):
        t.read(7)
    assert VersionedTable(spark, t.path, SPEC, 99).bucket_count == 8


def test_each_bucket_is_one_file_and_only_touched_buckets_are_rewritten(spark, tmp_path):
    t = table(spark, tmp_path, buckets=16)
    t.overwrite(numbers(spark, 0, 2000, "a"))
    first = t.pointer().buckets
    assert data_files(tmp_path, first[0]) == {f"bucket={b}": 1 for b in range(16)}
    t.upsert(numbers(spark, 5, 6, "b"))
    second = t.pointer().buckets
    changed = [b for b in second if second[b] != first[b]]
    assert len(changed) == 1
    t.upsert(numbers(spark, 0, 1500, "c"))
    third = t.pointer().buckets
    assert data_files(tmp_path, third[0]) == {f"bucket={b}": 1 for b in range(16)}
    assert rows(t.read().groupBy("v").count()) == [("a", 500), ("c", 1500)]


def test_null_safe_tables_also_write_one_file_per_bucket(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"), CUSTOM_VALUES, 8)
    values = spark.range(500).select(
        F.lit("c").alias("CompanyId"), F.lit("Account").alias("ObjectType"), F.col("id").cast("string").alias("ExternalId"),
        F.lit(None).cast("string").alias("Type"), F.lit("A__c").alias("Name"), F.lit("1").alias("Value"),
    )
    t.upsert(values)
    t.upsert(values.withColumn("Value", F.lit("2")))
    assert data_files(tmp_path, t.pointer().buckets[0]) == {f"bucket={b}": 1 for b in range(8)}
    assert rows(t.read().groupBy("Value").count()) == [("2", 500)]


def test_replays_are_no_ops(spark, tmp_path):
    t = table(spark, tmp_path)
    t.upsert(numbers(spark, 0, 10, "a"), applied=("w", 0))
    t.upsert(numbers(spark, 0, 10, "b"), applied=("w", 1))
    before = t.version
    t.upsert(numbers(spark, 0, 10, "a"), applied=("w", 0))
    t.upsert(numbers(spark, 0, 10, "x"), applied=("w", 1))
    assert t.version == before
    assert {r.v for r in t.read().collect()} == {"b"}
    t.upsert(numbers(spark, 0, 10, "x"), applied=("other", 1))
    assert {r.v for r in t.read().collect()} == {"x"}


def test_an_empty_batch_is_recorded(spark, tmp_path):
    t = table(spark, tmp_path)
    t.overwrite(numbers(spark, 0, 10, "a"))
    t.upsert(numbers(spark, 0, 0, "a"), applied=("w", 3))
    assert t.was_applied("w", 3) and t.read().count() == 10


def test_a_write_that_fails_changes_nothing(spark, tmp_path):
    t = table(spark, tmp_path)
    t.overwrite(numbers(spark, 0, 10, "a"))
    broken = numbers(spark, 0, 10, "b").withColumn("v", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        t.upsert(broken)
    assert t.version == 1 and {r.v for r in t.read().collect()} == {"a"}


def test_two_writers_cannot_take_one_version(spark, tmp_path):
    t = table(spark, tmp_path)
    t.overwrite(numbers(spark, 0, 10, "a"))
    stale = t.pointer()
    t.upsert(numbers(spark, 0, 5, "b"))
    with pytest.raises(RuntimeError):
        t._write(numbers(spark, 0, 5, "c"), stale, None)
    assert {r.v for r in t.read().collect()} == {"a", "b"}


def test_vacuum_keeps_what_is_used(spark, tmp_path):
    t = table(spark, tmp_path)
    for value in "abcd":
        t.upsert(numbers(spark, 0, 50, value))
    t.upsert(numbers(spark, 3, 4, "e"))
    gone = t.vacuum(keep_versions=2)
    assert len(gone) == 3
    assert t.read().count() == 50 and t.read(4).count() == 50
    with pytest.raises(ValueError):
        t.read(1)


def test_shared_folder_comes_from_the_session(spark):
    first, second = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert first != second
    assert first.startswith(spark.conf.get("spark.checkpoint.dir"))


# Runs ------------------------------------------------------------------------

def feed(spark, *tuples):
    return spark.createDataFrame(tuples, "Id string, CompanyId string, Name string, AnnualRevenue string, LastModifiedDate string")


def test_a_feed_over_three_runs(spark, tmp_path):
    run = SyncRun(spark, str(tmp_path), buckets=4)
    companies = spark.createDataFrame([("1",), ("2",)], "Id string")
    key = ACCOUNTS.keys[0]
    source = feed(
        spark,
        ("a", "1", "A", "1.5", "2024-01-01T00:00:00Z"),
        ("b", "1", "B", "x", "2024-01-02T00:00:00Z"),
        ("c", "3", "other tenant", None, "2024-01-02T00:00:00Z"),
    )
    report = run_feed(run, ACCOUNTS, source, companies, run_ts=datetime(2024, 2, 1))
    assert {r.CompanyId: (r.sync_type, r.records_processed) for r in report.collect()} == {
        "1": ("full", 2), "2": ("full", 0)
    }
    assert [r[key] for r in run.table(ACCOUNTS).read().collect()] == ["a"]
    bad = spark.read.json(run.quarantine("accounts"))
    assert sorted(r.reasons for r in bad.collect()) == [["bad_AnnualRevenue"], ["unknown_tenant"]]
    log = run.table(SYNC_LOG).read().collect()
    assert [(r.table_name, r.CompanyId, str(r.last_sync_time)) for r in log] == [("accounts", "1", "2024-01-02 00:00:00")]

    more = feed(
        spark,
        ("a", "1", "not read again", "9", "2024-01-01T00:00:00Z"),
        ("b", "1", "B2", "2", "2024-01-03T00:00:00Z"),
        ("d", "2", "D", None, "2024-01-01T00:00:00Z"),
    )
    report = run_feed(run, ACCOUNTS, more, companies, run_ts=datetime(2024, 2, 2))
    assert {r.CompanyId: (r.sync_type, r.records_processed, r.last_sync) for r in report.collect()} == {
        "1": ("incremental", 1, "2024-01-02T00:00:00"), "2": ("full", 1, None)
    }
    assert {r[key]: r.Name for r in run.table(ACCOUNTS).read().collect()} == {"a": "A", "b": "B2", "d": "D"}

    report = run_feed(run, ACCOUNTS, more, companies, run_ts=datetime(2024, 2, 3))
    assert sum(r.records_processed for r in report.collect()) == 0
    after = {r.CompanyId: r for r in run.table(SYNC_LOG).read().collect()}
    assert str(after["1"].last_sync_time) == "2024-01-03 00:00:00"
    assert str(after["1"].created_at) == "2024-02-02 00:00:00"  # nothing read, nothing moved


def test_run_time_watermark_and_semi_join(spark):
    companies = spark.createDataFrame([("1",)], "Id string")
    tasks = spark.createDataFrame(
        [("t1", "o1", "1", "2024-01-01"), ("t2", "zz", "1", "2024-01-01"), ("t3", None, "1", "2024-01-01")],
        "Id string, WhatId string, CompanyId string, LastModifiedDate string",
    )
    parents = spark.createDataFrame([("o1",), ("o1",)], "Id string")
    empty = spark.createDataFrame([], ACTIVITIES.schema)
    log = spark.createDataFrame([], SYNC_LOG.schema)
    done = sync(ACTIVITIES, tasks, empty, log, companies, run_ts=datetime(2024, 2, 1), related=parents,
                watermark_mode="run_ts")
    assert [r[0] for r in done.target.collect()] == ["t1"]
    assert str(done.sync_log.first().last_sync_time) == "2024-02-01 00:00:00"


def test_watermark_column_outside_the_projection(spark):
    companies = spark.createDataFrame([("1",)], "Id string")
    stages = spark.createDataFrame(
        [("s1", "Open", True, 1, "1", datetime(2024, 1, 1)), ("s2", "Won", True, 2, "1", datetime(2024, 1, 3))],
        "Id string, MasterLabel string, IsActive boolean, SortOrder int, CompanyId string, LastModifiedDate timestamp_ntz",
    )
    log = spark.createDataFrame([("callstages", datetime(2024, 1, 2), None, "1")], SYNC_LOG.schema)
    target = spark.createDataFrame([("s1", False, "Old", 9)], CALL_STAGES.schema)
    done = sync(CALL_STAGES, stages, target, log, companies, run_ts=datetime(2024, 2, 1))
    assert rows(done.target) == [("s1", False, "Old", 9), ("s2", True, "Won", 2)]
    assert str(done.sync_log.first().last_sync_time) == "2024-01-03 00:00:00"


def test_a_log_with_a_wrong_type_is_refused(spark):
    with pytest.raises(TypeError):
        check_log(spark.createDataFrame([("a", "x", "1")], "table_name string, last_sync_time string, CompanyId string"))


def metadata(spark, *names):
    base = spark.createDataFrame([("1", "Account", i, n) for i, n in enumerate(names)],
                                 "CompanyId string, object_name string, seq int, n string")
    api = F.concat("n", F.lit("__c"))
    text = F.lit(None).cast("string")
    head = ["CompanyId", "object_name", "seq"]
    return {
        "custom_fields": base.select(*head, F.col("n").alias("DeveloperName"), F.concat(F.lit("id-"), "n").alias("Id"),
                                     F.lit("2020-01-01").alias("CreatedDate"), text.alias("CreatedById"),
                                     F.lit("2020-01-02").alias("LastModifiedDate"), text.alias("LastModifiedById")),
        "definitions": base.select(*head, api.alias("QualifiedApiName"), F.lit("Text").alias("DataType"),
                                   text.alias("Description")),
        "particles": base.select(*head, F.struct(api.alias("QualifiedApiName")).alias("FieldDefinition"),
                                 text.cast("boolean").alias("IsUnique"), F.lit(True).alias("IsDeprecatedAndHidden")),
        "described": base.select(*head, api.alias("name"), text.alias("label"), text.alias("type"),
                                 text.alias("inlineHelpText")),
    }


def test_custom_fields_over_two_runs(spark, tmp_path):
    run = SyncRun(spark, str(tmp_path), buckets=4)
    companies = spark.createDataFrame([("1",)], "Id string")
    wide = "CompanyId string, Id string, LastModifiedDate string, A__c string, B__c double, C__c boolean"
    first = spark.createDataFrame(
        [("1", "r1", "2024-01-01", "x", 1.5, True), ("1", "r2", "2024-01-01", None, None, None)], wide
    )
    feeds = metadata(spark, "A", "B", "C", "D")
    run_custom_fields(run, feeds, {"Account": first}, companies, run_ts=datetime(2024, 2, 1))
    attributes = run.table(CUSTOM_ATTRIBUTES).read()
    assert attributes.count() == 4  # a full run keeps the field without values
    row = attributes.filter("Name = 'A__c'").first()
    assert (row.IsActive, row.HasUniqueValue, row.CompanyId, str(row.CreatedAt)) == (False, None, "1", "2020-01-01 00:00:00")
    values = {(r.ExternalId, r.Name): r.Value for r in run.table(CUSTOM_VALUES).read().collect()}
    assert values == {("r1", "A__c"): "x", ("r1", "B__c"): "1.5", ("r1", "C__c"): "true"}

    second = spark.createDataFrame(
        [("1", "r1", "2024-01-02", "y", None, None), ("1", "r3", "2024-01-01", "old", None, None)], wide
    )
    feeds = metadata(spark, "A", "B", "E")
    report = run_custom_fields(run, feeds, {"Account": second}, companies, run_ts=datetime(2024, 2, 2))
    assert (report.first().sync_type, report.first().records_processed) == ("incremental", 1)
    names = {r.Name for r in run.table(CUSTOM_ATTRIBUTES).read().collect()}
    assert names == {"A__c", "B__c", "C__c", "D__c"}  # E has no values yet
    values = {(r.ExternalId, r.Name): r.Value for r in run.table(CUSTOM_VALUES).read().collect()}
    assert values == {("r1", "A__c"): "y", ("r1", "B__c"): "1.5", ("r1", "C__c"): "true"}


def test_landed_pages_are_all_read(spark, tmp_path):
    for page in (1, 2):
        (tmp_path / f"page{page}.json").write_text(
            json.dumps({"Id": str(page), "Owner": {"Name": "N", "Email": "E"}, "Amount": 1.5, "IsWon": True}) + "\n"
        )
    df = read_landed(spark, f"{tmp_path}/*.json", OPPORTUNITIES, "json")
    assert rows(df.select("Id", "Owner.Name", F.col("Amount").cast("string"), "IsWon")) == [
        ("1", "N", "1.5", "true"), ("2", "N", "1.5", "true")
    ]
    df.select("Id", "LastModifiedDate").write.option("header", True).csv(f"{tmp_path}/csv")
    (tmp_path / "tasks.json").write_text('{"Id":"1","LastModifiedDate":"2024-01-01"}\n')
    assert "LastModifiedDate" in read_landed(spark, f"{tmp_path}/tasks.json", ACTIVITIES, "json").columns


# Streams ---------------------------------------------------------------------

def pushed(n):
    """Bodies over four routes with repeated keys, some of them bad."""
    out = []
    for i in range(n):
        key = f"k{i % 7}"
        record = {"Id": key, "Name": f"n{i}", "OwnerId": f"u{i % 3}", "LastModifiedDate": "2024-01-01T00:00:00Z"}
        if i % 11 == 0:
            record = {"Name": "no id"}
        body = json.dumps([record, {"Id": f"{key}-x", "LastName": f"l{i}"}])
        route = ("accounts", "Contacts", "opportunities", "leads")[i % 4]
        if i % 13 == 0:
            body = body[:-2]
        out.append({
            "object_type": route, "content_type": "application/json", "body": body, "company_id": f"c{i % 2}",
            "received_at": f"2024-01-01T00:{i // 60:02d}:{i % 60:02d}", "seq": i,
        })
    return out


def users(spark):
    return spark.createDataFrame([("u0", "Zero", "0@x"), ("u1", "One", "1@x")], "Id string, Name string, Email string")


def land(folder, bodies, files):
    folder.mkdir()
    for f in range(files):
        lines = [json.dumps(b) for i, b in enumerate(bodies) if i * files // len(bodies) == f]
        part = folder / f"part{f}.json"
        part.write_text("\n".join(lines) + "\n")
        # A file stream takes files in the order of their times: these arrived a minute apart.
        os.utime(part, (1_700_000_000 + 60 * f,) * 2)


def snapshot(sink):
    run = sink.run
    tables = {s.name: rows(run.table(s).read()) for s in (ACCOUNTS, CONTACTS, OPPORTUNITIES, SYNC_LOG)}
    out = run.spark.read.parquet(sink.outcomes()).select("seq", "status", "records_processed")
    return tables, rows(out)


def test_stream_equals_batch_and_replays_change_nothing(spark, tmp_path):
    bodies = pushed(60)
    land(tmp_path / "landed", bodies, 3)
    now = datetime(2024, 2, 1)
    stream_sink = PushSink(SyncRun(spark, str(tmp_path / "s"), 4), "push", lambda: users(spark), now)
    source = read_bodies(spark, str(tmp_path / "landed"), maxFilesPerTrigger="1")
    start_push_stream(stream_sink, source, str(tmp_path / "c")).awaitTermination()

    batch_sink = PushSink(SyncRun(spark, str(tmp_path / "b"), 4), "push", lambda: users(spark), now)
    static = spark.read.schema(source.schema).json(str(tmp_path / "landed"))
    apply_pushed(batch_sink, static, 0)
    assert snapshot(stream_sink) == snapshot(batch_sink)
    tables, outcomes = snapshot(batch_sink)
    assert len(outcomes) == 60 and len(tables["sync_log"]) == 3
    key = OPPORTUNITIES.keys[0]
    owned = {r[key]: (r.OwnerName, r.OwnerId) for r in batch_sink.run.table(OPPORTUNITIES).read().collect()}
    assert {v for v in owned.values()} >= {("Zero", "u0"), (None, "u2"), (None, None)}
    bad = spark.read.json(batch_sink.run.quarantine("accounts"), recursiveFileLookup=True)
    assert bad.count() > 0

    apply_pushed(batch_sink, static, 0)  # the same batch again
    assert snapshot(batch_sink) == (tables, outcomes)
    before = stream_sink.run.table(ACCOUNTS).version
    start_push_stream(stream_sink, source, str(tmp_path / "c")).awaitTermination()
    assert stream_sink.run.table(ACCOUNTS).version == before


def test_stream_goes_on_after_a_failed_batch(spark, tmp_path):
    t = table(spark, tmp_path)
    land_dir = tmp_path / "rows"
    numbers(spark, 0, 40, "a").repartition(2).write.parquet(str(land_dir))
    source = spark.readStream.schema("k bigint, v string, at bigint").option("maxFilesPerTrigger", 1).parquet(str(land_dir))
    fail = {"on": True}

    def prepare(df):
        if fail["on"] and t.version == 1:
            raise RuntimeError("executor lost")
        return df

    args = dict(writer="w", seq=["at"], prepare=prepare)
    with pytest.raises(Exception, match="executor lost"):
        start_upsert_stream(t, source, str(tmp_path / "c"), **args).awaitTermination()
    assert t.version == 1
    fail["on"] = False
    start_upsert_stream(t, source, str(tmp_path / "c"), **args).awaitTermination()
    assert t.version == 2 and t.read().count() == 40


def test_sparse_pushes_keep_old_values_on_request(spark, tmp_path):
    sink = PushSink(SyncRun(spark, str(tmp_path), 4), "push", run_ts=datetime(2024, 2, 1), present_only=True)

    def push(number, *records):
        row = ("contacts", "json", json.dumps(list(records)), "c", datetime(2024, 1, 1), number)
        df = spark.createDataFrame(
            [row], "object_type string, content_type string, body string, company_id string, received_at timestamp_ntz, seq bigint"
        )
        apply_pushed(sink, df, number)

    push(0, {"Id": "1", "LastName": "L", "Title": "T"})
    push(1, {"Id": "1", "LastName": "M"}, {"Id": "1", "Title": None})
    row = sink.run.table(CONTACTS).read().first()
    assert (row.LastName, row.Title) == ("M", None)


def test_upsert_against_merge(spark, tmp_path):
    t = table(spark, tmp_path)
    old, new = numbers(spark, 0, 300, "a"), numbers(spark, 200, 400, "b")
    t.overwrite(old)
    t.upsert(new)
    assert rows(t.read()) == rows(merge(old, new, ["k"], null_keys=False))
    t.overwrite(old)
    t.upsert(new, whole=True)
    assert rows(t.read()) == rows(merge(old, new, ["k"], null_keys=False))


# What must not get lost -------------------------------------------------------

PUSH = "object_type string, content_type string, body string, company_id string, received_at timestamp_ntz, seq bigint"


def test_keyless_rows_are_set_apart(spark, tmp_path):
    t = table(spark, tmp_path)
    batch = spark.createDataFrame([(None, "a", 1), (None, "b", 2), (3, "c", 3)], "k bigint, v string, at bigint")
    t.upsert(batch, seq=["at"])
    t.upsert(batch, seq=["at"], applied=("w", 0))
    t.upsert(batch, seq=["at"], whole=True)
    assert rows(t.read()) == [(3, "c", 3)]
    assert sorted(r.v for r in t.keyless().collect()) == ["a", "a", "a", "b", "b", "b"]


def test_every_row_read_is_stored_or_set_apart(spark, tmp_path):
    run = SyncRun(spark, str(tmp_path), buckets=4)
    source = feed(
        spark, ("good", "1", "A", None, "2024-01-01"), ("blank", "1", "A", None, "2024-02-01 00:00:00"),
        ("none", "1", "A", None, None), ("lost", None, "A", None, "2024-01-01"), ("other", "9", "A", None, "2024-01-01"),
        (None, "1", "A", None, "2024-01-01"),
    )
    run_feed(run, ACCOUNTS, source, spark.createDataFrame([("1",)], "Id string"), run_ts=datetime(2024, 3, 1))
    reasons = {json.loads(r.row).get("Id"): r.reasons for r in spark.read.json(run.quarantine("accounts")).collect()}
    assert reasons == {
        "blank": ["bad_LastModifiedDate"], "none": ["bad_LastModifiedDate"], "lost": ["missing_tenant"],
        "other": ["unknown_tenant"], None: ["missing_SalesForceId"],
    }
    assert run.table(ACCOUNTS).read().count() == 1
    wrong = source.withColumn("LastModifiedDate", F.lit(5))
    with pytest.raises(TypeError):
        run_feed(run, ACCOUNTS, wrong, spark.createDataFrame([("1",)], "Id string"), run_ts=datetime(2024, 3, 1))


def test_landed_text_and_broken_lines_keep_their_text(spark, tmp_path):
    page = {"CompanyId": "1", "records": [{"Id": "a", "AnnualRevenue": "n/a", "LastModifiedDate": "2024-01-01"}, {"Id": "b", "AnnualRevenue": 1.5, "LastModifiedDate": "2024-01-01"}]}
    lines = [json.dumps(page), json.dumps({"Id": "c", "CompanyId": "1", "LastModifiedDate": "2024-01-01"}), '{"Id": "d", "CompanyId": "1", "Name']
    (tmp_path / "in.json").write_text("\n".join(lines) + "\n")
    run = SyncRun(spark, str(tmp_path / "out"), buckets=4)
    landed = read_landed(spark, f"{tmp_path}/in.json", ACCOUNTS, "json")
    run_feed(run, ACCOUNTS, landed, spark.createDataFrame([("1",)], "Id string"), run_ts=datetime(2024, 3, 1))
    assert sorted((r.SalesForceId, r.AnnualRevenue and float(r.AnnualRevenue)) for r in run.table(ACCOUNTS).read().collect()) == [("b", 1.5), ("c", None)]
    bad = {json.loads(r.row).get("Id"): r for r in spark.read.json(run.quarantine("accounts")).collect()}
    assert bad["a"].reasons == ["bad_AnnualRevenue"] and "corrupt" in bad[None].reasons if None in bad else "corrupt" in bad["d"].reasons
    assert any('"Name' in json.loads(r.row).get("_corrupt_record", "") for r in bad.values())


def test_a_tenant_that_lands_later_is_seen(spark, tmp_path):
    folder = str(tmp_path / "companies")
    spark.createDataFrame([("1",)], "Id string").write.parquet(folder)
    run = SyncRun(spark, str(tmp_path / "t"), buckets=4)
    cached = set(spark.sparkContext._jsc.getPersistentRDDs())
    source = feed(spark, ("a", "1", "A", None, "2024-01-01"), ("b", "2", "B", None, "2024-01-01"))
    run_feed(run, ACCOUNTS, source, spark.read.parquet(folder), run_ts=datetime(2024, 2, 1))
    spark.createDataFrame([("2",)], "Id string").write.mode("append").parquet(folder)
    run_feed(run, ACCOUNTS, source, spark.read.parquet(folder), run_ts=datetime(2024, 2, 2))
    assert {r.CompanyId for r in run.table(ACCOUNTS).read().collect()} == {"1", "2"}
    assert set(spark.sparkContext._jsc.getPersistentRDDs()) <= cached  # the runs leave nothing behind


def test_attributes_of_two_tenants_do_not_multiply(spark, tmp_path):
    run = SyncRun(spark, str(tmp_path), buckets=4)
    one = metadata(spark, "A")
    feeds = {k: v.unionByName(v.withColumn("CompanyId", F.lit("2"))) for k, v in one.items()}
    wide = spark.createDataFrame(
        [("1", "r", "2024-01-01", "x"), ("2", "r", "2024-01-01", "y")], "CompanyId string, Id string, LastModifiedDate string, A__c string"
    )
    companies = spark.createDataFrame([("1",), ("2",)], "Id string")
    for day in (1, 2, 3):
        now = wide.withColumn("LastModifiedDate", F.lit(f"2024-01-0{day}"))
        run_custom_fields(run, feeds, {"Account": now}, companies, run_ts=datetime(2024, 2, day))
    assert run.table(CUSTOM_ATTRIBUTES).read().count() == 2


def test_emptied_values_through_the_runner(spark, tmp_path):
    run = SyncRun(spark, str(tmp_path), buckets=4)
    companies = spark.createDataFrame([("1",)], "Id string")
    wide = "CompanyId string, Id string, LastModifiedDate string, A__c string, B__c string"
    feeds = metadata(spark, "A", "B")
    for day, row in ((1, ("x", None)), (2, (None, None)), (3, (None, "z"))):
        df = spark.createDataFrame([("1", "r", f"2024-01-0{day}", *row)], wide)
        run_custom_fields(run, feeds, {"Account": df}, companies, run_ts=datetime(2024, 2, day), clear_nulls=True)
        values = {r.Name: r.Value for r in run.table(CUSTOM_VALUES).read().collect()}
        assert values == [{"A__c": "x"}, {"A__c": None}, {"A__c": None, "B__c": "z"}][day - 1]


def test_a_new_checkpoint_under_the_same_name_loses_nothing(spark, tmp_path):
    t = table(spark, tmp_path)
    for i, value in enumerate("ab"):
        numbers(spark, i * 10, i * 10 + 10, value).write.parquet(str(tmp_path / f"in{i}"))
        source = spark.readStream.schema("k bigint, v string, at bigint").parquet(str(tmp_path / f"in{i}"))
        start_upsert_stream(t, source, str(tmp_path / f"c{i}"), writer="w", seq=["at"]).awaitTermination()
    assert rows(t.read().groupBy("v").count()) == [("a", 10), ("b", 10)]


def test_pushes_keep_tenants_apart_and_leave_the_pull_watermark(spark, tmp_path):
    run = SyncRun(spark, str(tmp_path), buckets=4)
    source = feed(spark, ("a", "1", "A", None, "2024-02-01T00:00:00Z"), ("a", "2", "B", None, "2024-02-01T00:00:00Z"))
    companies = spark.createDataFrame([("1",), ("2",)], "Id string")
    run_feed(run, ACCOUNTS, source, companies, run_ts=datetime(2024, 3, 1))
    body = json.dumps({"Id": "a", "Name": "pushed"})
    pushed_rows = [("accounts", "json", body, c, datetime(2024, 4, 1), i) for i, c in enumerate(["1", None, None])]
    sink = PushSink(run, "push", run_ts=datetime(2024, 4, 1))
    apply_pushed(sink, spark.createDataFrame(pushed_rows, PUSH), 0)
    assert rows(run.table(ACCOUNTS).read().select("CompanyId", "SalesForceId", "Name")) == [("1", "a", "pushed"), ("2", "a", "B")]
    log = {(r.table_name, r.CompanyId): str(r.last_sync_time) for r in run.table(SYNC_LOG).read().collect()}
    assert log == {
        ("accounts", "1"): "2024-02-01 00:00:00", ("accounts", "2"): "2024-02-01 00:00:00", ("push:accounts", "1"): "2024-04-01 00:00:00",
    }
    statuses = sorted(r.status for r in spark.read.parquet(sink.outcomes()).collect())
    assert statuses == ["accepted", "rejected_tenant", "rejected_tenant"]
    assert spark.read.json(run.quarantine("tenantless"), recursiveFileLookup=True).count() == 2
    with pytest.raises(ValueError, match="other columns or keys"):
        VersionedTable(spark, f"{run.root}/accounts", ACCOUNTS)


def test_two_writers_of_one_log_both_arrive(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    t = table(spark, tmp_path, buckets=1)
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda i: table(spark, tmp_path, buckets=1).upsert(numbers(spark, i * 10, i * 10 + 10, str(i))), range(4)))
    assert t.read().count() == 40 and t.version == 4


def test_a_feed_is_read_once(spark, tmp_path):
    reads = spark.sparkContext.accumulator(0)
    source = feed(spark, ("a", "1", "A", None, "2024-01-01"), ("b", "1", "B", "x", "2024-01-01"))
    schema = source.schema

    def count(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    counted = source.mapInArrow(count, schema)
    report = run_feed(SyncRun(spark, str(tmp_path), 4), ACCOUNTS, counted, spark.createDataFrame([("1",)], "Id string"), run_ts=datetime(2024, 2, 1))
    assert report.first().records_processed == 2 and reads.value == 2


def test_a_failing_feed_leaves_the_others_alone(spark, tmp_path):
    run = SyncRun(spark, str(tmp_path), buckets=4)
    companies = spark.createDataFrame([("1",)], "Id string")
    good = feed(spark, ("a", "1", "A", None, "2024-01-01"))
    tasks = spark.createDataFrame(
        [("t", "o", "1", "2024-01-01"), ("u", "zz", "1", "2024-01-01")], "Id string, WhatId string, CompanyId string, LastModifiedDate string"
    )
    deals = spark.createDataFrame([("o", "1", "2024-01-01")], "Id string, CompanyId string, LastModifiedDate string")
    broken = good.withColumn("LastName", F.raise_error(F.lit("gone away")).cast("string"))
    feeds = [
        FeedSource(ACTIVITIES, tasks, related="opportunities"), FeedSource(ACCOUNTS, good), FeedSource(CONTACTS, broken),
        FeedSource(OPPORTUNITIES, deals),
    ]
    report = {r.feed: r for r in sync_all(run, feeds, companies, run_ts=datetime(2024, 2, 1)).collect()}
    assert {n: (r.success, r.records_processed) for n, r in report.items()} == {
        "accounts": (True, 1), "opportunities": (True, 1), ACTIVITIES.name: (True, 1), "contacts": (False, 0),
    }
    assert "gone away" in report["contacts"].error
    assert [r.SalesforceId for r in run.table(ACTIVITIES).read().collect()] == ["t"]


# A writer that dies -------------------------------------------------------------


def test_a_dead_writers_pointer_stops_nothing(spark, tmp_path):
    t = table(spark, tmp_path)
    t.overwrite(numbers(spark, 0, 10, "a"))
    folder = tmp_path / "t" / "_pointer"
    for number, text in ((2, ""), (3, '{"version": 3, "buck'), (5, "[]")):
        (folder / f"{number:020d}.json").write_text(text)
    assert t.version == 1 and t.read().count() == 10
    assert t.upsert(numbers(spark, 5, 15, "b"), applied=("w", 0)) == 6
    again = table(spark, tmp_path)
    assert again.version == 6 and again.was_applied("w", 0) and again.read().count() == 15
    with pytest.raises(ValueError):
        t.read(3)
    assert again.upsert(numbers(spark, 0, 1, "c")) == 7
    again.vacuum(keep_versions=1)
    assert again.version == 7 and rows(again.read().groupBy("v").count()) == [("a", 4), ("b", 10), ("c", 1)]


def test_a_writer_that_dies_before_its_pointer_has_a_number(spark, tmp_path, monkeypatch):
    t = table(spark, tmp_path)
    t.overwrite(numbers(spark, 0, 10, "a"))

    def die(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(VersionedTable, "_publish", die)
        with pytest.raises(KeyboardInterrupt):
            t.upsert(numbers(spark, 0, 10, "b"), applied=("w", 0))
    assert t.version == 1 and not t.was_applied("w", 0)
    assert t.upsert(numbers(spark, 0, 10, "b"), applied=("w", 0)) == 2
    assert {r.v for r in t.read().collect()} == {"b"}


def test_a_number_is_given_once(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    from tidemark.sinks.versioned import Pointer, VersionTaken

    t = table(spark, tmp_path)

    def commit(i):
        try:
            t._commit(Pointer(1, applied={"w": i}))
            return i
        except VersionTaken:
            return None

    with ThreadPoolExecutor(8) as pool:
        won = [i for i in pool.map(commit, range(24)) if i is not None]
    assert len(won) == 1 and t.pointer().applied == {"w": won[0]}
    assert os.listdir(tmp_path / "t" / "_pointer" / "aside") == []


def test_keyless_rows_of_a_lost_race_are_set_apart_once(spark, tmp_path, monkeypatch):
    t = table(spark, tmp_path)
    t.overwrite(numbers(spark, 0, 10, "a"))
    other, publish, lost = table(spark, tmp_path), VersionedTable._publish, []

    def late(self, *args):
        if self is t and not lost:
            lost.append(other.upsert(numbers(spark, 20, 21, "o")))
        publish(self, *args)

    monkeypatch.setattr(VersionedTable, "_publish", late)
    t.upsert(spark.createDataFrame([(None, "lost", 1), (5, "b", 2)], "k bigint, v string, at bigint"), seq=["at"])
    assert lost and [r.v for r in t.keyless().collect()] == ["lost"]
    assert rows(t.read().groupBy("v").count()) == [("a", 9), ("b", 1), ("o", 1)]


def test_actions_are_counted_by_the_write_itself(spark, tmp_path, monkeypatch):
    t = table(spark, tmp_path)
    t.overwrite(numbers(spark, 0, 100, "a"))
    scans = []
    read = VersionedTable._read
    monkeypatch.setattr(VersionedTable, "_read", lambda self, buckets: scans.append(len(buckets)) or read(self, buckets))
    t.upsert(numbers(spark, 90, 130, "b"))
    assert len(scans) == 1
    monkeypatch.undo()
    t.upsert(numbers(spark, 0, 0, "c"))
    t.upsert(spark.createDataFrame([(5, "old", 1), (7, "new", 99), (500, "x", 1)], SPEC.schema), seq=["at"], event_col="at")
    assert rows(t.actions().fillna(-1)) == [(1, -1, -1), (2, 30, 10), (3, 0, 0), (4, 1, 1)]


@pytest.mark.parametrize("seq", [None, ["at"]])
def test_tasks_of_a_write_follow_its_rows(spark, tmp_path, monkeypatch, seq):
    monkeypatch.setattr(versioned, "TASK_ROWS", 100)
    t = table(spark, tmp_path)
    most = lambda: max(r.n for r in t.read().groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect())
    t.overwrite(numbers(spark, 0, 4000, "a"))
    assert most() < 200
    t.upsert(numbers(spark, 3000, 8000, "b"), seq=seq)
    assert most() < 200 and t.read().count() == 8000 and t.read().where("v = 'b'").count() == 5000
    assert t.pointer().actions == {"inserted": 4000, "updated": 1000}
    for rows_, tasks in ((0, None), (100, None), (101, 2), (10**6, 10**4)):
        n = t._tasks(rows_)
        assert n == tasks if rows_ < 101 else n >= tasks and (n % t.bucket_count == 0 or t.bucket_count % n == 0)
