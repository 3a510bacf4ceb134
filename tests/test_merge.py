import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import conform_payload, conform_source, merge, merge_actions, split_valid, type_rules
from tidemark.specs import ACCOUNTS, CONTACTS, FEEDS, HISTORY, OPPORTUNITIES, USERS

SCHEMA = "k string, l int, a string, b int, c string"
KEYS = ("k", "l")


def replay(target, batch, update, null_safe=False, event=False, present=False):
    """The batch row by row, as a database would apply it."""
    names = ["k", "l", "a", "b", "c"]
    rows = [dict(zip(names, t)) for t in target]
    for row in batch:
        new = dict(zip(names, row))
        carried = row[6] if present else names
        hits = [
            r for r in rows
            if all((r[k] == new[k]) if null_safe else (r[k] is not None and r[k] == new[k]) for k in KEYS)
        ]
        for hit in hits:
            if event and hit["b"] is not None and (new["b"] is None or new["b"] < hit["b"]):
                continue
            hit.update({u: new[u] for u in update if u in carried})
        if not hits:
            rows.append(new)
    return sorted((tuple(r.values()) for r in rows), key=repr)


def make(rng, n, seq=False, unique=False, present=False):
    rows, seen = [], set()
    for i in range(n):
        key = (rng.choice(["x", "y", "z", None]), rng.choice([1, 2, 3, None]))
        if unique and (key in seen or None in key):
            continue
        seen.add(key)
        row = [*key, rng.choice(["p", "q", None]), rng.choice([1, 2, 3, None]), f"v{i}"]
        if seq:
            row.append(i)
        if present:
            carried = [c for c in ("a", "b", "c") if rng.random() < 0.5]
            row = [*row[:2], *[v if c in carried else None for c, v in zip("abc", row[2:5])], row[5], carried]
        rows.append(tuple(row))
    return rows


def frames(spark, target, batch, extra=""):
    shuffled = list(batch)
    random.Random(5).shuffle(shuffled)
    return spark.createDataFrame(target, SCHEMA), spark.createDataFrame(shuffled, f"{SCHEMA}, n int{extra}")


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("null_safe", [False, True])
@pytest.mark.parametrize("update", [("a", "b", "c"), ("a", "b"), ("b",)])
def test_merge_is_a_serial_replay(spark, seed, null_safe, update):
    rng = random.Random(seed)
    target, batch = make(rng, 8, unique=True), make(rng, 30, seq=True)
    t, s = frames(spark, target, batch)
    got = result(merge(t, s, KEYS, update=update, seq=["n"], null_safe=null_safe))
    assert got == replay(target, batch, update, null_safe)


@pytest.mark.parametrize("seed", range(4))
def test_event_order_is_a_serial_replay(spark, seed):
    rng = random.Random(seed)
    target, batch = make(rng, 8, unique=True), [r for r in make(rng, 40, seq=True) if None not in r[:2]]
    t, s = frames(spark, target, batch)
    got = result(merge(t, s, KEYS, seq=["n"], event_col="b", null_keys=False))
    assert got == replay(target, batch, ("a", "b", "c"), event=True)


@pytest.mark.parametrize("seed", range(4))
def test_sparse_rows_are_a_serial_replay(spark, seed):
    rng = random.Random(seed)
    target = make(rng, 8, unique=True)
    batch = [r for r in make(rng, 30, seq=True, present=True) if None not in r[:2]]
    t, s = frames(spark, target, batch, ", given array<string>")
    got = result(merge(t, s, KEYS, seq=["n"], present="given", null_keys=False))
    assert got == replay(target, batch, ("a", "b", "c"), present=True)


def test_merge_again_changes_nothing(spark):
    rng = random.Random(9)
    target, batch = make(rng, 8, unique=True), [r for r in make(rng, 30, seq=True) if None not in r[:2]]
    t, s = frames(spark, target, batch)
    once = merge(t, s, KEYS, update=("a",), seq=["n"])
    twice = merge(once, s, KEYS, update=("a",), seq=["n"])
    assert result(once) == result(twice)
    assert once.select(*KEYS).distinct().count() == once.count()


def test_missing_source_columns_overwrite_with_null(spark):
    t = spark.createDataFrame([("x", 1, "a", 1, "c")], SCHEMA)
    s = spark.createDataFrame([("x", 1, "new")], "k string, l int, a string")
    assert result(merge(t, s, KEYS)) == [("x", 1, "new", None, None)]


def test_actions(spark):
    t = spark.createDataFrame([("x", 1, "a", 1, "c"), ("y", 1, "a", 1, "c")], SCHEMA)
    s = spark.createDataFrame([("x", 1, "n"), ("z", 1, "n"), (None, 1, "n")], "k string, l int, a string")
    got = {r.action: r.n_rows for r in merge_actions(t, s, KEYS).collect()}
    assert got == {"insert": 2, "update": 1, "keep": 1}


def test_sparse_and_event_order_do_not_mix(spark):
    t = spark.createDataFrame([], SCHEMA)
    with pytest.raises(ValueError):
        merge(t, t, KEYS, event_col="b", present="a")


def test_spec_sizes():
    # Columns per target.
    sizes = {"accounts": 42, "opportunities": 39, "contacts": 48, "opportunity_activities": 19,
             "opportunity_history": 12, "users": 39, "callstages": 4}
    assert {n: len(s.columns) for n, s in FEEDS.items()} == sizes
    reads = {"accounts": 34, "opportunities": 34, "contacts": 46, "opportunity_activities": 19,
             "opportunity_history": 12, "users": 40, "callstages": 4}
    assert {n: len(s.extract) for n, s in FEEDS.items()} == reads
    for spec in FEEDS.values():
        assert set(spec.dates) <= set(spec.columns)
        assert set(spec.types) <= {*spec.columns, *spec.extract}


def test_conform_source(spark):
    df = spark.sql(
        "SELECT '1' AS Id, named_struct('Name', 'N', 'Email', 'E') AS Owner, '12.345' AS Amount, 'x' AS FiscalYear, "
        "'2024-01-15' AS CloseDate, '2024-01-15T00:00:00+01:00' AS LastReferencedDate, 'y' AS Unknown "
        "UNION ALL SELECT '2', NULL, NULL, '7', 'bad', 'bad', 'z'"
    )
    rows = {r[OPPORTUNITIES.keys[0]]: r for r in conform_source(df, OPPORTUNITIES).collect()}
    one, two = rows["1"], rows["2"]
    assert (one.OwnerName, one.OwnerEmail, str(one.Amount), one.FiscalYear) == ("N", "E", "12.35", None)
    assert (str(one.CloseDate), str(one.LastReferenceDate)) == ("2024-01-15", "2024-01-14 23:00:00")
    assert (two.OwnerName, two.FiscalYear, two.CloseDate, two.LastReferenceDate) == (None, 7, None, None)
    assert len(rows["1"]) == 39


def test_conform_payload_tells_absent_from_null(spark):
    df = spark.sql("SELECT map('Id', '1', 'Name', CAST(NULL AS string), 'Owner', '{\"Name\":\"N\"}') AS fields")
    row = conform_payload(df, OPPORTUNITIES).first()
    assert (row.Name, row.OwnerName, row.OwnerEmail) == (None, "N", None)
    assert set(row.present) == {OPPORTUNITIES.keys[0], "Name", "OwnerName", "OwnerEmail"}


def test_conform_renames(spark):
    df = spark.sql("SELECT '1' AS Id, 's' AS SLA__c, '2024-01-01' AS SLAExpirationDate__c")
    row = conform_source(df, ACCOUNTS).first()
    assert (row.SLA, str(row.SLAExpirationDate)) == ("s", "2024-01-01 00:00:00")
    history = conform_source(spark.sql("SELECT '1' AS Id, '2024-01-01' AS CloseDate"), HISTORY).first()
    assert str(history.CloseDate) == "2024-01-01 00:00:00"
    assert "ReceivesAdminInfoEmails" not in conform_source(df, USERS).columns
    assert "Level__c" in conform_source(df, CONTACTS).columns


def test_quarantine_keeps_every_row(spark):
    df = spark.createDataFrame(
        [("1", "5"), (None, "x"), ("3", "n/a"), ("4", None)], "Id string, Amount string"
    )
    good, bad = split_valid(df, type_rules(df, OPPORTUNITIES))
    assert sorted(r.Id for r in good.collect()) == ["1", "4"]
    reasons = {r.Id: r.reasons for r in bad.collect()}
    assert reasons == {None: [f"missing_{OPPORTUNITIES.keys[0]}", "bad_Amount"], "3": ["bad_Amount"]}
    everything, none = split_valid(df, {})
    assert (everything.count(), none.count()) == (4, 0)
