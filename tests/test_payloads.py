import json

import pytest

from tidemark.operators import push_outcomes, route_records
from tidemark.sources import PUSH_SCHEMA, describe_fields, json_records, parse_bodies, soap_records

HEAD = '<?xml version="1.0" encoding="UTF-8"?><e:Envelope xmlns:e="urn:e"><e:Body><notifications xmlns="urn:o">'
TAIL = "</notifications></e:Body></e:Envelope>"


def note(inner, attributes=""):
    return (
        f'<Notification><Id>n</Id><sObject {attributes} xmlns:sf="urn:f" xmlns:xsi="urn:i">{inner}</sObject></Notification>'
    )


def soap(*notes):
    return HEAD + "<OrganizationId>1</OrganizationId>" + "".join(notes) + TAIL


def records_of(df):
    return [
        None if r.records is None else [(dict(x.fields) if x.fields is not None else None, x.type) for x in r.records]
        for r in df.collect()
    ]


def bodies(spark, *rows):
    return spark.createDataFrame(
        [(route, kind, body, "c", None, i) for i, (route, kind, body) in enumerate(rows)], PUSH_SCHEMA
    )


@pytest.mark.parametrize(
    "body, want",
    [
        (soap(note("<sf:Id>1</sf:Id><sf:Name>A &amp; &lt;B&gt;</sf:Name>", 'xsi:type="sf:Account"')),
         [({"Id": "1", "Name": "A & <B>"}, "Account")]),
        (soap(note("<sf:type>Contact</sf:type><sf:Id>1</sf:Id>", 'xsi:type="sf:Other"'), note("<sf:Id>2</sf:Id>")),
         [({"Id": "1"}, "Contact"), ({"Id": "2"}, None)]),
        (soap(note("<sf:Id>01.50</sf:Id><sf:Fax/><sf:N>  x </sf:N>")), [({"Id": "01.50", "Fax": None, "N": "  x "}, None)]),
        (soap(), None),
        (HEAD + "<Notification>", None),
        ("<a><b/></a>", None),
        ("not xml", None),
        ("", None),
        (None, None),
    ],
)
def test_soap(spark, body, want):
    df = spark.createDataFrame([(body,)], "body string")
    assert records_of(soap_records(df)) == [want]


@pytest.mark.parametrize(
    "body, want",
    [
        ('[{"Id":"1"},{"Id":2}]', [({"Id": "1"}, None), ({"Id": "2"}, None)]),
        ('{"records":[{"Id":"1","x":null}]}', [({"Id": "1", "x": None}, None)]),
        ('{"data":[{"Id":true}],"other":1}', [({"Id": "true"}, None)]),
        ('{"records":null,"data":[{"Id":1}]}', []),
        (' {"Id":"1","Owner":{"Name":"n"}} ', [({"Id": "1", "Owner": '{"Name":"n"}'}, None)]),
        ('[{"ObjectType":"Account","Id":1}]', [({"ObjectType": "Account", "Id": "1"}, "Account")]),
        ("[1]", [(None, None)]),
        ("[]", []),
        ("5", []),
        ('"s"', []),
        ("bad", None),
        ('{"a":1} x', None),
        ('{"a":1},{"a":2}', None),
        ('{"a":1', None),
        (None, None),
    ],
)
def test_json(spark, body, want):
    df = spark.createDataFrame([(body,)], "body string")
    assert records_of(json_records(df)) == [want]


def test_statuses(spark):
    good = json.dumps([{"Id": "1"}])
    cases = [
        ("accounts", "application/json", good, "accepted", 1),
        ("ACCOUNTS", None, good, "accepted", 1),
        ("accounts", "", "", "rejected_empty", 0),
        ("accounts", "application/json", None, "rejected_empty", 0),
        ("accounts", "application/json", " {} ", "rejected_empty", 0),
        ("accounts", "application/json", "[]", "rejected_empty", 0),
        ("accounts", "application/json", "0", "rejected_empty", 0),
        ("accounts", "application/json", "-0.0", "rejected_empty", 0),
        ("accounts", "application/json", '""', "rejected_empty", 0),
        ("accounts", "application/json", "false", "rejected_empty", 0),
        ("accounts", "application/json", "7", "accepted", 0),
        ("accounts", "application/json", "{", "rejected_parse", 0),
        ("leads", "application/json", good, "unsupported_type", 0),
        ("leads", "application/json", "{", "rejected_parse", 0),
        ("users", "Text/XML; charset=utf-8", soap(note("<sf:Id>1</sf:Id>")), "accepted", 1),
        ("users", "application/SOAP", "{}", "rejected_parse", 0),
        ("users", "text/xml", soap(note("<sf:type>User</sf:type><sf:Id>1</sf:Id>"),
                                   note("<sf:type>Task</sf:type><sf:Id>2</sf:Id>")), "accepted", 1),
        # A typed envelope is not a list: all its records count.
        ("contacts", "application/json", '{"records":[{"ObjectType":"Account","Id":"1"}]}', "accepted", 1),
        ("contacts", "application/json", '[{"ObjectType":"Account","Id":"1"}]', "accepted", 0),
    ]
    parsed = parse_bodies(bodies(spark, *[c[:3] for c in cases]))
    out = push_outcomes(parsed, "seq").orderBy("seq").collect()
    assert [(r.status, r.records_processed) for r in out] == [c[3:] for c in cases]
    assert [r.success for r in out] == [r.status == "accepted" for r in out]
    assert "supported: accounts, " in out[12].error


def test_mismatched_records_are_kept_apart(spark):
    body = json.dumps([{"ObjectType": "Contact", "Id": "1"}, {"ObjectType": "Case", "Id": "2"}, {"Id": "3"}])
    row = parse_bodies(bodies(spark, ("contacts", "application/json", body))).first()
    assert [r.fields["Id"] for r in row.records] == ["1"]
    assert [r.fields["Id"] for r in row.mismatched] == ["2", "3"]


def test_routed_rows_keep_their_place(spark):
    body = json.dumps([{"Id": "b"}, {"Id": "a"}, {"Id": "b"}])
    parsed = parse_bodies(bodies(spark, ("contacts", "json", body), ("contacts", "json", "[]")))
    rows = route_records(parsed, "seq").orderBy("seq", "pos").collect()
    assert [(r.route, r.seq, r.pos, r.fields["Id"]) for r in rows] == [
        ("contacts", 0, 0, "b"), ("contacts", 0, 1, "a"), ("contacts", 0, 2, "b")
    ]


def test_describe(spark):
    doc = json.dumps({"name": "Account", "fields": [{"name": "A__c", "label": "A", "type": "text"}, {"name": "B"}]})
    rows = describe_fields(spark.createDataFrame([("Account", doc), ("X", "{}")], "object_name string, doc string"))
    assert [tuple(r) for r in rows.orderBy("pos").collect()] == [
        ("Account", 0, "A__c", "A", "text", None), ("Account", 1, "B", None, None, None)
    ]
