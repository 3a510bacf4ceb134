from datetime import datetime, timezone

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tidemark.functions import (
    config_json,
    instant,
    iso_text,
    json_map,
    json_value,
    safe_parse_date,
    to_millis,
    watermark_text,
)

# The five accepted forms, in order.
FORMS = ("%Y-%m-%dT%H:%M:%S.%f%z", "%Y-%m-%dT%H:%M:%S%z", "%Y-%m-%dT%H:%M:%S.%f", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%d")


def expected(text):
    if not text:
        return None
    for form in FORMS:
        try:
            parsed = datetime.strptime(text, form)
        except ValueError:
            continue
        return parsed.astimezone(timezone.utc).replace(tzinfo=None) if parsed.tzinfo else parsed
    return None


CASES = [
    "2024-01-15T10:30:00.000+0000", "2024-01-15T10:30:00.123456+05:30", "2024-01-15T10:30:00Z",
    "2024-01-15T10:30:00.5-0800", "2024-01-15T10:30:00.123", "2024-03-10T02:30:00", "2024-01-15", "2024-1-5",
    "2024-12-34", "2024-02-30", "2023-02-29", "garbage", "", None, "2024-01-15 10:30:00", " 2024-01-15",
    "2024-01-15\n", "2024-01-15T10:30", "2024-01-15T24:00:00", "2024-01-15T10:60:00", "2024-01-15T10:30:60",
    "0000-01-01", "0001-01-01", "9999-12-31", "99999-01-01", "2024-01-15t10:30:00", "2024-01-15T10:30:00z",
    "2024-01-15T10:30:00+0530", "2024-01-15T10:30:00-23:59", "2024-01-15T10:30:00+24:00",
    "2024-01-15T10:30:00+05:30:15", "2024-01-15T10:30:00+0530:15", "2024-01-15T10:30:00+053015.25",
    "2024-01-15T1:2:3", "2024-01- 5", "2024-01-15T10:30:00.1234567", "2024-01-15T10:30:00 +0000", "1582-10-10",
    "2024-01-15T", "2024-01-15Z", "24-01-15", "+2024-01-15", "2024-11-03T01:30:00", "2024-013-01",
]


def parse(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, v string")
    return [r.p for r in df.select("i", safe_parse_date("v").alias("p")).orderBy("i").collect()]


def test_dates_as_the_standard_library_reads_them(spark, zone):
    got = parse(spark, CASES)
    assert {c: g for c, g in zip(CASES, got)} == {c: expected(c) for c in CASES}


pieces = st.sampled_from(
    ["2024", "1999", "0", "1", "2", "02", "12", "13", "29", "31", "32", "-", "-", ":", ":", "T", ".", "5", "000", "+",
     "05", "30", "Z", " "]
)
close = st.builds(
    lambda y, m, d, t, f, z: f"{y:04d}-{m}-{d}{t}{f}{z}",
    st.integers(0, 9999), st.integers(0, 13), st.integers(0, 32),
    st.sampled_from(["", "T00:00:00", "T9:05:7", "T23:59:59", "T24:00:00"]),
    st.sampled_from(["", ".1", ".123456", ".1234567"]),
    st.sampled_from(["", "Z", "+0000", "+01:00", "-0930", "+2359"]),
)


@settings(max_examples=8, deadline=None)
@given(st.lists(close | st.lists(pieces, max_size=14).map("".join), min_size=150, max_size=150))
def test_random_texts(spark, texts):
    def safe(text):
        try:
            return expected(text)
        except OverflowError:  # an offset at the edge of the calendar
            return "edge"

    pairs = [(t, g, safe(t)) for t, g in zip(texts, parse(spark, texts))]
    assert [p for p in pairs if p[2] != "edge" and p[1] != p[2]] == []


def test_instants_of_typed_columns(spark, zone):
    row = spark.sql(
        "SELECT timestamp_ntz'2024-03-10 02:30:00' AS n, timestamp'2024-11-03 05:30:00.25 UTC' AS t, "
        "date'2024-01-15' AS d, 5 AS i"
    )
    got = row.select(*[instant(c, row.schema[c].dataType).alias(c) for c in row.columns]).first()
    assert got.n == datetime(2024, 3, 10, 2, 30)
    assert got.t == datetime(2024, 11, 3, 5, 30, 0, 250000)
    assert got.d == datetime(2024, 1, 15)
    assert got.i is None


@pytest.mark.parametrize(
    "text, mark, iso",
    [
        ("2024-03-10 02:30:00.123987", "2024-03-10T02:30:00.123Z", "2024-03-10T02:30:00.123987"),
        ("2024-01-01 00:00:00", "2024-01-01T00:00:00.000Z", "2024-01-01T00:00:00"),
        ("1969-12-31 23:59:59.9999", "1969-12-31T23:59:59.999Z", "1969-12-31T23:59:59.999900"),
    ],
)
def test_watermark_text(spark, zone, text, mark, iso):
    ts = F.lit(text).cast("timestamp_ntz")
    got = spark.range(1).select(
        watermark_text(ts).alias("w"), iso_text(ts).alias("i"), watermark_text(to_millis(ts)).alias("m")
    ).first()
    assert (got.w, got.i, got.m) == (mark, iso, mark)


def test_json_maps(spark):
    texts = ['{"a": 1, "b": null}', "", None, "{", '{"a":1} x', "[1]", "5", '{"a":{"b":[1]}}']
    df = spark.createDataFrame(list(enumerate(texts)), "i int, v string").withColumn("m", json_map(F.col("v")))
    got = [r.m for r in df.orderBy("i").collect()]
    assert got == [{"a": "1", "b": None}, {}, {}, {}, {}, {}, {}, {"a": '{"b":[1]}'}]
    one = df.filter("i = 0").select(
        json_value(F.col("m"), "a", "x").alias("a"), json_value(F.col("m"), "b", "x").alias("b"),
        json_value(F.col("m"), "c", "x").alias("c"),
    ).first()
    assert (one.a, one.b, one.c) == ("1", None, "x")


def test_config_json(spark):
    got = spark.range(1).select(config_json(a=F.lit("x"), b=F.lit(None), c=F.lit(3)).alias("j")).first().j
    assert got == '{"a":"x","b":"","c":"3"}'
