import pytest
from pyspark.sql import functions as F

from tidewheel.functions.ids import parse_id, python_id
from tidewheel.functions.names import max_mb, python_max_mb, python_redact_url, redact_url, session_pk, team_safe
from tidewheel.functions.payload import as_object, is_json, json_value
from tidewheel.functions.times import dt_for, resolve, to_rfc3339


def values(spark, rows, schema, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column.alias("x")).collect()]


@pytest.mark.parametrize(
    "text, want",
    [("1-2", (1, 2)), ("0", (0, 0)), ("18446744073709551615-0", (18446744073709551615, 0)), ("18446744073709551616-0", None), ("1", None), ("a-1", None), ("1-2-3", None), ("", None), ("-", None)],
)
def test_stream_id(spark, text, want):
    got = values(spark, [(text,)], "t string", parse_id(F.col("t")))[0]
    assert (None if got is None else (int(got.ms), int(got.seq))) == want == python_id(text)


def test_ids_order_as_numbers(spark):
    rows = spark.createDataFrame([("10-0",), ("9-5",), ("9-10",)], "t string").orderBy(parse_id(F.col("t"))).collect()
    assert [r.t for r in rows] == ["9-5", "9-10", "10-0"]


@pytest.mark.parametrize(
    "stream_id, ts, date, stamp",
    [
        ("1725062400000-0", "2026-08-30T21:00:00Z", "2026-08-30", "2026-08-30T21:00:00Z"),
        ("1725062400000-0", "2026-08-30T23:30:00.120-02:00", "2026-08-31", "2026-08-31T01:30:00.120Z"),
        ("1725062400000-0", "2026-08-30t21:00:00.123456789z", "2026-08-30", "2026-08-30T21:00:00.123456Z"),
        ("1725062400000-0", "2026-08-30", "2024-08-31", "2024-08-31T00:00:00Z"),
        ("1725062400000-0", "2026-08-30T21:00:00", "2024-08-31", "2024-08-31T00:00:00Z"),
        ("1725062400000-0", None, "2024-08-31", "2024-08-31T00:00:00Z"),
        ("garbage", "not-a-date", "1970-01-01", "1970-01-01T00:00:00Z"),
        ("18446744073709551615-0", "", "1970-01-01", "1970-01-01T00:00:00Z"),
    ],
)
def test_event_time(spark, stream_id, ts, date, stamp):
    rows = [(stream_id, ts)]
    assert values(spark, rows, "i string, t string", dt_for(F.col("i"), F.col("t"))) == [date]
    assert values(spark, rows, "i string, t string", to_rfc3339(resolve(F.col("i"), F.col("t")))) == [stamp]


@pytest.mark.parametrize(
    "team, actor, want",
    [
        ("", "system", "_office"), (None, "architect", "_office"), ("", "developer", "_unknown"), (None, None, "_unknown"), ("dev-1", None, "dev-1"), ("Dev Team/1", "x", "Dev_Team_1"), ("...", "x", "_unknown"),
        ("..a b  c..", "x", "a_b_c.."), ("../../etc", "x", "_.._etc"), ("é", "x", "_"), ("a" * 80, "x", "a" * 64), ("." * 10 + "b" * 100, "x", "b" * 54), ("x" * 63 + "  y", "x", "x" * 63 + "_"),
    ],
)
def test_team_safe(spark, team, actor, want):
    assert values(spark, [(team, actor)], "t string, a string", team_safe(F.col("t"), F.col("a"))) == [want]


@pytest.mark.parametrize(
    "text, json_ok, object_ok",
    [('{"a":1}', True, True), ("{}", True, True), ('{"a":1} x', False, False), ("{'a':1}", False, False), ('{"a":NaN}', False, False), ('{"a":1,"a":2}', True, True), ("", False, False), ("[1,2,3]", True, False), ("42", True, False), ('"s"', True, False), ("null", True, False), ("1,2", False, False), ("{broken", False, False)],
)
def test_strict_json(spark, text, json_ok, object_ok):
    assert values(spark, [(text,)], "t string", is_json(F.col("t"))) == [json_ok]
    assert values(spark, [(text,)], "t string", as_object(json_value(F.col("t"))).isNotNull()) == [object_ok]


@pytest.mark.parametrize(
    "url, want",
    [("redis://:s3cr3t@127.0.0.1:6380", "redis://127.0.0.1:6380"), ("redis://u:p@ss@h/0", "redis://h/0"), ("redis://h/0?x=a@b", "redis://h/0?x=a@b"), ("h:6379", "h:6379"), ("", "")],
)
def test_redact(spark, url, want):
    assert values(spark, [(url,)], "u string", redact_url(F.col("u"))) == [want] == [python_redact_url(url)]


@pytest.mark.parametrize("asked, want", [(None, 500), (0, 500), (-3, 500), (1, 16), (15, 16), (16, 16), (700, 700)])
def test_max_mb(spark, asked, want):
    assert values(spark, [(asked,)], "m long", max_mb(F.col("m"))) == [want] == [python_max_mb(asked)]


def test_session_pk_treats_missing_as_empty(spark):
    import hashlib

    got = values(spark, [(None, "a", "1-0"), ("t", None, "1-0")], "t string, a string, i string", session_pk(F.col("t"), F.col("a"), F.col("i")))
    assert got == [hashlib.sha256(x).hexdigest() for x in (b"|a|1-0", b"t||1-0")]
