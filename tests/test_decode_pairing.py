import json
import random

import pytest
from pyspark.sql import functions as F

from tidewheel.operators.decode import RAW_COLUMNS, decode, raw_line
from tidewheel.operators.pairing import age, latest, pair_sessions, with_location

WIRE = "stream_id string, fields map<string,string>"


def line(spark, fields, stream_id="5-0"):
    rows = decode(spark.createDataFrame([(stream_id, fields)], WIRE))
    return json.loads(rows.select(raw_line().alias("l")).first().l)


@pytest.mark.parametrize(
    "fields, want",
    [
        ({"action": "task.started", "actor": "dev", "team": ""}, {"action": "task.started", "actor": "dev", "team": None, "payload": {}, "decode_ok": True}),
        ({"json": '{"id":"e1","actor":"a","payload":{"x":[1]}}', "actor": "flat", "team": "t"}, {"envelope_id": "e1", "actor": "a", "team": "t", "payload": {"x": [1]}}),
        ({"json": '{"actor":"","team":7}', "actor": "flat", "team": "t"}, {"actor": "flat", "team": "t", "payload": {}}),
        ({"json": "{broken", "snippet": "s"}, {"decode_ok": False, "payload": {"snippet": "s"}}),
        ({"json": "[1]", "envelope": '{"id":"hidden"}'}, {"decode_ok": False, "envelope_id": None}),
        ({"envelope": '{"id":"e2","payload":null}'}, {"envelope_id": "e2", "payload": None, "decode_ok": True}),
        ({"payload": '{"session_id":"s1","custom":1}', "snippet": "x"}, {"payload": {"session_id": "s1", "custom": 1}}),
        ({"payload": "not json", "snippet": "x"}, {"payload": {"snippet": "x"}, "decode_ok": True}),
        ({"task_ref": '{"issues":["A"]}', "handoff": "plain-ref", "summary": 'say "hi"\n'}, {"payload": {"task_ref": {"issues": ["A"]}, "handoff": "plain-ref", "summary": 'say "hi"\n'}}),
        ({}, {"payload": {}, "decode_ok": True, "action": None}),
        (None, {"payload": {}, "fields": {}}),
    ],
)
def test_decode(spark, fields, want):
    got = line(spark, fields)
    assert list(got) == RAW_COLUMNS
    assert {k: got[k] for k in want} == want
    assert got["fields"] == (fields or {})


def event(i, action, sid=None, actor="a", team="t", ts=None, **payload):
    if sid is not None:
        payload["session_id"] = sid
    return (f"{i}-0", {"action": f"task.{action}", "actor": actor, "team": team, "payload": json.dumps(payload), **({"timestamp": ts} if ts else {})})


def sessions(spark, *events, **kw):
    rows = pair_sessions(decode(spark.createDataFrame(list(events), WIRE)), **kw).collect()
    return sorted(((r.start_stream_id, r.finish_stream_id, r.state) for r in rows), key=str)


S, F_ = "started", "finished"


@pytest.mark.parametrize(
    "events, want",
    [
        ([(100, S, "x"), (102, F_, "x")], [("100-0", "102-0", "completed")]),
        ([(100, S, "x"), (101, S, "x"), (102, F_, "x")], [("100-0", "102-0", "completed"), ("101-0", None, "open")]),
        ([(100, S, "a"), (101, S, "b"), (102, F_, "b")], [("100-0", None, "interrupted"), ("101-0", "102-0", "completed")]),
        ([(100, S, None), (101, F_, "")], [("100-0", "101-0", "completed")]),
        ([(100, S, "a"), (101, F_, "b")], [(None, "101-0", "orphan_finish"), ("100-0", None, "open")]),
        ([(101, F_, "b")], [(None, "101-0", "orphan_finish")]),
        ([(200, S, "a"), (100, F_, "a")], [(None, "100-0", "orphan_finish"), ("200-0", None, "open")]),
        ([(100, S, "1"), (101, S, "2"), (102, F_, "1")], [("100-0", "102-0", "completed"), ("101-0", None, "open")]),
        ([(100, S, "x"), (101, F_, "x"), (102, F_, "x")], [(None, "102-0", "orphan_finish"), ("100-0", "101-0", "completed")]),
        ([(100, "noted", "x")], []),
    ],
)
def test_pairing(spark, events, want):
    got = sessions(spark, *(event(*e) for e in events))
    assert sorted(got, key=str) == sorted(want, key=str)


def test_pairing_columns(spark):
    rows = decode(
        spark.createDataFrame(
            [
                event(1, S, "x", ts="2026-08-30T23:59:00Z", snippet="in", task_ref={"issues": ["A", 1, "B"]}),
                event(2, F_, "x", ts="2026-08-31T00:01:00.500Z", snippet="", handoff={"to": "b"}, task_ref={"issues": ["B", "C"], "prs": []}),
            ],
            WIRE,
        )
    )
    r = with_location(pair_sessions(rows)).first()
    assert (r.duration_ms, r.snippet_in, r.snippet_out, r.issues, r.prs, r.handoff, r.dt, r.team_safe) == (120500, "in", "", ["A", "B", "C"], None, '{"to":"b"}', "2026-08-30", "t")


def test_expiry_is_strict_and_spares_interrupted(spark):
    rows = [event(1000, S, "a"), event(2000, S, "b"), event(2000, S, "c", actor="z")]
    at = lambda ms: F.timestamp_millis(F.lit(ms))
    window = 6 * 3_600_000
    assert sessions(spark, *rows, now=at(2000 + window)) == [("1000-0", None, "interrupted"), ("2000-0", None, "open"), ("2000-0", None, "open")]
    assert sessions(spark, *rows, now=at(2001 + window)) == [("1000-0", None, "interrupted"), ("2000-0", None, "expired"), ("2000-0", None, "expired")]
    table = pair_sessions(decode(spark.createDataFrame(rows, WIRE)))
    assert age(table, at(2000 + window)).count() == 0
    assert sorted(r.start_stream_id for r in age(table, at(2001 + window)).collect()) == ["2000-0", "2000-0"]


def simulate(events):
    """The rules one event at a time."""
    pool, done = [], []
    for i, action, sid, actor in sorted(events):
        sid = sid or ""
        if action == S:
            own = [p for p in pool if p["actor"] == actor]
            if own and max(own, key=lambda p: p["id"])["state"] == "open":
                max(own, key=lambda p: p["id"])["state"] = "interrupted"
            pool.append({"id": i, "sid": sid, "actor": actor, "state": "open"})
            continue
        fits = [p for p in pool if p["actor"] == actor and p["sid"] == sid and p["id"] < i]
        if fits:
            first = min(fits, key=lambda p: p["id"])
            pool.remove(first)
            done.append((f"{first['id']}-0", f"{i}-0", "completed"))
        else:
            done.append((None, f"{i}-0", "orphan_finish"))
    return sorted(done + [(f"{p['id']}-0", None, p["state"]) for p in pool], key=str)


@pytest.mark.parametrize("seed", range(3))
def test_pairing_equals_simulation_in_any_split(spark, seed):
    rnd = random.Random(seed)
    events = [(k, rnd.choice((S, F_)), rnd.choice((None, "x", "y")), rnd.choice("ab")) for k in range(1, 60)]
    want = simulate(events)
    for chunk_ms in (1, 7, 86_400_000):
        assert sorted(sessions(spark, *(event(*e) for e in events), chunk_ms=chunk_ms), key=str) == want
    cut = rnd.randint(5, 50)
    table = None
    for part in (events[:cut], events[cut:]):
        rows = decode(spark.createDataFrame([event(*e) for e in part], WIRE))
        new = pair_sessions(rows, pool=table, chunk_ms=5)
        table = new if table is None else table.where("state not in ('open', 'interrupted')").unionByName(new)
        table = spark.createDataFrame(table.collect(), new.schema)
    assert sorted(((r.start_stream_id, r.finish_stream_id, r.state) for r in table.collect()), key=str) == want


def test_latest_keeps_the_last_write(spark):
    rows = spark.createDataFrame([("a", "open", 1), ("a", "completed", 2), ("b", "open", 1)], "session_pk string, state string, seq int")
    assert sorted(tuple(r)[:2] for r in latest(rows, F.col("seq")).collect()) == [("a", "completed"), ("b", "open")]
