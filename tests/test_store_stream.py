import json
import socketserver
import threading
import time

import pytest
from pyspark.sql import functions as F

from tidewheel.control import checkpoint
from tidewheel.control.cli import main
from tidewheel.control.config import PROGRAM_DIR, ConfigError, load
from tidewheel.control.lock import Busy, WriterLock
from tidewheel.operators.retention import cap_bytes, dates_to_evict, events_to_trim, kept_raw, kept_sessions
from tidewheel.sources.events import after, check_bound, range_scan
from tidewheel.sources.redis_stream import RedisClient, RedisStreamReader, backoff, pages, stream_exists
from tidewheel.sources.store import Store
from tidewheel.streaming.follow import Collector, status_lines

WIRE = "stream_id string, fields map<string,string>"


def entry(i, action, team="dev-1", sid="s", ts="2026-08-30T10:00:00Z"):
    return (f"{i}-0", {"action": f"task.{action}", "actor": "a", "team": team, "timestamp": ts, "session_id": sid})


def collector(spark, tmp_path, **kw):
    return Collector(spark, Store(spark, f"file://{tmp_path}/data"), tmp_path / "state", **kw)


def table(c):
    return sorted(((r.start_stream_id, r.finish_stream_id, r.state, r.dt) for r in c.store.sessions().collect()), key=str)


def test_batches_are_idempotent_and_pair_across_runs(spark, tmp_path):
    c = collector(spark, tmp_path, redis_url="redis://:p@h", stream="s")
    one = spark.createDataFrame([entry(1, "started"), entry(2, "started", team="Dev Team/1")], WIRE)
    assert c.batch(one).raw_lines == 2
    assert c.batch(one).raw_lines == 0
    assert checkpoint.read(tmp_path / "state") == "2-0"
    two = spark.createDataFrame([entry(1, "started"), entry(3, "finished", ts="2026-08-31T10:00:00Z"), entry(4, "finished", sid="other")], WIRE)
    assert c.batch(two).raw_lines == 2
    assert table(c) == sorted([("1-0", "3-0", "completed", "2026-08-30"), ("2-0", None, "open", "2026-08-30"), (None, "4-0", "orphan_finish", "2026-08-30")], key=str)
    found = c.manifest()
    assert (found["event_count"], found["session_count"], found["checkpoint"], found["redis_url"]) == (4, 3, "4-0", "redis://h")
    assert found["session_states"] == {"completed": 1, "expired": 0, "interrupted": 0, "open": 1, "orphan_finish": 1}
    assert found["discovered_teams"] == ["Dev Team/1", "dev-1"]
    assert any(x.startswith("event_count: 4") for x in status_lines(found))
    assert json.loads((tmp_path / "state" / "MANIFEST.json").read_text())["event_count"] == 4


def test_lost_checkpoint_adds_nothing(spark, tmp_path):
    c = collector(spark, tmp_path)
    rows = spark.createDataFrame([entry(1, "started"), entry(2, "finished")], WIRE)
    c.batch(rows)
    (tmp_path / "state" / "CHECKPOINT").unlink()
    assert c.backfill(rows).raw_lines == 0
    assert c.store.lines().count() == 4


class Stop(Exception):
    pass


STEPS = ["after journal", "after sessions", "after events", "after checkpoint", "in events"]


@pytest.mark.parametrize("step", STEPS)
def test_a_stopped_batch_is_finished_once(spark, tmp_path, monkeypatch, step):
    c = collector(spark, tmp_path)
    c.batch(spark.createDataFrame([entry(1, "started"), entry(2, "started", team="t2")], WIRE))
    rows = spark.createDataFrame([entry(3, "finished"), entry(4, "started"), entry(5, "finished", team="t2", ts="2026-08-31T10:00:00Z")], WIRE)

    def stop(*_, **__):
        raise Stop

    with monkeypatch.context() as m:
        upsert, append, write = c.store.upsert, c.store.append, checkpoint.write
        if step == "after journal":
            m.setattr(c.store, "upsert", stop)
        elif step == "after sessions":
            m.setattr(c.store, "append", stop)
        elif step == "in events":  # one view has them, the other some
            def some(events, again=False):
                append(events.where("stream_id <> '4-0'"))
                raise Stop
            m.setattr(c.store, "append", some)
        elif step == "after events":
            m.setattr(checkpoint, "write", stop)
        else:
            m.setattr(checkpoint, "write", lambda *a: (write(*a), stop()))
        with pytest.raises(Stop):
            c.batch(rows)
        assert upsert
    again = collector(spark, tmp_path)
    assert again.batch(rows).raw_lines == 0
    want = [("1-0", "3-0", "completed", "2026-08-30"), ("2-0", "5-0", "completed", "2026-08-30"), ("4-0", None, "open", "2026-08-30")]
    assert table(again) == sorted(want, key=str)
    for view in ("view = 'office'", "view <> 'office'"):
        assert sorted(r.stream_id for r in again.store.lines().where(view).collect()) == [f"{k}-0" for k in range(1, 6)]
    assert checkpoint.read(tmp_path / "state") == "5-0" and checkpoint.read_pending(tmp_path / "state") is None
    fresh = again.totals()
    (tmp_path / "state" / "TOTALS.json").unlink()
    assert again.totals() == fresh


def test_a_batch_reads_no_more_than_it_needs(spark, tmp_path, monkeypatch):
    c = collector(spark, tmp_path, max_bytes=1 << 30)
    c.batch(spark.createDataFrame([entry(1, "started", team=f"t{k}", ts=f"2026-08-{k:02d}T10:00:00Z") if k < 28 else entry(1, "noted") for k in range(1, 2)], WIRE))
    c.batch(spark.createDataFrame([entry(k, "noted", team=f"t{k}", ts=f"2026-08-{k:02d}T10:00:00Z") for k in range(2, 9)] + [entry(9, "finished", team="gone", ts="2026-07-01T00:00:00Z")], WIRE))
    read = []
    at = c.store._at

    def no(*_):
        raise AssertionError("the whole dataset was scanned")

    for name in ("lines", "session_lines", "max_written"):
        monkeypatch.setattr(c.store, name, no)
    monkeypatch.setattr(c.store, "_at", lambda name, schema, parts: read.append(sorted(parts)) or at(name, schema, parts))
    c.batch(spark.createDataFrame([entry(20, "finished", team="t1", ts="2026-08-02T10:00:00Z"), entry(21, "noted", team="t9")], WIRE))
    assert read == [[("t1", "2026-08-01")], [("t1", "2026-08-01")]]  # for the pool and for the merge
    assert c.manifest()["event_count"] == 11 and c.manifest()["session_states"]["completed"] == 1
    monkeypatch.undo()
    kept = c.totals()
    (tmp_path / "state" / "TOTALS.json").unlink()
    assert c.totals() == kept and kept.states == {"completed": 1, "expired": 0, "interrupted": 0, "open": 0, "orphan_finish": 1} | {}


def test_a_tick_and_a_batch_take_turns(spark, tmp_path):
    c = collector(spark, tmp_path, clock=lambda: F.lit("2026-08-30 16:30:01").cast("timestamp"))
    c.clock = lambda: F.lit("2026-08-30 10:00:00").cast("timestamp")
    c.batch(spark.createDataFrame([entry(1, "started"), entry(2, "started", team="t2")], WIRE))
    c.clock = lambda: F.lit("2026-08-30 16:30:01").cast("timestamp")
    errors = []

    def guard(work):
        try:
            work()
        except Exception as error:
            errors.append(error)

    threads = [threading.Thread(target=guard, args=(w,)) for w in (c.tick, lambda: c.batch(spark.createDataFrame([entry(3, "started", sid="x")], WIRE)), c.tick)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors
    assert sorted((x[0], x[2]) for x in table(c)) == [("1-0", "expired"), ("2-0", "expired"), ("3-0", "expired")] or sorted(x[2] for x in table(c)).count("expired") >= 2


def test_lines_stand_in_order_and_are_private(spark, tmp_path):
    c = collector(spark, tmp_path)
    ids = [10, 9, 100, 11, 2]
    c.batch(spark.createDataFrame([entry(k, "started", sid=f"s{k}") for k in ids], WIRE))
    files = [p for p in (tmp_path / "data").rglob("part-*")]
    assert sorted(p.relative_to(tmp_path / "data").parts[0] for p in files) == ["raw", "sessions", "team_raw"]
    for path in files:
        key = "start_stream_id" if "sessions" in path.parts else "stream_id"
        assert [json.loads(x)[key] for x in path.read_text().splitlines()] == [f"{k}-0" for k in sorted(ids)]
        assert path.stat().st_mode & 0o077 == 0 and path.parent.stat().st_mode & 0o077 == 0
    assert "dt=2026-08-30" in str(files[0]) and any("team_safe=dev-1" in str(p) for p in files)


def test_partial_lines_are_cut_at_the_start(spark, tmp_path):
    c = collector(spark, tmp_path)
    c.batch(spark.createDataFrame([entry(k, "noted") for k in range(1, 4)], WIRE))
    for path in (tmp_path / "data" / "raw").rglob("part-*"):
        path.write_text(path.read_text() + '{"stream_id":"4-0","te')
    c.start()
    assert sorted(r.stream_id for r in c.store.lines().where("view = 'office'").collect()) == ["1-0", "2-0", "3-0"]
    assert c.store.repair() == [] and c.manifest()["event_count"] == 3


def test_other_files_count_and_an_empty_team_goes(spark, tmp_path):
    c = collector(spark, tmp_path)
    c.batch(spark.createDataFrame([entry(1, "noted", team="old", ts="2026-08-01T00:00:00Z"), entry(2, "noted")], WIRE))
    before = c.manifest()["bytes_used"]
    (tmp_path / "data" / "notes").mkdir()
    (tmp_path / "data" / "notes" / "x.jsonl").write_text("x" * 50)
    assert c.manifest()["bytes_used"] == before + 50
    assert c.enforce_cap(before)["dates_deleted"] == 1
    assert not (tmp_path / "data" / "team_raw" / "team_safe=old").exists() and (tmp_path / "data" / "notes" / "x.jsonl").exists()
    log = checkpoint.load_drop_log(tmp_path / "state")
    assert checkpoint.bytes_freed(log) == sum(e["bytes_freed"] for e in log) > 0


def test_a_failing_cap_stops_nothing(spark, tmp_path, monkeypatch):
    c = collector(spark, tmp_path, max_bytes=1)
    monkeypatch.setattr(c, "enforce_cap", lambda cap: 1 / 0)
    assert c.batch(spark.createDataFrame([entry(1, "noted")], WIRE)).raw_lines == 1
    assert c.store.lines().count() == 2 and [cap_bytes(x) for x in (0, 1, 16, 2**60)] == [0, 1 << 20, 16 << 20, 2**63 - 1]


def test_follow_counts_reads(spark, tmp_path):
    wire = tmp_path / "wire"
    wire.mkdir()

    def put(name, *rows):
        (wire / name).write_text("\n".join(json.dumps({"stream_id": i, "fields": f}) for i, f in rows))

    put("a.json", entry(1, "started"))
    put("b.json", entry(2, "finished"))
    c = collector(spark, tmp_path)
    stream = lambda: spark.readStream.schema(WIRE).option("maxFilesPerTrigger", 1).json(str(wire))
    c.follow(stream(), f"file://{tmp_path}/offsets", once=False, max_reads=1, poll_s=0.3)
    assert c.flushed == [1] and (tmp_path / "state" / "MANIFEST.json").exists()
    c.follow(stream(), f"file://{tmp_path}/offsets", once=False, max_reads=3, poll_s=0.3)  # what is left, and empty reads
    assert sum(c.flushed) == 2 and [x[2] for x in table(c)] == ["completed"]
    put("c.json", entry(3, "started"))
    c.follow(stream(), f"file://{tmp_path}/offsets", once=False, max_idle_ms=0, poll_s=0.3)
    assert sum(c.flushed) == 3


def test_expiry_on_a_quiet_stream(spark, tmp_path):
    c = collector(spark, tmp_path, clock=lambda: F.lit("2026-08-30 10:00:01").cast("timestamp"))
    c.batch(spark.createDataFrame([entry(1, "started")], WIRE))
    assert c.tick() == 0
    c.clock = lambda: F.lit("2026-08-30 16:00:01").cast("timestamp")
    assert c.tick() == 1
    c.batch(spark.createDataFrame([entry(5, "finished")], WIRE))
    assert [x[2] for x in table(c)] == ["orphan_finish", "expired"] or sorted(x[2] for x in table(c)) == ["expired", "orphan_finish"]


def test_cap_drops_dates_then_events(spark, tmp_path):
    c = collector(spark, tmp_path)
    rows = [entry(1, "noted", ts="2026-08-28T00:00:00Z"), *(entry(k, "noted") for k in range(2, 8))]
    c.batch(spark.createDataFrame(rows, WIRE))
    one = c.store.lines().agg(F.max(F.octet_length("line") + 1)).first()[0]
    done = c.enforce_cap(one * 8)
    assert done["dates_deleted"] == 1 and done["events_trimmed"] == 2
    assert sorted(r.stream_id for r in c.store.lines().where("view = 'office'").collect()) == ["4-0", "5-0", "6-0", "7-0"]
    log = checkpoint.load_drop_log(tmp_path / "state")
    assert [e["scope"] for e in log] == ["date", "today", "today"]


def lines(spark, view, ids):
    return [(view, None if view == "office" else view, "2026-08-30", f"{i}-0", "x" * 9) for i in ids]


def test_trim_stops_before_a_view_is_empty(spark):
    schema = "view string, team string, dt string, stream_id string, line string"
    raw = spark.createDataFrame(lines(spark, "office", [1, 2, 3]) + lines(spark, "dev-1", [1, 2]) + lines(spark, "dev-2", [3]), schema)
    none = spark.createDataFrame([], "team string, session_pk string, state string, start_stream_id string, finish_stream_id string, line string")
    gone = events_to_trim(raw, none, 1)
    assert [r.stream_id for r in gone.collect()] == ["1-0"]
    assert kept_raw(raw, gone).count() == 4


def test_trim_takes_closed_sessions_with_their_event(spark):
    schema = "view string, team string, dt string, stream_id string, line string"
    raw = spark.createDataFrame(lines(spark, "office", [1, 2, 3, 4]) + lines(spark, "dev-1", [1, 2, 3, 4]), schema)
    own = spark.createDataFrame(
        [("dev-1", "p", "completed", "1-0", "2-0", "y" * 19), ("dev-1", "q", "open", "3-0", None, "y" * 19)], "team string, session_pk string, state string, start_stream_id string, finish_stream_id string, line string"
    )
    gone = events_to_trim(raw, own, 120 - 50)
    assert {(r.stream_id, r.bytes_freed) for r in gone.collect()} == {("1-0", 40), ("2-0", 20)}
    assert [r.session_pk for r in kept_sessions(own, gone).collect()] == ["q"]


@pytest.mark.parametrize("cap, want", [(30, []), (29, ["a"]), (10, ["a", "b"]), (1, ["a", "b"])])
def test_dates(spark, cap, want):
    rows = spark.createDataFrame([("a", 10), ("b", 10), ("c", 10)], "dt string, bytes long")
    assert sorted(r.dt for r in dates_to_evict(rows, cap).where("evicted").collect()) == want


def test_scans(spark):
    rows = spark.createDataFrame([(f"{i}-0", {}) for i in (5, 50, 500)] + [("bad", {})], WIRE)
    assert [r.stream_id for r in range_scan(rows, "5-0", "50-0").collect()] == ["5-0", "50-0"]
    assert range_scan(rows).count() == 3
    assert [r.stream_id for r in after(rows.where("stream_id <> 'bad'"), "50-0").collect()] == ["500-0"]
    with pytest.raises(Exception, match="no stream id"):
        after(rows, "50-0").collect()
    with pytest.raises(ValueError, match="no stream id"):
        check_bound("x")


def test_checkpoint(tmp_path):
    assert checkpoint.read(tmp_path) == "0"
    checkpoint.write(tmp_path, "7-1")
    assert checkpoint.read(tmp_path) == "7-1"
    assert (tmp_path / "CHECKPOINT").stat().st_mode & 0o077 == 0
    with pytest.raises(ValueError, match="no stream id"):
        checkpoint.write(tmp_path, "x")
    (tmp_path / "CHECKPOINT").write_text("garbage")
    with pytest.raises(ValueError, match="no stream id"):
        checkpoint.read(tmp_path)
    assert checkpoint.resume_point("9-0", "10-0") == "10-0"
    assert checkpoint.resume_point("9-0", None) == "9-0"
    assert len(checkpoint.append_drop_log(tmp_path, [{"scope": "date", "date": None}] * 120)) == 100
    assert "date" not in checkpoint.load_drop_log(tmp_path)[0]


def test_lock(tmp_path):
    with WriterLock(tmp_path):
        with pytest.raises(Busy):
            WriterLock(tmp_path).__enter__()
    (tmp_path / ".lock").write_text(json.dumps({"pid": 999999999, "start": "1"}))
    with WriterLock(tmp_path):
        assert (tmp_path / ".lock").exists()
    assert not (tmp_path / ".lock").exists()


def test_config(tmp_path):
    file = tmp_path / "tidewheel.toml"
    file.write_text('stream = "f"\nmax_mb = 3\ndata_dir = "d"\n')
    file.chmod(0o644)
    with pytest.raises(ConfigError, match="owner"):
        load(env={}, cwd=tmp_path)
    file.chmod(0o600)
    found = load({"stream": ""}, {"TIDEWHEEL_MAX_MB": "20"}, cwd=tmp_path)
    assert (found.stream, found.max_mb, found.data_dir) == ("f", 20, str(tmp_path / "d"))
    assert load({"stream": "c", "max_mb": "-1"}, {}, cwd=tmp_path).max_mb == 500
    with pytest.raises(ConfigError):
        load({"config": str(tmp_path / "none")}, {})
    assert "p" not in load({"redis_url": "redis://:p@h"}, {}, cwd="/").shown()["redis_url"].replace("redis", "")


def test_cli(spark, tmp_path, capsys):
    source = tmp_path / "wire"
    source.mkdir()
    (source / "a.json").write_text("\n".join(json.dumps({"stream_id": i, "fields": f}) for i, f in (entry(1, "started"), entry(2, "finished"))))
    base = ["--data-dir", str(tmp_path / "d"), "--source", str(source), "--expire-hours", "1000000"]
    assert main([*base, "backfill"], spark) == 0
    assert "2 events, 1 sessions, checkpoint 2-0" in capsys.readouterr().out
    assert main([*base, "status", "--json"], spark) == 0
    assert json.loads(capsys.readouterr().out)["session_states"]["completed"] == 1
    assert main(["--once", "--max-reads", "3"], spark) == 1
    with WriterLock(tmp_path / "d"):
        assert main([*base, "backfill"], spark) == 3


class FakeRedis(socketserver.StreamRequestHandler):
    entries = [(b"1-0", [b"action", b"task.started"]), (b"2-0", [b"actor", b"\xff"])]
    names = (b"s",)

    def handle(self):
        number = lambda x, rest: (int(x.split(b"-")[0]), int(x.split(b"-")[1]) if b"-" in x else rest)
        pack = lambda x: b":%d\r\n" % x if isinstance(x, int) else b"$%d\r\n%s\r\n" % (len(x), x) if isinstance(x, bytes) else b"*%d\r\n" % len(x) + b"".join(map(pack, x))
        while line := self.rfile.readline():
            words = []
            for _ in range(int(line[1:])):
                words.append(self.rfile.read(int(self.rfile.readline()[1:]) + 2)[:-2])
            if words[0] == b"XREAD":
                later = [e for e in self.entries if number(e[0], 0) > number(words[-1] if b"-" in words[-1] else words[-1] + b"-0", 0)][: int(words[2])]
                self.wfile.write(pack([[words[-2], later]]) if later and words[-2] in self.names else b"*-1\r\n")
            elif words[0] in (b"XRANGE", b"XREVRANGE"):
                lo, hi = (words[2], words[3]) if words[0] == b"XRANGE" else (words[3], words[2])
                above = (lambda i: True) if lo == b"-" else (lambda i: i > number(lo[1:], 0)) if lo[:1] == b"(" else (lambda i: i >= number(lo, 0))
                below = (lambda i: True) if hi == b"+" else (lambda i: i <= number(hi, 1 << 63))
                found = [e for e in self.entries if above(number(e[0], 0)) and below(number(e[0], 0))]
                self.wfile.write(pack((found if words[0] == b"XRANGE" else found[::-1])[: int(words[5])]))
            else:
                self.wfile.write(pack(int(words[1] in self.names)))


@pytest.fixture
def redis_url():
    class Server(socketserver.ThreadingTCPServer):
        daemon_threads, block_on_close = True, False  # clients keep their connections

    with Server(("127.0.0.1", 0), FakeRedis) as server:
        threading.Thread(target=server.serve_forever, daemon=True).start()
        yield f"redis://127.0.0.1:{server.server_address[1]}"
        server.shutdown()


def test_redis_source(redis_url, monkeypatch):
    reader = RedisStreamReader({"url": redis_url, "stream": "s"})
    rows, end = reader.read(reader.initialOffset())
    assert list(rows) == [("1-0", {"action": "task.started"}), ("2-0", {"actor": "�"})] and end == {"id": "2-0"}
    assert [list(x) if not isinstance(x, dict) else x for x in reader.read(end)] == [[], {"id": "2-0"}]
    assert reader.failures == 0 and len(list(reader.readBetweenOffsets({"id": "0"}, end))) == 2
    client = RedisClient(redis_url)
    assert stream_exists(client, "s") and not stream_exists(client, "t")
    monkeypatch.setattr(FakeRedis, "entries", [(b"%d-0" % k, [b"a", b"b"]) for k in range(1, 1300)])
    rows, end = reader.read(end)
    assert len(list(rows)) == 16 and end == {"id": "18-0"}
    assert [i for i, _ in pages(client, "s", "-", "+")] == [f"{k}-0" for k in range(1, 1300)]


def test_redis_is_asked_again_after_a_pause(redis_url):
    assert [backoff(k, 0) for k in (1, 2, 3, 20)] == [1.0, 2.0, 4.0, 60.0]
    for options in ({"url": redis_url, "stream": "missing"}, {"url": "redis://127.0.0.1:1", "stream": "s"}):
        reader = RedisStreamReader(options)
        for failures in (1, 2, 3):
            assert [list(x) if not isinstance(x, dict) else x for x in reader.read({"id": "7-0"})] == [[], {"id": "7-0"}]
            assert reader.failures == failures and reader.again > time.monotonic() + 0.7 * 2 ** (failures - 1)
            reader.read({"id": "7-0"})
            assert reader.failures == failures  # not asked during the pause
            reader.again = 0


def test_redis_backfill(spark, redis_url, tmp_path, monkeypatch, capsys):
    many = [(b"%d-%d" % (1000 + k // 3, k % 3), [b"action", b"noted", b"actor", b"a"]) for k in range(1600)]
    monkeypatch.setattr(FakeRedis, "entries", many)
    base = ["--data-dir", str(tmp_path / "d"), "--redis", redis_url, "--stream", "s"]
    assert main([*base, "backfill", "--from", "1000-1", "--to", "1500-0"], spark) == 0
    want = [i.decode() for i, _ in many if (1000, 1) <= tuple(map(int, i.split(b"-"))) <= (1500, 0)]
    assert f"{len(want)} events" in capsys.readouterr().out
    rows = spark.read.format("redis_stream").options(url=redis_url, stream="s").load()
    assert sorted(r.stream_id for r in rows.collect()) == sorted(i.decode() for i, _ in many)
    assert main([*base, "backfill"], spark) == 0
    assert f"{len(many) - len(want) - 1} events" in capsys.readouterr().out  # 1000-0 lies before the checkpoint
    assert main([*base[:-1], "missing", "backfill"], spark) == 1
    assert main([*base, "backfill", "--from", "x"], spark) == 1


def test_data_dir_is_not_the_folder_of_the_shell(tmp_path, monkeypatch):
    monkeypatch.chdir(tmp_path)
    assert load({"data_dir": "d"}, {}).data_dir == str(PROGRAM_DIR / "d") != str(tmp_path / "d")
    assert load({}, {}, program_dir=tmp_path / "p").data_dir == str(tmp_path / "p" / "data")
