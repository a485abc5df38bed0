"""Following a stream: micro-batches are deduplicated, decoded, paired and stored; a quiet stream still ages its sessions."""

from __future__ import annotations

import json
import logging
import tempfile
import threading
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tidewheel.control import checkpoint, totals
from tidewheel.control.totals import Totals
from tidewheel.functions.ids import parse_id
from tidewheel.functions.names import python_redact_url, team_safe
from tidewheel.functions.times import dt_for
from tidewheel.operators.decode import decode, raw_line
from tidewheel.operators.manifest import discovered_teams, state_counts
from tidewheel.operators.pairing import STATES, age, pair_sessions
from tidewheel.operators.retention import dates_to_evict, events_to_trim, kept_raw, kept_sessions, line_bytes
from tidewheel.session import configure, shared_folder
from tidewheel.sources.events import after, max_id, range_scan
from tidewheel.sources.store import PRIVATE, Store

log = logging.getLogger(__name__)
WIRE_SCHEMA = "stream_id string, fields map<string,string>"
VERSION = "0.1.0"


@dataclass
class Outcome:
    """What a replay did."""

    raw_lines: int = 0
    session_rows: int = 0
    checkpoint: str = "0"


class StopReading(Exception):
    """A batch came after the last one that was asked for."""


class Reads:
    """Reads of a stream: how many, and since when it is quiet."""

    def __init__(self, most: int | None):
        self.most, self.count, self.told, self.last_event = most, 0, 0, time.monotonic()

    def done(self, events: bool) -> None:
        self.count += 1
        if events:
            self.last_event = time.monotonic()

    def more(self) -> bool:
        return self.most is None or self.count < self.most

    def passed(self) -> bool:
        """Whether there were reads since the last call."""
        before, self.told = self.told, self.count
        return self.count > before

    def quiet_s(self) -> float:
        return time.monotonic() - self.last_event


class IdleListener(StreamingQueryListener):
    """Counts reads that brought nothing."""

    def __init__(self, reads: Reads):
        self.reads = reads

    def onQueryStarted(self, event) -> None:
        """Nothing to count."""

    def onQueryProgress(self, event) -> None:
        """Batches count themselves."""

    def onQueryIdle(self, event) -> None:
        self.reads.done(False)

    def onQueryTerminated(self, event) -> None:
        """Nothing to count."""


@dataclass
class Collector:
    """A dataset and how far the stream is stored in it.

    state_dir holds the checkpoint, sums, drop log and manifest: small files of the driver. clock gives the time that ages
    sessions (None: no session expires). A batch first writes what it will store into a journal; a writer that stops on the
    way is finished from there by the next one, so every event and session is stored once.
    """

    spark: SparkSession
    store: Store
    state_dir: Path
    expire_hours: float = 6.0
    clock: Callable[[], Column] | None = None
    max_bytes: int | None = None
    redis_url: str = ""
    stream: str = ""
    flushed: list[int] = field(default_factory=list)
    lock: threading.RLock = field(default_factory=threading.RLock)

    def __post_init__(self):
        configure(self.spark)
        self.state_dir = Path(self.state_dir)

    def _now(self) -> Column | None:
        return self.clock() if self.clock else None

    def totals(self) -> Totals:
        """The sums of the dataset: the stored ones if they are those of the checkpoint, else by a scan of all."""
        durable = checkpoint.read(self.state_dir)
        known = totals.read(self.state_dir)
        if known and known.checkpoint == durable:
            return known
        found = Totals(durable, checkpoint.resume_point(durable, self.store.max_written()))
        raw, size = self.store.lines(), F.sum(line_bytes(F.col("line")))
        for r in raw.groupBy(F.col("view") == "office", "dt").agg(size.alias("bytes"), F.count("*").alias("n")).collect():  # a row or two for each date
            (found.office if r[0] else found.teams_bytes)[r.dt] = r.bytes
            found.events += r.n if r[0] else 0
        found.sessions = {r.dt: r.bytes for r in self.store.session_lines().groupBy("dt").agg(size.alias("bytes")).collect()}
        sessions = self.store.sessions()
        found.states = {r.state: r.n for r in state_counts(sessions).collect()}
        found.open = sorted([r.team_safe, r.dt] for r in sessions.where(F.col("state").isin(*totals.WAITING)).select("team_safe", "dt").distinct().collect())
        found.teams = sorted(r.team for r in discovered_teams(raw.where("view = 'office'").select(F.get_json_object("line", "$.team").alias("team")), sessions).collect())
        return found

    def start(self) -> None:
        """Before reading: finish a batch that was stopped, cut partial lines, bring the dataset under the cap."""
        with self.lock:
            self.recover()
            self.store.clean()
            for path, dropped in self.store.repair():
                log.warning("%s: %d bytes of a partial line dropped", path, dropped)
                totals.forget(self.state_dir)
            self.finish()

    def recover(self) -> None:
        """Finish the batch of the journal, whatever of it is stored already."""
        pending = checkpoint.read_pending(self.state_dir)
        if pending:
            totals.forget(self.state_dir)  # how much of the batch they hold isn't known
            self._apply(pending, None)

    def batch(self, wire: DataFrame, batch_id: int = -1) -> Outcome:
        """Store a batch: journal, sessions, events, checkpoint; a batch that comes again adds nothing."""
        with self.lock:
            self.recover()
            known = self.totals()
            fresh = after(wire, known.last).dropDuplicates(["stream_id"])
            rows = decode(fresh).withColumns({"team_safe": team_safe(F.col("team"), F.col("actor")), "dt": dt_for(F.col("stream_id"), F.col("ts"))}).persist()
            try:
                last = max_id(rows).first()[0]
                if last is None:
                    return Outcome(checkpoint=known.last)
                for r in rows.where("not decode_ok").select("stream_id", "decode_error").limit(20).collect():
                    log.warning("event %s: %s", r.stream_id, r.decode_error)
                pool = self.store.sessions([tuple(p) for p in known.open]).where(F.col("state").isin(*totals.WAITING))
                name = f".batch-{uuid.uuid4().hex}"
                paired = pair_sessions(rows, pool=pool, now=self._now(), expire_hours=self.expire_hours, folder=self.store.path(f"{name}/edges"))
                paired.write.options(**PRIVATE).parquet(self.store.path(f"{name}/sessions"))
                rows.select("stream_id", raw_line().alias("value"), "team_safe", "dt", F.trim("team").alias("team")).write.options(**PRIVATE).parquet(self.store.path(f"{name}/events"))
            finally:
                rows.unpersist()
            checkpoint.replace_file(self.state_dir / checkpoint.PENDING, json.dumps({"name": name, "last": last}))
            done = self._apply({"name": name, "last": last}, known)
            self.flushed.append(done.raw_lines)
            self.finish()
            return done

    def _apply(self, pending: dict, known: Totals | None) -> Outcome:
        """Store what a journal holds; known: the sums before, None if some of it may be stored already."""
        name, last = pending["name"], pending["last"]
        sessions, events = (self.spark.read.parquet(self.store.path(f"{name}/{part}")) for part in ("sessions", "events"))
        written = sessions.count()
        changes = self.store.upsert(sessions) if written else []
        self.store.append(events, again=known is None)
        dates = events.groupBy("dt").agg(F.count("*").alias("n"), F.sum(line_bytes(F.col("value"))).alias("bytes")).collect()
        teams = [r.team for r in events.where("team <> ''").select("team").distinct().collect()]
        checkpoint.write(self.state_dir, last)
        if known:
            known.add_events(dates, teams)
            known.add_sessions(changes)
            known.checkpoint = known.last = last
            totals.write(self.state_dir, known)
        else:
            totals.write(self.state_dir, self.totals())
        (self.state_dir / checkpoint.PENDING).unlink()
        self.store.delete(name)
        return Outcome(sum(r.n for r in dates), written, last)

    def tick(self) -> int:
        """Expire sessions that are over age, also while no events come. Not while a batch is being stored."""
        if not self.clock:
            return 0
        with self.lock:
            self.recover()
            known = self.totals()
            old = age(self.store.sessions([tuple(p) for p in known.open]), self._now(), self.expire_hours).drop("team_safe", "dt").persist()
            try:
                n = old.count()
                if n:
                    totals.forget(self.state_dir)  # until the change is stored
                    known.add_sessions(self.store.upsert(old))
                    totals.write(self.state_dir, known)
            finally:
                old.unpersist()
            return n

    def finish(self) -> None:
        """After a flush: cap and manifest; neither failing stops the collector."""
        try:
            if self.max_bytes:
                self.enforce_cap(self.max_bytes)
            self.write_manifest()
        except Exception:
            log.exception("cap or manifest failed")

    def backfill(self, wire: DataFrame, first: str = "0", last: str = "+") -> Outcome:
        """Replay a range; what is stored already is skipped and the checkpoint never goes back."""
        return self.batch(range_scan(wire, first, last))

    def follow(self, wire_stream: DataFrame, location: str, once: bool = True, max_idle_ms: int | None = None, poll_s: float = 1.0, max_reads: int | None = None) -> None:
        """Run a stream of wire entries until it is drained (once), quiet for max_idle_ms, or read max_reads times; empty reads count.

        A batch beyond max_reads is refused before anything of it is stored, so the stream brings it again.
        """
        self.start()
        reads = Reads(max_reads)

        def take(df: DataFrame, batch_id: int) -> None:
            with self.lock:
                if not reads.more():
                    raise StopReading
                self.batch(df, batch_id)
                reads.done(True)

        interval, had = "spark.sql.streaming.noDataProgressEventInterval", self.spark.conf.get("spark.sql.streaming.noDataProgressEventInterval", "10s")
        self.spark.conf.set(interval, f"{max(1, int(poll_s * 900))}ms")
        listener = IdleListener(reads)
        self.spark.streams.addListener(listener)
        try:
            writer = wire_stream.writeStream.foreachBatch(take).option("checkpointLocation", location)
            query = (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=f"{poll_s} seconds")).start()
            try:
                while not query.awaitTermination(min(poll_s, 0.2)):
                    if reads.passed():
                        self.tick()
                    if not reads.more():
                        break
                    if max_idle_ms is not None and reads.count and reads.quiet_s() * 1000 >= max_idle_ms:
                        break
            except StreamingQueryException as error:
                if StopReading.__name__ not in str(error):
                    raise
            finally:
                with self.lock:  # a batch on its way is stored whole, no other begins
                    reads.most = reads.count
                query.stop()
            if once:
                self.tick()
        finally:
            self.spark.streams.removeListener(listener)
            self.spark.conf.set(interval, had)

    def enforce_cap(self, cap: int) -> dict[str, int]:
        """Bring the dataset under cap bytes: whole dates, then events of the newest; what went is in the drop log."""
        known, other = self.totals(), self.store.other_bytes()
        per_date = known.per_date()
        if sum(per_date.values()) + other <= cap:
            return {"dates_deleted": 0, "events_trimmed": 0}
        sizes = self.spark.createDataFrame(sorted(per_date.items()), "dt string, bytes long")
        gone = dates_to_evict(sizes, max(0, cap - other)).where("evicted").orderBy("dt").collect()  # one row a date
        totals.forget(self.state_dir)
        entries = []
        for r in gone:
            self.store.drop_date(r.dt)
            entries.append({"when": self._stamp(), "scope": "date", "date": r.dt, "bytes_freed": r.bytes})
        trimmed = 0
        raw, own = self.store.lines(), self.store.session_lines()
        left = {dt: n for dt, n in per_date.items() if dt not in {r.dt for r in gone}}
        if len(left) == 1 and sum(left.values()) + other > cap:
            # written down, as a cache of it would be dropped and made anew once the views below are rewritten
            name = f".trim-{uuid.uuid4().hex}"
            found = events_to_trim(raw, own, max(0, cap - other))
            found.write.parquet(self.store.path(name))
            events = self.spark.read.schema(found.schema).parquet(self.store.path(name))
            trimmed = events.count()
            if trimmed:
                kept = kept_raw(raw, events)
                self.store.overwrite(kept.where("view = 'office'").select(F.col("line").alias("value"), "dt"), "raw", ["dt"])
                self.store.overwrite(kept.where("view <> 'office'").select(F.col("line").alias("value"), F.col("team").alias("team_safe"), "dt"), "team_raw", ["team_safe", "dt"])
                self.store.overwrite(kept_sessions(own, events).select(F.col("line").alias("value"), F.col("team").alias("team_safe"), "dt"), "sessions", ["team_safe", "dt"])
                newest = events.orderBy(parse_id(F.col("stream_id")).desc()).limit(100).collect()
                entries += [{"when": self._stamp(), "scope": "today", "stream_id": r.stream_id, "bytes_freed": r.bytes_freed} for r in reversed(newest)]
            self.store.delete(name)
        totals.write(self.state_dir, self.totals())
        if entries:
            checkpoint.append_drop_log(self.state_dir, entries)
        return {"dates_deleted": len(gone), "events_trimmed": trimmed}

    @staticmethod
    def _stamp() -> str:
        return time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime())

    def manifest(self) -> dict:
        """What the dataset holds, in the order of its keys; reads only, and from the sums."""
        held = self.totals()
        known = lambda x: None if x == "0" else x
        states = {state: held.states.get(state, 0) for state in STATES}
        return {
            "plugin_version": VERSION, "redis_url": python_redact_url(self.redis_url), "stream": self.stream, "checkpoint": known(held.checkpoint), "last_flush_stream_id": known(held.last),
            "event_count": held.events, "session_count": sum(states.values()), "per_dt_bytes": dict(sorted(held.office.items())), "session_states": dict(sorted(states.items())),
            "drop_log": checkpoint.load_drop_log(self.state_dir), "discovered_teams": sorted(held.teams), "bytes_used": sum(held.per_date().values()) + self.store.other_bytes(),
            "max_mb": (self.max_bytes or 0) // (1024 * 1024),
        }

    def write_manifest(self) -> None:
        checkpoint.replace_file(self.state_dir / checkpoint.MANIFEST, json.dumps(self.manifest()))


def status_lines(manifest: dict) -> list[str]:
    """A manifest for people: `key: value`."""
    plain = lambda v: v if isinstance(v, str) else json.dumps(v, separators=(",", ":"))
    return [f"{k}: {plain(v)}" for k, v in manifest.items()]


def follow_events(spark: SparkSession, sf_dir: str, files: int = 3) -> DataFrame:
    """Events as a stream of files, followed in micro-batches; the session table that comes out. Nothing expires."""
    from tidewheel.plans.queries import wire

    folder = shared_folder(spark, "follow")
    entries = wire(spark, sf_dir)
    ordered = entries.withColumn("id", parse_id(F.col("stream_id")))
    cuts = ordered.agg(F.percentile_approx(F.col("id.ms").cast("double"), [k / files for k in range(1, files)])).first()[0] or []
    slot = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c < F.col("id.ms").cast("double"))) if cuts else F.lit(0)
    collector = Collector(spark, Store(spark, f"{folder}/data"), Path(tempfile.mkdtemp(prefix="tidewheel-state-")))
    for k in range(files):  # the files of a slot come together, and are the next micro-batch
        ordered.where(slot == k).select("stream_id", "fields").write.mode("append").json(f"{folder}/wire")
        collector.follow(spark.readStream.schema(WIRE_SCHEMA).json(f"{folder}/wire"), f"{folder}/offsets")
    return collector.store.sessions()


def backfill_events(spark: SparkSession, sf_dir: str, first: str, last: str) -> DataFrame:
    """A range of events replayed twice into a new dataset (the second time adds nothing); events by team and date."""
    from tidewheel.plans.queries import wire

    folder = shared_folder(spark, "backfill")
    collector = Collector(spark, Store(spark, f"{folder}/data"), Path(tempfile.mkdtemp(prefix="tidewheel-state-")))
    entries = wire(spark, sf_dir)
    collector.backfill(entries, first, last)
    collector.backfill(entries, first, last)
    return collector.store.lines().where("view <> 'office'").groupBy("team", "dt").agg(F.count("*").alias("n_events")).select("team", "dt", "n_events")
