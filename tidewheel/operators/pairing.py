"""Pairing: every task start with the first later finish of the same team, actor and session id, first in first out.

The queue has a closed form over window functions. In id order, with +1 for a start and -1 for a finish, the running sum S of
a key falls below all earlier values (and 0) exactly at finishes that find the queue empty. The r-th start and the r-th of the
other finishes belong together. A start without one is interrupted if its team and actor start again later, else expired or
open by its age.

Running sums, minima and ranks are taken within chunks of time of a key and over the totals of chunks (a row for each), so no
task has more of a busy actor than one chunk. Edges are written down once, as three steps read them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewheel.functions.ids import parse_id
from tidewheel.functions.names import session_pk, team_safe
from tidewheel.functions.payload import payload_handoff, payload_refs, payload_session_id, payload_snippet, union_refs
from tidewheel.functions.times import date_of, millis_between, resolve, rfc3339, to_rfc3339
from tidewheel.session import shared_folder, written

STARTED, FINISHED = "task.started", "task.finished"
STATES = ("completed", "open", "interrupted", "orphan_finish", "expired")
SESSION_SCHEMA = (
    "session_pk string, team string, actor string, session_id string, start_stream_id string, finish_stream_id string, started_at string, finished_at string, duration_ms long, "
    "state string, snippet_in string, snippet_out string, issues array<string>, prs array<string>, linear array<string>, handoff string, project string"
)
SESSION_COLUMNS = [part.split(" ")[0] for part in SESSION_SCHEMA.split(", ")]
#: Milliseconds of the chunks that a key's edges are cut into: a day.
CHUNK_MS = 86_400_000
_REFS = ("issues", "prs", "linear")
_EDGE = ["team", "actor", "sid", "session_id", "id", "step", "stream_id", "at", "snippet", *_REFS, "handoff", "project", "was"]


def edges(events: DataFrame) -> DataFrame:
    """Starts (+1) and finishes (-1) among decoded events; ids that don't parse order nothing and are left out."""
    c = F.col
    rows = events.where(c("action").isin(STARTED, FINISHED))
    return rows.select(
        F.coalesce("team", F.lit("")).alias("team"),
        F.coalesce("actor", F.lit("")).alias("actor"),
        F.coalesce(payload_session_id(c("payload")), F.lit("")).alias("sid"),
        payload_session_id(c("payload")).alias("session_id"),
        parse_id(c("stream_id")).alias("id"),
        F.when(c("action") == STARTED, 1).otherwise(-1).alias("step"),
        "stream_id",
        resolve(c("stream_id"), c("ts")).alias("at"),
        payload_snippet(c("payload")).alias("snippet"),
        *(payload_refs(c("payload"), r).alias(r) for r in _REFS),
        payload_handoff(c("payload")).alias("handoff"),
        "project",
        F.lit(None).cast("string").alias("was"),
    ).where("id is not null")


def pool_edges(sessions: DataFrame) -> DataFrame:
    """Open and interrupted sessions as starts that wait since an earlier run."""
    return sessions.where(F.col("state").isin("open", "interrupted") & F.col("start_stream_id").isNotNull()).select(
        "team", "actor", F.coalesce("session_id", F.lit("")).alias("sid"), "session_id", parse_id(F.col("start_stream_id")).alias("id"), F.lit(1).alias("step"), F.col("start_stream_id").alias("stream_id"),
        rfc3339(F.col("started_at")).alias("at"), F.col("snippet_in").alias("snippet"), *_REFS, F.lit(None).cast("string").alias("handoff"), "project", F.col("state").alias("was"),
    )


def pair_edges(rows: DataFrame, now: Column | None = None, expire_hours: float = 6.0, chunk_ms: int = CHUNK_MS, folder: str | None = None) -> DataFrame:
    """Sessions of edges. now: expires starts that are older than the window then; without it none expire.

    chunk_ms: milliseconds of a chunk; any number gives the same sessions. folder: where the edges are written.
    """
    spark = rows.sparkSession
    key = ["team", "actor", "sid"]
    part = [*key, "chunk"]
    chunked = rows.select(*_EDGE).withColumn("chunk", F.floor(F.col("id.ms") / F.lit(chunk_ms)))
    rows = written(chunked, folder or shared_folder(spark, "edges")).repartition(*part)
    by_id, before = W.partitionBy(*part).orderBy("id"), W.partitionBy(*key).orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("__depth", F.sum("step").over(by_id.rowsBetween(W.unboundedPreceding, 0)))
    sums = rows.groupBy(*part).agg(F.sum("step").alias("__total"), F.min("__depth").alias("__lowest"))
    sums = sums.withColumn("__base", F.coalesce(F.sum("__total").over(before), F.lit(0)))
    sums = sums.withColumn("__floor", F.min(F.col("__base") + F.col("__lowest")).over(before)).drop("__total", "__lowest")
    rows = rows.withColumn("__low", F.min("__depth").over(by_id.rowsBetween(W.unboundedPreceding, -1))).join(sums, part)
    lowest = F.least(F.col("__base") + F.col("__low"), F.col("__floor"), F.lit(0))
    rows = rows.withColumn("orphan", (F.col("step") == -1) & (F.col("__base") + F.col("__depth") < lowest))
    side = [*part, "step", "orphan"]
    counts = rows.groupBy(*side).agg(F.count("*").alias("__n"))
    taken = counts.withColumn("__taken", F.coalesce(F.sum("__n").over(W.partitionBy(*key, "step", "orphan").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("__n")
    rows = rows.withColumn("rank", F.row_number().over(W.partitionBy(*side).orderBy("id"))).join(taken, side).withColumn("rank", F.col("rank") + F.col("__taken"))
    start, finish = F.col("step") == 1, F.col("step") == -1
    last = rows.where(start).groupBy("team", "actor").agg(F.max("id").alias("last_start"))
    at = lambda which, name: F.max(F.when(which, F.struct(F.col("id"), F.col(name).alias("v"))))["v"]
    met = rows.groupBy(*key, "rank", "orphan").agg(
        at(start, "stream_id").alias("start_stream_id"), at(finish, "stream_id").alias("finish_stream_id"), at(start, "at").alias("start_at"), at(finish, "at").alias("finish_at"),
        at(start, "session_id").alias("start_sid"), at(finish, "session_id").alias("finish_sid"), at(start, "snippet").alias("snippet_in"), at(finish, "snippet").alias("snippet_out"),
        *(at(start, r).alias(f"start_{r}") for r in _REFS), *(at(finish, r).alias(f"finish_{r}") for r in _REFS),
        at(finish, "handoff").alias("handoff"), at(start, "project").alias("start_project"), at(finish, "project").alias("finish_project"), at(start, "was").alias("was"),
        F.max(F.when(start, F.col("id"))).alias("started"),
    )
    met = met.join(last, ["team", "actor"], "left").withColumn("again", F.coalesce(F.col("started") < F.col("last_start"), F.lit(False)))
    c = F.col
    old = F.lit(False) if now is None else F.coalesce(F.unix_micros(now) - F.unix_micros(c("start_at")) > F.lit(int(expire_hours * 3_600_000_000)), F.lit(False))
    state = (
        F.when(c("start_stream_id").isNull(), "orphan_finish")
        .when(c("finish_stream_id").isNotNull(), "completed")
        .when((c("was") == "interrupted") | c("again"), "interrupted")
        .when(old, "expired")
        .otherwise("open")
    )
    return met.select(
        session_pk(c("team"), c("actor"), F.coalesce("start_stream_id", "finish_stream_id")).alias("session_pk"),
        "team",
        "actor",
        F.when(c("start_stream_id").isNull(), c("finish_sid")).otherwise(c("start_sid")).alias("session_id"),
        "start_stream_id",
        "finish_stream_id",
        to_rfc3339(c("start_at")).alias("started_at"),
        to_rfc3339(c("finish_at")).alias("finished_at"),
        F.when(c("start_stream_id").isNotNull() & c("finish_stream_id").isNotNull(), millis_between(c("start_at"), c("finish_at"))).alias("duration_ms"),
        state.alias("state"),
        "snippet_in",
        "snippet_out",
        *(union_refs(c(f"start_{r}"), c(f"finish_{r}")).alias(r) for r in _REFS),
        "handoff",
        F.coalesce("start_project", "finish_project").alias("project"),
    )


def pair_sessions(events: DataFrame, pool: DataFrame | None = None, now: Column | None = None, expire_hours: float = 6.0, chunk_ms: int = CHUNK_MS, folder: str | None = None) -> DataFrame:
    """Sessions of decoded events and of the pool of earlier runs."""
    rows = edges(events)
    return pair_edges(rows if pool is None else rows.unionByName(pool_edges(pool)), now, expire_hours, chunk_ms, folder)


def age(sessions: DataFrame, now: Column, expire_hours: float = 6.0) -> DataFrame:
    """The open sessions that are over age at now, as expired. Interrupted ones never expire."""
    old = F.unix_micros(now) - F.unix_micros(rfc3339(F.col("started_at"))) > F.lit(int(expire_hours * 3_600_000_000))
    return sessions.where((F.col("state") == "open") & old).withColumn("state", F.lit("expired"))


def with_location(sessions: DataFrame) -> DataFrame:
    """Adds team_safe and dt, the partition of a session: the date it started, or finished if it never did."""
    at = F.coalesce(rfc3339(F.col("started_at")), rfc3339(F.col("finished_at")), F.timestamp_seconds(F.lit(0)))
    return sessions.withColumn("team_safe", team_safe(F.col("team"), F.col("actor"))).withColumn("dt", date_of(at))


def latest(rows: DataFrame, order: Column) -> DataFrame:
    """The last row of each session_pk by order: a later write replaces an earlier one. Partial aggregation, so a key written often costs a row per task."""
    return rows.groupBy("session_pk").agg(F.max_by(F.struct(*[c for c in rows.columns if c != "session_pk"]), order).alias("r")).select("session_pk", "r.*")


def session_order() -> list[Column]:
    """Order of a session file: by start (or finish) id, none first, then key."""
    return [parse_id(F.coalesce("start_stream_id", "finish_stream_id")).asc_nulls_first(), F.col("session_pk").asc()]
