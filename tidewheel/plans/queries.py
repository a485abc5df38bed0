"""Queries over the driver's events, one for each group of operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.functions.ids import parse_id
from tidewheel.functions.names import max_mb, redact_url, session_pk, team_safe
from tidewheel.functions.payload import payload_handoff, payload_refs, payload_snippet, union_refs
from tidewheel.functions.times import dt_for, epoch_to_rfc3339, resolve, to_rfc3339
from tidewheel.operators.decode import decode
from tidewheel.operators.manifest import discovered_teams, event_counts, state_counts
from tidewheel.operators.pairing import latest, pair_sessions, with_location
from tidewheel.operators.retention import bytes_per_dt, dates_to_evict, events_to_trim, kept_raw, line_bytes, ring
from tidewheel.sources.events import after, events_table, max_id, range_scan, wire_from_events

NOW = "2024-01-31 00:00:00"
SPLIT_MS = 1705276800000  # 2024-01-15


def wire(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wire_from_events(events_table(spark, sf_dir))


def decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode(wire(spark, sf_dir))


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pair_sessions(decoded(spark, sf_dir), now=F.lit(NOW).cast("timestamp"))


def decode_raw(spark, sf_dir):
    rows = decoded(spark, sf_dir)
    fields = F.array_join(F.transform(F.map_entries("fields"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
    return rows.select("stream_id", "envelope_id", "ts", "actor", "action", "target", "team", "project", F.to_json("payload").alias("payload"), fields.alias("fields"), "decode_ok")


def decode_envelopes(spark, sf_dir):
    """Envelopes of every kind, made from events: valid, under the second key, broken, no object, with trailing text."""
    e = events_table(spark, sf_dir)
    k = F.col("event_id") % 6
    own = F.concat(F.lit('{"id":"e'), "event_id", F.lit('","actor":"a'), F.col("user_id") % 3, F.lit('","team":"","payload":{"session_id":"s","task_ref":{"issues":["I1",2,"I2"]}}}'))
    text = F.when(k == 1, F.lit("{broken")).when(k == 2, F.lit("[1,2,3]")).when(k == 3, F.concat(own, F.lit(" x"))).otherwise(own)
    fields = F.when(k == 4, F.create_map(F.lit("envelope"), text, F.lit("actor"), F.lit("flat"), F.lit("team"), F.lit("t1"))).when(
        k == 5, F.create_map(F.lit("snippet"), F.lit("hi"), F.lit("task_ref"), F.lit('{"prs":["P1"]}'), F.lit("handoff"), F.lit("plain"))
    ).otherwise(F.create_map(F.lit("json"), text, F.lit("actor"), F.lit("flat"), F.lit("team"), F.lit("t1")))
    rows = decode(e.select(F.concat(F.col("event_id") + 1, F.lit("-0")).alias("stream_id"), fields.alias("fields")))
    return rows.select("stream_id", "envelope_id", "actor", "team", F.to_json("payload").alias("payload"), "decode_ok", "decode_error")


def stream_id_order(spark, sf_dir):
    e = events_table(spark, sf_dir)
    text = F.when(F.col("event_id") % 50 == 0, F.concat(F.lit("x"), "event_id")).when(F.col("event_id") % 50 == 1, F.lit("0")).otherwise(F.concat(F.col("event_id") % 1000, F.lit("-"), F.col("user_id")))
    rows = e.select(text.alias("stream_id")).distinct().withColumn("id", parse_id(F.col("stream_id")))
    return rows.select("stream_id", F.col("id").isNotNull().alias("valid"), F.col("id.ms").cast("string").alias("ms"), F.col("id.seq").cast("string").alias("seq"))


def dt_partition_counts(spark, sf_dir):
    rows = decoded(spark, sf_dir)
    ts = F.when(parse_id(F.col("stream_id"))["seq"] % 3 == 0, F.lit("not-a-date")).otherwise(F.col("ts"))
    return rows.groupBy(dt_for(F.col("stream_id"), ts).alias("dt")).agg(F.count("*").alias("n"))


def resolved_times(spark, sf_dir):
    rows = decoded(spark, sf_dir)
    seq = parse_id(F.col("stream_id"))["seq"].cast("long")
    ts = F.when(seq % 3 == 0, F.lit("2026")).when(seq % 3 == 1, F.regexp_replace("ts", "Z$", "+02:00")).otherwise(F.col("ts"))
    return rows.select("stream_id", to_rfc3339(resolve(F.col("stream_id"), ts)).alias("at"), epoch_to_rfc3339(seq).alias("seconds"))


def team_safe_names(spark, sf_dir):
    e = events_table(spark, sf_dir)
    k = F.col("event_id") % 7
    team = F.when(k == 0, "").when(k == 1, F.concat(F.lit("Dev Team/"), F.col("user_id"))).when(k == 2, F.concat(F.lit("..."), F.col("event_type"), F.lit("é"))).when(
        k == 3, F.concat(F.repeat(F.lit("."), F.lit(10)), F.repeat(F.lit("ab"), F.lit(50)))).when(k == 4, F.concat(F.repeat(F.lit("x"), F.lit(63)), F.lit("  y"))).when(k == 5, "///").otherwise(F.col("event_type"))
    actor = F.when(F.col("user_id") % 2 == 0, "system").otherwise("developer")
    return e.select("event_id", team_safe(team, actor).alias("team_safe"))


def range_scan_query(spark, sf_dir):
    return range_scan(wire(spark, sf_dir), "1704672000000-0", f"{SPLIT_MS}-0").select("stream_id", F.col("fields")["action"].alias("action"))


def dedupe_after_checkpoint(spark, sf_dir):
    return after(wire(spark, sf_dir), f"{SPLIT_MS}-0").select("stream_id")


def resume_point(spark, sf_dir):
    return max_id(wire(spark, sf_dir))


def pair_sessions_query(spark, sf_dir):
    columns = ["session_pk", "team", "actor", "session_id", "start_stream_id", "finish_stream_id", "started_at", "finished_at", "duration_ms", "state", "project"]
    return sessions(spark, sf_dir).select(*columns)


def pair_with_pool(spark, sf_dir):
    """The first half of the stream paired, then the second half with what waits from the first: no expiry, so the same as one run."""
    rows = decoded(spark, sf_dir)
    early = parse_id(F.col("stream_id"))["ms"] < SPLIT_MS
    first = pair_sessions(rows.where(early))
    second = pair_sessions(rows.where(~early), pool=first)
    closed = first.where(~F.col("state").isin("open", "interrupted"))
    return closed.unionByName(second).select("session_pk", "start_stream_id", "finish_stream_id", "state")


def interrupted_starts(spark, sf_dir):
    return sessions(spark, sf_dir).where("state = 'interrupted'").select("start_stream_id", "team", "actor")


def expired_sessions(spark, sf_dir):
    return sessions(spark, sf_dir).where("state = 'expired'").select("start_stream_id", "started_at")


def orphan_finishes(spark, sf_dir):
    return sessions(spark, sf_dir).where("state = 'orphan_finish'").select("finish_stream_id", "finished_at", "session_id")


def session_pk_query(spark, sf_dir):
    e = events_table(spark, sf_dir)
    actor = F.when(F.col("event_id") % 5 != 0, F.concat(F.lit("u"), F.col("user_id")))
    return e.select("event_id", session_pk(F.concat(F.lit("team-"), F.col("user_id") % 5), actor, F.col("event_id").cast("string")).alias("pk"))


def session_payloads(spark, sf_dir):
    """What sessions take from payloads: references of both ends, snippets, handoffs."""
    e = events_table(spark, sf_dir)
    text = F.concat(F.lit('{"snippet":"'), "event_type", F.lit('","task_ref":{"issues":["a'), F.col("event_id") % 3, F.lit('",7,"b"]},"handoff":'), F.when(F.col("event_id") % 3 == 0, F.lit("null")).when(F.col("event_id") % 3 == 1, F.lit('{"to":"x"}')).otherwise(F.lit('"done"')), F.lit("}"))
    p = F.parse_json(text)
    both = union_refs(payload_refs(p, "issues"), F.array(F.lit("b"), F.lit("c")))
    return e.select("event_id", payload_snippet(p).alias("snippet"), payload_handoff(p).alias("handoff"), F.array_join(both, ",").alias("issues"), F.array_join(payload_refs(p, "prs"), ",").alias("prs"))


def latest_upsert(spark, sf_dir):
    e = events_table(spark, sf_dir)
    rows = e.select(F.concat(F.lit("pk"), F.col("user_id")).alias("session_pk"), F.col("event_type").alias("state"), F.col("event_id").alias("seq"))
    return latest(rows, F.col("seq")).select("session_pk", "state", "seq")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw lines in the office's view and in that of their team, in a short form."""
    rows = decoded(spark, sf_dir)
    line = F.concat(F.lit('{"stream_id":"'), "stream_id", F.lit('","action":"'), "action", F.lit('","ts":"'), "ts", F.lit('","team":"'), "team", F.lit('"}'))
    one = rows.select(F.explode(F.array(F.lit("office"), F.col("team"))).alias("view"), "team", dt_for(F.col("stream_id"), F.col("ts")).alias("dt"), "stream_id", line.alias("line"))
    return one


def manifest_event_counts(spark, sf_dir):
    return event_counts(lines(spark, sf_dir))


def session_state_counts(spark, sf_dir):
    return state_counts(sessions(spark, sf_dir))


def discovered_teams_query(spark, sf_dir):
    return discovered_teams(decoded(spark, sf_dir), sessions(spark, sf_dir))


def bytes_per_dt_query(spark, sf_dir):
    return bytes_per_dt(lines(spark, sf_dir).where("view = 'office'"))


def cap_evict_dates(spark, sf_dir):
    own = lines(spark, sf_dir).groupBy("dt").agg(F.sum(line_bytes(F.col("line"))).alias("bytes"))
    return dates_to_evict(own, _cap(spark, sf_dir))


def _cap(spark: SparkSession, sf_dir: str) -> int:
    """A cap that about 40 % of the lines fit."""
    return 40 * 2 * events_table(spark, sf_dir).count()


def last_date(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Raw and session lines of the newest date."""
    raw, own = lines(spark, sf_dir), with_location(sessions(spark, sf_dir))
    newest = raw.agg(F.max("dt")).first()[0]
    raw, own = raw.where(F.col("dt") == newest), own.where(F.col("dt") == newest)
    none = F.lit("")
    line = F.concat(F.lit('{"session_pk":"'), "session_pk", F.lit('","state":"'), "state", F.lit('","start":"'), F.coalesce("start_stream_id", none), F.lit('","finish":"'), F.coalesce("finish_stream_id", none), F.lit('"}'))
    return raw, own.select("team", "session_pk", "state", "start_stream_id", "finish_stream_id", line.alias("line"))


def _trim_cap(spark: SparkSession, sf_dir: str) -> int:
    return 3 * events_table(spark, sf_dir).count()


def cap_trim_events(spark, sf_dir):
    raw, own = last_date(spark, sf_dir)
    return events_to_trim(raw, own, _trim_cap(spark, sf_dir))


def drop_log_ring(spark, sf_dir):
    e = events_table(spark, sf_dir).where("event_type = 'error'")
    return ring(e.select(F.col("event_id").alias("seq"), F.col("event_type").alias("scope"), F.octet_length("props").alias("bytes_freed")))


def redact_url_query(spark, sf_dir):
    e = events_table(spark, sf_dir)
    k = F.col("event_id") % 4
    host = F.concat(F.lit("10.0.0."), F.col("user_id") % 250)
    url = F.when(k == 0, F.concat(F.lit("redis://:p@ss@"), host, F.lit(":6379/0"))).when(k == 1, F.concat(F.lit("redis://"), host, F.lit("/0?x=a@b"))).when(k == 2, F.concat(F.lit("rediss://u:p@"), host)).otherwise(F.concat(host, F.lit("@x")))
    return e.select("event_id", redact_url(url).alias("url"))


def max_mb_query(spark, sf_dir):
    e = events_table(spark, sf_dir)
    asked = F.when(F.col("event_id") % 10 != 0, F.col("event_id") % 40 - 5)
    return e.select("event_id", max_mb(asked).cast("long").alias("mb"))


def follow_microbatch(spark, sf_dir):
    """The stream followed in micro-batches to a dataset; its sessions."""
    from tidewheel.streaming.follow import follow_events

    return follow_events(spark, sf_dir).select("session_pk", "start_stream_id", "finish_stream_id", "state")


def backfill_range(spark, sf_dir):
    """A range of the stream replayed to a dataset; what it wrote, by partition."""
    from tidewheel.streaming.follow import backfill_events

    return backfill_events(spark, sf_dir, "0", f"{SPLIT_MS}-0")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "pair_sessions": pair_sessions_query,
        "pair_with_pool": pair_with_pool,
        "decode_raw": decode_raw,
        "decode_envelopes": decode_envelopes,
        "stream_id_order": stream_id_order,
        "dt_partition_counts": dt_partition_counts,
        "resolved_times": resolved_times,
        "team_safe_names": team_safe_names,
        "range_scan": range_scan_query,
        "dedupe_after_checkpoint": dedupe_after_checkpoint,
        "resume_point": resume_point,
        "interrupted_starts": interrupted_starts,
        "expired_sessions": expired_sessions,
        "orphan_finishes": orphan_finishes,
        "session_pk": session_pk_query,
        "session_payloads": session_payloads,
        "latest_upsert": latest_upsert,
        "manifest_event_counts": manifest_event_counts,
        "session_state_counts": session_state_counts,
        "discovered_teams": discovered_teams_query,
        "bytes_per_dt": bytes_per_dt_query,
        "cap_evict_dates": cap_evict_dates,
        "cap_trim_events": cap_trim_events,
        "drop_log_ring": drop_log_ring,
        "redact_url": redact_url_query,
        "max_mb": max_mb_query,
        "follow_microbatch": follow_microbatch,
        "backfill_range": backfill_range,
    }
