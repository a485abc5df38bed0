"""The driver's events table as wire entries, and scans of wire entries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.functions.ids import id_literal, is_valid_id, parse_id, python_id
from tidewheel.session import configure

ACTIONS = {"signup": "task.started", "purchase": "task.finished"}


def events_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/events.parquet")


def wire_from_events(events: DataFrame) -> DataFrame:
    """(stream_id, fields): signup starts a task, purchase finishes one; props are the payload, with a session id for most."""
    ts = F.col("ts").cast("timestamp")
    n = F.get_json_object("props", "$.k").cast("long")
    action = F.col("event_type")
    for kind, task in ACTIONS.items():
        action = F.when(F.col("event_type") == kind, task).otherwise(action)
    session = F.when(n % 4 != 0, F.concat(F.lit(',"session_id":"s'), (n % 2).cast("string"), F.lit('"'))).otherwise("")
    fields = F.create_map(
        F.lit("action"), action,
        F.lit("actor"), F.concat(F.lit("u"), F.col("user_id")),
        F.lit("payload"), F.concat(F.lit('{"k":'), n, session, F.lit("}")),
        F.lit("team"), F.concat(F.lit("team-"), F.col("user_id") % 5),
        F.lit("timestamp"), F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"),
    )
    return events.select(F.concat(F.unix_millis(ts), F.lit("-"), F.col("event_id")).alias("stream_id"), fields.alias("fields"))


def wire_from_json(spark: SparkSession, path: str) -> DataFrame:
    """Entries from JSON lines {"stream_id": ..., "fields": {...}}; lines that are no such object are dropped."""
    return configure(spark).read.schema("stream_id string, fields map<string,string>").option("mode", "DROPMALFORMED").json(path).where("stream_id is not null")


def coerce_text(value: Column) -> Column:
    """Bytes of a field as text; what is no UTF-8 becomes the replacement character."""
    return F.make_valid_utf8(value.cast("string"))


def check_bound(bound: str) -> str:
    """`-` and `0` are the first id, `+` the last; anything else must be an id."""
    if bound in ("-", "+") or python_id(bound) is not None:
        return bound
    raise ValueError(f"no stream id: {bound!r}")


def range_scan(wire: DataFrame, first: str = "0", last: str = "+") -> DataFrame:
    """Entries with first <= id <= last."""
    first, last = check_bound(first), check_bound(last)
    found = wire.where(is_valid_id(F.col("stream_id")))
    if first not in ("-", "0"):
        found = wire.limit(0) if first == "+" else found.where(parse_id(F.col("stream_id")) >= id_literal(first))
    if last != "+":
        found = wire.limit(0) if last == "-" else found.where(parse_id(F.col("stream_id")) <= id_literal(last))
    return found


def after(wire: DataFrame, checkpoint: str) -> DataFrame:
    """Entries beyond a checkpoint; an id that doesn't parse fails the job, as order would be lost."""
    own = parse_id(F.col("stream_id"))
    checked = F.when(own.isNull(), F.raise_error(F.concat(F.lit("no stream id: "), F.coalesce("stream_id", F.lit("null")))).cast("boolean")).otherwise(own > id_literal(checkpoint))
    return wire.where(checked)


def max_id(rows: DataFrame, column: str = "stream_id") -> DataFrame:
    """One row, max_stream_id: the largest id as it was written; null without any."""
    own = parse_id(F.col(column))
    return rows.where(own.isNotNull()).agg(F.max_by(F.col(column), own).alias("max_stream_id"))
