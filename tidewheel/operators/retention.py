"""Retention under a byte cap: whole dates go first, oldest first; of the last date events go, oldest first.

Lines are rows (view, team, dt, stream_id, line) of raw views, `office` or a team's, and (team, dt, session_pk, state,
start_stream_id, finish_stream_id, line) of session views. A line's bytes include its line feed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewheel.functions.ids import parse_id

OFFICE = "office"
CLOSED = ("completed", "orphan_finish")
RING = 100


def line_bytes(line: Column) -> Column:
    return F.octet_length(line) + 1


def cap_bytes(megabytes: int) -> int:
    return min(megabytes * 1024 * 1024, 2**63 - 1)


def bytes_per_dt(lines: DataFrame) -> DataFrame:
    return lines.groupBy("dt").agg(F.sum(line_bytes(F.col("line"))).alias("bytes"), F.count("*").alias("n_lines"))


def dates_to_evict(per_date: DataFrame, cap: int) -> DataFrame:
    """(dt, bytes) to (dt, bytes, evicted): while the rest is over the cap the oldest date goes, but never the newest.

    One row for each date, so the running sum over all dates is small.
    """
    order = W.orderBy("dt")
    total, before = F.sum("bytes").over(W.partitionBy()), F.coalesce(F.sum("bytes").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return per_date.select("dt", "bytes", ((total - before > cap) & (F.col("dt") < F.max("dt").over(W.partitionBy()))).alias("evicted"))


def events_to_trim(raw: DataFrame, sessions: DataFrame, cap: int, chunks: int = 256) -> DataFrame:
    """Events of the one date left that go: (stream_id, bytes_freed), the shortest run of oldest events that meets the cap.

    An event goes from every raw view that holds it, with the closed sessions that start or finish at it and didn't go with
    an earlier event. No view is left without a line: at the first event where one would be, trimming ends. Running sums are
    taken in two levels, within ranges of events and over the sums of ranges, so no task sees all events.
    """
    raw = raw.withColumn("id", parse_id(F.col("stream_id"))).where("id is not null")
    office = raw.where(F.col("view") == OFFICE).select("stream_id", "id").distinct()
    every = raw.select("stream_id", "id").distinct()
    ids = office if not office.isEmpty() else every
    single = raw.join(ids.select("stream_id"), "stream_id", "left_semi").groupBy("view", "stream_id", "id").agg(F.min_by(line_bytes(F.col("line")), F.col("line")).alias("b"))
    lines_of = raw.groupBy("view").agg(F.count("*").alias("lines"))
    closed = sessions.where(F.col("state").isin(*CLOSED)).select("team", "session_pk", line_bytes(F.col("line")).alias("b"), F.explode(F.array_compact(F.array("start_stream_id", "finish_stream_id"))).alias("stream_id"))
    first = closed.join(ids, "stream_id").groupBy("team", "session_pk").agg(F.min("id").alias("id"), F.min_by("stream_id", "id").alias("stream_id"), F.max("b").alias("b"))
    rows_of = sessions.groupBy("team").agg(F.count("*").alias("lines"))
    gone = single.select(F.concat(F.lit("r:"), F.col("view")).alias("view"), "stream_id", "id", "b").union(first.groupBy("team", "stream_id", "id").agg(F.sum("b").alias("b"), F.count("*").alias("n")).select(F.concat(F.lit("s:"), F.col("team")), "stream_id", "id", "b"))
    size = lines_of.select(F.concat(F.lit("r:"), F.col("view")).alias("view"), "lines").union(rows_of.select(F.concat(F.lit("s:"), F.col("team")), "lines"))
    number = first.groupBy("team", "stream_id").agg(F.count("*").alias("n")).select(F.concat(F.lit("s:"), F.col("team")).alias("view"), "stream_id", "n")
    counted = gone.join(number, ["view", "stream_id"], "left").withColumn("n", F.coalesce("n", F.lit(1))).join(F.broadcast(size), "view")
    ranked = running(counted, "id", "n", "taken", chunks, by=["view"])
    # a raw view keeps its last line, a session view too: the event that would take it is guarded
    guarded = ranked.withColumn("guard", F.col("lines") - F.col("taken") < 1)
    per_event = guarded.groupBy("stream_id", "id").agg(F.sum("b").alias("bytes_freed"), F.max("guard").alias("guard"))
    per_event = running(per_event.withColumn("g", F.col("guard").cast("long")), "id", "bytes_freed", "freed", chunks)
    per_event = running(per_event, "id", "g", "guards", chunks)
    total = raw.agg(F.sum(line_bytes(F.col("line"))).alias("t")).union(sessions.agg(F.sum(line_bytes(F.col("line"))).alias("t"))).agg(F.coalesce(F.sum("t"), F.lit(0)).alias("total"))
    over = per_event.crossJoin(F.broadcast(total)).where((F.col("guards") == 0) & (F.col("total") - (F.col("freed") - F.col("bytes_freed")) > cap))  # one row
    return over.select("stream_id", "bytes_freed")


def running(rows: DataFrame, order: str, value: str, name: str, chunks: int, by: list[str] | None = None) -> DataFrame:
    """Adds the running sum of value by order (within by), as sums within chunks of the order plus the sums of chunks before.

    Chunks are ranges of the order found by quantiles of its milliseconds, so each holds a bounded share of the rows.
    """
    by = by or []
    ms = F.col(order)["ms"].cast("double")
    cuts = rows.agg(F.percentile_approx(ms, [k / chunks for k in range(1, chunks)], 10_000)).first()[0] or []
    cuts = sorted(set(cuts))
    chunk = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c < ms)) if cuts else F.lit(0)
    rows = rows.withColumn("__chunk", chunk)
    within = F.sum(value).over(W.partitionBy(*by, "__chunk").orderBy(order).rowsBetween(W.unboundedPreceding, 0))
    sums = rows.groupBy(*by, "__chunk").agg(F.sum(value).alias("__sum"))
    before = sums.select(*by, "__chunk", F.coalesce(F.sum("__sum").over(W.partitionBy(*by).orderBy("__chunk").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    joined = rows.withColumn("__within", within).join(before, [*by, "__chunk"])
    return joined.withColumn(name, F.col("__within") + F.col("__before")).drop("__chunk", "__within", "__before")


def kept_raw(raw: DataFrame, trimmed: DataFrame) -> DataFrame:
    """Raw lines that stay, byte for byte."""
    return raw.join(trimmed.select("stream_id"), "stream_id", "left_anti").select(raw.columns)


def kept_sessions(sessions: DataFrame, trimmed: DataFrame) -> DataFrame:
    """Session lines that stay: all but closed ones that start or finish at a trimmed event."""
    gone = trimmed.select(F.col("stream_id").alias("__e"))
    closed = F.col("state").isin(*CLOSED)
    first = sessions.join(gone, closed & (F.col("start_stream_id") == F.col("__e")), "left_anti")
    return first.join(gone, closed & (F.col("finish_stream_id") == F.col("__e")), "left_anti")


def ring(entries: DataFrame, order: str = "seq", size: int = RING) -> DataFrame:
    """The last `size` entries; a top-k, so nothing is gathered beyond it."""
    return entries.orderBy(F.desc(order)).limit(size)
