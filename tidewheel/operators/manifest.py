"""What a dataset holds: counts, bytes, states and teams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.operators.pairing import STATES
from tidewheel.operators.retention import line_bytes


def event_counts(lines: DataFrame) -> DataFrame:
    """One row: event_count (office lines, malformed ones too) and bytes_used (all lines)."""
    office = F.col("view") == "office"
    return lines.agg(F.count(F.when(office, 1)).alias("event_count"), F.coalesce(F.sum(line_bytes(F.col("line"))), F.lit(0)).cast("long").alias("bytes_used"))


def state_counts(sessions: DataFrame) -> DataFrame:
    """(state, n) with every state, those without sessions too."""
    known = sessions.sparkSession.createDataFrame([(s,) for s in STATES], "state string")
    counted = sessions.groupBy("state").agg(F.count("*").alias("n"))
    return F.broadcast(known).join(counted, "state", "left").select("state", F.coalesce("n", F.lit(0)).alias("n"))


def discovered_teams(raw: DataFrame, sessions: DataFrame) -> DataFrame:
    """Trimmed names of teams in events or sessions, each once, without blank ones."""
    both = raw.select(F.trim("team").alias("team")).union(sessions.select(F.trim("team").alias("team")))
    return both.where("team <> ''").distinct()
