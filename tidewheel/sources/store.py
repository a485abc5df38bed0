"""The dataset: event lines in an office view by date and in team views by team and date, sessions by team and date.

    raw/dt=YYYY-MM-DD/            lines of all events
    team_raw/team_safe=T/dt=D/    the same lines by team
    sessions/team_safe=T/dt=D/    session lines
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidewheel.functions.ids import parse_id
from tidewheel.operators.pairing import SESSION_COLUMNS, SESSION_SCHEMA, latest, session_order, with_location
from tidewheel.sources.events import max_id

VIEWS = ("raw", "team_raw", "sessions")
SESSION_LINE = "value string, team_safe string, dt string"
#: Files of the dataset are private to their owner: a umask of its own, which a cached file system would not see.
PRIVATE = {"fs.permissions.umask-mode": "077", "fs.file.impl.disable.cache": "true"}
#: So many partitions are read by their paths; more by a scan that is joined with their names.
BY_PATH = 1000


class Store:
    """A dataset under a folder that all executors see."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, str(folder).rstrip("/")
        self.hadoop = spark._jvm.org.apache.hadoop.fs

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def _fs(self, path: str):
        own = self.hadoop.Path(path)
        return own.getFileSystem(self.spark._jsc.hadoopConfiguration()), own

    def exists(self, name: str) -> bool:
        files, path = self._fs(self.path(name))
        return files.exists(path)

    def holds(self, view: str) -> bool:
        """Whether a view has any partition."""
        files, path = self._fs(self.path(view))
        return files.exists(path) and any(status.isDirectory() for status in files.listStatus(path))

    def delete(self, name: str) -> bool:
        files, path = self._fs(self.path(name))
        return files.delete(path, True)

    def clean(self) -> None:
        """Remove what a stopped writer left beside the views: journals that were not complete, staged rows."""
        files, top = self._fs(self.folder)
        for status in files.listStatus(top) if files.exists(top) else []:
            if status.getPath().getName().startswith((".batch-", ".staging-", ".trim-")):
                files.delete(status.getPath(), True)

    def lines(self) -> DataFrame:
        """Every event line: view ('office' or a team's folder), team (folder, null in the office's view), dt, stream_id, line."""
        parts = []
        for name, schema in (("raw", "value string, dt string"), ("team_raw", "value string, team_safe string, dt string")):
            if self.holds(name):
                rows = self.spark.read.schema(schema).text(self.path(name))
                team = F.col("team_safe") if "team_safe" in rows.columns else F.lit(None).cast("string")
                parts.append(rows.select(F.coalesce(team, F.lit("office")).alias("view"), team.alias("team"), F.col("dt").cast("string").alias("dt"), F.get_json_object("value", "$.stream_id").alias("stream_id"), F.col("value").alias("line")))
        if not parts:
            return self.spark.createDataFrame([], "view string, team string, dt string, stream_id string, line string")
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def other_bytes(self) -> int:
        """Bytes of lines (*.jsonl) that lie in the folder, but in no view: counted, never trimmed."""
        files, top = self._fs(self.folder)
        if not files.exists(top):
            return 0
        total, todo = 0, [s for s in files.listStatus(top) if s.getPath().getName() not in VIEWS]
        while todo:
            status = todo.pop()
            if status.isDirectory():
                todo += files.listStatus(status.getPath())
            elif status.getPath().getName().endswith(".jsonl"):
                total += status.getLen()
        return total

    def repair(self) -> list[tuple[str, int]]:
        """Cut the partial last line of files whose writer was stopped; (path, bytes dropped) of those. One look at the end of each file, by all executors."""
        there = [self.path(v) for v in VIEWS if self.holds(v)]
        if not there:
            return []
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(there).where("length > 0").select("path")
        return [(r.path, r.dropped) for r in files.mapInArrow(_cut_partial_lines, "path string, dropped long").collect()]  # damaged files only

    def _at(self, name: str, schema: str, parts: list[tuple[str, str]]) -> DataFrame | None:
        """Lines of some partitions (team_safe, dt) of a view by team, of which no other is opened; None if none exists."""
        if len(parts) > BY_PATH:
            return self.spark.read.schema(schema).text(self.path(name)).join(F.broadcast(self.spark.createDataFrame(parts, "team_safe string, dt string")), ["team_safe", "dt"], "left_semi") if self.holds(name) else None
        escaped = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
        there = [p for p in (f"{name}/team_safe={escaped(team)}/dt={escaped(dt)}" for team, dt in parts) if self.exists(p)]
        return self.spark.read.schema(schema).option("basePath", self.path(name)).text([self.path(p) for p in there]) if there else None

    def session_lines(self) -> DataFrame:
        """Every session line: team (folder), dt, session_pk, state, start_stream_id, finish_stream_id, line."""
        if not self.holds("sessions"):
            return self.spark.createDataFrame([], "team string, dt string, session_pk string, state string, start_stream_id string, finish_stream_id string, line string")
        rows = self.spark.read.schema(SESSION_LINE).text(self.path("sessions"))
        keys = ("session_pk", "state", "start_stream_id", "finish_stream_id")
        return rows.select(F.col("team_safe").alias("team"), F.col("dt").cast("string").alias("dt"), *(F.get_json_object("value", f"$.{k}").alias(k) for k in keys), F.col("value").alias("line"))

    def sessions(self, parts: list[tuple[str, str]] | None = None) -> DataFrame:
        """The session table, or some partitions (team_safe, dt) of it; lines that are no session are skipped."""
        if parts is None:
            rows = self.spark.read.schema(SESSION_LINE).text(self.path("sessions")) if self.holds("sessions") else None
        else:
            rows = self._at("sessions", SESSION_LINE, parts)
        if rows is None:
            return self.spark.createDataFrame([], SESSION_SCHEMA + ", team_safe string, dt string")
        parsed = rows.withColumn("s", F.from_json("value", SESSION_SCHEMA)).where("s.session_pk is not null and s.state is not null")
        return parsed.select("s.*", "team_safe", F.col("dt").cast("string").alias("dt"))

    def max_written(self, view: str = "raw") -> str | None:
        """Largest id in a view."""
        if not self.holds(view):
            return None
        rows = self.spark.read.text(self.path(view)).select(F.get_json_object("value", "$.stream_id").alias("stream_id"))
        return max_id(rows).first()[0]

    def append(self, events: DataFrame, again: bool = False) -> None:
        """Add events (stream_id, value, team_safe, dt) to both views, each partition in order of ids. again: some may be there already, from a write that was stopped; then the ids of the partitions at hand are read."""
        for view, keys in (("team_raw", ["team_safe", "dt"]), ("raw", ["dt"])):
            fresh = events
            if again and self.holds(view):
                schema = "value string, " + ", ".join(f"{k} string" for k in keys)
                there = self.spark.read.schema(schema).text(self.path(view)).join(F.broadcast(events.select(*keys).distinct()), keys, "left_semi")
                fresh = events.join(there.select(F.get_json_object("value", "$.stream_id").alias("stream_id")).distinct(), "stream_id", "left_anti")
            ordered = fresh.withColumn("id", parse_id(F.col("stream_id"))).repartition(*keys).sortWithinPartitions(*keys, "id")
            ordered.select("value", *keys).write.mode("append").options(**PRIVATE).partitionBy(*keys).text(self.path(view))

    def overwrite(self, lines: DataFrame, name: str, keys: list[str]) -> None:
        """Replace the partitions that lines (value and keys) touch. Lines may come from these partitions: they are staged first."""
        staged = self.path(f".staging-{uuid.uuid4().hex}")
        lines.write.options(**PRIVATE).parquet(staged)
        try:
            again = self.spark.read.schema(lines.schema).parquet(staged)
            again.write.mode("overwrite").options(**PRIVATE).option("partitionOverwriteMode", "dynamic").partitionBy(*keys).text(self.path(name))
        finally:
            files, path = self._fs(staged)
            files.delete(path, True)

    def upsert(self, sessions: DataFrame) -> list[Row]:
        """Write sessions; of those with one key the new one stays. Only partitions that change are read and written.

        Returns what these partitions hold now and held before: (team_safe, dt, state, n, bytes, n_before, bytes_before).
        """
        new = with_location(sessions).withColumn("seq", F.lit(1))
        touched = [(r.team_safe, r.dt) for r in new.select("team_safe", "dt").distinct().collect()]  # names of folders
        old = self.sessions(touched).withColumn("seq", F.lit(0))
        line = F.to_json(F.struct(*SESSION_COLUMNS), {"ignoreNullFields": "false"})
        count = lambda rows, end: rows.groupBy("team_safe", "dt", "state").agg(F.count("*").alias(f"n{end}"), F.sum(F.octet_length(line) + 1).alias(f"bytes{end}"))
        before = count(old, "_before").collect()
        merged = latest(old.unionByName(new), F.col("seq")).persist()
        try:
            ordered = merged.repartition("team_safe", "dt").sortWithinPartitions("team_safe", "dt", *session_order())
            after = count(merged, "").collect()
            self.overwrite(ordered.select(line.alias("value"), "team_safe", "dt"), "sessions", ["team_safe", "dt"])
        finally:
            merged.unpersist()
        zero = {"n": 0, "bytes": 0, "n_before": 0, "bytes_before": 0}
        found: dict[tuple, dict] = {}
        for r in [*before, *after]:
            found.setdefault((r.team_safe, r.dt, r.state), dict(zero)).update({k: v for k, v in r.asDict().items() if k in zero})
        return [Row(team_safe=k[0], dt=k[1], state=k[2], **v) for k, v in found.items()]

    def drop_date(self, dt: str) -> None:
        """Remove a date from every view, and the folders of teams that it leaves empty."""
        self.delete(f"raw/dt={dt}")
        for name in ("team_raw", "sessions"):
            files, top = self._fs(self.path(name))
            if files.exists(top):
                for team in files.listStatus(top):
                    files.delete(self.hadoop.Path(team.getPath(), f"dt={dt}"), True)
                    if team.isDirectory() and not files.listStatus(team.getPath()):
                        files.delete(team.getPath(), False)


def _cut_partial_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyarrow import fs

    for batch in batches:
        cut = []
        for path in batch.column(0).to_pylist():
            files, name = fs.FileSystem.from_uri(path if "://" in path else re.sub("^file:/*", "file:///", path))
            with files.open_input_file(name) as source:
                size = end = source.size()
                while end > 0:  # from the end, block by block
                    source.seek(max(0, end - 65536))
                    at = source.read(min(end, 65536)).rfind(b"\n")
                    end = max(0, end - 65536)
                    if at >= 0:
                        end += at + 1
                        break
                if end < size:
                    source.seek(0)
                    with files.open_output_stream(f"{name}.repair") as out:
                        for at in range(0, end, 1 << 20):
                            out.write(source.read(min(1 << 20, end - at)))
            if end < size:
                files.move(f"{name}.repair", name)
                folder, _, file = name.rpartition("/")
                crc = f"{folder}/.{file}.crc"  # a checksum beside a local file is that of the damaged one
                if files.get_file_info(crc).type == fs.FileType.File:
                    files.delete_file(crc)
                cut.append((path, size - end))
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in cut], pa.string()), pa.array([n for _, n in cut], pa.int64())], names=["path", "dropped"])
