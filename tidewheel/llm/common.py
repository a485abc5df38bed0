"""What the operators of this subpackage share: tables, the shared folder, Arrow helpers."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

CHECKPOINT_KEY = "spark.checkpoint.dir"


ARROW_KEY, ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "4m"


def bounded(spark: SparkSession) -> SparkSession:
    """Batches for Python workers hold a few MB, or one longer row, whatever the texts are like; a session that sets a bound of its own keeps it."""
    if spark.sparkContext.getConf().get(ARROW_KEY) is None:
        spark.conf.set(ARROW_KEY, ARROW_BYTES)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; any store that Spark can read."""
    return bounded(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that every executor sees. Where the session names none, a private one in local mode (tests), an error on a cluster."""
    named = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if not named:
        existing = spark.sparkContext._jsc.sc().getCheckpointDir()
        if existing.isDefined():
            return existing.get()
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that all executors see")
        named = "file://" + tempfile.mkdtemp(prefix="tidewheel-")
        spark.sparkContext.setCheckpointDir(named)
        return spark.sparkContext._jsc.sc().getCheckpointDir().get()
    return named


class Scratch:
    """Tables that cut lineage: written once to the shared folder, so a lost executor costs no recomputation of what came before.

    They are removed when no later step reads them, and those that a result still reads when the driver's process ends.
    Where the shared folder is a mounted one (file:), Hadoop starts a child process of the executor, chmod, for each file and
    folder that a task of Spark's writer makes. hold() and made() start none.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = bounded(spark)
        self.held: dict[str, DataFrame] = {}
        self.root = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
        path = spark._jvm.org.apache.hadoop.fs.Path(self.root)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def hold(self, df: DataFrame, name: str) -> DataFrame:
        """A table of short rows as blocks on the local disks of two executors each; nothing makes it anew, so all steps read the same rows."""
        self.held[name] = df.localCheckpoint(True, StorageLevel.DISK_ONLY_2)
        return self.held[name]

    def made(self, df: DataFrame, make, schema: str, name: str) -> DataFrame:
        """keep(df.mapInArrow(make, schema), name), in a mounted folder by files that the Python workers write.

        An attempt of a task writes a file of its own; only the files that finished tasks name are read.
        """
        if not self.root.startswith("file:"):
            return self.keep(df.mapInArrow(make, schema), name)
        rows = self.spark.createDataFrame([], schema)
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).mkdirs(path)
        names = [r.file for r in df.mapInArrow(_filed(make, self.path(name), to_arrow_schema(rows.schema)), "file string").collect()]  # one a task
        return self.spark.read.schema(rows.schema).parquet(*names) if names else rows

    def release(self) -> None:
        """Let the driver notice that the plans of finished steps are garbage: Spark removes shuffle files only then."""
        gc.collect()
        self.spark._jvm.System.gc()

    def drop(self, *names: str) -> None:
        """Remove tables that no later read needs."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        for name in names:
            if name in self.held:
                self.held.pop(name)._jdf.queryExecution().analyzed().rdd().unpersist(False)
                continue
            path = hadoop.Path(self.path(name))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


#: Bytes of a row group that a Python worker writes.
GROUP = 4 << 20


def _filed(make, folder: str, schema: pa.Schema):
    """What make yields goes to one Parquet file of a new name in the folder; the task's row is that name, none without rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs, parquet

        file, out, held, size = f"{folder}/part-{uuid.uuid4().hex}.parquet", None, [], 0
        for batch in make(batches):
            if not batch.num_rows:
                continue
            if out is None:
                files, path = fs.FileSystem.from_uri(file)
                out = parquet.ParquetWriter(path, schema, filesystem=files)
            held.append(batch)
            size += batch.nbytes
            if size >= GROUP:
                out.write_table(pa.Table.from_batches(held).select(schema.names).cast(schema))
                held, size = [], 0
        if held:
            out.write_table(pa.Table.from_batches(held).select(schema.names).cast(schema))
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([file])], names=["file"])

    return run


#: What operators cache in a Python worker, which outlives tasks and operators: the cache by name, and the call that gives it back.
CACHES: dict = {}


def lean_worker(keep: str = "") -> None:
    """Give back what this worker still holds from other operators: their caches (all but `keep`), and free memory that the allocators hold."""
    for name, clear in CACHES.items():
        if name != keep:
            clear()
    pa.default_memory_pool().release_unused()
    gc.collect()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def fits(df: DataFrame, *texts: str, most: int = 16 << 20) -> bool:
    """Whether a table is small enough to broadcast: 64 bytes a row and the bytes of its text columns, `most` in all."""
    size = F.lit(64)
    for name in texts:
        size = size + F.coalesce(F.octet_length(name), F.lit(0))
    return (df.agg(F.sum(size.cast("long"))).first()[0] or 0) <= most


def utf8(column: str = "text"):
    """A text column as its UTF-8 bytes; null counts as empty."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b"")).alias(column)


def byte_view(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary array without nulls as one uint8 array, and the offsets of its values."""
    if pa.types.is_large_binary(array.type):
        kind = np.int64
    else:
        kind = np.int32
    _, offsets, data = array.buffers()
    at = np.frombuffer(offsets, kind)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    if data is None or not len(array):
        return np.zeros(0, np.uint8), np.zeros(len(array) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def slices(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of values of at most `most` bytes together; a longer value stands alone. Bounds the memory of vectorised work."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1, first + 1)
        yield first, min(last, n)
        first = min(last, n)


def without(docs: DataFrame, losers: DataFrame, scratch: Scratch, name: str, key: str = "doc_id", few: int = 1_000_000) -> DataFrame:
    """The rows of docs whose key isn't among the losers (one column of distinct longs); all columns. Rows without key stay.

    Up to `few` losers (8 bytes each) are broadcast, so the texts stay where they are; more are met in a shuffled join.
    """
    gone = scratch.hold(losers.toDF("__gone"), name)
    small = gone.count() <= few
    return docs.join(F.broadcast(gone) if small else gone, F.col(key) == F.col("__gone"), "left_anti")


#: Rows of one key that a task of a join takes; a key with more is dealt over several tasks.
HOT = 1_000_000


def is_hot(rows: int | None) -> bool:
    """Whether so many rows of one key are too many for a task."""
    return (rows or 0) > HOT


def spread(left: DataFrame, right: DataFrame, on: str, how: str = "inner", counts: DataFrame | None = None) -> DataFrame:
    """left joined to right (one row for each key) on a key that a large part of left's rows may have.

    Rows of a key with more than HOT rows are dealt by their hash over as many tasks as it takes, and the key's row of right
    is repeated for each of them. counts: (on, n) of left where it is known already; at most 1 / HOT of left's rows are broadcast.
    """
    counts = left.groupBy(on).agg(F.count("*").alias("n")) if counts is None else counts
    cuts = F.broadcast(counts.where(F.col("n") > HOT).select(F.col(on).alias("__hot"), F.ceil(F.col("n") / HOT).cast("int").alias("__cuts")))
    dealt = F.coalesce(F.pmod(F.xxhash64(*left.columns), F.col("__cuts")), F.lit(0)).cast("int")
    each = F.explode(F.sequence(F.lit(0), F.coalesce("__cuts", F.lit(1)) - 1))
    one, two = (side.join(cuts, F.col(on) == F.col("__hot"), "left").withColumn("__salt", salt).drop("__hot", "__cuts") for side, salt in ((left, dealt), (right, each)))
    return one.join(two, [on, "__salt"], how).drop("__salt")


def connected(spark: SparkSession, links: DataFrame, scratch: Scratch, name: str = "cc") -> DataFrame:
    """Components of undirected links (a long, b long): (node, label), label the smallest node reachable.

    Min-label exchange with pointer jumping: each round every node takes the label of its label, then the smallest among its
    neighbours. Every round is a table of its own, so the plan stays short and the driver sees counts only. A component of
    diameter d settles in about log2(d) rounds. Hubs and labels that many nodes have are dealt over several tasks.
    """
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    edges = scratch.hold(both.where("u <> v").distinct(), f"{name}-edges")
    now = scratch.hold(edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select(F.col("u").alias("node"), F.least("u", "m").alias("label"), "n"), f"{name}-0")
    degree = now.agg(F.max("n")).first()[0]  # links have both directions: a node's links out are those in
    now, largest, step = now.select("node", "label"), None, 0
    while True:
        if largest is None:
            largest = now.groupBy("label").count().agg(F.max("count")).first()[0] or 0
        to = now.select(F.col("node").alias("label"), F.col("label").alias("onward"))
        led = spread(now, to, "label", "left") if is_hot(largest) else now.join(to, "label", "left")
        led = led.select("node", F.col("label").alias("old"), F.least("label", F.coalesce("onward", "label")).alias("label"))
        at = led.select(F.col("node").alias("v"), "label")
        met = spread(edges, at, "v") if is_hot(degree) else edges.join(at, "v")
        near = met.groupBy("u").agg(F.min("label").alias("near"))
        new = led.join(near, led.node == near.u, "left").select("node", "old", F.least("label", F.coalesce("near", "label")).alias("label"))
        step += 1
        after = scratch.hold(new, f"{name}-{step}")
        scratch.drop(f"{name}-{step - 1}")
        now = after.select("node", "label")
        seen = after.groupBy("label").agg(F.count("*").alias("n"), F.max(F.col("old") != F.col("label")).alias("moved")).agg(F.max("n"), F.max("moved")).first()
        largest = seen[0] or 0
        if not seen[1]:
            scratch.drop(f"{name}-edges")
            return now
