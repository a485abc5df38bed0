"""Exact dedup by a tree-merge of sorted digest runs.

1. Leaves: one pass over the texts turns every document into (id, digest) and notes its run, the scan partition that read it.
   The digest table is written down, so runs are fixed from here on. Each run is sorted by digest within ranges of digests and
   folded: one row for each digest of the run, however many copies it holds.
2. Tree: in each round `fan_in` neighbouring runs exchange their rows: a range of digests of all of them meets in one task,
   where the sorted pieces are merged in order of digest and equal neighbours are folded into one, keeping the identifier that
   stays and the number of copies. The merged run is sorted again, so the next round merges as this one did. After
   log(runs) rounds one run is left, in ranges. A digest that every run holds gives `fan_in` rows to a merge, never one row for
   each copy.
3. Way down: every leaf row learns its class, then every document that of its leaf row. Both joins are on keys with few rows
   on one side and at most one run of documents on the other, so a group with a third of all rows isn't one task's work.

Identifiers are verified at every level: a class also carries the byte length and a second, independent 64-bit hash of the
text, and a merge fails the job if equal digests disagree in either.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.llm.common import Scratch, lean_worker, table, utf8, without

LEAF = "doc_id long, digest binary, n_bytes long, proof long"
RUN = "run long, digest binary, keep_id long, copies long, n_bytes long, proof long"


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    lean_worker()
    for batch in batches:
        digest, size, proof = [], [], []
        for raw in batch.column(1):
            text = raw.as_buffer().to_pybytes().lower()  # bytes.lower touches A-Z only
            digest.append(hashlib.sha256(text).digest())
            size.append(len(text))
            proof.append(xxhash.xxh3_64_intdigest(text) - (1 << 63))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digest, pa.binary()), pa.array(size, pa.int64()), pa.array(proof, pa.int64())], names=["doc_id", "digest", "n_bytes", "proof"])


def _fold(keep: str):
    """Rows sorted by (run, digest) to one row for each: the identifier that stays, the copies and the proof. Only the row at the end of a batch is held over."""
    best = np.maximum if keep == "largest" else np.minimum

    def folded(run, digest, best_id, some, copies, size, proof) -> list:
        fresh = np.ones(len(run), bool)
        fresh[1:] = (run[1:] != run[:-1]) | (digest[1:] != digest[:-1])
        at = np.flatnonzero(fresh)
        group = np.cumsum(fresh) - 1
        if (size != size[at][group]).any() or (proof != proof[at][group]).any():
            raise ValueError("different texts share a digest")
        return [run[at], digest[at], best.reduceat(best_id, at), np.maximum.reduceat(some, at), np.add.reduceat(copies, at), size[at], proof[at]]

    def batch_of(columns: list) -> pa.RecordBatch:
        run, digest, ids, some, copies, size, proof = columns
        digests = pa.array(digest.tolist(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(run), digests, pa.array(ids, pa.int64(), mask=~some), pa.array(copies), pa.array(size), pa.array(proof)], names=["run", "digest", "keep_id", "copies", "n_bytes", "proof"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_worker()
        held = None
        none = -(1 << 63) if keep == "largest" else (1 << 63) - 1
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(2)
            columns = [batch.column(0).to_numpy(), np.array(batch.column(1).to_pylist(), object), ids.fill_null(none).to_numpy(), ids.is_valid().to_numpy(zero_copy_only=False), *(batch.column(k).to_numpy() for k in (3, 4, 5))]
            if held:
                columns = [np.concatenate(pair) for pair in zip(held, columns, strict=True)]
            done = folded(*columns)
            held = [c[-1:] for c in done]
            if len(done[0]) > 1:
                yield batch_of([c[:-1] for c in done])
        if held:
            yield batch_of(held)

    return run


def merge_runs(rows: DataFrame, keep: str, ranges: int) -> DataFrame:
    """Merge the sorted runs that met under `run`, each range of digests in one task. A verified fold: equal digests must agree in length and second hash."""
    at = F.conv(F.hex(F.substring("digest", 1, 2)), 16, 10).cast("long") * ranges / 65536
    met = rows.withColumn("range", F.floor(at)).repartition("run", "range").sortWithinPartitions("run", "digest")
    return met.select("run", "digest", "keep_id", "copies", "n_bytes", "proof").mapInArrow(_fold(keep), RUN)


def exact_duplicates(docs: DataFrame, keep: str = "largest", fan_in: int = 8, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Classes of documents whose texts are equal after lower-casing A-Z.

    Returns one row for each row of docs: doc_id, keep_id, group_size long, kept boolean, text_sha256 string.
    keep: 'largest' or 'smallest' doc_id stays. Null texts count as empty, and empty texts are equal to each other. Rows that
    repeat a doc_id count as rows of their own; all of those with the id that stays are marked kept (`keep_one` leaves one).
    A null doc_id never wins against another. Columns besides id and text are not read.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "exact-dedup")
    hashed = docs.select(F.col(id_col).cast("long").alias("doc_id"), utf8(text)).mapInArrow(_digests, LEAF)
    leaves = scratch.keep(hashed.withColumn("run", F.spark_partition_id().cast("long")), "leaves")
    total = (leaves.agg(F.max("run")).first()[0] or 0) + 1
    rows = leaves.select("run", "digest", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("copies"), "n_bytes", "proof")
    # a run is cut into as many ranges as it has leaves, so every task of every round has about one leaf's rows
    runs = scratch.keep(merge_runs(rows, keep, 1), "runs")
    level, left, leaves_in = runs, total, 1
    while left > 1:
        left, leaves_in = -(-left // fan_in), leaves_in * fan_in
        level = merge_runs(level.withColumn("run", F.floor(F.col("run") / fan_in)), keep, min(leaves_in, total))
    root = scratch.keep(level.select(F.col("digest").alias("root_digest"), F.col("keep_id").alias("keep"), F.col("copies").alias("size")), "root")
    classes = scratch.keep(runs.select("run", "digest").join(root, F.col("digest") == F.col("root_digest")).select(F.col("run").alias("of_run"), "root_digest", "keep", "size"), "classes")
    scratch.drop("runs", "root")
    return leaves.join(classes, (leaves.run == classes.of_run) & (leaves.digest == classes.root_digest)).select(
        "doc_id",
        F.col("keep").alias("keep_id"),
        F.col("size").alias("group_size"),
        F.coalesce(F.col("doc_id") == F.col("keep"), F.col("keep").isNull()).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def keep_one(docs: DataFrame, keep: str = "largest", fan_in: int = 8, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs that stay, one for each text; all columns.

    Of equal texts the row with the largest (or smallest) doc_id stays, one of them if several have it, and one without doc_id
    only if none has any. Rows that repeat a doc_id with other texts are judged each by its own text.
    """
    scratch = Scratch(docs.sparkSession, "keep-one")
    rows = scratch.keep(exact_duplicates(docs, keep, fan_in, id_col, text).select("doc_id", "keep_id", "kept", "text_sha256"), "rows")
    verdict = scratch.keep(rows.groupBy("doc_id").agg(F.max("kept").alias("kept"), F.count("*").alias("n")), "verdict")
    if verdict.where("n > 1 or doc_id is null").isEmpty():  # the id names the row, so texts stay where they are
        return without(docs, verdict.where("not kept").select("doc_id"), scratch, "losers", id_col)
    best = rows.where("kept").select(F.col("text_sha256").alias("__digest"), F.col("keep_id").alias("__keep")).distinct()
    upper, lower = (bytes(range(a, a + 26)).decode() for a in (65, 97))
    named = docs.withColumn("__text", F.sha2(F.translate(F.coalesce(F.col(text), F.lit("")), upper, lower), 256))
    met = named.join(best, (F.col("__text") == F.col("__digest")) & F.col(id_col).eqNullSafe(F.col("__keep")))
    return met.dropDuplicates(["__text"]).select(docs.columns)


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


#: DuckDB. translate() touches A-Z only, unlike lower().
OP4_SQL = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY text_sha256) AS kept,
       text_sha256
FROM d
"""
