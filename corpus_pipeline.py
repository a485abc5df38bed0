"""From raw documents to token ids: toxic documents go, then exact copies, near copies and benchmark passages; the rest is encoded.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and works on all that the stage before it kept. run()
writes each stage's rows as Parquet and rereads them, so a lost executor costs one stage at most.

All stages take null and empty texts (as empty), an empty table, and more columns of any name, which stay as they are until the
last stage. What they do with rows that repeat or have no doc_id is said with each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.llm.bpe import encode_documents
from tidewheel.llm.common import Scratch, table, without
from tidewheel.llm.decontaminate import contamination
from tidewheel.llm.exact_dedup import keep_one
from tidewheel.llm.jaccard_join import ngram_components
from tidewheel.llm.toxicity import keep_clean


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier passes; each row is judged by its text. Without labels all pass."""
    return keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, the one with the largest doc_id; one row where several have it, one without doc_id if none has any."""
    return keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of similar documents, the one with the smallest doc_id.

    Rows without doc_id stay. A doc_id that repeats with other texts goes only if all of them are copies. Texts without words stay.
    """
    own = ngram_components(docs).groupBy("doc_id").agg(F.max(F.col("doc_id") == F.col("component_id")).alias("stays"))
    others = own.where("not stays").select("doc_id")
    return without(docs, others, Scratch(spark, "near-copies"), "others")


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. Rows without doc_id stay; rows that repeat a doc_id go if any of them holds one."""
    leaks = contamination(docs, table(spark, sf_dir, "benchmark")).where("contaminated").select("doc_id").distinct()
    return without(docs, leaks, Scratch(spark, "leaks"), "found")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, as digests: doc_id, n_tokens, ids_sha256, decoded_sha256; one row for each row, null ids stay null."""
    return encode_documents(docs, cached=100_000)  # executors have memory in use from the stages before


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_leaks),
    ("BPE encoding and decoding", encode),
]

#: The classifier and the encoder are beyond SQL; tests/llm holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, over the whole table of documents."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        done = scratch.keep(stage(spark, docs, sf_dir), f"stage-{k}")
        if k:
            scratch.drop(f"stage-{k - 1}")
        docs = done
    return docs
