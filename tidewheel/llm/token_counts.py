"""Token counts as delta-maintained rollups.

Totals by source, language and tokenizer version are sums of signed deltas: +1 document and its tokens for an insert, -1 for
a delete, minus the old count plus the new one for a revised count. A batch of changes is summed to one row for each group
before it is written, in a folder named by the batch. The folder counts once its _SUCCESS file stands, which Spark writes
last; a batch that is there already is not written again, so a repeated commit changes nothing, and a broken one is done
anew. Totals are read by summing the batches, or the newest snapshot and the batches after it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.llm.common import CACHES, Scratch, lean_worker, table, utf8
from tidewheel.llm.exact_dedup import exact_duplicates

GROUP = ("source", "lang", "tokenizer")
DELTA = "source string, lang string, tokenizer string, n_docs long, n_tokens long"
RANKS = "byte_bpe_50k.tiktoken"
#: Tokenizer versions of the counts.
BPE, WORDS, LETTERS = "byte_bpe_50k", "words_v1", "words_v2"


class TokenRollup:
    """Totals under a folder that all executors see."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.hadoop = spark._jvm.org.apache.hadoop.fs
        root = self.hadoop.Path(self.folder)
        self.files = root.getFileSystem(spark._jsc.hadoopConfiguration())

    def _done(self, kind: str) -> list[str]:
        top = self.hadoop.Path(f"{self.folder}/{kind}")
        if not self.files.exists(top):
            return []
        names = [s.getPath().getName() for s in self.files.listStatus(top)]
        return sorted(n for n in names if self.files.exists(self.hadoop.Path(f"{self.folder}/{kind}/{n}/_SUCCESS")))

    def committed(self) -> list[str]:
        return self._done("batches")

    def commit(self, batch: str, deltas: DataFrame) -> bool:
        """Add a batch of signed rows (DELTA); False if it was there already. Names are letters, digits, . _ and -."""
        if not re.fullmatch(r"[A-Za-z0-9._-]+", batch):
            raise ValueError(f"no name for a batch: {batch!r}")
        if batch in self.committed():
            return False
        summed = deltas.groupBy(*GROUP).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).where("n_docs <> 0 or n_tokens <> 0")
        summed.write.mode("overwrite").parquet(f"{self.folder}/batches/{batch}")
        return True

    def _read(self, paths: list[str]) -> DataFrame:
        return self.spark.read.schema(DELTA).parquet(*paths) if paths else self.spark.createDataFrame([], DELTA)

    def totals(self) -> DataFrame:
        """Totals of all committed batches; groups without documents and tokens are gone."""
        folded, rows = set(), self.spark.createDataFrame([], DELTA)
        snapshots = self._done("snapshots")
        if snapshots:
            newest = f"{self.folder}/snapshots/{snapshots[-1]}"
            rows = self._read([newest])
            folded = {r.batch for r in self.spark.read.parquet(f"{self.folder}/folded/{snapshots[-1]}").collect()}  # names of batches
        rest = [f"{self.folder}/batches/{b}" for b in self.committed() if b not in folded]
        every = rows.unionByName(self._read(rest))
        return every.groupBy(*GROUP).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).where("n_docs <> 0 or n_tokens <> 0")

    def snapshot(self) -> str:
        """Fold all committed batches into one table; the list of what it holds is written first, so a broken snapshot is never read."""
        batches = self.committed()
        name = f"{len(self._done('snapshots')):08d}"
        totals = self.totals()
        self.spark.createDataFrame([(b,) for b in batches], "batch string").write.mode("overwrite").parquet(f"{self.folder}/folded/{name}")
        totals.write.mode("overwrite").parquet(f"{self.folder}/snapshots/{name}")
        return name


def signed(counts: DataFrame, tokenizer: str, column: str, sign: int) -> DataFrame:
    """Rows of counts (source, lang, column) as deltas of one tokenizer version."""
    return counts.select(
        F.coalesce("source", F.lit("")).alias("source"), F.coalesce("lang", F.lit("")).alias("lang"), F.lit(tokenizer).alias("tokenizer"), F.lit(sign).cast("long").alias("n_docs"), (sign * F.col(column)).cast("long").alias("n_tokens")
    )


def load_ranks(path: str) -> dict[bytes, int]:
    import base64

    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


_encodings: dict[str, object] = {}
CACHES["counts"] = _encodings.clear


def count_tokens(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, source, lang, text_sha256, n_bpe, n_words, n_letters) of every whole text; null counts as empty. One pass, no shuffle.

    text_sha256: of the text with A-Z lower-cased, as in exact dedup.
    """
    import public_tokenizers

    spark = docs.sparkSession
    path = path or public_tokenizers.path(RANKS)
    ranks = spark.sparkContext.broadcast(load_ranks(path))  # bounded by the vocabulary
    pattern = public_tokenizers.PATTERN

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex
        import tiktoken

        lean_worker(keep="counts")
        if path not in _encodings:
            _encodings[path] = tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=ranks.value, special_tokens={})
        encoding, letters = _encodings[path], regex.compile(r"\p{L}+")
        for batch in batches:
            bpe, words, runs, digests = [], [], [], []
            for raw in batch.column(3):
                data = raw.as_buffer().to_pybytes()
                text = data.decode("utf-8", "replace")
                bpe.append(len(encoding.encode_ordinary(text)))
                words.append(len(data.split()))
                runs.append(sum(1 for _ in letters.finditer(text)))
                digests.append(hashlib.sha256(data.lower()).hexdigest())
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(3)), pa.array(digests, pa.string()), pa.array(bpe, pa.int64()), pa.array(words, pa.int64()), pa.array(runs, pa.int64())], names=["doc_id", "source", "lang", "text_sha256", "n_bpe", "n_words", "n_letters"])

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), utf8("text"))
    return own.mapInArrow(run, "doc_id long, source string, lang string, text_sha256 string, n_bpe long, n_words long, n_letters long")


def maintain(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """A day in the life of the totals, over all of docs: source, lang, tokenizer, n_docs long, n_tokens long.

    Batch `load` inserts every document under two tokenizer versions; `dedup` deletes those of which an exact copy stays;
    `revise` replaces the counts of word version 1 by those of version 2; the last two are sent twice, as after a lost reply.
    The totals are read from a snapshot of the first batch and the batches after it. Null sources and languages count as
    empty; rows without doc_id are never deleted; an empty table has no totals.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "token-counts")
    rollup = TokenRollup(spark, folder or scratch.path("rollup"))
    counts = scratch.keep(count_tokens(docs), "counts")
    gone = scratch.keep(exact_duplicates(docs).where("not kept").select("doc_id", "text_sha256").distinct(), "gone")
    dropped = scratch.keep(counts.join(gone, ["doc_id", "text_sha256"], "left_semi"), "dropped")
    stays = counts.join(gone, ["doc_id", "text_sha256"], "left_anti")
    rollup.commit("load", signed(counts, BPE, "n_bpe", 1).union(signed(counts, WORDS, "n_words", 1)))
    rollup.snapshot()
    for batch, deltas in (
        ("dedup", signed(dropped, BPE, "n_bpe", -1).union(signed(dropped, WORDS, "n_words", -1))),
        ("revise", signed(stays, WORDS, "n_words", -1).union(signed(stays, LETTERS, "n_letters", 1))),
    ):
        rollup.commit(batch, deltas)
        rollup.commit(batch, deltas)
    return rollup.totals()


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maintain(table(spark, sf_dir, "documents"))
