"""Quality scores by hierarchical empirical Bayes.

A linear classifier over the style of a text (shares of kinds of characters, word and line lengths, repetition) gives each
document its evidence. Sites have a quality of their own: the evidence is summed by path (a part of a host) and by host in
grouped aggregations; a host's posterior is its mean shrunk toward the global mean, a path's posterior its mean shrunk toward
its host's, each by a prior strength that the spread between groups gives (method of moments). Sparse groups stay near their
prior, large ones speak for themselves. A document's score adds its own log-odds to those of its path, which are taken
without the document itself, against the global ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.llm.common import Scratch, byte_view, fits, lean_worker, slices, table, utf8
from tidewheel.llm.shingles import word_hashes
from tidewheel.llm.toxicity import held_out, joined

#: Kinds of bytes whose shares describe a text.
KINDS = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" ", b"\n", b".", b",", b"!", b"?", b"|", b"%", b"$", b"&", b"*", b"#", b"{}[]();=<>/\\_", b"\"'`", b":-+~^@", bytes(range(128, 256)), b"\t\r"]
BINS, PORTION = 8, 4 << 20
FEATURES = len(KINDS) + 8


def style(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Documents x features; an empty text has zeros."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    kind = np.zeros((256, len(KINDS)))
    for k, letters in enumerate(KINDS):
        kind[list(letters), k] = 1
    found = np.zeros((n, FEATURES))
    for first, last in slices(offsets, PORTION):
        at = offsets[first : last + 1] - offsets[first]
        part = data[offsets[first] : offsets[last]]
        text = np.repeat(np.arange(last - first), np.diff(at))
        counts = np.bincount(text * 256 + part, minlength=(last - first) * 256).reshape(-1, 256)
        found[first:last, : len(KINDS)] = (counts @ kind) / np.maximum(1, np.diff(at))[:, None]
        words, begin = word_hashes(part, at)
        many = np.diff(begin)
        lines = counts[:, 10] + 1
        found[first:last, -8] = np.log1p(np.diff(at))
        found[first:last, -7] = np.log1p(many)
        found[first:last, -6] = np.diff(at) / np.maximum(1, many)
        found[first:last, -5] = many / lines
        for k, (a, b) in enumerate(zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True)):
            if b > a:
                own = words[a:b]
                one = np.unique(own, return_counts=True)[1]
                two = len(np.unique(own[1:] * np.uint64(3) + own[:-1])) if b - a > 1 else 1
                found[first + k, -4:] = len(one) / (b - a), one.max() / (b - a), two / max(1, b - a - 1), (one > 3).mean()
    found[size == 0] = 0
    return found


class QualityModel:
    """Logistic regression over binned features."""

    def __init__(self, features: np.ndarray, target: np.ndarray, rounds: int = 600, ridge: float = 1e-3):
        self.edges = np.stack([np.quantile(features[:, k], np.linspace(0, 1, BINS + 1)[1:-1]) for k in range(FEATURES)])
        self.mean, self.scale = features.mean(0), features.std(0) + 1e-9
        x = self._wide(features)
        share = float(np.clip(target.mean(), 0.02, 0.98))
        weight = (target * 0.5 / share + (1 - target) * 0.5 / (1 - share)) / len(target)
        self.w, self.b = np.zeros(x.shape[1]), 0.0
        look, look_b = self.w, 0.0
        step = 4 / max(1.0, float((x**2).sum(1).mean()))
        for k in range(rounds):
            error = (1 / (1 + np.exp(-np.clip(x @ look + look_b, -30, 30))) - target) * weight
            new, new_b = look - step * (x.T @ error + ridge * look), look_b - step * error.sum()
            momentum = min(0.9, k / (k + 3))
            look, look_b = new + momentum * (new - self.w), new_b + momentum * (new_b - self.b)
            self.w, self.b = new, new_b

    def _wide(self, features: np.ndarray) -> np.ndarray:
        bins = np.stack([np.searchsorted(self.edges[k], features[:, k], "right") for k in range(FEATURES)], 1)
        hot = (bins[:, :, None] == np.arange(BINS)).reshape(len(features), -1)
        return np.concatenate((hot, np.clip((features - self.mean) / self.scale, -4, 4)), 1)

    def evidence(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self._wide(features) @ self.w + self.b, -12, 12)))


class ConstantModel:
    """Where nothing is labelled: no evidence either way."""

    def evidence(self, features: np.ndarray) -> np.ndarray:
        return np.full(len(features), 0.5)


def training_rows(docs: DataFrame, labels: DataFrame, most: int) -> tuple[list[bytes], list[int]]:
    """At most `most` labelled rows outside the held-out fifth, smallest hashes of doc_id first."""
    learn = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    sample = learn.groupBy("doc_id").agg(F.max(F.col("quality").cast("int")).alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    found = docs.select("doc_id", utf8("text")).join(F.broadcast(sample), "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text"))  # one row an id, however often it is there
    rows = found.collect()  # bounded by `most`
    rows.sort(key=lambda r: r.doc_id)
    return [bytes(r.text) for r in rows], [r.quality for r in rows]


def fit(texts: list[bytes], labels: list[int]) -> QualityModel | ConstantModel:
    if len(set(labels)) < 2:
        return ConstantModel()
    return QualityModel(style(*joined(texts)), np.array(labels, float))


def shrunk(groups: DataFrame, prior: Column, strength: Column, name: str) -> DataFrame:
    """Adds a group's posterior: its mean shrunk toward `prior` as if by `strength` more documents."""
    return groups.withColumn(name, (F.col("total") + strength * prior) / (F.col("n") + strength))


def strength_of(within: float, between: float, groups: float, parents: float, effective: float) -> float:
    """Prior strength by the method of moments: the variance within groups over that of group means around their parents'.

    between: sum of squares of group means around the parents' means; effective: the factor of the spread in its expectation.
    """
    spread = (between - (groups - parents) * within) / max(1e-9, effective) if groups > parents else 0.0
    return float(np.clip(within / spread if spread > 0 else 1e4, 1.0, 1e4))


def moments(paths: DataFrame) -> tuple[float, float, float]:
    """(mean, prior strength of hosts around it, prior strength of paths around their host) of paths (host, n, total, squares)."""
    hosts = paths.groupBy("host").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.sum("squares").alias("squares"), F.count("*").alias("k"), F.sum(F.col("total") * F.col("total") / F.col("n")).alias("means"), F.sum(F.col("n") * F.col("n")).alias("nn")
    )
    own = F.col("total") * F.col("total") / F.col("n")
    row = hosts.agg(
        *(F.sum(c).alias(c) for c in ("n", "total", "squares", "k", "means")), F.sum(own).alias("own"), F.sum(F.col("nn") / F.col("n")).alias("share"), F.sum(F.col("n") * F.col("n")).alias("nn"), F.count("*").alias("hosts")
    ).first()
    if not row.n:
        return 0.5, 1.0, 1.0
    mean = row.total / row.n
    in_paths = max(1e-6, (row.squares - row.means) / max(1, row.n - row.k))
    in_hosts = max(1e-6, (row.squares - row.own) / max(1, row.n - row.hosts))
    by_host = strength_of(in_hosts, row.own - row.n * mean * mean, row.hosts, 1, row.n - row.nn / row.n)
    return float(mean), by_host, strength_of(in_paths, row.means - row.own, row.k, row.hosts, row.n - row.share)


def logit(p: Column) -> Column:
    q = F.greatest(F.least(p, F.lit(1 - 1e-6)), F.lit(1e-6))
    return F.log(q / (1 - q))


def score_quality(docs: DataFrame, labels: DataFrame, host: Column | None = None, path: Column | None = None, max_train: int = 8_000) -> DataFrame:
    """Quality of every document: doc_id, held_out boolean, evidence, host_posterior, path_posterior, score double, predicted int.

    docs: doc_id, text and what host and path are made of (default: source, and lang within it); labels: doc_id, quality 0/1.
    max_train bounds the labelled rows that the classifier is fitted on; all statistics of hosts and paths cover every row.
    Null and empty texts have the evidence of a text without characters; null hosts form a host of their own; one row for
    each row of docs. Without labels the evidence is 0.5 throughout.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "quality")
    host = F.col("source") if host is None else host
    path = F.col("lang") if path is None else path
    model = spark.sparkContext.broadcast(fit(*training_rows(docs, labels, max_train)))  # a few hundred weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_worker()
        for batch in batches:
            found = model.value.evidence(style(*byte_view(batch.column(3))))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(3)), pa.array(found)], names=["doc_id", "host", "path", "evidence"])

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(host.cast("string"), F.lit("")).alias("host"), F.coalesce(path.cast("string"), F.lit("")).alias("path"), utf8("text"))
    rows = scratch.keep(own.mapInArrow(run, "doc_id long, host string, path string, evidence double"), "evidence")
    sums = [F.count("*").alias("n"), F.sum("evidence").alias("total"), F.sum(F.col("evidence") * F.col("evidence")).alias("squares")]
    paths = scratch.keep(rows.groupBy("host", "path").agg(*sums), "paths")
    hosts = paths.groupBy("host").agg(*(F.sum(c).alias(c) for c in ("n", "total", "squares")))
    mean, by_host, by_path = moments(paths)
    shrunk_hosts = shrunk(hosts, F.lit(mean), F.lit(by_host), "host_posterior").select(F.col("host").alias("of"), "host_posterior")
    known = scratch.keep(paths.join(shrunk_hosts, F.col("host") == F.col("of")).select(F.col("host").alias("of_host"), F.col("path").alias("of_path"), "n", "total", "host_posterior"), "known")
    known = F.broadcast(known) if fits(known, "of_host", "of_path") else known
    met = rows.join(known, (F.col("host") == F.col("of_host")) & (F.col("path") == F.col("of_path")))
    others = (F.col("total") - F.col("evidence") + by_path * F.col("host_posterior")) / (F.col("n") - 1 + by_path)
    total = logit(F.col("evidence")) + logit(others) - F.lit(float(np.log(mean / (1 - mean))) if 0 < mean < 1 else 0.0)
    score = 1 / (1 + F.exp(-total))
    return met.select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "evidence",
        "host_posterior",
        others.alias("path_posterior"),
        score.alias("score"),
        (score >= 0.5).cast("int").alias("predicted"),
    )


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
