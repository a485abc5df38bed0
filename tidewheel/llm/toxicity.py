"""Toxicity by weak supervision.

Many voters look at a document: lexicon voters, each with a share of the words and word stems that the labelled training rows
tie to toxicity, and pattern voters (how many lexicon hits, how dense, none at all, shouting, strings of marks). No voter is
trusted. A generative label model sees only their votes and estimates by expectation maximisation how often each votes which
way on toxic and on clean documents; voters that agree beyond that (correlation given the label) share their weight, so that
many copies of one opinion count once. Its posterior probabilities, not the given labels, train a linear classifier over the
presence of lexicon features, which scores every document in one pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.llm.common import byte_view, lean_worker, slices, table, utf8
from tidewheel.llm.shingles import CHUNK, mix, shingle_sets
from tidewheel.llm.words import Words

#: Fewest training documents (near copies count once) that a lexicon feature is in.
SUPPORT = 6
LEXICON_VOTERS = 24


def held_out(doc_id: Column) -> Column:
    """A fifth of the documents; their labels are never learned from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


@dataclass
class ToxicModel:
    features: np.ndarray  # sorted uint64
    weights: np.ndarray
    bias: float

    def hits(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of text, index of feature) of the features present, each pair once."""
        texts, found = [], []
        size = max(1, len(self.features))
        maybe = np.zeros(1 << 20, bool)
        maybe[self.features >> np.uint64(44)] = True
        for first, last in slices(offsets, CHUNK):
            at = offsets[first : last + 1]
            for hashes, text in Words(data[at[0] : at[-1]], at - at[0]).features():
                likely = np.flatnonzero(maybe[hashes >> np.uint64(44)])
                if len(likely) and len(self.features):
                    where = np.minimum(np.searchsorted(self.features, hashes[likely]), size - 1)
                    same = self.features[where] == hashes[likely]
                    texts.append(text[likely][same] + first)
                    found.append(where[same])
        if not texts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        both = np.unique(np.concatenate(texts) * size + np.concatenate(found))
        return both // size, both % size

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        text, feature = self.hits(data, offsets)
        total = np.full(len(offsets) - 1, self.bias)
        np.add.at(total, text, self.weights[feature])
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(texts), np.uint8), np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)


def without_near_copies(texts: list[bytes]) -> np.ndarray:
    """Marks the texts that share no minimum of two hash orders of their 3-word shingles with an earlier one; copies would pass off chance words as lexicon."""
    keep, seen = np.ones(len(texts), bool), set()
    data, offsets = joined(texts)
    for k, hashes in enumerate(shingle_sets(data, offsets, 3)):
        if len(hashes):
            marks = {(0, int(hashes.min())), (1, int(mix(hashes).min()))}
            keep[k] = not marks & seen
            seen |= marks
    return keep


def features_by_text(data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """Hashes of the features of consecutive texts, each once a text, a few texts at a time."""
    for first, last in slices(offsets, CHUNK):
        at = offsets[first : last + 1]
        own = Words(data[at[0] : at[-1]], at - at[0]).features()
        hashes, text = np.concatenate([h for h, _ in own]), np.concatenate([t for _, t in own])
        order = np.lexsort((hashes, text))
        hashes, text = hashes[order], text[order]
        fresh = np.ones(len(hashes), bool)
        fresh[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
        yield hashes[fresh]


def mine_lexicon(texts: list[bytes], toxic: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The `most` features whose presence speaks most clearly for label 1, and the documents of label 1 that have each.

    A feature needs SUPPORT documents of label 1, so those are read first; the others only count what was found there.
    """
    bad = joined([t for t, y in zip(texts, toxic, strict=True) if y])
    found, hit = np.unique(np.concatenate([np.zeros(0, np.uint64), *features_by_text(*bad)]), return_counts=True)
    found, hit = found[hit >= SUPPORT], hit[hit >= SUPPORT]
    if not len(found):
        return found, hit
    count = hit.copy()
    for hashes in features_by_text(*joined([t for t, y in zip(texts, toxic, strict=True) if not y])):
        at = np.minimum(np.searchsorted(found, hashes), len(found) - 1)
        count += np.bincount(at[found[at] == hashes], minlength=len(found))
    rate = (toxic.sum() + 1) / (len(toxic) + 2)
    z = (hit - count * rate) / np.sqrt(count * rate * (1 - rate))
    good = np.flatnonzero((hit / count >= max(0.6, 3 * rate if rate < 0.25 else 0.75)) & (z > 6))
    good = good[np.argsort(-z[good], kind="stable")][:most]
    return np.sort(found[good]), hit[good][np.argsort(found[good])]


def votes_of(texts: list[bytes], present: np.ndarray, strength: np.ndarray) -> np.ndarray:
    """Votes, documents x voters: 1 toxic, -1 clean, 0 abstains. present: documents x features."""
    order = np.argsort(-strength, kind="stable")
    hits = present.sum(1)
    size = np.array([max(1, len(t)) for t in texts])
    views = [np.frombuffer(t, np.uint8) for t in texts]
    shout = np.array([np.count_nonzero((v >= 65) & (v <= 90)) / max(1, np.count_nonzero(v > 64)) for v in views])
    marks = np.array([t.count(b"!!") + t.count(b"***") for t in texts]) / size
    columns = [present[:, order[k::LEXICON_VOTERS]].any(1).astype(int) for k in range(min(LEXICON_VOTERS, len(order)))]
    columns += [np.where(hits >= least, 1, 0) for least in (2, 3, 5)] + [np.where(hits / size > d, 1, 0) for d in (1e-3, 5e-3)]
    columns += [np.where(hits == 0, -1, 0), np.where(shout > 0.6, 1, 0), np.where(marks > 0.01, 1, 0)]
    return np.stack(columns, 1)


def label_model(votes: np.ndarray, share: float, rounds: int = 40, shrink: float = 0.7) -> np.ndarray:
    """Posterior probability of label 1 from the votes and the share of label 1.

    Rates of each vote given the label by expectation maximisation, started from any vote for 1 against none. The model also
    estimates how voters correlate given the label; their evidence is weighted by the inverse of that correlation matrix, which
    is shrunk toward independence as it is estimated from few documents, so opinions that come together count about once.
    """
    n, m = votes.shape
    cases = np.stack([votes == v for v in (-1, 0, 1)], 2).astype(float)
    post = np.where((votes > 0).any(1), 0.9, 0.02)
    weight = np.full(m, 0.5)
    for step in range(rounds):
        rates = []
        for p in (1 - post, post):
            counts = np.einsum("n,nmv->mv", p, cases) + 0.5
            rates.append(counts / counts.sum(1, keepdims=True))
        if step % 10 == 0:
            together = np.zeros((m, m))
            for p, rate in zip((1 - post, post), rates, strict=True):
                centred = (votes - rate @ np.array([-1, 0, 1])) * np.sqrt(p)[:, None]
                cov = centred.T @ centred
                spread = np.sqrt(np.maximum(np.diag(cov), 1e-9))
                together += cov / np.outer(spread, spread) * p.mean()
            related = (1 - shrink) * together
            np.fill_diagonal(related, 1)
            weight = np.clip(np.linalg.solve(related, np.ones(m)), 0.05, 1)
        gain = np.einsum("nmv,mv,m->n", cases, np.log(rates[1]) - np.log(rates[0]), weight)
        post = 1 / (1 + np.exp(-np.clip(np.log(share / (1 - share)) + gain, -30, 30)))
    return post


def fit_linear(present: np.ndarray, target: np.ndarray, rounds: int = 400, ridge: float = 0.02) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels, both classes with equal weight, weights of lexicon features not below 0.

    Accelerated gradient steps, each coordinate scaled by how many documents have it; the penalty keeps weights finite where
    the classes can be told apart.
    """
    x = present.astype(np.float32)
    prior = float(np.clip(target.mean(), 1e-3, 1 - 1e-3))
    balance = (target * 0.5 / prior + (1 - target) * 0.5 / (1 - prior)) / len(target)
    scale = 1 / (0.25 * (x.T @ balance) * max(1.0, float(x.sum(1).max()) / 4) + ridge / len(x.T))
    w, b = np.zeros(x.shape[1], np.float32), 0.0
    look_w, look_b = w, b
    for k in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ look_w + look_b, -30, 30)))
        error = (p - target) * balance
        new_w = np.maximum(look_w - scale * (x.T @ error + ridge / len(x.T) * look_w), 0).astype(np.float32)
        new_b = look_b - 0.5 * float(error.sum())
        momentum = min(0.9, k / (k + 3))
        look_w, look_b = new_w + momentum * (new_w - w), new_b + momentum * (new_b - b)
        w, b = new_w, new_b
    return w, b


def fit(texts: list[bytes], labels: list[int], max_features: int = 3_000) -> ToxicModel:
    """A model of at most max_features lexicon features from labelled texts. Without any lexicon feature every score is the share of label 1, held below 0.5."""
    toxic = np.array(labels, float)
    if not len(texts):
        return ToxicModel(np.zeros(0, np.uint64), np.zeros(0), -3.0)
    single = np.flatnonzero(without_near_copies(texts))
    texts, toxic = [texts[k] for k in single], toxic[single]
    features, strength = mine_lexicon(texts, toxic, max_features)
    share = min(0.4, max(0.01, toxic.mean()))
    if not len(features):
        return ToxicModel(features, np.zeros(0), float(np.log(share / (1 - share))))
    present = np.zeros((len(texts), len(features)), bool)
    present[ToxicModel(features, np.zeros(len(features)), 0.0).hits(*joined(texts))] = True
    post = label_model(votes_of(texts, present, strength), share)
    weights, bias = fit_linear(present, post)
    return ToxicModel(features, weights.astype(float), min(bias, -0.5))


def training_rows(docs: DataFrame, labels: DataFrame, most: int) -> tuple[list[bytes], list[int]]:
    """A bounded sample of labelled rows outside the held-out fifth, the same on each run: smallest hashes of doc_id first. At most `most` rows."""
    learn = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    sample = learn.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    found = docs.select("doc_id", utf8("text")).join(F.broadcast(sample), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))  # one row an id, however often it is there
    rows = found.collect()  # bounded by `most`
    rows.sort(key=lambda r: r.doc_id)
    return [bytes(r.text) for r in rows], [r.toxic for r in rows]


def score_toxicity(docs: DataFrame, labels: DataFrame, train_docs: DataFrame | None = None, max_train: int = 8_000, max_features: int = 3_000) -> DataFrame:
    """Toxicity of every whole text: doc_id, held_out boolean, score double, predicted int; one row for each row of docs.

    labels: doc_id, toxic (0/1); rows with null in either are not learned from. train_docs: where the labelled texts are
    (default docs). max_train bounds the labelled rows that the model is fitted on, max_features its lexicon. Null texts count as empty and get the
    score of a text without any hit; null ids stay null and count as not held out. Only doc_id and text are read.
    """
    source = docs if train_docs is None else train_docs
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(fit(*training_rows(source, labels, max_train), max_features))  # bounded by max_features

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_worker()
        for batch in batches:
            data, offsets = byte_view(batch.column(2))
            score = model.value.scores(data, offsets)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"]
            )

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), utf8("text"))
    return own.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def keep_clean(docs: DataFrame, labels: DataFrame, train_docs: DataFrame | None = None, max_train: int = 8_000, max_features: int = 3_000) -> DataFrame:
    """The rows of docs that score_toxicity predicts as 0; all columns, in one pass."""
    source = docs if train_docs is None else train_docs
    model = docs.sparkSession.sparkContext.broadcast(fit(*training_rows(source, labels, max_train), max_features))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_worker()
        for batch in batches:
            text = batch.column(at)
            score = model.value.scores(*byte_view(text.cast(pa.binary() if pa.types.is_string(text.type) else pa.large_binary()).fill_null(b"")))
            yield batch.filter(pa.array(score < 0.5))

    return docs.mapInArrow(run, docs.schema)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
