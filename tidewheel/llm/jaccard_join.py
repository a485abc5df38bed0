"""N-gram Jaccard join with PartEnum signatures.

Sets of similar size fall into bands [lo, 2 lo), and a signature belongs to a band. In it the domain of shingle hashes is cut
into partitions, and subsets of partitions that r and s must have in common are enumerated. The cut is the finest one, each
shingle a partition of its own, and the subsets are single partitions: with coarser ones a shingle that only s has spoils a
partition of r, so twice as many may differ and twice as many signatures are needed. (At this end of its parameters PartEnum
is a prefix filter.) r and s with a Jaccard similarity of at least num / den agree in
a = ceil(num (|r| + |s|) / (num + den)) shingles, so of one order of all shingles the first |r| - a + 1 of r and the first
|s| - a + 1 of s share one. The order takes rare shingles first and those that are common in the corpus last. A set emits
signatures for its own band, for any partner that is not larger or in the band, and for the next band if a partner may be there.

From signatures to components, without listing the pairs of a large group:

1. One pass makes the signatures. Equal sets have one identifier and emit once in a task. Sets that share a signature in the
   same batch of rows meet there, and only one of them is passed on; so a signature that a third of all sets have gives a
   row for each batch, not for each set.
2. Signatures are dealt by hash and sorted; a run of equal ones streams by, each set paired with the first of its run.
3. Each set's pair with its most central partner, the one that meets most others, is verified on the sets, exactly, and
   linked sets form components; then the pairs of a run's first with its others, where they are still apart.
4. Runs that now hold a single component are done. In the others the sets of different components are held against each
   other by stars: a star is a hub and the sets that were found to link to it, each with its exact distance. Jaccard distance is
   a metric, so if hubs are farther apart than the threshold and the distances of two members from them, these don't link. The
   hubs of stars that meet are measured once; those that link join their components, and where they are still apart only
   members that the bound leaves are verified in pairs. So a set that stays
   apart from a large group meets the group's few hubs, not its members.
   This completes the join: each link joins two sets that share a signature, so it was verified, lies in one component or is
   ruled out by the bound. Before sets are fetched, the counts of their shingles in cells of the hash domain rule out most
   pairs that aren't near enough.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.llm.common import Scratch, byte_view, connected, is_hot, lean_worker, slices, spread, table, utf8
from tidewheel.llm.shingles import mix, set_id, shingle_sets

#: First size of the second band; smaller sets use every shingle as a partition of its own.
SMALL = 16
EMITTED = "key long, a long, x binary"
STAGED = "kind int, a long, b long, c long, left long, cells binary"
#: Fewest cells of the hash domain whose counts bound the symmetric difference; larger sets have up to half as many as shingles.
CELLS = 64
#: Bytes of text whose signatures meet in a task before they are dealt.
PORTION = 4 << 20
#: Bytes of text over which a task counts shingles before it passes on the repeated ones.
COUNTED = 12 << 20


class Signatures:
    """Signatures of one set; t = num / den."""

    def __init__(self, num: int, den: int, common: np.ndarray, level: np.ndarray):
        self.num, self.den, self.common, self.level = num, den, common, level

    def band(self, size: int) -> tuple[int, int, int]:
        """(number, smallest size, largest size) of a size's band."""
        if size < SMALL:
            return 0, 1, SMALL - 1
        number = (size // SMALL).bit_length()
        lo = SMALL << (number - 1)
        return number, lo, 2 * lo - 1

    def _first(self, order: np.ndarray, hashes: np.ndarray, smallest: int, number: int) -> tuple[np.ndarray, np.ndarray]:
        """Signatures in a band for partners of at least `smallest` shingles, and how many shingles of the order are left from each on."""
        n = len(hashes)
        agree = -(-self.num * (n + smallest) // (self.num + self.den))
        chosen = order[: max(0, n - agree + 1)]
        return mix(hashes[chosen] ^ np.uint64((number + 1) * 0x2545F4914F6CDD1D & 0xFFFFFFFFFFFFFFFF)), n - np.arange(len(chosen))

    def of(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(hashes)
        place = mix(hashes) >> np.uint64(8)
        if len(self.common):
            at = np.minimum(np.searchsorted(self.common, hashes), len(self.common) - 1)
            place |= np.where(self.common[at] == hashes, self.level[at], 0).astype(np.uint64) << np.uint64(56)
        order = np.argsort(place)
        number, _, hi = self.band(n)
        own = self._first(order, hashes, -(-n * self.num // self.den), number)
        if n * self.den // self.num <= hi:
            return own
        return tuple(map(np.concatenate, zip(own, self._first(order, hashes, hi + 1, number + 1), strict=True)))


def _binary(flat: np.ndarray) -> pa.Array:
    """The rows of a matrix as binary values."""
    flat = np.ascontiguousarray(flat)
    offsets = np.arange(len(flat) + 1, dtype=np.int32) * (flat.itemsize * flat.shape[1])
    return pa.Array.from_buffers(pa.binary(), len(flat), [None, pa.py_buffer(offsets), pa.py_buffer(flat)])


def _packed(columns: list[np.ndarray]) -> np.ndarray:
    return np.stack([c.astype(np.int64) for c in columns], 1).view(np.uint8)


def _cells(hashes: np.ndarray) -> bytes:
    """How many hashes are in each cell, 255 for more; cells are a power of two."""
    bits = max(6, (len(hashes) // 2).bit_length() - 1)
    return np.minimum(np.bincount((hashes >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits), 255).astype(np.uint8).tobytes()


def _rows(key: np.ndarray, a: np.ndarray, x: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(a), x], names=["key", "a", "x"])


def _portions(batches: Iterator[pa.RecordBatch], size: int = PORTION) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows (id, text) in portions of bounded text: ids, bytes, offsets."""
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        data, offsets = byte_view(batch.column(1))
        for first, last in slices(offsets, size):
            yield ids[first:last], data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]


def _often(width: int, least: int):
    """Shingles of at least `least` different sets of a portion, with their number; every portion of the corpus is counted."""

    def counted(sets: dict[int, np.ndarray]) -> pa.RecordBatch:
        found, counts = np.unique(np.concatenate([*sets.values(), np.zeros(0, np.uint64)]), return_counts=True)
        often = counts >= least
        return pa.RecordBatch.from_arrays([pa.array(found[often].view(np.int64)), pa.array(counts[often].astype(np.int64))], names=["shingle", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_worker()
        sets, held = {}, 0
        for _, data, offsets in _portions(batches):
            for hashes in shingle_sets(data, offsets, width):
                sets[set_id(hashes)] = hashes
            held += len(data)
            if held >= COUNTED:
                yield counted(sets)
                sets, held = {}, 0
        if sets:
            yield counted(sets)

    return run


def common_shingles(texts: DataFrame, width: int, least: int = 2, total: int = 6, most: int = 200_000) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles of the corpus, at most `most` (16 bytes each to every task), and a level that rises with their number. They only decide the order of signatures: any list gives the same links."""
    counted = texts.mapInArrow(_often(width, least), "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n")).where(F.col("n") >= total)
    top = counted.orderBy(F.desc("n"), "shingle").limit(most).toPandas()  # bounded by `most`
    found, n = top["shingle"].to_numpy(np.int64).view(np.uint64), top["n"].to_numpy(np.int64)
    order = np.argsort(found)
    return found[order], np.minimum(255, 4 * np.log2(np.maximum(n[order], 2))).astype(np.uint8)


def _emitter(width: int, num: int, den: int, common):
    """Texts to rows: 8 bytes: signature key of set a, and the shingles left; 16 bytes and the cells: a document's id and size, a its set; 24 bytes: a's pivot, the signature that they share in a batch, and the shingles left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_worker()
        scheme, seen = Signatures(num, den, *common.value), set()
        for ids, data, offsets in _portions(batches):
            sets, sizes, cells, found, of = [], [], [], [], []
            for hashes in shingle_sets(data, offsets, width):
                own = set_id(hashes)
                sets.append(own)
                sizes.append(len(hashes))
                cells.append(_cells(hashes))
                if len(hashes) and own not in seen:
                    if len(seen) > 1 << 18:
                        seen.clear()
                    seen.add(own)
                    found.append(scheme.of(hashes))
                    of.append(own)
            sets = np.array(sets, np.int64)
            if not len(sets):
                continue
            yield _rows(mix(ids.astype(np.int64).view(np.uint64)), sets, pa.array([head.tobytes() + own for head, own in zip(_packed([ids, np.array(sizes)]), cells, strict=True)], pa.binary()))
            if not found:
                continue
            owner = np.repeat(np.array(of, np.int64), [len(f) for f, _ in found])
            signature, left = (np.concatenate(x) for x in zip(*found, strict=True))
            order = np.lexsort((owner, signature))
            signature, owner, left = signature[order], owner[order], left[order]
            first = np.flatnonzero(np.concatenate(([True], signature[1:] != signature[:-1])))
            length = np.diff(np.append(first, len(signature)))
            pivot = owner[first]
            sent = np.argsort(pivot, kind="stable")  # rows of a set side by side: shuffled blocks compress better
            for lo in range(0, len(first), 1 << 18):
                part = sent[lo : lo + (1 << 18)]
                yield _rows(signature[first[part]], pivot[part], _binary(_packed([left[first[part]]])))
            met = np.repeat(length > 1, length)
            if met.any():
                member, shared, to = owner[met], signature[met], np.repeat(pivot, length)[met]
                yield _rows(mix(member.view(np.uint64) ^ shared), member, _binary(_packed([to, shared.view(np.int64), left[met]])))

    return run


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key to staged rows: kind 1: document b of size c has set a; kind 2: set a shares signature c with its pivot b."""
    lean_worker()
    key, pivot, pivot_left, shown = None, 0, 0, False
    for batch in batches:
        data, offsets = byte_view(batch.column(2))
        wide = np.diff(offsets)
        a = batch.column(1).to_numpy()
        parts = []  # kind, a, b, c, left, cells

        def numbers(which: np.ndarray, size: int) -> np.ndarray:
            return data[(offsets[which][:, None] + np.arange(size)).ravel()].view(np.int64).reshape(len(which), size // 8)

        which = np.flatnonzero((wide != 8) & (wide != 24))
        if len(which):
            own = numbers(which, 16)
            cells = pa.array([data[offsets[k] + 16 : offsets[k + 1]].tobytes() for k in which], pa.binary())
            parts.append((1, a[which], own[:, 0], own[:, 1], np.zeros(len(which), np.int64), cells))
        which = np.flatnonzero(wide == 24)
        if len(which):
            own = numbers(which, 24)
            parts.append((2, a[which], own[:, 0], own[:, 1], own[:, 2], pa.nulls(len(which), pa.binary())))
        which = np.flatnonzero(wide == 8)
        if len(which):
            keys, sets, left = batch.column(0).to_numpy()[which], a[which], numbers(which, 8)[:, 0]
            fresh = np.concatenate(([keys[0] != key], keys[1:] != keys[:-1]))
            runs = np.cumsum(fresh)  # 0: the run of the batch before
            heads, heads_left = np.append(pivot, sets[fresh]), np.append(pivot_left, left[fresh])
            lead, lead_left = heads[runs], heads_left[runs]
            other = ~fresh & (sets != lead)
            if other.any():
                parts.append((2, sets[other], lead[other], keys[other], left[other], pa.nulls(int(other.sum()), pa.binary())))
                runs_met, at = np.unique(runs[other], return_index=True)
                if shown and runs_met[0] == 0:
                    at = at[1:]
                parts.append((2, lead[other][at], lead[other][at], keys[other][at], lead_left[other][at], pa.nulls(len(at), pa.binary())))
            in_last = bool((other & (runs == runs[-1])).any())
            shown = (shown and runs[-1] == 0) or in_last
            key, pivot, pivot_left = keys[-1], lead[-1], lead_left[-1]
        if parts:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(np.array([p[0] for p in parts], np.int32), [len(p[1]) for p in parts])),
                    *(pa.array(np.concatenate([p[k] for p in parts])) for k in range(1, 5)),
                    pa.concat_arrays([p[5] for p in parts]),
                ],
                names=["kind", "a", "b", "c", "left", "cells"],
            )


def _sets_of(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_worker()
        for batch in batches:
            data, offsets = byte_view(batch.column(0))
            ids, sets, held = [], [], 0
            for hashes in shingle_sets(data, offsets, width):
                ids.append(set_id(hashes))
                sets.append(hashes.tobytes())
                held += len(sets[-1])
                if held > 1 << 23:
                    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sets, pa.binary())], names=["set", "hashes"])
                    ids, sets, held = [], [], 0
            if ids:
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sets, pa.binary())], names=["set", "hashes"])

    return run


def _pruner(num: int, den: int):
    """Drops pairs that cannot be as near as they should: a Jaccard distance of 1 - num / den and `slack` more.

    The counts of shingles in the cells of the hash domain differ by no more than the symmetric difference. Counts above 255
    stand as 255, which only weakens the bound.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_worker()
        for batch in batches:
            far = np.minimum((den - num) / den + batch.column(2).to_numpy(), 1)
            most = far * (batch.column(3).to_numpy() + batch.column(4).to_numpy()) / (2 - far) + 1e-6
            good = []
            for p, q, k in zip(batch.column(5), batch.column(6), most.tolist(), strict=True):
                p, q = (np.frombuffer(z.as_buffer(), np.uint8).astype(np.int32) for z in (p, q))
                n = min(len(p), len(q))
                good.append(int(np.abs(p.reshape(n, -1).sum(1) - q.reshape(n, -1).sum(1)).sum()) <= k)
            yield batch.select([0, 1, 2]).filter(pa.array(good, pa.bool_()))

    return run


def _measured(num: int, den: int):
    """Pairs with their exact Jaccard distance, where it is at most 1 - num / den and `slack` more, and whether they link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_worker()
        for batch in batches:
            good, far, link = [], [], []
            for slack, p, q in zip(batch.column(2).to_pylist(), batch.column(3), batch.column(4), strict=True):
                p, q = (np.frombuffer(z.as_buffer(), np.uint64) for z in (p, q))
                if len(p) > len(q):
                    p, q = q, p
                both = 0
                if len(p):
                    at = np.searchsorted(q, p)
                    both = int((q[np.minimum(at, len(q) - 1)] == p).sum())
                union = len(p) + len(q) - both
                links = den * both >= num * union
                good.append(bool(len(p)) and (links or (slack > 0 and den * both >= (num - den * slack) * union - 1e-6)))
                if good[-1]:
                    far.append(1 - both / union)
                    link.append(links)
            pairs = batch.select([0, 1]).filter(pa.array(good, pa.bool_()))
            yield pa.RecordBatch.from_arrays([*pairs.columns, pa.array(far, pa.float64()), pa.array(link, pa.bool_())], names=["a", "b", "far", "links"])

    return run


def similar_sets(docs: DataFrame, scratch: Scratch, width: int, num: int, den: int, few: int = 1_000_000) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(members: doc_id, n, set), (classes: set, n, rep) and (component: node, label) over the sets that have links."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8("text"))
    texts = texts.where("doc_id is not null")
    common = docs.sparkSession.sparkContext.broadcast(common_shingles(texts, width))
    scratch.release()
    met = texts.mapInArrow(_emitter(width, num, den, common), EMITTED).repartition("key").sortWithinPartitions("key")
    staged = scratch.made(met, _meet, STAGED, "staged")
    scratch.release()
    members = staged.where("kind = 1").select(F.col("b").alias("doc_id"), F.col("c").alias("n"), F.col("a").alias("set"))
    outline = staged.where("kind = 1 and c > 0").groupBy(F.col("a").alias("set")).agg(F.min("c").alias("n"), F.min("b").alias("rep"), F.min("cells").alias("cells"))
    classes = scratch.hold(outline, "classes")
    shared = staged.where("kind = 2").select(F.col("c").alias("signature"), F.col("a").alias("set"), F.col("b").alias("pivot"), "left")

    def likely(pairs: DataFrame, name: str) -> DataFrame:
        """Pairs (a, b, slack) without those that sizes and cell counts rule out."""
        one, two = (classes.select(F.col("set").alias(x), F.col("n").alias(f"n_{x}"), F.col("cells").alias(f"cells_{x}")) for x in "ab")
        least = num - den * F.col("slack") - 1e-6
        fits = (F.col("n_a") * den >= F.col("n_b") * least) & (F.col("n_b") * den >= F.col("n_a") * least)
        known = pairs.join(one, "a").join(two, "b").where(fits).select("a", "b", "slack", "n_a", "n_b", "cells_a", "cells_b")
        return scratch.made(known, _pruner(num, den), "a long, b long, slack double", name)

    def near(pairs: DataFrame, name: str) -> DataFrame:
        """The pairs that are near enough with their distance, by their sets, which are made anew from the texts that are needed."""
        nodes = pairs.select(F.col("a").alias("set")).union(pairs.select("b")).distinct()
        wanted = scratch.hold(classes.join(nodes, "set", "left_semi").select(F.col("rep").alias("doc_id")), f"{name}-wanted")
        if wanted.count() <= few:  # 8 bytes each: small whatever the texts hold
            wanted = F.broadcast(wanted)
        sets = scratch.made(texts.join(wanted, "doc_id", "left_semi").select("text"), _sets_of(width), "set long, hashes binary", f"{name}-sets")
        one, two = (sets.select(F.col("set").alias(x), F.col("hashes").alias(y)) for x, y in ("ap", "bq"))
        found = scratch.made(pairs.join(one, "a").join(two, "b").select("a", "b", "slack", "p", "q"), _measured(num, den), "a long, b long, far double, links boolean", name)
        scratch.drop(f"{name}-wanted", f"{name}-sets")
        scratch.release()
        return found

    spark = docs.sparkSession
    # partners first: in each run the set that meets most others, which is the likeliest centre of a group
    met_by = scratch.hold(shared.groupBy("signature").agg(F.count("*").alias("n")), "met-by")
    hot = is_hot(met_by.agg(F.max("n")).first()[0])

    def by_signature(rows: DataFrame, other: DataFrame, how: str = "inner") -> DataFrame:
        """rows, no more of a signature than shared has, joined to one row for each signature; a common signature isn't one task's work."""
        return spread(rows, other, "signature", how, met_by) if hot else rows.join(other, "signature", how)

    weight = scratch.hold(by_signature(shared, met_by).groupBy("set").agg(F.sum("n").alias("weight")), "weight")
    centre = shared.join(weight, "set").groupBy("signature").agg(F.max(F.struct("weight", "set")).alias("centre"))
    nearest = by_signature(shared, centre).where(F.col("set") != F.col("centre.set")).groupBy("set").agg(F.max("centre").alias("centre"))
    none = F.lit(0.0).alias("slack")
    centred = near(likely(nearest.select(F.col("set").alias("a"), F.col("centre.set").alias("b"), none), "first"), "links-1")
    component = connected(spark, centred, scratch, "cc1")
    pairs = shared.where("set <> pivot").select(F.col("set").alias("a"), F.col("pivot").alias("b")).distinct()
    one, two = (component.select(F.col("node").alias(x), F.col("label").alias(f"label_{x}")) for x in "ab")
    apart = pairs.join(one, "a", "left").join(two, "b", "left").where(F.coalesce("label_a", "a") != F.coalesce("label_b", "b"))
    led = near(likely(apart.select("a", "b", none), "apart"), "links-2")
    component = grown(spark, component, led, scratch, "cc2")
    # stars: each set with a set that it links to and their distance; itself without one
    ties = centred.select("a", F.struct(F.lit(1).alias("step"), "far", F.col("b").alias("hub")).alias("to")).union(led.select("a", F.struct(F.lit(2), "far", "b")))
    star = scratch.hold(ties.groupBy("a").agg(F.min("to").alias("to")).select(F.col("a").alias("of"), "to.hub", "to.far"), "stars")
    scratch.release()

    own = shared.join(component, F.col("set") == F.col("node"), "left").groupBy("signature", "set").agg(F.max("left").alias("left"), F.first(F.coalesce("label", "set")).alias("label"))
    own = scratch.hold(own, "own")
    split = own.groupBy("signature").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("signature")
    opened = by_signature(own, split, "left_semi").join(classes.select("set", "n"), "set").join(star, F.col("set") == F.col("of"), "left")
    opened = scratch.hold(opened.select("signature", "set", "label", "left", "n", F.coalesce("hub", "set").alias("hub"), F.coalesce("far", F.lit(0.0)).alias("far")), "opened")
    scratch.drop("own", "weight", "met-by", "first", "apart")
    scratch.release()
    # sets whose first common signature this is agree in what is left at most; where that is too little, another signature or none joins them
    enough = lambda x, y, p, q: F.least(x, y) * (num + den) >= (F.col(p) + F.col(q)) * num
    fit = lambda p, q: F.col(p) * den >= F.col(q) * num
    stars = opened.groupBy("signature", "label", "hub").agg(F.min("n").alias("small"), F.max("n").alias("large"), F.max("left").alias("left"), F.max("far").alias("radius"))
    of = lambda x: stars.select(F.col("signature").alias(f"run_{x}"), F.col("label").alias(f"l{x}"), F.col("hub").alias(f"h{x}"), F.col("small").alias(f"s{x}"), F.col("large").alias(f"b{x}"), F.col("left").alias(f"r{x}"), F.col("radius").alias(f"d{x}"))
    meet = of("a").join(of("b"), (F.col("run_a") == F.col("run_b")) & (F.col("la") < F.col("lb")) & fit("ba", "sb") & fit("bb", "sa") & enough("ra", "rb", "sa", "sb"))
    meet = scratch.hold(meet.select(F.col("run_a").alias("run"), "ha", "hb", "sb", "bb", "rb", (F.col("da") + F.col("db")).alias("reach")), "meet")
    hubs = meet.groupBy(F.col("ha").alias("a"), F.col("hb").alias("b")).agg(F.max("reach").alias("slack"))
    # distance is a metric: members of two stars link only where the hubs are near by their distances from the hubs
    span = near(likely(hubs, "hubs"), "links-3")
    component = grown(spark, component, span.where("links"), scratch, "cc3")
    one, two = (component.select(F.col("node").alias(f"h{x}"), F.col("label").alias(f"l{x}")) for x in "ab")
    span = span.select(F.col("a").alias("ha"), F.col("b").alias("hb"), (F.col("far") - (den - num) / den - 1e-9).alias("gap")).join(one, "ha", "left").join(two, "hb", "left")
    span = scratch.hold(span.where(F.coalesce("la", "ha") != F.coalesce("lb", "hb")).select("ha", "hb", "gap"), "span")
    side = lambda x: opened.select(F.col("signature").alias(f"run_{x}"), F.col("hub").alias(f"of_{x}"), F.col("set").alias(x), F.col("n").alias(f"n_{x}"), F.col("left").alias(f"r_{x}"), F.col("far").alias(f"far_{x}"))
    may = fit("n_a", "sb") & fit("bb", "n_a") & enough("r_a", "rb", "n_a", "sb")
    close = meet.join(span, ["ha", "hb"]).where("reach >= gap")
    cross = close.join(side("a"), (F.col("run") == F.col("run_a")) & (F.col("ha") == F.col("of_a")) & may)
    fits = fit("n_a", "n_b") & fit("n_b", "n_a") & enough("r_a", "r_b", "n_a", "n_b") & (F.col("far_a") + F.col("far_b") >= F.col("gap"))
    cross = cross.join(side("b"), (F.col("run") == F.col("run_b")) & (F.col("hb") == F.col("of_b")) & fits)
    rest = likely(cross.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), none).distinct(), "rest")
    component = grown(spark, component, near(rest, "links-4"), scratch, "cc4")
    scratch.drop("opened", "rest", "meet", "hubs", "span", "stars", "links-1", "links-2", "links-3", "links-4")
    scratch.release()
    return members, classes, component


def grown(spark: SparkSession, component: DataFrame, links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Components after more links (a, b)."""
    if links.isEmpty():
        return component
    return connected(spark, component.select(F.col("node").alias("a"), F.col("label").alias("b")).union(links.select("a", "b")), scratch, name)


def ngram_components(docs: DataFrame, width: int = 5, num: int = 75, den: int = 100) -> DataFrame:
    """Documents with their near-duplicate component: doc_id, n_shingles long, component_id long.

    docs needs doc_id and text; other columns, whatever their names, are not read. Two documents link when
    den * |intersection| >= num * |union| of their sets of `width`-word shingles; a component_id is the smallest doc_id
    reachable by links. Texts with fewer words are one shingle; null and empty texts and those of white space only link with
    nothing. Rows that repeat a doc_id and a text are returned each; rows without doc_id are left out. Sets are told apart by
    64-bit hashes. An empty table gives an empty table.
    """
    scratch = Scratch(docs.sparkSession, "jaccard-join")
    members, classes, component = similar_sets(docs, scratch, width, num, den)
    named = component.join(classes, F.col("node") == F.col("set")).groupBy("label").agg(F.min("rep").alias("least"))
    of = spread(component, named, "label").select("node", "least")
    found = scratch.hold(classes.join(of, F.col("set") == F.col("node"), "left").select(F.col("set").alias("own"), F.coalesce("least", "rep").alias("component")), "found")
    scratch.drop("classes")
    full = members.where("n > 0").join(found, F.col("set") == F.col("own")).select("doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))
    return full.union(members.where("n = 0").select("doc_id", "n", F.col("doc_id")))


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(table(spark, sf_dir, "documents"))
