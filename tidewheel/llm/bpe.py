"""Byte-level BPE by a backtracking encoder, and decoding by an offset table.

Encoding a piece of text walks it from the left. An Aho-Corasick automaton over the vocabulary gives every token that
starts at a position; the longest is tried first and kept only if it is compatible with the token before it, that is, if
merging the bytes of both tokens from scratch would leave exactly these two. A sequence whose neighbours are all compatible
is the result of the merges, so no merge is ever replayed. When no token fits, the position is marked dead and the walk goes
back by one token; each position dies at most once, so the work is linear in the piece.

Decoding gathers token bytes from one buffer through a table of offsets.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.llm.common import CACHES, bounded, lean_worker, table, utf8

VOCABULARY = "byte_bpe_50k.json"
#: Longer pieces are encoded anew each time; the cache holds as many pieces at most.
CACHED_CHARS, CACHED_PIECES = 48, 250_000


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of the 256 bytes in a byte-level vocabulary: printable bytes stand for themselves, the others follow from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    names = {chr(b): b for b in shown}
    hidden = [b for b in range(256) if b not in set(shown)]
    return names | {chr(256 + k): b for k, b in enumerate(hidden)}


def load_rules(path: str) -> dict:
    """The parts of a tokenizer file that decide ids, small enough to ship with a task (the vocabulary bounds it)."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    pre, model = spec["pre_tokenizer"] or {}, spec["model"]
    if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or spec["normalizer"] or model.get("ignore_merges"):
        raise ValueError(f"{path}: only byte-level BPE without normalizer and prefix space is supported")
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
        raise ValueError(f"{path}: added tokens with stripping or word bounds are not supported")
    alphabet = byte_alphabet()
    raw = lambda token: bytes(alphabet[c] for c in token)
    vocab = {raw(t): i for t, i in model["vocab"].items()}
    merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
    return {
        "vocab": vocab,
        "merges": [(vocab[raw(a)], vocab[raw(b)], vocab[raw(a + b)]) for a, b in merges],
        "added": {t["content"]: t["id"] for t in spec["added_tokens"]},
    }


class Pieces(dict):
    """Piece of text to its ids, packed as little-endian 32-bit numbers; bounded."""

    def __init__(self, encode, most: int):
        super().__init__()
        self.encode, self.most = encode, most

    def __missing__(self, piece: str) -> bytes:
        packed = np.array(self.encode(piece.encode()), "<u4").tobytes()
        if len(piece) <= CACHED_CHARS:
            if len(self) >= self.most:
                self.clear()
            self[piece] = packed
        return packed


class BytePairCodec:
    """Encoder and decoder of one vocabulary.

    Edge cases: an empty text has no ids; strings of added tokens inside a text become their ids, as the public library does
    by default; long runs without a break cost linear time.
    """

    #: The public byte-level split pattern (fixed value).
    SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

    def __init__(self, rules: dict, cached: int = CACHED_PIECES):
        import ahocorasick
        import regex

        self.split = regex.compile(self.SPLIT)
        added = sorted(rules["added"], key=len, reverse=True)
        self.added = rules["added"]
        self.apart = regex.compile("(" + "|".join(map(regex.escape, added)) + ")") if added else None
        size = max([*rules["vocab"].values(), *rules["added"].values()]) + 1
        spelled: list[bytes] = [b""] * size
        for token, i in rules["vocab"].items():
            spelled[i] = token
        for token, i in rules["added"].items():
            spelled[i] = token.encode()
        self.widths = np.array([len(t) for t in spelled], np.int64)
        self.length = self.widths.tolist()
        self.starts = np.concatenate(([0], np.cumsum(self.widths)))[:-1]
        self.buffer = np.frombuffer(b"".join(spelled), np.uint8)
        decimal = [str(i).encode() + b"," for i in range(size)]
        self.number_widths = np.array([len(t) for t in decimal], np.int64)
        self.number_starts = np.concatenate(([0], np.cumsum(self.number_widths)))[:-1]
        self.number_buffer = np.frombuffer(b"".join(decimal), np.uint8)
        self.rank: dict[tuple[int, int], int] = {}
        self.made: dict[int, tuple[int, int, int]] = {}
        for r, (a, b, whole) in enumerate(rules["merges"]):
            self.rank.setdefault((a, b), r)
            self.made.setdefault(whole, (r, a, b))
        self.automaton = ahocorasick.Automaton()
        for token, i in rules["vocab"].items():
            self.automaton.add_word(token.decode("latin-1"), i)
        self.automaton.make_automaton()
        self.fits: dict[int, bool] = {}
        self.edges: tuple[dict, dict] = ({}, {})
        self.pieces, self.cached = Pieces(self.encode_piece, cached), cached

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """The tokens that stand at a token's right (side 1) or left (side 0) end while it is being built, each with the rank of the merge that uses it up."""
        known = self.edges[side].get(token)
        if known is None:
            known, at, used = [], token, len(self.rank) + 1
            while True:
                known.append((at, used))
                if at not in self.made:
                    break
                used, left, right = self.made[at]
                at = right if side else left
            self.edges[side][token] = known
        return known

    def compatible(self, a: int, b: int) -> bool:
        """Whether the merges leave the bytes of a and b as exactly these two tokens.

        They don't if some merge across the border has its turn while both of its parts still stand there. Equal merges go
        from left to right, so on a tie the left part is gone already and the right part isn't.
        """
        key = a << 20 | b
        known = self.fits.get(key)
        if known is None:
            known = True
            for x, x_used in self._edge(a, 1):
                for y, y_used in self._edge(b, 0):
                    r = self.rank.get((x, y))
                    if r is not None and r < x_used and r <= y_used:
                        known = False
                        break
                if not known:
                    break
            if len(self.fits) >= self.cached:
                self.fits.clear()
            self.fits[key] = known
        return known

    def encode_piece(self, piece: bytes) -> list[int]:
        n, length = len(piece), self.length
        found: list[list[int]] = [[] for _ in range(n + 1)]
        for last, token in self.automaton.iter(piece.decode("latin-1")):
            found[last + 1 - length[token]].append(token)
        dead, out, tried = bytearray(n + 1), [], []
        at, k = 0, len(found[0]) - 1
        while at < n:
            here = found[at]
            while k >= 0 and (dead[at + length[here[k]]] or (out and not self.compatible(out[-1], here[k]))):
                k -= 1
            if k >= 0:
                out.append(here[k])
                tried.append(k)
                at += length[here[k]]
                k = len(found[at]) - 1
            elif out:
                dead[at] = 1
                at -= length[out.pop()]
                k = tried.pop() - 1
            else:
                raise ValueError("the vocabulary lacks a byte")
        return out

    def encode(self, text: str) -> np.ndarray:
        """The ids of a whole text."""
        parts = self.apart.split(text) if self.apart else [text]
        packed = []
        for k, part in enumerate(parts):
            if k % 2:
                packed.append(np.array([self.added[part]], "<u4").tobytes())
            elif part:
                packed.extend(map(self.pieces.__getitem__, self.split.findall(part)))
        return np.frombuffer(b"".join(packed), "<u4")

    @staticmethod
    def _gather(ids: np.ndarray, starts: np.ndarray, widths: np.ndarray, buffer: np.ndarray) -> bytes:
        if not len(ids):
            return b""
        wide = widths[ids]
        ends = np.cumsum(wide)
        return buffer[np.repeat(starts[ids] - (ends - wide), wide) + np.arange(ends[-1])].tobytes()

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        return self._gather(ids, self.starts, self.widths, self.buffer)

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; bytes that are no UTF-8 become U+FFFD."""
        return self.decode_bytes(ids).decode("utf-8", "replace")

    def decimals(self, ids: np.ndarray) -> bytes:
        """The ids in decimal, joined by commas."""
        return self._gather(ids, self.number_starts, self.number_widths, self.number_buffer)[:-1]


_codecs: dict[tuple[str, int], BytePairCodec] = {}
CACHES["codecs"] = _codecs.clear


def codec(rules, path: str, cached: int) -> BytePairCodec:
    """One codec for each vocabulary in a Python worker, which outlives a task. rules: the broadcast of load_rules(), whose copy in the worker goes once the codec stands."""
    if (path, cached) not in _codecs:
        _codecs[path, cached] = BytePairCodec(rules.value, cached)
        rules.__dict__.pop("_value", None)  # loaded again if another codec needs it
    return _codecs[path, cached]


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def encode_documents(docs: DataFrame, path: str | None = None, text: str = "text", id_col: str = "doc_id", with_ids: bool = False, cached: int = CACHED_PIECES) -> DataFrame:
    """Encode every whole text and decode it again.

    cached: pieces of text whose ids a worker remembers at most; fewer take less memory and more time.

    Returns (id_col, n_tokens long, ids_sha256 string, decoded_sha256 string[, ids array<int>, decoded string]), one row for
    each row of docs. Null texts count as empty; null ids stay null; repeated rows give repeated rows; an empty table gives
    an empty table; other columns, whatever their names, are not read. No shuffle: one pass over the input.
    """
    spark = bounded(docs.sparkSession)
    path = path or default_vocabulary()
    rules = spark.sparkContext.broadcast(load_rules(path))  # bounded by the vocabulary
    schema = f"`{id_col}` long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded string" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_worker(keep="codecs")
        own = codec(rules, path, cached)
        for batch in batches:
            n, ids_hash, text_hash, kept, texts = [], [], [], [], []
            for raw in batch.column(1):
                ids = own.encode(raw.as_buffer().to_pybytes().decode("utf-8", "replace") if raw.is_valid else "")
                decoded = own.decode(ids)
                n.append(len(ids))
                ids_hash.append(hashlib.sha256(own.decimals(ids)).hexdigest())
                text_hash.append(hashlib.sha256(decoded.encode()).hexdigest())
                if with_ids:
                    kept.append(ids.astype(np.int32))
                    texts.append(decoded)
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(text_hash, pa.string())]
            if with_ids:
                columns += [pa.array(kept, pa.list_(pa.int32())), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"][: len(columns)])

    return docs.select(F.col(id_col).cast("long").alias(id_col), utf8(text)).mapInArrow(run, schema)


def op3_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"))
