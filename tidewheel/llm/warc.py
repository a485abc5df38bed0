"""WARC archives compressed record by record with a Zstandard dictionary that the archive carries.

Writing: a dictionary is built from a bounded sample of the records. Each scan partition writes one archive: a skippable
frame with the dictionary first, then every record as a frame of its own, so that a reader may start at any record. Of
records with equal payloads one is stored in full, the others are revisit records that name it. Archives are written under
a temporary name and moved when complete, so a repeated or lost task leaves whole files only.

Reading: the dictionary is taken from the leading frame, frames are decompressed as a stream and records are parsed from it;
the digest of each stored payload is checked against its header.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.llm.common import Scratch, table, utf8

#: Fixed values of the format: magic number of the skippable frame, profile of a revisit record.
SKIPPABLE = 0x184D2A5D
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID = "urn:tidewheel:page:"
EPOCH = "1970-01-01T00:00:00Z"
#: Fewest records that a dictionary can be trained on.
FEWEST = 16


@dataclass
class Record:
    page_id: int | None
    url: str | None
    payload: bytes
    digest: str
    payload_bytes: int
    record_type: str
    refers_to: int | None


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str = EPOCH) -> bytes:
    """A record as it stands in the archive before compression; a revisit has the HTTP head, but no payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = head if revisit else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <{ID}{'none' if page_id is None else page_id}>", f"WARC-Date: {date}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    lines.append(f"WARC-Payload-Digest: sha1:{payload_digest(payload)}")
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{ID}{refers_to}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def build_dictionary(samples: list[bytes], size: int) -> bytes:
    """A dictionary from records; empty where there are too few to train one."""
    if len(samples) < FEWEST:
        return b""
    try:
        return zstandard.train_dictionary(size, samples, level=3).as_bytes()
    except zstandard.ZstdError:
        return b""


def open_archive(out, dictionary: bytes, level: int):
    """Write the leading frame; returns the compressor of the records."""
    out.write(struct.pack("<II", SKIPPABLE, len(dictionary)) + dictionary)
    return zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None, write_content_size=True, write_checksum=True)


def read_archive(source) -> Iterator[Record]:
    """The records of an archive, one in memory at a time."""
    magic, size = struct.unpack("<II", source.read(8))
    if magic != SKIPPABLE:
        raise ValueError("the archive has no dictionary frame")
    dictionary = source.read(size)
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
    stream = io.BufferedReader(reader.stream_reader(source, read_across_frames=True), 1 << 18)
    number = lambda text: None if text in (None, f"<{ID}none>") else int(text.strip("<>").removeprefix(ID))
    while line := stream.readline():
        if line.strip() != b"WARC/1.1":
            raise ValueError("a record doesn't begin with its version")
        fields = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode().partition(":")
            fields[name.strip().lower()] = value.strip()
        block = stream.read(int(fields["content-length"]))
        stream.read(4)
        head, _, payload = block.partition(b"\r\n\r\n")
        stated = int(next(x.partition(b":")[2] for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:")))
        kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:")
        if kind == "response" and (len(payload) != stated or payload_digest(payload) != digest):
            raise ValueError(f"payload of {fields['warc-record-id']} is damaged")
        yield Record(number(fields["warc-record-id"]), fields.get("warc-target-uri"), payload, digest, stated, kind, number(fields.get("warc-refers-to")))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, sizes = [], []
        for raw in batch.column(1):
            payload = raw.as_buffer()
            keys.append(hashlib.sha1(payload).digest() + xxhash.xxh3_128_digest(payload))
            sizes.append(payload.size)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64())], names=["page_id", "mark", "key", "n"])


def revisits(pages: DataFrame, scratch: Scratch, min_bytes: int) -> DataFrame:
    """(revisit_id, mark, refers_to) of the pages whose payload a page with a larger id has too; mark: a hash of the payload, as ids may repeat.

    Copies are counted within each scan partition first; a payload that a third of all pages have gives a row for each
    partition from there on.
    """
    own = pages.select("page_id", "html", F.xxhash64("html").alias("mark")).mapInArrow(_digests, "page_id long, mark long, key binary, n long")
    leaves = scratch.keep(own.where(f"n >= {int(min_bytes)} and page_id is not null").withColumn("run", F.spark_partition_id()), "digests")
    runs = scratch.keep(leaves.groupBy("run", "key").agg(F.max("page_id").alias("most"), F.min("page_id").alias("least")), "runs")
    best = runs.groupBy("key").agg(F.max("most").alias("best"), F.min("least").alias("least")).where("best > least").select(F.col("key").alias("of"), "best")
    classes = scratch.keep(runs.join(best, F.col("key") == F.col("of")).select(F.col("run").alias("of_run"), "of", "best"), "classes")
    found = leaves.join(classes, (leaves.run == classes.of_run) & (leaves.key == classes.of)).where("page_id < best")
    found = scratch.keep(found.select(F.col("page_id").alias("revisit_id"), "mark", F.col("best").alias("refers_to")).distinct(), "revisits")
    scratch.drop("digests", "runs", "classes")
    return found


def write_archives(
    pages: DataFrame, folder: str, scratch: Scratch, min_bytes: int = 0, level: int = 3, dictionary_size: int = 32_768, sample: int = 600, sample_bytes: int = 65_536, few: int = 1_000_000
) -> DataFrame:
    """Write pages (page_id, url, html) as archives in folder; returns (archive string, records long, bytes long).

    The dictionary is built from at most `sample` records of at most `sample_bytes` bytes of html (smallest hashes of page_id
    first), so the driver holds their product at most. It only decides how small the archives get. From fewer than
    FEWEST records none can be trained; the leading frame is empty then and records are compressed without.
    """
    spark = pages.sparkSession
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), utf8("html"))
    again = revisits(own, scratch, min_bytes)
    chosen = own.where((F.octet_length("html") <= sample_bytes) & F.col("page_id").isNotNull()).select("page_id").orderBy(F.xxhash64("page_id"), "page_id").limit(sample).distinct()
    rows = own.where(F.octet_length("html") <= sample_bytes).join(F.broadcast(chosen), "page_id").limit(sample).collect()
    dictionary = spark.sparkContext.broadcast(build_dictionary([record_bytes(r.page_id, r.url, bytes(r.html), None) for r in rows], dictionary_size))
    if again.count() <= few:  # 24 bytes each
        again = F.broadcast(again)
    named = own.join(again, (own.page_id == again.revisit_id) & (F.xxhash64("html") == again.mark), "left").select("page_id", "url", "html", "refers_to")
    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        context, out, where = TaskContext.get(), None, None
        target = f"{folder}/{name}-{context.partitionId():06d}.warc.zst"
        records = 0
        try:
            for batch in batches:
                for page_id, url, html, refers_to in zip(*(batch.column(k) for k in range(4)), strict=True):
                    if out is None:
                        files, path = fs.FileSystem.from_uri(target)
                        where = f"{path}.{context.taskAttemptId()}.part"
                        files.create_dir(path.rpartition("/")[0], recursive=True)
                        out = files.open_output_stream(where, compression=None, buffer_size=1 << 20)
                        packer = open_archive(out, dictionary.value, level)
                    out.write(packer.compress(record_bytes(page_id.as_py(), url.as_py(), html.as_py(), refers_to.as_py())))
                    records += 1
        finally:
            if out is not None:
                out.close()
        if out is not None:
            size = files.get_file_info(where).size
            files.move(where, path)
            yield pa.RecordBatch.from_arrays([pa.array([target]), pa.array([records], pa.int64()), pa.array([size], pa.int64())], names=["archive", "records", "bytes"])

    return scratch.keep(named.mapInArrow(run, "archive string, records long, bytes long"), "archives")


def read_archives(archives: DataFrame) -> DataFrame:
    """Every record of the archives: page_id, url, payload_bytes, payload_digest, record_type, refers_to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        pack = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                files, path = fs.FileSystem.from_uri(archive)
                with files.open_input_stream(path, compression=None, buffer_size=1 << 20) as source:
                    rows = []
                    for r in read_archive(source):
                        rows.append((r.page_id, r.url, r.payload_bytes, r.digest, r.record_type, r.refers_to))
                        if len(rows) == 8192:
                            yield pack(rows)
                            rows = []
                    if rows:
                        yield pack(rows)

    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    tasks = max(1, archives.count())  # one for each archive; a number that is asked for isn't coalesced
    return archives.select("archive").repartition(tasks).mapInArrow(run, schema)


def archive_pages(pages: DataFrame, folder: str | None = None, min_bytes: int = 0) -> DataFrame:
    """Write pages as archives and read these back: page_id, payload_bytes long, payload_digest string, record_type string,
    refers_to long, url string, archived in folder (default: the shared folder).

    Of records with equal payloads of at least min_bytes bytes that with the largest page_id is the response and the others
    revisit it; rows that repeat this page_id too are responses. Null html counts as empty; rows without page_id are
    responses that nothing refers to; line breaks in a url are escaped. Other columns are not read. An empty table writes no
    archive. folder is any URI that pyarrow opens; all executors must see it.
    """
    scratch = Scratch(pages.sparkSession, "warc")
    folder = (folder or scratch.path("files")).rstrip("/")
    if ":" not in folder:
        folder = f"file://{folder}"
    written = write_archives(pages, folder, scratch, min_bytes)
    return read_archives(written).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


def op10_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(table(spark, sf_dir, "pages")).drop("url")
