"""A Redis stream as a source of streams and of batches, by a small client of its wire protocol.

Offsets are stream ids, so a query that restarts asks for what is after its last one. A batch reads a range of ids, cut by
time into slices that executors page through side by side. Register with spark.dataSource.register(RedisStreamSource);
options: url, stream; of streams start (default 0), block_ms, count; of batches first, last (ids, - or +), slices.
"""

from __future__ import annotations

import logging
import random
import socket
import time
from collections.abc import Iterator
from urllib.parse import unquote, urlparse

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader

log = logging.getLogger(__name__)

#: Entries of a read while following, of a page of a range; milliseconds that a read waits for entries (fixed values).
COUNT, PAGE, BLOCK_MS = 16, 512, 1000
#: Seconds to connect, first and longest pause after a failure, share that pauses vary by (fixed values).
CONNECT_S, PAUSE_S, MOST_PAUSE_S, JITTER = 2.0, 1.0, 60.0, 0.25


def backoff(failures: int, jitter: float | None = None) -> float:
    """Pause after so many failures in a row: doubling, 25 % up or down, never above a minute."""
    factor = 1 + JITTER * (random.uniform(-1, 1) if jitter is None else jitter)
    return min(MOST_PAUSE_S, PAUSE_S * 2 ** max(0, min(failures - 1, 16)) * factor)


class RedisClient:
    """Commands over one connection, which is opened when needed and dropped after any error."""

    def __init__(self, url: str, timeout: float = 10.0):
        parsed = urlparse(url)
        if parsed.scheme not in ("redis", "rediss") or not parsed.hostname:
            raise ValueError("no redis URL")
        self.url, self.timeout, self._socket, self._file = parsed, timeout, None, None

    def _connect(self) -> None:
        self._socket = socket.create_connection((self.url.hostname, self.url.port or 6379), CONNECT_S)
        if self.url.scheme == "rediss":
            import ssl

            self._socket = ssl.create_default_context().wrap_socket(self._socket, server_hostname=self.url.hostname)
        self._socket.settimeout(self.timeout)
        self._file = self._socket.makefile("rb")
        if self.url.password:
            self._send("AUTH", *([unquote(self.url.username)] if self.url.username else []), unquote(self.url.password))
        if self.url.path.strip("/"):
            self._send("SELECT", self.url.path.strip("/"))

    def close(self) -> None:
        for part in (self._file, self._socket):
            if part:
                part.close()
        self._file = self._socket = None

    def call(self, *words: str):
        try:
            if not self._socket:
                self._connect()
            return self._send(*words)
        except (OSError, ValueError):
            self.close()
            raise

    def _send(self, *words: str):
        parts = [w.encode() for w in map(str, words)]
        self._socket.sendall(b"*%d\r\n" % len(parts) + b"".join(b"$%d\r\n%s\r\n" % (len(p), p) for p in parts))
        return self._reply()

    def _reply(self):
        line = self._file.readline()
        if not line.endswith(b"\r\n"):
            raise ConnectionError("the server went away")
        kind, rest = line[:1], line[1:-2]
        if kind == b"+":
            return rest
        if kind == b"-":
            raise ValueError(rest.decode("utf-8", "replace"))
        if kind == b":":
            return int(rest)
        n = int(rest)
        if n < 0:
            return None
        if kind == b"$":
            return self._file.read(n + 2)[:-2]
        return [self._reply() for _ in range(n)]


def entries(reply) -> list[tuple[str, dict[str, str]]]:
    """Entries of a reply; bytes that are no UTF-8 become replacement characters."""
    text = lambda b: b.decode("utf-8", "replace") if isinstance(b, bytes) else str(b)
    return [(text(i), dict(zip(map(text, f[::2]), map(text, f[1::2]), strict=True))) for i, f in reply or []]


def pages(client: RedisClient, stream: str, first: str, last: str) -> Iterator[tuple]:
    """The entries with first <= id <= last, page by page; the next page begins after the last id of the one before."""
    at = first
    while True:
        page = entries(client.call("XRANGE", stream, at, last, "COUNT", PAGE))
        yield from page
        if len(page) < PAGE:
            return
        at = f"({page[-1][0]}"


class RedisStreamReader(SimpleDataSourceStreamReader):
    """While the server is out of reach or the stream is missing, reads bring nothing, and the server is asked again after a pause that grows from 1 s to a minute."""

    def __init__(self, options):
        self.options = dict(options)
        self.client, self.failures, self.again = None, 0, 0.0

    def _client(self) -> RedisClient:
        if self.client is None:
            self.client = RedisClient(self.options["url"])
        return self.client

    def __getstate__(self):
        return {"options": self.options, "client": None, "failures": 0, "again": 0.0}

    def initialOffset(self) -> dict:
        return {"id": self.options.get("start", "0")}

    def _pause(self, why: str) -> None:
        self.failures += 1
        wait = backoff(self.failures)
        self.again = time.monotonic() + wait
        log.warning("%s, asked again in %.1f s", why, wait)

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        """What is after start, up to `count` entries."""
        name = self.options["stream"]
        if time.monotonic() < self.again:
            time.sleep(min(0.2, self.again - time.monotonic()))  # a stream that is stopped needn't wait for the pause
            return iter(()), start
        try:
            reply = self._client().call("XREAD", "COUNT", self.options.get("count", COUNT), "BLOCK", self.options.get("block_ms", BLOCK_MS), "STREAMS", name, start["id"])
            found = entries(reply[0][1]) if reply else []
            if not found and not stream_exists(self._client(), name):
                self._pause(f"there is no stream {name}")
                return iter(()), start
        except OSError as error:
            self._pause(f"the stream can't be read: {error}")
            return iter(()), start
        self.failures = 0
        return iter(found), {"id": found[-1][0] if found else start["id"]}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        """The entries of a batch again, page by page."""
        return pages(self._client(), self.options["stream"], f"({start['id']}" if start["id"] != "0" else "-", end["id"])

    def commit(self, end: dict) -> None:
        """Nothing to do: the server keeps its stream."""


class RedisRangeReader(DataSourceReader):
    """A range of ids, in slices of equal time."""

    def __init__(self, options):
        self.options = dict(options)

    def partitions(self) -> list[InputPartition]:
        first, last = self.options.get("first", "-"), self.options.get("last", "+")
        first = "-" if first == "0" else first
        if first == "+" or last == "-":
            return [InputPartition(("+", "-"))]
        client, stream = RedisClient(self.options["url"]), self.options["stream"]
        if not stream_exists(client, stream):
            raise ValueError(f"there is no stream {stream}")
        ends = [entries(client.call(*words, "COUNT", 1)) for words in (("XRANGE", stream, first, last), ("XREVRANGE", stream, last, first))]
        client.close()
        if not all(ends):
            return [InputPartition(("+", "-"))]
        lo, hi = (int(end[0][0].split("-")[0]) for end in ends)
        slices = max(1, min(int(self.options.get("slices", 8)), hi - lo + 1))
        cuts = [lo + (hi - lo + 1) * k // slices for k in range(1, slices)]
        return [InputPartition(pair) for pair in zip([first, *map(str, cuts)], [*(str(c - 1) for c in cuts), last], strict=True)]  # an id without its second part: the first or last of its millisecond

    def read(self, partition) -> Iterator[tuple]:
        first, last = partition.value
        return iter(()) if first == "+" else pages(RedisClient(self.options["url"]), self.options["stream"], first, last)


class RedisStreamSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "redis_stream"

    def schema(self) -> str:
        return "stream_id string, fields map<string,string>"

    def reader(self, schema) -> RedisRangeReader:
        return RedisRangeReader(self.options)

    def simpleStreamReader(self, schema) -> RedisStreamReader:
        return RedisStreamReader(self.options)


def stream_exists(client: RedisClient, stream: str) -> bool:
    """Tells a quiet stream from one that isn't there."""
    return bool(client.call("EXISTS", stream))
