"""WARC archives with a two-level capture index.

Writing. Every page becomes a gzip member of its own in a WARC 1.1 file. Of
pages with equal payloads of at least ``min_bytes`` bytes that with the largest
page_id is the response, the others are revisit records without the payload,
which name it. A scan makes the digests and the finished response records; rows
that another row of the same task already outranks carry no record further.
The rows are then joined to the largest page_id of their digest (aggregated
before the shuffle, so a payload that a third of all pages share is one row per
task there; the join itself may be split by Spark) and written by tasks.

Index. The captures' keys (host names reversed, then path, then page_id) are
sorted by range, so a host with a third of all pages spreads over many shards.
Each shard is a file of compressed blocks of lines; its directory holds each
block's first key and place. The driver keeps one line for each shard.

Reading. A key is searched by bisection among the shards, then in the shard's
directory, then in one decompressed block. The captures found are sorted by
file and place and range-read, near ones in one read.

Files get a new name on each attempt and are known only through the rows that
the successful attempt returns, so a task that runs twice does no harm.

Defined results: a null html is an empty payload; a null or empty url is stored
as ``urn:page:<page_id>``; rows with the same page_id and payload are all
responses (or all revisits); a null page_id is a revisit if its payload has a
page_id elsewhere, otherwise a response; an empty table gives no file, an empty
index and no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import sharedfs
from .common import fresh_path, stash, table

MIN_BYTES, BLOCK_LINES, ARCHIVE_BYTES = 0, 3000, 256 << 20
DATE = "1970-01-01T00:00:00Z"
#: What a task of a lookup searches and reads.
TASK_KEYS, TASK_BYTES = 20_000, 16 << 20
_SLICE, _READ, _GAP = 512, 4 << 20, 64 << 10
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload, usedforsecurity=False).digest()).decode()


def record_id(page_id: int | None, payload_digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id}/{payload_digest}')}>"


def target(url: str | None, page_id: int | None) -> str:
    """The url without characters that a header line can't hold."""
    return quote(url, safe="!#$%&'()*+,-./:;=?@[]_~") if url else f"urn:page:{page_id}"


def url_key(url: str) -> str:
    """Host names reversed and joined by commas, then port, path and query, in lower case up to the path."""
    try:
        parts = urlsplit(url)
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return url
    if not host:
        return url
    key = ",".join(reversed(host.lower().strip(".").split("."))) + (f":{port}" if port and port not in (80, 443) else "")
    return f"{key}){parts.path or '/'}" + (f"?{parts.query}" if parts.query else "")


def capture_key(url: str | None, page_id: int | None) -> str:
    return f"{url_key(target(url, page_id))} {-1 if page_id is None else page_id:020d}"


def record(kind: str, page_id: int | None, url: str | None, size: int, payload_digest: str, payload: bytes = b"", refers_to: int | None = None) -> bytes:
    """One WARC record as a gzip member."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {record_id(page_id, payload_digest)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {target(url, page_id)}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{payload_digest}",
        f"WARC-Block-Digest: sha1:{digest(block)}",
        *([f"WARC-Profile: {_REVISIT}", f"WARC-Refers-To: {record_id(refers_to, payload_digest)}", f"X-Refers-To-Page-Id: {refers_to}"] if kind == "revisit" else []),
        *([] if page_id is None else [f"X-Page-Id: {page_id}"]),
        f"Content-Length: {len(block)}",
    ]
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    return deflate.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + deflate.flush()


def parse(member: bytes) -> dict:
    """The headers, HTTP headers and payload of a gzip member; digests are checked."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    headers = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[: int(headers["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    if lines[0] != "WARC/1.1" or headers["WARC-Block-Digest"] != f"sha1:{digest(block)}":
        raise ValueError(f"damaged record {headers.get('WARC-Record-ID')}")
    if headers["WARC-Type"] == "response" and headers["WARC-Payload-Digest"] != f"sha1:{digest(payload)}":
        raise ValueError(f"damaged payload {headers['WARC-Record-ID']}")
    return {"headers": headers, "http": dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:]), "payload": payload}


def _prepare(min_bytes: int):
    """page_id, url, size, digest and, unless the row is outranked in this task, the response record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top: dict[str, int] = {}
        for b in batches:
            for i in range(0, len(b), _SLICE):
                own = b.slice(i, _SLICE)
                pages, urls, payloads = own.column(0).to_pylist(), own.column(1).to_pylist(), [(x or "").encode() for x in own.column(2).to_pylist()]
                digests = [digest(x) for x in payloads]
                if len(top) > 200_000:  # only an economy: forgetting is harmless
                    top.clear()
                for p, d in zip(pages, digests, strict=True):
                    if p is not None:
                        top[d] = max(p, top.get(d, p))
                records = [
                    record("response", p, u, len(x), d, x) if len(x) < min_bytes or p is None or p >= top[d] else None
                    for p, u, x, d in zip(pages, urls, payloads, digests, strict=True)
                ]
                yield pa.RecordBatch.from_arrays([own.column(0), own.column(1), pa.array([len(x) for x in payloads], pa.int64()), pa.array(digests), pa.array(records, pa.binary())], ["page_id", "url", "size", "digest", "record"])

    return run


def _write(folder: str):
    """Archives from prepared rows; a row of the catalogue for each record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, name, at = None, "", 0
        try:
            for b in batches:
                keys, files, offsets, lengths = [], [], [], []
                for p, u, size, d, raw, ref in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    if ref is not None or raw is None:
                        raw = record("revisit", p, u, size, d, refers_to=ref)
                    if out is None or at + len(raw) > ARCHIVE_BYTES:
                        if out is not None:
                            out.close()
                        name, at = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0
                        out = sharedfs.create(name)
                    out.write(raw)
                    keys.append(capture_key(u, p))
                    files.append(name)
                    offsets.append(at)
                    lengths.append(len(raw))
                    at += len(raw)
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(files, pa.string()), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())], ["key", "file", "start", "length"])
        finally:
            if out is not None:
                out.close()

    return run


_CATALOGUE = "key string, file string, start long, length long"


def _write_index(folder: str, block_lines: int):
    """A shard of sorted lines in compressed blocks with its directory; one row that names it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines: list[str] = []
        blocks: list[tuple[str, int, int]] = []
        first = last = None
        name, out, at = f"{folder}/{uuid.uuid4().hex}", None, 0

        def flush() -> None:
            nonlocal out, at
            if lines:
                out = out or sharedfs.create(f"{name}.cdx.gz")
                deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
                raw = deflate.compress("".join(lines).encode()) + deflate.flush()
                out.write(raw)
                blocks.append((lines[0].partition("\t")[0], at, len(raw)))
                at += len(raw)
                lines.clear()

        for b in batches:
            for key, file, start, length in zip(*(c.to_pylist() for c in b.columns), strict=True):
                first, last = key if first is None else first, key
                lines.append(f"{key}\t{json.dumps([file, start, length])}\n")
                if len(lines) >= block_lines:
                    flush()
        flush()
        if out is not None:
            out.close()
            with sharedfs.create(f"{name}.idx") as f:
                f.write("".join(f"{k}\t{a}\t{n}\n" for k, a, n in blocks).encode())
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.string()) for x in (first, last, name)], ["first", "last", "shard"])

    return run


@dataclass
class Archive:
    """What a reader needs: the index shards in key order (first key, last key, name without suffix), and how many records of how many bytes there are."""

    folder: str
    shards: list[tuple[str, str, str]]
    records: int = 0
    size: int = 0


def write(pages: DataFrame, folder: str | None = None, min_bytes: int = MIN_BYTES, block_lines: int = BLOCK_LINES) -> Archive:
    """Write archives and index of page_id, url and html below ``folder`` (by default in the shared folder)."""
    spark = pages.sparkSession
    folder = folder or fresh_path(spark, "warc")
    pages = pages.select(F.col("page_id").cast("long"), "url", "html")
    rows = pages.mapInArrow(_prepare(min_bytes), "page_id long, url string, size long, digest string, record binary")
    ids = pages.select("page_id", F.coalesce("html", F.lit("")).alias("html")).mapInArrow(_digests, "page_id long, size long, digest string")
    top = ids.where(F.col("size") >= min_bytes).groupBy("digest").agg(F.max("page_id").alias("top"), F.count("*").alias("n")).where("n > 1 and top is not null").select("digest", "top")
    ref = F.when((F.col("size") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("top")), F.col("top"))
    joined = rows.join(top, "digest", "left").select("page_id", "url", "size", "digest", "record", ref.alias("refers_to"))
    catalogue = stash(joined.mapInArrow(_write(f"{folder}/archive"), _CATALOGUE), "catalogue", f"{folder}/catalogue")
    ordered = catalogue.repartitionByRange("key", "file", "start").sortWithinPartitions("key", "file", "start")
    shards = ordered.mapInArrow(_write_index(f"{folder}/index", block_lines), "first string, last string, shard string").collect()
    held = catalogue.agg(F.count("*").alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("size")).first()
    return Archive(folder, sorted((r["first"], r["last"], r["shard"]) for r in shards), held["n"], held["size"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sizes, digests = [], []
        for i in range(0, len(b), _SLICE):
            for x in b.column(1).slice(i, _SLICE).to_pylist():
                raw = x.encode()
                sizes.append(len(raw))
                digests.append(digest(raw))
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.string())], ["page_id", "size", "digest"])


class Index:
    """Searches by key; keeps the directory and the block that it used last."""

    def __init__(self, shards: list[tuple[str, str, str]]):
        self.shards = [(a.encode(), b.encode(), name) for a, b, name in shards]
        self.firsts = [a for a, _, _ in self.shards]
        self._directory: tuple[str, list[tuple[bytes, int, int]]] = ("", [])
        self._block: tuple[tuple[str, int], list[bytes], list[bytes]] = (("", -1), [], [])

    def _blocks(self, shard: str) -> list[tuple[bytes, int, int]]:
        if self._directory[0] != shard:
            rows = [line.split(b"\t") for line in sharedfs.read(f"{shard}.idx").splitlines()]
            self._directory = (shard, [(k, int(a), int(n)) for k, a, n in rows])
        return self._directory[1]

    def _lines(self, shard: str, start: int, length: int) -> tuple[list[bytes], list[bytes]]:
        if self._block[0] != (shard, start):
            with sharedfs.open_read(f"{shard}.cdx.gz") as f:
                f.seek(start)
                lines = zlib.decompress(f.read(length), 31).split(b"\n")[:-1]
            self._block = ((shard, start), [x.partition(b"\t")[0] for x in lines], lines)
        return self._block[1], self._block[2]

    def find(self, key: str) -> list[tuple[str, int, int]]:
        """(file, start, length) of every capture with this key."""
        want, out = key.encode(), []
        s = max(0, bisect_left(self.firsts, want) - 1)
        while s < len(self.shards) and self.shards[s][0] <= want:
            if self.shards[s][1] >= want:
                blocks = self._blocks(self.shards[s][2])
                b = max(0, bisect_left(blocks, want, key=lambda x: x[0]) - 1)
                while b < len(blocks) and blocks[b][0] <= want:
                    keys, lines = self._lines(self.shards[s][2], *blocks[b][1:])
                    i = bisect_left(keys, want)
                    while i < len(keys) and keys[i] == want:
                        out.append(tuple(json.loads(lines[i].partition(b"\t")[2])))
                        i += 1
                    b += 1
            s += 1
        return out


def _locate(shards: list[tuple[str, str, str]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(shards)
        for b in batches:
            found = [x for key in b.column(0).to_pylist() for x in index.find(key)]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], kind) for k, kind in ((0, pa.string()), (1, pa.int64()), (2, pa.int64()))], ["file", "start", "length"])

    return run


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    open_file, handle = "", None
    for b in batches:
        wanted, i = list(zip(*(c.to_pylist() for c in b.columns), strict=True)), 0
        while i < len(wanted):
            file, start, length = wanted[i]
            j, end = i + 1, start + length
            while j < len(wanted) and wanted[j][0] == file and 0 <= wanted[j][1] - end <= _GAP and wanted[j][1] + wanted[j][2] - start <= _READ:
                end = wanted[j][1] + wanted[j][2]
                j += 1
            if file != open_file:
                open_file, handle = file, sharedfs.open_read(file)
            handle.seek(start)
            raw, rows = handle.read(end - start), []
            for _, at, n in wanted[i:j]:
                r = parse(raw[at - start : at - start + n])
                h = r["headers"]
                ref, page = h.get("X-Refers-To-Page-Id"), h.get("X-Page-Id")
                rows.append((page and int(page), h["WARC-Target-URI"], int(r["http"]["Content-Length"]), h["WARC-Payload-Digest"].removeprefix("sha1:"), h["WARC-Type"], ref and int(ref), r["payload"] if h["WARC-Type"] == "response" else None))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
            i = j


def lookup(archive: Archive, wanted: DataFrame) -> DataFrame:
    """The captures of every distinct (url, page_id) of ``wanted``, read through the index.

    Numbers of tasks are given, as Spark would judge them by the small rows that name a capture and not by what is read.
    """
    asked = wanted.count()
    keys = wanted.select(F.col("url"), F.col("page_id").cast("long")).mapInArrow(_keys, "key string").distinct()
    tasks = -(-asked // TASK_KEYS) or 1
    places = keys.repartitionByRange(tasks, "key").sortWithinPartitions("key").mapInArrow(_locate(archive.shards), "file string, start long, length long")
    share = min(1.0, asked / max(archive.records, 1))  # of the archive's bytes, if its records are alike
    tasks = max(1, -int(-archive.size * share // TASK_BYTES))
    return places.repartitionByRange(tasks, "file", "start").sortWithinPartitions("file", "start").mapInArrow(_fetch, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([pa.array([capture_key(u, p) for u, p in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)], pa.string())], ["key"])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return lookup(write(pages), pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
