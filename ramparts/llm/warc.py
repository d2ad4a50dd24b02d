"""WARC archives with revisit records, and a two-level index over their captures.

Archives are gzip files with a member for each record, so a record is read by its offset and length. Capture lines are
sorted by url with the host reversed and cut into blocks of BLOCK_LINES, each compressed on its own; an index file ends
with its sparse directory (first key, offset and length of each block) and where that begins. A manifest has the first
key of each index file. A lookup searches manifest, directory and block by bisection and reads one block and then only
the records it names.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import struct
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ramparts.llm.shared import Kept, file_system, map_in_arrow, partitions
from ramparts.session import scratch_path

BLOCK_LINES, ARCHIVE_BYTES = 512, 1 << 30
RECORD_ID = "urn:page:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
CAPTURE = "key string, archive string, offset long, length long"


def sort_key(url: str | None) -> str:
    """``org,example,www)/path?query``: the host's labels reversed and in lower case, then the rest without fragment."""
    url = url or ""
    rest = (url.partition("://")[2] if "://" in url else url).partition("#")[0]
    cut = min([i for i in (rest.find("/"), rest.find("?")) if i >= 0], default=len(rest))
    host = rest[:cut].rpartition("@")[2].lower()
    return ",".join(reversed(host.split("."))) + ")" + (rest[cut:] or "/")


def header_value(text: str | None) -> str:
    """A url as a header can hold it: control characters and blanks are percent-encoded."""
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in text or "")


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One record, compressed. A revisit keeps the HTTP head, whose length is that of the whole payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{RECORD_ID}{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {header_value(url)}",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if revisit:
        head += [f"WARC-Refers-To: <{RECORD_ID}{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return gzip.compress("\r\n".join(head).encode() + block + b"\r\n\r\n", 6, mtime=0)


def parsed(packed: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and block of a compressed record."""
    data = gzip.decompress(packed)
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")[1:]
    headers = {name.lower(): value for name, _, value in (line.partition(": ") for line in lines)}
    size = int(headers["content-length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError("damaged record")
    return headers, rest[:size]


def page_number(value: str | None) -> int | None:
    text = (value or "").strip("<>").removeprefix(RECORD_ID)
    return int(text) if text else None


def capture(packed: bytes) -> tuple[int | None, int, str, str, int | None]:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to); a response's payload is measured anew."""
    headers, block = parsed(packed)
    http, _, payload = block.partition(b"\r\n\r\n")
    told = headers["warc-payload-digest"].removeprefix("sha1:")
    size = int(http.decode().partition("Content-Length: ")[2].partition("\r\n")[0])
    if headers["warc-type"] == "response" and (len(payload) != size or payload_digest(payload) != told):
        raise ValueError("payload does not match its record")
    own, other = page_number(headers["warc-record-id"]), page_number(headers.get("warc-refers-to"))
    return own, size, told, headers["warc-type"], other


def with_responses(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(page_id, url, html, response_id): of pages with equal payloads of ``least_bytes`` or more, the largest page_id.

    Only a digest and the ids meet by payload; the largest id is combined before the shuffle.
    """
    rows = pages.withColumn("key", F.unhex(F.sha2(F.col("html").cast("binary"), 256)))
    large = F.octet_length("html") >= least_bytes
    groups = rows.filter(large).groupBy("key").agg(F.max("page_id").alias("response_id"), F.count(F.lit(1)).alias("n"))
    again = groups.filter("n > 1").select("key", "response_id")
    joined = rows.join(again, "key", "left")
    return joined.select("page_id", "url", "html", F.coalesce("response_id", "page_id").alias("response_id"))


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Writes a record for each row of (page_id, url, html, response_id) and returns the captures, stored.

    A repeated task writes new archives; only those that captures name count.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = file_system(folder)
        system.create_dir(base)
        sink, name, offset = None, "", 0
        for batch in batches:
            found = []
            for page_id, url, html, response in zip(*(column.to_pylist() for column in batch.columns)):
                if sink is None or offset >= ARCHIVE_BYTES:
                    if sink is not None:
                        sink.close()
                    name, offset = f"{uuid.uuid4().hex}.warc.gz", 0
                    sink = system.open_output_stream(f"{base}/{name}", compression=None)
                payload = html.encode()
                packed = record(page_id, url, payload, payload_digest(payload), response, response != page_id)
                sink.write(packed)
                found.append((sort_key(url), name, offset, len(packed)))
                offset += len(packed)
            yield captures_batch(found)
        if sink is not None:
            sink.close()

    return Kept(map_in_arrow(pages, run, CAPTURE), "captures").rows


def captures_batch(rows: list[tuple[str, str, int, int]]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[], [], [], []]
    kinds = [pa.string(), pa.string(), pa.int64(), pa.int64()]
    arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds)]
    return pa.RecordBatch.from_arrays(arrays, names=["key", "archive", "offset", "length"])


def write_index(captures: DataFrame, folder: str) -> DataFrame:
    """Sorts the captures into index files and returns the manifest (part, file, first_key), stored; files in order.

    Dealt by ranges of key and place, so the captures of one frequent url spread over files.
    """
    order = ["key", "archive", "offset"]
    dealt = captures.repartitionByRange(partitions(captures.sparkSession), *order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = file_system(folder)
        system.create_dir(base)
        name, first, directory, lines, offset = f"{uuid.uuid4().hex}.index", None, [], [], 0
        with system.open_output_stream(f"{base}/{name}", compression=None) as sink:

            def close_block() -> None:
                nonlocal lines, offset
                packed = zlib.compress("\n".join(json.dumps(line) for line in lines).encode(), 6)
                sink.write(packed)
                directory.append((lines[0][0], offset, len(packed)))
                lines, offset = [], offset + len(packed)

            for batch in batches:
                for line in zip(*(column.to_pylist() for column in batch.columns)):
                    first = line[0] if first is None else first
                    lines.append(line)
                    if len(lines) == BLOCK_LINES:
                        close_block()
            if lines:
                close_block()
            sink.write(zlib.compress(json.dumps(directory).encode(), 6) + struct.pack("<Q", offset))
        found = [pa.array([v], k) for v, k in ((TaskContext.get().partitionId(), pa.int64()), (name, pa.string()), (first, pa.string()))]
        yield pa.RecordBatch.from_arrays(found, names=["part", "file", "first_key"])

    manifest = map_in_arrow(dealt.select("key", "archive", "offset", "length"), run, "part long, file string, first_key string")
    return Kept(manifest, "manifest").rows.filter("first_key is not null").orderBy("part")


class IndexFile:
    """One index file: its directory, and its blocks by number."""

    def __init__(self, system: pafs.FileSystem, path: str):
        self.source = system.open_input_file(path)
        size = self.source.size()
        (start,) = struct.unpack("<Q", self.fetch(size - 8, 8))
        self.directory = json.loads(zlib.decompress(self.fetch(start, size - 8 - start)))
        self.keys = [entry[0] for entry in self.directory]

    def fetch(self, offset: int, length: int) -> bytes:
        self.source.seek(offset)
        return self.source.read(length)

    def block(self, number: int) -> list[tuple[str, str, int, int]]:
        _, offset, length = self.directory[number]
        return [tuple(json.loads(line)) for line in zlib.decompress(self.fetch(offset, length)).decode().split("\n")]

    def find(self, key: str) -> Iterator[tuple[str, str, int, int]]:
        """Captures of a key. Blocks may begin in the middle of a key's captures, so the one before counts too."""
        number = max(0, bisect_right(self.keys, key) - 1)
        while number and self.keys[number] == key:
            number -= 1
        while number < len(self.keys) and self.keys[number] <= key:
            yield from (line for line in self.block(number) if line[0] == key)
            number += 1


class Archives:
    """Range reads, with a few archives open at a time."""

    def __init__(self, folder: str):
        system, base = file_system(folder)
        self.opened = lru_cache(maxsize=8)(lambda name: system.open_input_file(f"{base}/{name}"))

    def read(self, archive: str, offset: int, length: int) -> bytes:
        source = self.opened(archive)
        source.seek(offset)
        return source.read(length)


RESULT = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
RESULT_KINDS = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]


def result_batch(found: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*found)) if found else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)], names=names)


def read_all(manifest: DataFrame, index_folder: str, archive_folder: str) -> DataFrame:
    """Every capture of the index, read from the archives; a task for each index file. The driver sees the manifest,
    which has a row for each partition."""
    spark = manifest.sparkSession
    files = [(row.file,) for row in manifest.collect()]
    if not files:
        return spark.createDataFrame([], RESULT)
    listed = spark.createDataFrame(files, "file string").repartition(len(files))
    names = [c.split()[0] for c in RESULT.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = file_system(index_folder)
        archives = Archives(archive_folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                index = IndexFile(system, f"{base}/{name}")
                for number in range(len(index.directory)):
                    lines = sorted(index.block(number), key=lambda line: line[1:])
                    yield result_batch([capture(archives.read(*line[1:])) for line in lines], names, RESULT_KINDS)

    return map_in_arrow(listed, run, RESULT)


def lookup(urls: DataFrame, manifest: DataFrame, index_folder: str, archive_folder: str, url: str = "url") -> DataFrame:
    """(url, page_id, ...) for each capture of each url of ``urls``; urls without captures give no rows.

    The manifest (a row for each partition) goes to the tasks; they search it, a file's directory and a block.
    """
    files = [(row.first_key, row.file) for row in manifest.collect()]
    names = ["url", *(c.split()[0] for c in RESULT.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = file_system(index_folder)
        archives, keys = Archives(archive_folder), [first for first, _ in files]
        opened = lru_cache(maxsize=8)(lambda name: IndexFile(system, f"{base}/{name}"))
        for batch in batches:
            found = []
            for wanted in batch.column(0).to_pylist():
                key = sort_key(wanted)
                number = max(0, bisect_right(keys, key) - 1)
                while number and keys[number] == key:
                    number -= 1
                while number < len(files) and keys[number] <= key:
                    lines = opened(files[number][1]).find(key)
                    found += [(wanted, *capture(archives.read(*line[1:]))) for line in lines]
                    number += 1
            yield result_batch(found, names, [pa.string(), *RESULT_KINDS])

    return map_in_arrow(urls.select(F.col(f"`{url}`").alias("url")), run, f"url string, {RESULT}")


def archived_pages(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Writes archives and index under the shared folder and reads every capture back, a row for each row of ``pages``.

    A null html is an empty payload; equal payloads, empty ones too, have one response, that of the largest page_id.
    Rows that share that id are responses all. A null page_id never is the largest. Null urls are filed under ``)/``.
    """
    folder = scratch_path(pages.sparkSession, "warc")
    rows = pages.select(
        F.col(f"`{key}`").cast("long").alias("page_id"),
        F.col(f"`{url}`").alias("url"),
        F.coalesce(F.col(f"`{html}`"), F.lit("")).alias("html"),
    )
    captures = write_archives(with_responses(rows), f"{folder}/archives")
    manifest = write_index(captures, f"{folder}/index")
    return read_all(manifest, f"{folder}/index", f"{folder}/archives")
