"""Token ids in binary files: independent zstandard frames, a trailing seek table, a checksum for each frame.

A file holds the ids of its documents one after the other as little-endian unsigned 32-bit integers, cut into data
frames of FRAME_TOKENS ids (the last may be shorter), then index frames with a record for each document, then a frame
that describes the file (JSON), then a skippable frame with the seek table: for each frame its compressed size, its
size and the low 32 bits of the XXH64 of its content; at the very end the number of frames, a flag byte and the seekable
format's magic number. The frames also carry zstandard's own checksum. Any zstandard program can unpack such a file.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from tokenizers import Tokenizer
from xxhash import xxh64_intdigest

from ramparts.llm.shared import Kept, file_system, map_in_arrow, partitions, texts_of
from ramparts.session import scratch_path

FRAME_TOKENS, INDEX_RECORDS, END_ID = 1 << 16, 1 << 16, 1
RECORD = np.dtype([("known", "u1"), ("doc_id", "<i8"), ("start", "<u8"), ("n_tokens", "<u8")])
SKIPPABLE_MAGIC, SEEKABLE_MAGIC, WITH_CHECKSUMS = 0x184D2A5E, 0x8F92EAB1, 0x80
MOST_WORDS, MOST_PARTS, LONGEST_WORD = 450_000, 200_000, 64

# What a tokenizer must do to a text before its model for PLAIN words to be cut here: lower case, then runs of letters
# and runs of marks as byte characters. Letters are those of ASCII and Latin-1, which NFC leaves alone and whose lower case
# is one letter of the same kind. Marks are those of ASCII but for the apostrophe, with which contractions begin.
BEFORE_MODEL = {
    "truncation": None,
    "padding": None,
    "post_processor": None,
    "normalizer": {
        "type": "Sequence",
        "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split",
                "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
                "behavior": "Removed",
                "invert": True,
            },
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}
PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]*)([!-&(-/:-@\[-`{-~]*)").fullmatch
_VISIBLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_OTHERS = [byte for byte in range(256) if byte not in _VISIBLE]
BYTE_CHARACTERS = {byte: 256 + n for n, byte in enumerate(_OTHERS)}


class Writer:
    """Writes one file. Holds one data frame and one index frame of content at a time, and a seek table entry each."""

    def __init__(self, sink: pa.NativeFile, level: int = 3):
        self.sink = sink
        self.packer = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True)
        self.entries: list[tuple[int, int, int]] = []
        self.open, self.tokens, self.records, self.n_docs = bytearray(), 0, [], 0
        self.index: list[bytes] = []

    def frame(self, content: bytes) -> None:
        packed = self.packer.compress(content)
        self.sink.write(packed)
        self.entries.append((len(packed), len(content), xxh64_intdigest(content) & 0xFFFFFFFF))

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.records.append((doc_id is not None, doc_id or 0, self.tokens, len(ids) // 4))
        self.n_docs += 1
        self.tokens += len(ids) // 4
        self.open += ids
        if len(self.open) >= 4 * FRAME_TOKENS:
            whole = len(self.open) - len(self.open) % (4 * FRAME_TOKENS)
            for at in range(0, whole, 4 * FRAME_TOKENS):
                self.frame(bytes(self.open[at : at + 4 * FRAME_TOKENS]))
            del self.open[:whole]
        if len(self.records) == INDEX_RECORDS:
            self.close_index()

    def close_index(self) -> None:
        self.index.append(zlib.compress(np.array(self.records, RECORD).tobytes(), 1))
        self.records = []

    def close(self) -> None:
        if self.open:
            self.frame(bytes(self.open))
        self.close_index()
        data_frames = len(self.entries)
        for part in self.index:
            self.frame(zlib.decompress(part))
        about = {"docs": self.n_docs, "tokens": self.tokens, "frame_tokens": FRAME_TOKENS, "data_frames": data_frames}
        self.frame(json.dumps(about).encode())
        table = b"".join(struct.pack("<III", *entry) for entry in self.entries)
        footer = struct.pack("<IBI", len(self.entries), WITH_CHECKSUMS, SEEKABLE_MAGIC)
        self.sink.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table) + len(footer)) + table + footer)


class Reader:
    """Reads one file; only the frames that are asked for are fetched and unpacked, and each is checked."""

    def __init__(self, source: pa.NativeFile):
        self.source, size = source, source.size()
        n, flags, magic = struct.unpack("<IBI", self.fetch(size - 9, 9))
        if magic != SEEKABLE_MAGIC or flags != WITH_CHECKSUMS:
            raise ValueError("no seek table")
        self.entries = np.frombuffer(self.fetch(size - 9 - 12 * n, 12 * n), "<u4").reshape(n, 3)
        self.starts = np.concatenate([[0], np.cumsum(self.entries[:, 0], dtype=np.int64)])
        self.unpacker = zstandard.ZstdDecompressor()
        self.about = json.loads(self.frame(n - 1))
        self.n_data = self.about["data_frames"]

    def fetch(self, start: int, size: int) -> bytes:
        self.source.seek(int(start))
        return self.source.read(int(size))

    def frame(self, number: int) -> bytes:
        packed, size, checksum = self.entries[number]
        content = self.unpacker.decompress(self.fetch(self.starts[number], packed), max_output_size=int(size))
        if len(content) != size or xxh64_intdigest(content) & 0xFFFFFFFF != checksum:
            raise ValueError(f"frame {number} is damaged")
        return content

    def records(self) -> Iterator[np.ndarray]:
        """Index records of all documents, frame by frame."""
        for number in range(self.n_data, len(self.entries) - 1):
            yield np.frombuffer(self.frame(number), RECORD)

    def parts(self, records: Iterable[np.void]) -> Iterator[Iterator[bytes]]:
        """For each record, its ids frame by frame. Records in file order unpack each frame once."""
        at, content = -1, b""

        def of(start: int, end: int) -> Iterator[bytes]:
            nonlocal at, content
            while start < end:
                number = start // FRAME_TOKENS
                if number != at:
                    at, content = number, self.frame(number)
                first, upto = start - number * FRAME_TOKENS, min(end - number * FRAME_TOKENS, FRAME_TOKENS)
                yield content[4 * first : 4 * upto]
                start = number * FRAME_TOKENS + upto

        for record in records:
            yield of(int(record["start"]), int(record["start"] + record["n_tokens"]))


class Bounded(dict):
    """A table in front of ``make``. When it is full it becomes the older one, from which entries still in use come back.
    Long keys are not kept."""

    def __init__(self, make: Callable, most: int):
        super().__init__()
        self.make, self.most, self.older = make, most, {}

    def __missing__(self, key):
        found = self.older.get(key)
        if found is None:
            found = self.make(key)
        if len(key) <= LONGEST_WORD:
            if len(self) >= self.most:
                self.older = dict(self)
                self.clear()
            self[key] = found
        return found


class WordIds:
    """Ids of blank-separated words as packed bytes, a table in front of the tokenizer. It drops white space and lets
    nothing reach across it, so a text's ids are those of its words one after the other.

    Nor does its model reach from letters to the marks behind them. Plain words are cut there, and the library's model
    encodes the parts, which many words share; all other words pass through the whole library.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        special = any(PLAIN(token["content"]) for token in spec.get("added_tokens") or ())
        self.cuts = not special and all(spec.get(name) == value for name, value in BEFORE_MODEL.items())
        self.words, self.parts = Bounded(self.word, MOST_WORDS), Bounded(self.part, MOST_PARTS)

    def word(self, word: bytes) -> bytes:
        text = word.decode()
        plain = PLAIN(text) if self.cuts else None
        if plain is None:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            return struct.pack(f"<{len(ids)}I", *ids)
        letters, marks = plain.groups()
        return (self.parts[letters.lower()] if letters else b"") + (self.parts[marks] if marks else b"")

    def part(self, part: str) -> bytes:
        if not part.isascii():
            part = part.encode().decode("latin-1").translate(BYTE_CHARACTERS)
        ids = [token.id for token in self.model.tokenize(part)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def ids(self, text: bytes) -> bytes:
        return b"".join(map(self.words.__getitem__, text.split()))


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return WordIds(path)


def write_store(docs: DataFrame, tokenizer: str, folder: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Writes the ids of all texts, the end id after each, in ascending order of ``key`` (nulls first, rows with the
    same key by a hash of their text) and returns the manifest: (part, file, n_docs, n_tokens), files in order.

    Rows are dealt by ranges of key and text hash, so repeated keys spread over files. A repeated task writes a new
    file, and only files that the manifest names count. A null text has the end id alone.
    """
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    n = partitions(docs.sparkSession)
    dealt = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = file_system(folder)
        system.create_dir(base)
        name, part = f"{uuid.uuid4().hex}.ids.zst", TaskContext.get().partitionId()
        end, words = np.array([END_ID], "<u4").tobytes(), word_ids(tokenizer)
        with system.open_output_stream(f"{base}/{name}", compression=None) as sink:
            writer = Writer(sink)
            for batch in batches:
                for doc_id, value in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
                    writer.add(doc_id, words.ids(value) + end)
            writer.close()
        columns = [[part], [name], [writer.n_docs], [writer.tokens]]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64()]
        arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds)]
        yield pa.RecordBatch.from_arrays(arrays, names=["part", "file", "n_docs", "n_tokens"])

    manifest = map_in_arrow(dealt, run, "part long, file string, n_docs long, n_tokens long")
    return Kept(manifest, "manifest").rows.filter("n_docs > 0").orderBy("part")


def read_store(spark: SparkSession, manifest: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read back from the files, a task for each file.

    The manifest has a row for each file, as many as there were partitions, and is the only thing the driver sees.
    """
    files, start = [], 0
    for row in manifest.collect():
        files.append((row.file, start))
        start += row.n_tokens
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if not files:
        return spark.createDataFrame([], schema)
    listed = spark.createDataFrame(files, "file string, base long").repartition(len(files))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = file_system(folder)
        for batch in batches:
            for name, first in zip(*(column.to_pylist() for column in batch.columns)):
                with system.open_input_file(f"{base}/{name}") as source:
                    yield from _documents(Reader(source), first)

    return map_in_arrow(listed, run, schema)


def _documents(reader: Reader, first: int) -> Iterator[pa.RecordBatch]:
    for records in reader.records():
        sums = []
        for parts in reader.parts(records):
            crc = 0
            for part in parts:
                crc = zlib.crc32(part, crc)
            sums.append(crc)
        ids = pa.array(records["doc_id"], pa.int64(), mask=records["known"] == 0)
        starts, sizes = records["start"].astype(np.int64) + first, records["n_tokens"].astype(np.int64)
        arrays = [ids, pa.array(starts), pa.array(sizes), pa.array(sums, pa.int64())]
        yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "start", "n_tokens", "ids_crc32"])


def fetch_document(system: pafs.FileSystem, path: str, doc_id: int) -> list[np.ndarray]:
    """Ids of the documents with that id in one file; only their frames are unpacked."""
    with system.open_input_file(path) as source:
        reader = Reader(source)
        found = [r for records in reader.records() for r in records[(records["known"] == 1) & (records["doc_id"] == doc_id)]]
        return [np.frombuffer(b"".join(parts), "<u4") for parts in reader.parts(found)]


def stored_documents(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Writes a store under the shared folder and reads it back, a row for each row of ``docs``."""
    folder = scratch_path(docs.sparkSession, "tokens")
    return read_store(docs.sparkSession, write_store(docs, tokenizer, folder, key, text), folder)
