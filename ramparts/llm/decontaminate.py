"""Benchmark passages in documents, found with a positional inverted index in document-partitioned segments."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from ramparts.llm.shared import Kept, free_name, map_batches, map_in_arrow, texts_of

WINDOW = 13
# A segment of the index closes after so many tokens (a longer document makes a longer segment).
SEGMENT_TOKENS = 1_000_000
# Items are searched in blocks of so many characters at most (one longer item is a block); a block is broadcast.
BLOCK_CHARS = 4_000_000
# Words are runs of 0-9, a-z and everything beyond ASCII; the rest of ASCII becomes a blank.
TO_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
INDEX_SCHEMA = "segment string, keys binary, starts binary, lengths binary, terms binary, ends binary, places binary"


def words_of(text: bytes) -> list[bytes]:
    return text.translate(TO_WORDS).split()


@dataclass
class Segment:
    """Postings of some documents. Document d has the places starts[d] to starts[d] + lengths[d] - 1; between two
    documents one place stays empty, so a phrase never runs on. Term t has the sorted places[ends[t-1]:ends[t]]."""

    starts: np.ndarray
    lengths: np.ndarray
    ids: dict[bytes, int]
    ends: np.ndarray
    places: np.ndarray

    def postings(self, term: int) -> np.ndarray:
        return self.places[self.ends[term - 1] if term else 0 : self.ends[term]]

    @classmethod
    def of(cls, texts: list[list[bytes]]) -> Segment:
        ids: dict[bytes, int] = {}
        lengths = np.array([len(words) for words in texts], np.int64)
        starts = np.cumsum(lengths + 1) - lengths - 1
        number = ids.setdefault
        flat = np.fromiter((number(w, len(ids)) for words in texts for w in words), np.int32, int(lengths.sum()))
        at = np.arange(len(flat), dtype=np.int64) + np.repeat(np.arange(len(texts)), lengths)
        order = np.argsort(flat, kind="stable")
        ends = np.cumsum(np.bincount(flat, minlength=len(ids)))
        return cls(starts, lengths, ids, ends, at[order].astype(np.int32 if len(at) < 1 << 30 else np.int64))

    def packed(self) -> list[bytes]:
        width = np.array([self.places.itemsize], np.uint8).tobytes()
        arrays = [self.starts.tobytes(), self.lengths.tobytes(), b" ".join(self.ids), self.ends.tobytes()]
        return [*(zlib.compress(a, 1) for a in arrays), width + self.places.tobytes()]

    @classmethod
    def unpacked(cls, fields: list[bytes]) -> Segment:
        starts, lengths, terms, ends = map(zlib.decompress, fields[:4])
        ids = {term: i for i, term in enumerate(terms.split(b" "))} if terms else {}
        places = np.frombuffer(fields[4], np.int32 if fields[4][0] == 4 else np.int64, offset=1)
        return cls(*(np.frombuffer(a, np.int64) for a in (starts, lengths)), ids, np.frombuffer(ends, np.int64), places)


def build_index(docs: DataFrame, key: Column, text: str = "text") -> Kept:
    """The positional index of all documents, a row for each segment, stored in the shared folder.

    Every token of every text has its posting. ``key`` is cast to a string and names a document in the results.
    Segments split the documents, not the terms, so neither a frequent term nor a hot source meets in one task, and
    building and searching need no shuffle. A null text has no tokens.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: list[str | None] = []
        texts: list[list[bytes]] = []
        held = 0

        def closed() -> pa.RecordBatch:
            body = Segment.of(texts).packed()
            keys = pa.array(names, pa.string())
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, pa.schema([("key", pa.string())])) as out:
                out.write_batch(pa.RecordBatch.from_arrays([keys], names=["key"]))
            packed = zlib.compress(sink.getvalue().to_pybytes(), 1)
            name = hashlib.sha256(packed + body[0] + body[4][:4096]).hexdigest()
            columns = [[name], [packed], *([part] for part in body)]
            kinds = [pa.string(), *[pa.binary()] * 6]
            fields = [pa.array(c, kind) for c, kind in zip(columns, kinds)]
            return pa.RecordBatch.from_arrays(fields, names=[c.split()[0] for c in INDEX_SCHEMA.split(", ")])

        for batch in batches:
            for name, value in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
                words = words_of(value)
                names.append(name)
                texts.append(words)
                held += len(words) + 1
                if held >= SEGMENT_TOKENS:
                    yield closed()
                    names, texts, held = [], [], 0
        if names:
            yield closed()

    wanted = docs.select(key.cast("string").alias("key"), F.col(f"`{text}`").alias("text"))
    return Kept(map_in_arrow(wanted, run, INDEX_SCHEMA), "postings")


def keys_of(packed: bytes) -> list[str | None]:
    with pa.ipc.open_stream(zlib.decompress(packed)) as stream:
        return stream.read_all().column("key").to_pylist()


def phrase_starts(segment: Segment, terms: list[int]) -> np.ndarray:
    """Places where the terms stand one after the other: from the rarest term on, lists shifted by their offset are
    intersected until none is left."""
    offsets = sorted(range(len(terms)), key=lambda k: len(segment.postings(terms[k])))
    found = segment.postings(terms[offsets[0]]) - offsets[0]
    for k in offsets[1:]:
        if not len(found):
            break
        places = segment.postings(terms[k])
        at = np.searchsorted(places, found + k)
        at[at == len(places)] = 0
        found = found[places[at] == found + k]
    return found


def near_spans(segment: Segment, terms: list[int], width: int) -> list[tuple[int, int]]:
    """Shortest spans (first and last place) of at most ``width`` places that hold all the terms in any order, one
    for each last place. Terms given twice must stand there once. Spans stay within one document."""
    lists = sorted((segment.postings(t) for t in set(terms)), key=len)
    around = lists[0]
    for places in lists[1:]:
        after = np.searchsorted(places, around - width + 1)
        near = places[np.minimum(after, len(places) - 1)]
        around = around[(near > around - width) & (near < around + width)]
    spans = set()
    for middle in around.tolist():
        inside = [p[np.searchsorted(p, middle - width + 1) : np.searchsorted(p, middle + width)] for p in lists]
        for last in np.unique(np.concatenate(inside)):
            first = min((int(p[i - 1]) if (i := np.searchsorted(p, last, "right")) else -1) for p in inside)
            document = np.searchsorted(segment.starts, last, "right") - 1
            if first >= segment.starts[document] and last - first < width:
                spans.add((first, int(last)))
    return sorted(spans)


def windows_of(words: list[bytes]) -> list[list[bytes]]:
    """13 consecutive words each; a shorter item is one window, an item without words has none."""
    if not words:
        return []
    return [words[i : i + WINDOW] for i in range(max(1, len(words) - WINDOW + 1))]


def merged(spans: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    first, last = None, None
    for a, b in sorted(spans):
        if first is not None and a <= last:
            last = max(last, b)
        else:
            if first is not None:
                yield first, last
            first, last = a, b
    if first is not None:
        yield first, last


MATCH_SCHEMA = "segment string, document long, key string, item string, first long, last long"


def search(index: Kept, items: DataFrame, item: str = "item_id", text: str = "text", slack: int | None = None) -> DataFrame:
    """Spans of documents that windows of the items match: (segment, document, key, item, first, last), the last word
    excluded, overlapping spans of one item merged.

    Exact phrases by default. With ``slack``, proximity: all words of a window, in any order, within so many words
    more than the window has. Items are read in blocks of a bounded size, each broadcast on its own.
    """
    spark = index.spark
    wanted = items.select(F.col(f"`{item}`").cast("string").alias("item"), F.col(f"`{text}`").alias("text"))
    chars = wanted.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = 1 + chars // BLOCK_CHARS
    block = F.pmod(F.xxhash64("item", "text"), F.lit(blocks))
    found = []
    for number in range(blocks):
        rows = wanted.filter(block == number).collect()
        shared = spark.sparkContext.broadcast([(r.item, words_of((r.text or "").encode())) for r in rows])
        found.append(_block_matches(index.rows, shared, slack))
    all_blocks = found[0]
    for more in found[1:]:
        all_blocks = all_blocks.unionByName(more)
    return all_blocks


def _block_matches(rows: DataFrame, shared, slack: int | None) -> DataFrame:
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for row in range(batch.num_rows):
            name, keys, *fields = (batch.column(c)[row].as_py() for c in range(batch.num_columns))
            segment = Segment.unpacked(fields)
            out = []
            for item, words in shared.value:
                spans: dict[int, list[tuple[int, int]]] = {}
                known = [segment.ids.get(w, -1) for w in words]
                for window in windows_of(known):
                    if -1 in window:
                        continue
                    if slack is None:
                        hits = [(p, p + len(window)) for p in phrase_starts(segment, window).tolist()]
                    else:
                        hits = [(a, b + 1) for a, b in near_spans(segment, window, len(window) + slack)]
                    for first, last in hits:
                        document = int(np.searchsorted(segment.starts, first, "right")) - 1
                        spans.setdefault(document, []).append((first, last))
                for document, pairs in spans.items():
                    origin = int(segment.starts[document])
                    out += [(name, document, item, a - origin, b - origin) for a, b in merged(pairs)]
            if out:
                names = keys_of(keys)
                columns = list(zip(*[(s, d, names[d], i, a, b) for s, d, i, a, b in out]))
                kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
                fields = [pa.array(c, kind) for c, kind in zip(columns, kinds)]
                yield pa.RecordBatch.from_arrays(fields, names=[c.split()[0] for c in MATCH_SCHEMA.split(", ")])

    return map_batches(rows, run, MATCH_SCHEMA)


def indexed_documents(index: Kept) -> DataFrame:
    """(segment, document, key, n_words) of every document in the index."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for name, keys, lengths in zip(*(batch.column(c).to_pylist() for c in range(3))):
            names, n = keys_of(keys), np.frombuffer(zlib.decompress(lengths), np.int64)
            columns = [pa.array([name] * len(n)), pa.array(range(len(n)), pa.int64()), pa.array(names, pa.string()), pa.array(n)]
            yield pa.RecordBatch.from_arrays(columns, names=["segment", "document", "key", "n_words"])

    return map_batches(
        index.rows.select("segment", "keys", "lengths"), run, "segment string, document long, key string, n_words long"
    )


def covered_words(matches: DataFrame) -> DataFrame:
    """(segment, document, n_hit, items): words under any span, counted once, and the items that have spans."""
    by = Window.partitionBy("segment", "document").orderBy("first", "last")
    reached = F.coalesce(F.max("last").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    fresh = F.greatest(F.lit(0), F.col("last") - F.greatest("first", reached))
    counted = matches.select("segment", "document", "item", fresh.cast("long").alias("fresh"))
    return counted.groupBy("segment", "document").agg(F.sum("fresh").alias("n_hit"), F.collect_set("item").alias("items"))


def contamination(docs: DataFrame, benchmark: DataFrame, key: Column, text: str = "text") -> DataFrame:
    """(key, n_words, n_hit, n_items, items_sha256, contaminated), a row for each document.

    A document is contaminated when a twentieth of its words or more lie in windows of benchmark items. Null or empty
    texts have no words and are clean; so is everything against an empty benchmark. Items with a null id are searched
    and hit words, but have no name to list. Repeated rows come out repeated.
    """
    index = build_index(docs, key, text)
    hits = covered_words(search(index, benchmark))
    joined = indexed_documents(index).join(hits, ["segment", "document"], "left")
    n_hit = F.coalesce("n_hit", F.lit(0))
    items = F.sort_array(F.coalesce("items", F.array().cast("array<string>")))
    return joined.select(
        "key",
        "n_words",
        n_hit.cast("long").alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """Documents that are not contaminated, columns as they are. A verdict belongs to a text, so rows are told apart
    by the digest of theirs, and rows with null or repeated ids are judged each by its own text."""
    name = free_name(docs.columns, "digest")
    digest = F.sha2(F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary"), 256)
    found = contamination(docs, benchmark, digest, text).filter("contaminated")
    dirty = found.select(F.col("key").alias(name)).distinct()
    return docs.withColumn(name, digest).join(dirty, name, "left_anti").drop(name)
