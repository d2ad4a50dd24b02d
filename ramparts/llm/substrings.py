"""Repeated passages, found in an index of all documents' 35-word windows.

This is no Lempel-Ziv parse: nothing is matched greedily against reference blocks. The index is dealt by content, so
that a window meets all its occurrences in one place. In a first round a window is filed under
its minimizer, the smallest hash of its 8-word runs. Neighbouring windows with one minimizer make a passage. A
minimizer with one passage has nothing repeated; if all its passages have the same windows, all of these are repeated;
only where passages differ are the windows themselves counted, in a second round. A document's repeated
windows, in order, make its passages: each starts where none is open and runs on while the next window, which reaches one word
beyond it, is in the index too.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from xxhash import xxh3_64_intdigest

from ramparts.llm.shared import Kept, map_batches, texts_of

WINDOW, RUN = 35, 8
MOST_WORDS = 500_000
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)  # any odd numbers
MIX = np.uint64(0xFF51AFD7ED558CCD)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MOST_WORDS:
            self.clear()
        found = self[word] = xxh3_64_intdigest(word)
        return found


@lru_cache(maxsize=1)
def word_hashes() -> WordHashes:
    return WordHashes()


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * MIX
    return values ^ (values >> np.uint64(33))


def run_hashes(ids: np.ndarray, size: int, multiplier: int) -> np.ndarray:
    """A polynomial hash of each run of ``size`` words, put together from runs of powers of two."""
    out, length, power, width = None, 0, ids, 1
    while True:
        if size & width:
            if out is None:
                out, length = power, width
            else:  # the run found so far, then the longer one
                scale = np.uint64(pow(multiplier, width, 1 << 64))
                n = min(len(out), len(power) - length)
                out, length = out[:n] * scale + power[length : length + n], length + width
        width *= 2
        if width > size:
            return out
        scale, half = np.uint64(pow(multiplier, width // 2, 1 << 64)), width // 2
        power = power[:-half] * scale + power[half:] if len(power) > half else power[:0]


def smallest_within(values: np.ndarray, span: int) -> np.ndarray:
    """The minimum of each ``span`` neighbouring values."""
    width = 1
    while width * 2 <= span:
        values, width = np.minimum(values[:-width], values[width:]), width * 2
    return np.minimum(values[: len(values) - (span - width)], values[span - width :]) if span > width else values


def windows_of(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each window its two hashes, and the minimizers."""
    ids = np.fromiter(map(word_hashes().__getitem__, words), np.uint64, len(words))
    first, second = (run_hashes(ids, WINDOW, m) for m in MULTIPLIERS)
    minimizers = smallest_within(mixed(run_hashes(ids, RUN, MULTIPLIERS[0])), WINDOW - RUN + 1)
    return first, second, minimizers


def passages_of(first: np.ndarray, minimizers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts of the runs of windows with one minimizer, their minimizers, a sum over their windows, and which of
    them hold a window twice."""
    starts = np.flatnonzero(np.concatenate([[True], minimizers[1:] != minimizers[:-1]]))
    sums = np.add.reduceat(mixed(first), starts)
    twice = np.zeros(len(starts), bool)
    ordered = np.sort(first)
    if (ordered[1:] == ordered[:-1]).any():
        order = np.argsort(first, kind="stable")
        run = np.searchsorted(starts, order, "right") - 1
        again = (first[order][1:] == first[order][:-1]) & (run[1:] == run[:-1])
        twice[run[1:][again]] = True
    return starts, minimizers[starts], sums, twice


def digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _passages(docs: DataFrame) -> DataFrame:
    """(doc_id, key, n_words, kept_sha256 as if nothing went, minimizers, sums) of each row of (doc_id, key, text). A
    passage that holds a window twice is listed once more with another sum, so that it counts as differing."""
    schema = "doc_id {}, key binary, n_words long, kept_sha256 string, mins array<long>, sums array<long>, at array<int>"

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        counts, digests, mins, sums, places = [], [], [], [], []
        for text in texts_of(batch.column(2)):
            words = text.split()
            counts.append(len(words))
            digests.append(digest(words))
            m, s, p = np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0, np.int32)
            if len(words) >= WINDOW:
                first, _, minimizers = windows_of(words)
                starts, m, s, twice = passages_of(first, minimizers)
                p = np.concatenate([np.arange(len(starts)), np.flatnonzero(twice)]).astype(np.int32)
                m, s = np.concatenate([m, m[twice]]), np.concatenate([s, ~s[twice]])
            mins.append(m.view(np.int64))
            sums.append(s.view(np.int64))
            places.append(p)
        kinds = [pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32())]
        found = [pa.array(c, kind) for c, kind in zip((counts, digests, mins, sums, places), kinds)]
        names = ["doc_id", "key", "n_words", "kept_sha256", "mins", "sums", "at"]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *found], names=names)

    return map_batches(docs, run, schema.format(docs.schema["doc_id"].dataType.simpleString()))


def _differing_windows(texts: DataFrame) -> DataFrame:
    """(id, at, a, b): place and hashes of the windows of the passages in ``differing``, one row of arrays a text."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids, places, left, right = [], [], [], []
        wanted = batch.column(2).to_pylist()
        for number, text, passages in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), wanted):
            if passages:
                first, second, minimizers = windows_of(text.split())
                starts = passages_of(first, minimizers)[0]
                chosen = np.zeros(len(starts), bool)
                chosen[passages] = True
                at = np.flatnonzero(np.repeat(chosen, np.diff(np.append(starts, len(first)))))
                ids.append(number)
                places.append(at.astype(np.int32))
                left.append(first[at].view(np.int64))
                right.append(second[at].view(np.int64))
        kinds = [pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64())]
        arrays = [pa.array(c, kind) for c, kind in zip((ids, places, left, right), kinds)]
        yield pa.RecordBatch.from_arrays(arrays, names=["id", "at", "a", "b"])

    return map_batches(texts, run, "id long, at array<int>, a array<long>, b array<long>")


def factors(repeated: np.ndarray) -> list[tuple[int, int]]:
    """(first word, end) of each factor, from the sorted places of repeated windows; touching factors are one span."""
    if not len(repeated):
        return []
    cuts = np.flatnonzero(np.diff(repeated) > WINDOW) + 1
    groups = np.split(repeated, cuts)
    return [(int(g[0]), int(g[-1]) + WINDOW) for g in groups]


def _removed(texts: DataFrame) -> DataFrame:
    """(key, n_removed, kept_sha256, spans, kept_text) from (key, text, copied, same, windows)."""
    schema = (
        "key binary, n_removed long, kept_sha256 string, spans array<struct<first: long, last: long>>, kept_text string"
    )

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        counts, digests, spans, kept_texts = [], [], [], []
        columns = [batch.column(c).to_pylist() for c in (2, 3, 4)]
        for text, copied, same, windows in zip(texts_of(batch.column(1)), *columns):
            words = text.split()
            first, _, minimizers = windows_of(words)
            hit = np.zeros(len(first), bool)
            if copied:
                hit[:] = True
            else:
                starts = passages_of(first, minimizers)[0]
                whole = np.zeros(len(starts), bool)
                whole[same or []] = True
                hit = np.repeat(whole, np.diff(np.append(starts, len(first))))
                hit[windows or []] = True
            found = factors(np.flatnonzero(hit))
            kept, at = [], 0
            for begin, end in found:
                kept += words[at:begin]
                at = end
            kept += words[at:]
            counts.append(len(words) - len(kept))
            digests.append(digest(kept))
            spans.append([{"first": a, "last": b} for a, b in found])
            kept_texts.append(b" ".join(kept).decode())
        span = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
        arrays = [pa.array(c, k) for c, k in zip((counts, digests, spans, kept_texts), (pa.int64(), pa.string(), span, pa.string()))]
        names = ["key", "n_removed", "kept_sha256", "spans", "kept_text"]
        yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=names)

    return map_batches(texts, run, schema)


def repeated_passages(docs: DataFrame, key: str = "doc_id", text: str = "text", texts: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for each row of ``docs``; with ``texts`` also the removed spans (word
    numbers, the last excluded) and what is left, null where nothing goes.

    A word goes when a window of 35 words over it occurs anywhere else, in the same document or another. Copies of a
    document of 35 words or more lose everything. Null or empty texts and texts of fewer words keep what they have.
    Verdicts belong to texts, so rows with null or repeated ids are told apart by the digest of their text.
    """
    named = docs.select(
        F.col(f"`{key}`").alias("doc_id"),
        F.unhex(F.sha2(F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary"), 256)).alias("key"),
        F.col(f"`{text}`").alias("text"),
    )
    rows = Kept(_passages(named).withColumn("id", F.monotonically_increasing_id()), "passages").rows
    listed = rows.select("id", F.inline(F.arrays_zip("at", "mins", "sums")).alias("at", "m", "s"))
    blocks = listed.groupBy("m").agg(F.count(F.lit(1)).alias("n"), F.min("s").alias("lo"), F.max("s").alias("hi"))
    repeated = blocks.filter("n > 1").select("m", (F.col("lo") == F.col("hi")).alias("same"))
    hits = listed.select("id", "at", "m").join(repeated, "m").groupBy("id").agg(
        F.collect_set(F.when(F.col("same"), F.col("at"))).alias("same"),
        F.collect_set(F.when(~F.col("same"), F.col("at"))).alias("differing"),
    )
    owners = rows.groupBy("key").agg(F.min("id").alias("id"), (F.count(F.lit(1)) > 1).alias("copied"))
    marked = owners.join(hits, "id")
    whole = named.groupBy("key").agg(F.first("text").alias("text"))
    found = Kept(whole.join(marked, "key"), "repeated").rows
    open_texts = found.filter(~F.col("copied") | (F.size("differing") > 0)).select("id", "text", "differing")
    windows = Kept(_differing_windows(open_texts), "windows").rows
    single = windows.select("id", F.inline(F.arrays_zip("at", "a", "b")).alias("at", "a", "b"))
    again = single.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("a", "b")
    places = single.join(again, ["a", "b"]).groupBy("id").agg(F.collect_list("at").alias("windows"))
    judged = found.join(places, "id", "left").select("key", "text", "copied", "same", "windows")
    removed = _removed(judged)
    extra = ["spans", "kept_text"] if texts else []
    removed = removed.select("key", "n_removed", F.col("kept_sha256").alias("left_sha256"), *extra)
    joined = rows.select("doc_id", "key", "n_words", "kept_sha256").join(removed, "key", "left")
    return joined.select(
        "doc_id",
        "n_words",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("left_sha256", "kept_sha256").alias("kept_sha256"),
        *extra,
    )
