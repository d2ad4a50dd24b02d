"""SimHash near-duplicate groups, with links found in BK-trees."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from xxhash import xxh64_intdigest

from ramparts.llm.components import components
from ramparts.llm.shared import Kept, free_name, map_batches, map_in_arrow, texts_of

SHINGLE, SEED, RADIUS = 3, 42, 2
CHUNK = 1 << 15


def shingle_hashes(text: bytes, shingle: int = SHINGLE) -> Iterator[int]:
    """XXH64 of each shingle of the lower-cased words; fewer words than a shingle make one."""
    words = text.lower().split()
    if not words:
        return
    line = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths)
    size = min(shingle, len(words))
    starts = (ends - lengths)[: len(words) - size + 1]
    for first, last in zip(starts.tolist(), (ends[size - 1 :] - 1).tolist()):
        yield xxh64_intdigest(line[first:last], SEED)


def fingerprint(text: bytes) -> int:
    """64 bits, each set if it is set in over half of the shingles' hashes; 0 without words."""
    hashes = np.fromiter(shingle_hashes(text), np.uint64)
    votes = np.zeros(64, np.int64)
    for at in range(0, len(hashes), CHUNK):
        part = hashes[at : at + CHUNK].astype(">u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    bits = (2 * votes > len(hashes)).astype(np.uint8)
    return int.from_bytes(np.packbits(bits).tobytes(), "big")


def with_fingerprints(docs: DataFrame, text: str = "text", name: str = "fingerprint", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with the signed 64-bit fingerprint of its texts; ``keep`` names the columns to return beside it."""
    keep = docs.columns if keep is None else keep
    schema = docs.select(*[f"`{c}`" for c in keep]).schema.add(name, "long")

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = np.fromiter((fingerprint(t) for t in texts_of(batch.column(text))), np.uint64, batch.num_rows)
        columns = [batch.column(c) for c in keep]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(found.view(np.int64))], names=[*keep, name])

    return map_batches(docs, run, schema)


class BkTree:
    """Fingerprints as a tree whose children are keyed by their integer Hamming distance to the parent."""

    def __init__(self, prints: np.ndarray):
        self.prints = prints
        self.children: list[dict[int, int]] = [{} for _ in prints]
        todo = [np.arange(len(prints))] if len(prints) else []
        while todo:
            group = todo.pop()
            parent, below = int(group[0]), group[1:]
            distance = np.bitwise_count(prints[below] ^ prints[parent])
            for d in np.unique(distance):
                child = below[distance == d]
                self.children[parent][int(d)] = int(child[0])
                todo.append(child)

    def near(self, queries: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
        """(node, positions of the queries within ``radius`` of it). A query follows only the edges whose distance
        differs from its own distance to the node by at most ``radius``; queries walk together."""
        todo = [(0, np.arange(len(queries)))] if len(self.prints) and len(queries) else []
        while todo:
            node, asking = todo.pop()
            distance = np.bitwise_count(queries[asking] ^ self.prints[node]).astype(np.int16)
            hits = asking[distance <= radius]
            if len(hits):
                yield node, hits
            for edge, child in self.children[node].items():
                following = asking[np.abs(distance - edge) <= radius]
                if len(following):
                    todo.append((child, following))


def tree_links(prints: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """A star for each group that links within ``radius`` make: (member, its group's first print)."""
    group = np.arange(len(prints))
    for _, hits in BkTree(prints).near(prints, radius):
        met = group[hits]
        if (met != met[0]).any():
            group[np.isin(group, met)] = met.min()
    members = np.flatnonzero(group != np.arange(len(prints)))
    return prints[members], prints[group[members]]


# Two fingerprints that differ in at most two bits agree on six of their eight bytes at least. A shard holds the
# fingerprints that agree on six given bytes, so two bytes are free and its tree has 65,536 nodes at most.
SHARD_MASKS = [
    int.from_bytes(bytes(0 if i in free else 255 for i in range(8)), "big") for free in combinations(range(8), RADIUS)
]
SIGNED = [m - (1 << 64) if m >> 63 else m for m in SHARD_MASKS]


def _links_of_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within the shards of a partition sorted by shard. Holds one batch and one open shard at a time."""
    masks = np.array(SHARD_MASKS, np.uint64)
    shard, prints = np.empty(0, np.int64), np.empty(0, np.uint64)

    def closed(number: np.ndarray, found: np.ndarray, cuts: np.ndarray) -> pa.RecordBatch:
        sizes = np.diff(np.concatenate([[0], cuts]))
        stars = [tree_links(found[end - size : end]) for end, size in zip(cuts, sizes) if size > 1]
        a, b = (np.concatenate([s[i] for s in stars] or [np.empty(0, np.uint64)]) for i in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    for batch in batches:
        shard = np.concatenate([shard, batch.column(0).to_numpy().astype(np.int64)])
        prints = np.concatenate([prints, batch.column(1).to_numpy().view(np.uint64)])
        key = prints & masks[shard]
        cuts = np.flatnonzero((shard[1:] != shard[:-1]) | (key[1:] != key[:-1])) + 1
        if len(cuts):
            yield closed(shard, prints, cuts)
            shard, prints = shard[cuts[-1] :], prints[cuts[-1] :]
    if len(prints):
        yield closed(shard, prints, np.array([len(prints)]))


def linked_prints(prints: DataFrame, name: str = "fingerprint") -> DataFrame:
    """Links (a, b) whose components are those of all links of at most two bits among the fingerprints in ``prints``.

    Each distinct fingerprint goes to the 28 shards of its byte sextuples; a shard's BK-tree is built and queried
    where the shard's fingerprints are. A tree never meets fingerprints of another shard, as those are further away,
    so the trees (whose total grows with the data) need not be broadcast.
    """
    masks = F.array(*[F.lit(m) for m in SIGNED])
    shards = (
        prints.select(F.col(f"`{name}`").alias("p")).distinct().select("p", F.posexplode(masks).alias("shard", "mask"))
    )
    key = F.col("p").bitwiseAND(F.col("mask"))
    dealt = shards.select("shard", "p", key.alias("k")).repartition("shard", "k").sortWithinPartitions("shard", "k", "p")
    return map_in_arrow(dealt.select("shard", "p"), _links_of_shards, "a long, b long").distinct()


def print_groups(prints: DataFrame, name: str = "fingerprint") -> DataFrame:
    """(fingerprint, root) for the fingerprints linked to a smaller one, root being the smallest of the group."""
    return components(linked_prints(prints, name)).select(F.col("node").alias(name), "root")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, a row for each row of ``docs``.

    component_id is the smallest key that links reach. A null or empty text has fingerprint zero and is linked like
    any other. A row with a null key belongs to its group but never names it; a group of such rows alone has a null
    id. Repeated rows come out repeated. An empty table gives no rows.
    """
    base = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    prints = Kept(with_fingerprints(base, keep=["doc_id"]), "fingerprints").rows
    smallest = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("smallest"))
    roots = smallest.join(print_groups(prints), "fingerprint", "left")
    roots = Kept(roots.select("fingerprint", "smallest", F.coalesce("root", "fingerprint").alias("root")), "roots").rows
    ids = roots.groupBy("root").agg(F.min("smallest").alias("component_id"))
    named = roots.join(ids, "root").select("fingerprint", "component_id")
    joined = prints.join(named, "fingerprint")
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return joined.select("doc_id", digits.alias("fingerprint"), "component_id")


def one_of_each_group(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group: the one with the smallest key (nulls last), then the smallest text.

    Of rows alike in both, one stays. Columns stay as they are.
    """
    name = free_name(docs.columns, "fingerprint")
    tagged = Kept(with_fingerprints(docs, text, name), "fingerprints").rows
    groups = print_groups(tagged, name).withColumnRenamed("root", free_name(tagged.columns, "root"))
    root = F.coalesce(F.col(f"`{groups.columns[1]}`"), F.col(f"`{name}`"))
    # One struct is what rows are ordered by and what is kept, so that a text is held and shuffled once. Columns that
    # have no order are carried beside it.
    others = [c for c in docs.columns if c not in (key, text)]
    first, beside = [key, text], []
    for c in others:
        (first if _has_order(docs.schema[c].dataType) else beside).append(c)
    order = F.struct(F.col(f"`{key}`").isNull().alias("unnamed"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(first)])
    if beside:
        kept = F.min_by(F.struct(order.alias("first"), F.struct(*[F.col(f"`{c}`") for c in beside]).alias("beside")), order)
    else:
        kept = F.struct(F.min(order).alias("first"))
    rows = tagged.join(groups, name, "left").groupBy(root.alias("r")).agg(kept.alias("row"))
    place = {c: f"row.first.c{i}" for i, c in enumerate(first)} | {c: f"row.beside.`{c}`" for c in beside}
    return rows.select(*[F.col(place[c]).alias(c) for c in docs.columns])


def _has_order(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_has_order(f.dataType) for f in kind)
    if isinstance(kind, T.ArrayType):
        return _has_order(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))
