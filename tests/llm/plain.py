"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall((text or "").encode())


def sha(value):
    return hashlib.sha256(value if isinstance(value, bytes) else value.encode()).hexdigest()


def fingerprint(text):
    said = WORD.findall(re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not said:
        return 0
    shingles = [b" ".join(said[i : i + 3]) for i in range(max(1, len(said) - 2))]
    votes = Counter(bit for s in shingles for bit in range(64) if xxhash.xxh64(s, seed=42).intdigest() >> bit & 1)
    return sum(1 << bit for bit, n in votes.items() if 2 * n > len(shingles))


def groups(docs):
    """(doc_id, fingerprint, component_id) of (doc_id, text) rows."""
    prints = [fingerprint(text) for _, text in docs]
    distinct = sorted(set(prints))
    root = {p: p for p in distinct}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    numbers = np.array(distinct, np.uint64)
    for i, p in enumerate(distinct):
        for j in np.flatnonzero(np.bitwise_count(numbers ^ numbers[i]) <= 2):
            root[find(distinct[j])] = find(p)
    smallest = {}
    for (doc_id, _), p in zip(docs, prints):
        if doc_id is not None:
            smallest[find(p)] = min(smallest.get(find(p), doc_id), doc_id)
    return [(doc_id, f"{p:016x}", smallest.get(find(p))) for (doc_id, _), p in zip(docs, prints)]


def contamination(docs, items):
    def said(text):
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)

    windows = defaultdict(set)
    for item, text in items:
        w = said(text)
        for i in range(max(1, len(w) - 12) if w else 0):
            windows[tuple(w[i : i + 13])].add(item)
    sizes, out = {len(w) for w in windows}, []
    for doc_id, text in docs:
        w, hit, found = said(text), set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                if here := windows.get(tuple(w[i : i + size])):
                    hit |= set(range(i, i + size))
                    found |= {str(item) for item in here if item is not None}
        listed = sha(",".join(sorted(found)))
        out.append((doc_id, len(w), len(hit), len(found), listed, bool(hit) and 20 * len(hit) >= len(w)))
    return out


def passages(docs, window=35):
    texts = [words(text) for _, text in docs]
    seen = Counter(tuple(w[i : i + window]) for w in texts for i in range(len(w) - window + 1))
    out = []
    for (doc_id, _), w in zip(docs, texts):
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone |= set(range(i, i + window))
        out.append((doc_id, len(w), len(gone), sha(b" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


def store(docs, encode):
    """Token store rows of docs in order; ``encode`` gives the ids of a text."""
    out, start = [], 0
    for doc_id, text in docs:
        ids = np.array([*encode(text or ""), 1], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out
