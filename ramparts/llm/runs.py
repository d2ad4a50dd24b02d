"""Periodic runs of words, found online on sparse diagonals."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import count

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ramparts.llm.shared import free_name, map_batches, texts_of

# A run is this many words long at least, and this many times its period.
SHORTEST, TIMES = 6, 4
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def runs(words: Sequence, shortest: int = SHORTEST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of each maximal run, by start, then period.

    The words are read once, from left to right. Diagonal q holds how many words up to the present one equal the words
    q before them. Earlier occurrences of the present word make its diagonals longer by one; a diagonal that no
    earlier occurrence continues ends, and is a run if it is long enough.

    Frequent words would keep a diagonal for each earlier occurrence. Diagonals of lag size/2 + 1 to size are therefore
    opened by the last ``size`` words together (1, 2, 4, 8 and so on), and by the nearest earlier occurrence of these
    alone. No run is lost: with ``times`` of three or more, the diagonal of a run of smallest period q holds more than
    ``size`` words, and among these the nearest earlier occurrence is the one q before. What it holds back are multiples
    of a smaller period. A pair of sizes is looked up only where both its halves have occurred before, so most words
    cost one lookup, and none costs more than one for each size: n log n steps and places in all, in the worst text too.
    """
    if times < 3:
        raise ValueError("a run is three times its period at least")
    n = len(words)
    largest = n // times
    met: list[dict] = [{}]  # for each size: its words -> [nearest end, number once met again]
    numbers: list[list[int | None]] = [[None] * n]  # for each size: the number of the words that end there, once met again
    fresh = count()
    lags: dict[int, int] = {}
    opened: dict[int, list[int]] = {}
    found = []

    def number(level: int, end: int, value: int, now: int) -> None:
        mine = numbers[level]
        mine[end] = value
        size = 1 << level
        if size >= largest:
            return
        if level + 1 == len(met):
            met.append({})
            numbers.append([None] * n)
        if end >= size and (before := mine[end - size]) is not None:
            meet(level + 1, (before, value), end, now)
        if end + size <= now and (behind := mine[end + size]) is not None:
            meet(level + 1, (value, behind), end + size, now)

    def meet(level: int, key, end: int, now: int) -> None:
        entry = met[level].get(key)
        if entry is None:
            met[level][key] = [end, None]
            return
        nearest, value = entry
        if value is None:
            value = entry[1] = next(fresh)
            number(level, nearest, value, now)
        if end == now and (1 << level) >> 1 < now - nearest <= 1 << level:
            lags[level] = now - nearest
        entry[0] = max(nearest, end)
        number(level, end, value, now)

    def close(level: int, end: int) -> None:
        lag, matches = opened.pop(level)
        length = matches + lag
        if length >= max(shortest, times * lag):
            found.append((end - length + 1, length, lag))

    first = met[0]
    for now, word in enumerate(words):
        lags.clear()
        if word in first:
            meet(0, word, now, now)
        else:
            first[word] = [now, None]
        if opened:
            for level in [level for level, (lag, _) in opened.items() if lags.get(level) != lag]:
                close(level, now - 1)
        for level, lag in lags.items():
            if level in opened:
                opened[level][1] += 1
            else:
                opened[level] = [lag, 1 << level]
    for level in list(opened):
        close(level, n - 1)
    return sorted(found, key=lambda run: (run[0], run[2]))


def collapsed(words: Sequence, found: list[tuple[int, int, int]]) -> list:
    """The words without those behind the first period of a run."""
    kept, at = [], 0
    for begin, end in sorted((start + period, start + length) for start, length, period in found):
        kept += words[at:begin]
        at = max(at, end)
    return kept + list(words[at:])


def with_runs(docs: DataFrame, text: str = "text", shortest: int = SHORTEST, times: int = TIMES) -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` (array of start, length, period) and ``collapsed``, the text without repeats.

    Words are what ASCII blanks part; those kept are joined by one space. A null or empty text has no words, no runs
    and an empty collapsed text. Very long texts take n log n steps and memory in proportion. Runs that overlap or
    have equal lengths are all listed. Rows are judged apart, so repeated rows come out repeated, and an empty table gives
    no rows. A new column gets underscores in front where ``docs`` has its name.
    """
    names = []
    for name in ("n_words", "runs", "collapsed"):
        names.append(free_name([*docs.columns, *names], name))
    schema = T.StructType([*docs.schema])
    for name, kind in zip(names, ("bigint", RUNS, "string")):
        schema.add(name, T.DataType.fromDDL(kind))
    arrow = pa.list_(pa.struct([(part, pa.int64()) for part in ("start", "length", "period")]))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        sizes, listed, left = [], [], []
        for value in texts_of(batch.column(text)):
            words = value.split()
            found = runs(words, shortest, times)
            sizes.append(len(words))
            listed.append([dict(zip(("start", "length", "period"), r)) for r in found])
            left.append(b" ".join(collapsed(words, found)))
        more = [pa.array(sizes, pa.int64()), pa.array(listed, arrow), pa.array(left, pa.binary()).cast(pa.string())]
        yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=schema.names)

    return map_batches(docs, run, schema)


def probed(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The (key, text) that the registered query looks at: every tenth text, by its key, is periodic from some word on.

    A null key leaves its text as it is.
    """
    words = F.filter(F.split(F.col(f"`{text}`"), r"[\x20\x09-\x0D]+"), lambda word: word != "")
    drawn = F.crc32(F.col(f"`{key}`").cast("string").cast("binary"))
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"), drawn.alias("h"))
    chosen = rows.select("*", F.when(F.col("h") % 10 == 0, words).alias("words"))
    chosen = chosen.select("*", F.expr("h div 10").alias("g"), F.size("words").alias("n"))
    placed = chosen.select("*", F.when(F.col("n") > 0, F.expr("g % n")).alias("a"))
    period = placed.select("*", F.expr("1 + (n - a) div (3 + g % 8)").alias("p"))
    periodic = F.expr("array_join(transform(words, (w, i) -> if(i < a, w, words[a + (i - a) % p])), ' ')")
    return period.select("key", F.coalesce(F.when(F.col("n") > 0, periodic), F.col("text")).alias("text"))


def run_report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each document of ``probed``: its longest run, and digests of all runs and of the collapsed text."""
    found = with_runs(probed(docs, key, text))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("l"), -r.start, -r.period, r.alias("run"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    best = found.select(
        F.col("key").alias("doc_id"),
        F.size("runs").cast("long").alias("n_runs"),
        longest["run"].alias("run"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
    return best.select(
        "doc_id", "n_runs", "run.start", "run.length", "run.period",
        F.expr("1000 * run.length div run.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )
