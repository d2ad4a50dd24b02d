"""Fill-in-the-middle: texts cut at line borders and put together anew, so that a model learns to fill the gap."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ramparts.llm.shared import free_name, map_batches

# Marks of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
COLUMNS = (("n", "long"), ("form", "string"), ("prefix_chars", "long"), ("middle_chars", "long"), ("output", "string"))
# One match of all lines. The group keeps every repetition, and no repetition is ever taken back.
LINES = regex.compile(r"([^\n]*+\n|[^\n]++)*+")


@dataclass(frozen=True)
class Rates:
    """What is drawn from the digest of ``seed:key``: of 100 texts ``changed`` are cut, of 100 cut ones ``spm`` put the suffix first."""

    seed: int = 7
    changed: int = 100
    spm: int = 50


def infilled(text: str, key: str, rates: Rates) -> tuple[int, str, int | None, int | None, str]:
    """(lines, form, prefix length, middle length, output)."""
    ends = LINES.fullmatch(text).ends(1)
    drawn = hashlib.sha256(f"{rates.seed}:{key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(drawn[at : at + 8], 16) for at in (0, 8, 16, 24))
    n = len(ends)
    if not text or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= rates.changed:
        return n, "plain", None, None, text
    borders = [0, *ends]
    first, last = sorted((borders[h1 % (n + 1)], borders[h2 % (n + 1)]))
    prefix, middle, suffix = text[:first], text[first:last], text[last:]
    if h4 % 100 < rates.spm:
        return n, "spm", first, last - first, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", first, last - first, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def with_infill(docs: DataFrame, key: str = "doc_id", text: str = "text", rates: Rates = Rates()) -> DataFrame:
    """``docs`` with ``n`` (lines), ``form`` (plain, psm or spm), ``prefix_chars``, ``middle_chars`` and ``output``.

    A null text is an empty one, and an empty text stays plain; so does a text that holds a mark, whose output could
    not be read back. A null key draws as the word ``null``. Rows of equal key and text get equal outputs; repeated rows
    come out repeated and an empty table gives no rows. A text of any length is matched once, as a whole. A new
    column gets underscores in front where ``docs`` has its name.
    """
    names = []
    for name, _ in COLUMNS:
        names.append(free_name([*docs.columns, *names], name))
    schema = T.StructType([*docs.schema])
    for name, (_, kind) in zip(names, COLUMNS):
        schema.add(name, kind)
    drawn_by = free_name(schema.names, "key")
    width, keyed = len(docs.columns), docs.withColumn(drawn_by, F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("null")))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        keys, texts = batch.column(drawn_by), batch.column(text)
        made = [infilled(t.as_py() or "", k.as_py(), rates) for k, t in zip(keys, texts)]
        parts = zip(*made) if made else ([] for _ in COLUMNS)
        more = [pa.array(p, pa.string() if kind == "string" else pa.int64()) for p, (_, kind) in zip(parts, COLUMNS)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:width], *more], names=schema.names)

    return map_batches(keyed, run, schema)


def restored(output: Column, form: Column) -> Column:
    """The exact text, from output and form alone. No mark overlaps itself or another, so each is found where it was put."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}")
    ordered = F.when(form == "psm", F.concat(parts[1], parts[3], parts[2])).when(
        form == "spm", F.concat(parts[2], parts[3], parts[1])
    )
    return F.coalesce(ordered, output)


def infill_report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each document: how it was cut, and digests of its output and of the text read back from that."""
    made = with_infill(docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text")))
    back = restored(F.col("output"), F.col("form"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(back.cast("binary"), 256).alias("restored_sha256"),
    )
