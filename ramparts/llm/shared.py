"""What the operators share: reading tables, Arrow batches, intermediate tables and files in the shared folder."""

from __future__ import annotations

import ctypes
import gc
import os
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

from ramparts.session import scratch_path

HOME = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(taken: Iterable[str], wanted: str) -> str:
    """``wanted``, with underscores in front until no column of ``taken`` has that name in any case."""
    names = {name.lower() for name in taken}
    while wanted.lower() in names:
        wanted = f"_{wanted}"
    return wanted


class Kept:
    """A table written once under the folder of ``spark.checkpoint.dir``; ``drop`` deletes it when no longer needed."""

    def __init__(self, rows: DataFrame, purpose: str):
        self.spark = rows.sparkSession
        self.path = scratch_path(self.spark, purpose)
        rows.write.parquet(self.path)
        self.schema = rows.schema

    @property
    def rows(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)

    def drop(self) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def partitions(spark: SparkSession, rows_per_key: int = 1) -> int:
    """Shuffle partitions for data that one row blows up to ``rows_per_key`` rows."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))) * rows_per_key


# What the operators keep from task to task in a Python worker, by module: how to let go of it.
KEPT_BY_WORKER: dict[str, Callable[[], None]] = {}


# The C library's call that gives free memory back, where it has one.
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def _let_go_of_others(owner: str) -> None:
    """A worker serves one stage after another; what an earlier operator keeps in it is of no use to this one, nor is
    memory that is free but not yet given back to the system."""
    for module, let_go in list(KEPT_BY_WORKER.items()):
        if module != owner:
            let_go()
    gc.collect()
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)


def map_in_arrow(rows: DataFrame, run: Callable, schema, owner: str = "") -> DataFrame:
    """``mapInArrow`` whose Python workers find this package where the driver has it, unless it is installed.

    ``owner`` is the module whose caches the worker keeps, that of ``run`` unless given.
    """
    owner = owner or run.__module__

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _let_go_of_others(owner)
        yield from run(batches)

    environment = rows.sparkSession.sparkContext.environment
    folders = environment.get("PYTHONPATH", "").split(os.pathsep)
    if HOME not in folders:
        environment["PYTHONPATH"] = os.pathsep.join([HOME, *filter(None, folders)])
    return rows.mapInArrow(alone, schema)


def map_batches(
    rows: DataFrame, function: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``function`` applied to each Arrow batch. The session's limits on a batch bound what one call sees."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from function(batch)

    return map_in_arrow(rows, run, schema, function.__module__)


def texts_of(column: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of each text; a null is an empty text."""
    for text in column.cast(pa.large_binary()):
        value = text.as_py()
        yield b"" if value is None else value


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """Where tasks write and read files of the shared folder: a local path or any address that Arrow knows."""
    if "://" not in path and not path.startswith("file:"):
        return pafs.LocalFileSystem(), path
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(path)
