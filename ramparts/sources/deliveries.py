"""Which files of a log are part of it: a commit log of deliveries.

A streamed delivery writes its files straight into the hour folders, under names that begin with ``delivery.`` and carry
stream, batch and attempt. They count once the delivery is published: an empty file in ``_deliveries``
whose name says which attempt of which batch it is, and which hours it covers. Creating it is one atomic step on any
store, and nothing has to be moved, read or repaired. Files with other names always count.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

FOLDER, MARK = "_deliveries", "delivery"
# Names of data files, as Spark gives them: the part before the first dash is ours.
FILE_NAME = rf"^{MARK}[.]([^-]+)-"


@dataclass(frozen=True, order=True)
class Delivery:
    """An attempt at a micro-batch of a stream; ``first`` and ``last`` are the hours it covers (yyyyMMddHH), or empty."""

    stream: str
    batch: int
    attempt: str
    first: str = ""
    last: str = ""

    @property
    def tag(self) -> str:
        return f"{self.stream}.{self.batch:012d}.{self.attempt}"

    @property
    def file_names(self) -> str:
        return f"{MARK}.{self.tag}"

    @property
    def manifest(self) -> str:
        return f"{self.tag}.{self.first}.{self.last}"

    @staticmethod
    def of(manifest: str) -> Delivery | None:
        """None for a file that is no manifest."""
        parts = manifest.split(".")
        if len(parts) != 5 or not parts[1].isdigit():
            return None
        return Delivery(parts[0], int(parts[1]), *parts[2:])


def _manifests(spark: SparkSession, root: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{FOLDER}")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def publish(spark: SparkSession, root: str, delivery: Delivery) -> None:
    """Make the delivery part of the log. Fails if this very attempt has been published."""
    system, folder = _manifests(spark, root)
    system.create(spark._jvm.org.apache.hadoop.fs.Path(folder, delivery.manifest), False).close()


def published(spark: SparkSession, root: str) -> list[Delivery]:
    """One delivery for each batch, by one listing of names. Should two attempts at a batch have been published, the
    same one of them counts for every scan."""
    system, folder = _manifests(spark, root)
    if not system.exists(folder):
        return []
    names = (status.getPath().getName() for status in system.listStatus(folder))
    found = sorted(delivery for name in names if (delivery := Delivery.of(name)))
    return list({(d.stream, d.batch): d for d in reversed(found)}.values())


def forget(spark: SparkSession, root: str, before: str) -> None:
    """Remove what published deliveries that end before the hour ``before``, whose files are gone. Deliveries without
    rows stay, as they tell a stream which batches it has delivered."""
    system, folder = _manifests(spark, root)
    for delivery in published(spark, root):
        if delivery.last and delivery.last < before:
            system.delete(spark._jvm.org.apache.hadoop.fs.Path(folder, delivery.manifest), False)


def within(deliveries: Iterable[Delivery], first: str | None, last: str | None) -> Iterator[Delivery]:
    """Those that cover an hour from ``first`` to ``last`` (yyyyMMddHH, both inclusive, None for open)."""
    for delivery in deliveries:
        if delivery.first and (last is None or delivery.first <= last) and (first is None or delivery.last >= first):
            yield delivery


def delivery_of(file_name: Column) -> Column:
    """Tag of the delivery that a data file belongs to; empty for a file of another sink."""
    return F.regexp_extract(file_name, FILE_NAME, 1)


def counted(tags: Iterable[str]) -> Column:
    """Whether a scanned file counts, told by its name alone, so that the scan leaves out the others unread."""
    name = F.col("_metadata.file_name")
    return ~name.startswith(f"{MARK}.") | delivery_of(name).isin("", *tags)


def abandoned_files(spark: SparkSession, root: str, before) -> DataFrame:
    """(path, modificationTime, length) of delivery files last written before ``before`` (a timestamp) that belong to
    no published delivery: what attempts left that ended early. Listed by Spark, no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    tag = delivery_of(F.element_at(F.split("path", "/"), -1))
    known = [delivery.tag for delivery in published(spark, root)]
    lost = (tag != "") & ~tag.isin(known) & (F.col("modificationTime") < F.lit(before))
    return files.select("path", "modificationTime", "length").filter(lost)
