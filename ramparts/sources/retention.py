"""Expiry of whole partitions: folders of days beyond the retention go, and no file that stays is touched."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import date, datetime, timedelta

from pyspark.sql import SparkSession

from ramparts.sources.deliveries import forget
from ramparts.sources.schema import PARTITIONS

# Fixed value: for how long logs are kept.
RETENTION_DAYS = 90


def oldest_day(as_of: date | datetime, days: int) -> date:
    """The first day that is kept."""
    return (as_of.date() if isinstance(as_of, datetime) else as_of) - timedelta(days)


def expired_folders(spark: SparkSession, root: str, oldest: date) -> list[str]:
    """Folders below ``root`` that hold nothing from ``oldest`` on, each as high up as it can be: ``year=2023``, then
    ``year=2024/month=01``, then days of the month that ``oldest`` lies in. At most three folders are listed."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    bounds = [oldest.strftime(form) for form in ("%Y", "%m", "%d")]

    def below(folder: str, level: int) -> Iterator[str]:
        place = path(f"{root}/{folder}".rstrip("/"))
        if not system.exists(place):
            return
        for status in system.listStatus(place):
            name, _, value = status.getPath().getName().partition("=")
            if status.isDirectory() and name == PARTITIONS[level] and value.isdigit():
                inner = f"{folder}/{name}={value}".lstrip("/")
                if int(value) < int(bounds[level]):
                    yield inner
                elif int(value) == int(bounds[level]) and level < 2:
                    yield from below(inner, level + 1)

    return sorted(below("", 0))


def expire(
    spark: SparkSession, root: str, as_of: date | datetime, days: int = RETENTION_DAYS, table: str | None = None
) -> list[str]:
    """Remove the partitions dated before ``days`` before ``as_of``, and return the folders removed.

    ``root`` is a log or its columnar copy; ``table``, if given, is an external table over it, whose partitions are
    dropped first, so that it never names a folder that is gone. A run that was cut short is run again and
    goes on with what is left. Deliveries that cover expired hours alone are forgotten.
    """
    root, oldest = root.rstrip("/"), oldest_day(as_of, days)
    folders = expired_folders(spark, root, oldest)
    for folder in folders:
        if table:
            parts = [part.partition("=") for part in folder.split("/")]
            wanted = " AND ".join(f"{name} = '{value}'" for name, _, value in parts)
            known = spark.sql(f"SHOW PARTITIONS {table} PARTITION ({wanted.replace(' AND ', ', ')})").collect()
            specs = [", ".join(f"{n} = '{v}'" for n, _, v in (p.partition("=") for p in row[0].split("/"))) for row in known]
            if specs:
                spark.sql(f"ALTER TABLE {table} DROP IF EXISTS " + ", ".join(f"PARTITION ({spec})" for spec in specs))
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{folder}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    forget(spark, root, before=oldest.strftime("%Y%m%d00"))
    return folders
