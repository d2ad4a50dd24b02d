"""Session settings the library relies on, and where it may write."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def local_session(cores: str | int = "*", name: str = "ramparts", **settings: str) -> SparkSession:
    """Session for tests and the benchmark. On a cluster, submit with your own settings."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> None:
    """Hour partitions and windows are UTC; pin the session to it."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder.
    """
    named = spark.conf.get(CHECKPOINT_DIR, None)
    if named:
        return named.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="ramparts-")
    spark.conf.set(CHECKPOINT_DIR, folder)
    return folder


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A path of its own for each call, under the shared folder."""
    return f"{shared_folder(spark)}/ramparts-{purpose}-{uuid.uuid4().hex}"
