"""Continuous ingest of JSON log lines into hourly gzip partitions."""

from __future__ import annotations

import hashlib
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ramparts.operators.governance import filter_logged, redact
from ramparts.sources.deliveries import Delivery, published, publish
from ramparts.sources.logs import YEARS, append_hours, parse_lines, refused, with_hour_partition, write_errors
from ramparts.sources.schema import CORRUPT, PARTITIONS

# Fixed value: how long deliveries are gathered before they are written.
FLUSH = "5 minutes"
# Folder per micro-batch of refused text.
DELIVERY = "delivery"
# What one micro-batch takes from the landing folder, unless it is told otherwise.
BATCH_BYTES = 8 << 30


def line_stream(spark: SparkSession, landing: str, max_bytes: int | None = BATCH_BYTES) -> DataFrame:
    """Text lines from files as they arrive under ``landing``; ``max_bytes`` bounds one micro-batch."""
    reader = spark.readStream.format("text")
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes))
    return reader.load(landing)


def ingest(
    lines: DataFrame,
    root: str,
    errors_root: str,
    checkpoint: str,
    trigger: dict | None = None,
    moment: Column | None = None,
    filtered: bool = True,
    years: tuple[int, int] = YEARS,
) -> StreamingQuery:
    """Parse, filter, redact and store a stream of lines. Text that does not parse, and records without a time inside
    ``years``, go to ``errors_root``.

    A micro-batch writes its files once, where they stay, under names that carry the batch and the attempt; a scan sees
    them when the batch is published by the creation of one small file. What an attempt leaves that ended before
    is never seen, and a batch run again after it was published writes nothing. So every line is stored once,
    whatever ``moment`` dates its partition by (the event time unless given). Each batch is gathered by hour.
    """
    stream = hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]
    spark = lines.sparkSession
    done: set[int] | None = None

    def store(batch: DataFrame, batch_id: int) -> None:
        nonlocal done
        if done is None:
            done = {delivery.batch for delivery in published(spark, root) if delivery.stream == stream}
        if batch_id in done:
            return
        parsed = parse_lines(batch)
        good = parsed.filter(~refused(parsed, moment, years)).drop(CORRUPT)
        if filtered:
            good = redact(filter_logged(good))
        deliver(with_hour_partition(good, moment, years), root, stream, batch_id, lambda: write_errors(
            parsed, f"{errors_root.rstrip('/')}/{DELIVERY}={batch_id}", "overwrite", moment, years
        ))

    return (
        lines.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": FLUSH}))
        .start()
    )


def deliver(logs: DataFrame, root: str, stream: str, batch: int, before_publishing=lambda: None) -> Delivery:
    """Write rows by hour into ``root`` under names of an attempt of their own, then publish the attempt.

    Nothing is listed, moved or deleted. The hours that the rows cover are observed while they are written.
    """
    attempt = uuid.uuid4().hex
    covered = Observation()
    hour = F.concat(*PARTITIONS)
    rows = logs.observe(covered, F.min(hour).alias("first"), F.max(hour).alias("last"))
    append_hours(rows, root, file_names=Delivery(stream, batch, attempt).file_names)
    before_publishing()
    hours = _observed(covered)
    delivery = Delivery(stream, batch, attempt, hours.get("first") or "", hours.get("last") or "")
    publish(logs.sparkSession, root, delivery)
    return delivery


def _observed(covered: Observation) -> dict:
    try:
        return covered.get
    except Py4JJavaError:
        # Rows known to be none while the write was planned are planned away, and what observes them too.
        return {}
