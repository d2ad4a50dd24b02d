"""Live aggregates over a stream of requests, and their file sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from ramparts.operators.rate import LIMIT, is_counted
from ramparts.operators.series import LATENESS, PERIOD, timed

# Folder per micro-batch.
BATCH = "batch"
# Sliding windows that are counted in one row, at most.
GROUPED = 16


def stream_rate_limit(
    stream: DataFrame, limit: int = LIMIT, window: str = PERIOD, slide: str = "30 seconds", lateness: str = LATENESS
) -> DataFrame:
    """Clients with more than ``limit`` counted requests in a window that moves by ``slide``.

    Windows are counted in groups: one row of state holds the counts of a client in all the windows that begin within a
    stretch as long as a window, so a request is in two rows of state, not in one for each window that holds it. Counts are
    summed before the shuffle, so a client with very many requests costs no more than others. State is dropped
    as the watermark passes a group's last window; only then does append mode give the group, and until then a late request
    counts in all of its windows. Batch input gives the same windows.
    """
    window_ms, slide_ms = _millis(stream, window, slide)
    starts = range(0, slide_ms * min(-(-window_ms // slide_ms), GROUPED), slide_ms)
    group = F.window("ts", f"{starts[-1] + window_ms} milliseconds", f"{len(starts) * slide_ms} milliseconds")
    at = F.col("ts_ms") - F.unix_millis("group.start")
    held = [F.count_if((at >= start) & (at < start + window_ms)).alias(f"_{start}") for start in starts]
    grouped = timed(stream.filter(is_counted()), lateness).withColumn("group", group).groupBy("group", "clientip").agg(*held)
    counts = F.array(*[F.col(f"_{start}") for start in starts])
    over = grouped.filter(F.array_max(counts) > limit).select("group", "clientip", F.posexplode(counts).alias("no", "requests"))
    begin = F.unix_millis("group.start") + F.col("no") * slide_ms
    return over.filter(F.col("requests") > limit).select(
        F.timestamp_millis(begin).alias("window_start"),
        F.timestamp_millis(begin + window_ms).alias("window_end"),
        "clientip",
        "requests",
    )


def _millis(rows: DataFrame, *spans: str) -> list[int]:
    """Lengths of intervals, as ``F.window`` takes them, in milliseconds."""
    epoch = F.timestamp_millis(F.lit(0))
    lengths = [F.unix_millis(epoch + F.lit(span).cast("interval")) for span in spans]
    return list(rows.sparkSession.range(1).select(*lengths).first())


def to_files(stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Append finished windows to Parquet files, each exactly once."""
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": PERIOD}))
        .start()
    )


def drained(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Run a stream of windows, or of moments, over everything there is now and read back what they gave.

    Windows that the watermark has not closed when the input ends count too: each micro-batch writes the windows it
    has changed to a folder of its own, which a repeated batch replaces, and the last state of a window holds.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")

    query = (
        stream.writeStream.foreachBatch(store)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    spark, schema = stream.sparkSession, stream.schema
    written = StructType([*schema.fields, StructField(BATCH, LongType())])
    keys = [name for name in ("window_start", "window_end", "clientip", "ts_ms") if name in schema.names]
    values = [name for name in schema.names if name not in keys]
    last = F.max(F.struct(BATCH, *[f"`{name}`" for name in values])).alias("last")
    states = spark.read.schema(written).option("basePath", path).parquet(f"{path}/{BATCH}=*")
    return states.groupBy(*keys).agg(last).select(*keys, *[F.col(f"last.`{name}`").alias(name) for name in values])
