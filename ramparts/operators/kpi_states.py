"""Block KPIs from stored counts per delivered hour, so that a report reads whole hours of the log only once, ever."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from ramparts.operators.kpi import DELIVERY_DELAY_HOURS, between, bounds_ms, delivered_on, per_action_and_rule, report_of
from ramparts.sources.logs import read_logs
from ramparts.sources.schema import PARTITIONS

HOUR_MS = 3_600_000
STATES = "hour_ms long, action string, terminatingruleid string, n long, " + ", ".join(f"{p} string" for p in PARTITIONS)


def hourly_states(logs: DataFrame) -> DataFrame:
    """Counts by delivered hour (the folder), hour of the event, action and terminating rule; one aggregate.

    What a folder adds depends on that folder alone. A late record stands in a later folder, so counts that are stored
    never change by it. Rows without a time are in no report and are left out.
    """
    hour = F.col("ts_ms") - F.pmod("ts_ms", F.lit(HOUR_MS))
    timed = logs.filter(F.col("ts_ms").isNotNull())
    counts = timed.groupBy(hour.alias("hour_ms"), "action", "terminatingruleid", *PARTITIONS).agg(F.count(F.lit(1)).alias("n"))
    return counts.select("hour_ms", "action", "terminatingruleid", "n", *PARTITIONS)


def write_hourly_states(states: DataFrame, path: str) -> None:
    """Keep the counts by delivered hour. Hours that occur in ``states`` replace what is stored of them, others stay: a
    run that was cut short is repeated, and an hour that got another file is counted again by itself."""
    writer = states.hint("rebalance", *PARTITIONS).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*PARTITIONS).parquet(path)


def read_hourly_states(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STATES).parquet(path)


def refresh_hourly_states(spark: SparkSession, root: str, path: str, start: datetime, end: datetime) -> None:
    """Count the folders of these delivered hours (UTC, both inclusive) again; no other folder of the log is read."""
    write_hourly_states(hourly_states(read_logs(spark, root, start, end)), path)


def kpi_report_from_states(
    states: DataFrame,
    logs: DataFrame,
    as_of: datetime,
    hours: int = 24,
    top: int = 5,
    delay_hours: int = DELIVERY_DELAY_HOURS,
) -> DataFrame:
    """The rows of ``kpi_report``: hours that lie whole in the period come from ``states``, its two ends from ``logs``.

    ``states`` hold the counts of every folder of ``logs`` that the report reads. The period is closed and cut to
    seconds, so one end is never empty: at a full hour it is one second long.
    """
    if as_of.tzinfo is not None:
        as_of = as_of.astimezone(timezone.utc).replace(tzinfo=None)
    first, end = bounds_ms(as_of, hours)
    whole, rest = -(-first // HOUR_MS) * HOUR_MS, end - end % HOUR_MS
    if whole >= rest:
        return report_of(per_action_and_rule(between(logs, first, end, delay_hours)), top)
    stored = states.filter(F.col("hour_ms").between(whole, rest - HOUR_MS) & delivered_on(whole, rest, delay_hours))
    parts = stored.select("action", "terminatingruleid", "n")
    for low, high in ((first, whole), (rest, end)):
        if low < high:
            parts = parts.unionByName(per_action_and_rule(between(logs, low, high, delay_hours)))
    counts = parts.groupBy("action", "terminatingruleid").agg(F.sum("n").alias("n"))
    return report_of(counts, top)
