"""Five-minute traffic series, for a table or a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ramparts.functions.acl import acl_part

PERIOD = "5 minutes"
# How late a streamed event may come and still be counted.
LATENESS = "10 minutes"

# The rules that have a series of their own.
CHARTED_RULES = (
    "JuiceShopSQLiRule",
    "RateLimitRule",
    "AWSManagedRulesCommonRuleSet",
    "AWSManagedRulesSQLiRuleSet",
)


def timed(logs: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Add event time ``ts``, watermarked when ``logs`` is a stream."""
    with_time = logs.withColumn("ts", F.timestamp_millis("ts_ms"))
    return with_time.withWatermark("ts", lateness) if logs.isStreaming else with_time


def _bounds(series: DataFrame, *columns: str) -> DataFrame:
    return series.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *columns
    )


def traffic_overview(requests: DataFrame, period: str = PERIOD, lateness: str = LATENESS) -> DataFrame:
    """Allowed and blocked requests per period. Take the log before ALLOW rows are dropped."""
    series = (
        timed(requests, lateness)
        .groupBy(F.window("ts", period))
        .agg(
            F.count_if(F.col("action") == "ALLOW").alias("allowed_requests"),
            F.count_if(F.col("action") == "BLOCK").alias("blocked_requests"),
        )
    )
    return _bounds(series, "allowed_requests", "blocked_requests")


def blocked_by_rule(
    logs: DataFrame, rules: Sequence[str] = CHARTED_RULES, period: str = PERIOD, lateness: str = LATENESS
) -> DataFrame:
    """Blocked requests per period, one column per rule; periods without any are left out."""
    blocked = logs.filter((F.col("action") == "BLOCK") & F.col("terminatingruleid").isin(*rules))
    series = (
        timed(blocked, lateness)
        .groupBy(F.window("ts", period))
        .agg(*[F.count_if(F.col("terminatingruleid") == rule).alias(rule) for rule in rules])
    )
    return _bounds(series, *[f"`{rule}`" for rule in rules])


def period_counts(logs: DataFrame, period: str = "1 hour") -> DataFrame:
    """(period_start, acl_name, ruleid, allowed_requests, blocked_requests): what longer series are added up from.

    One aggregate over the log. Rows of one key can be added, so series per web ACL, per rule and in total, of any
    longer period, come from these rows and never from the log again.
    """
    named = timed(logs).withColumn("acl_name", acl_part(F.col("webaclid"), 2))
    counts = named.groupBy(F.window("ts", period).alias("w"), "acl_name", F.col("terminatingruleid").alias("ruleid"))
    counted = counts.agg(
        F.count_if(F.col("action") == "ALLOW").alias("allowed_requests"),
        F.count_if(F.col("action") == "BLOCK").alias("blocked_requests"),
    )
    return counted.select(F.col("w.start").alias("period_start"), "acl_name", "ruleid", "allowed_requests", "blocked_requests")


def write_period_counts(counts: DataFrame, path: str) -> None:
    """Keep the counts by day. Counts of a day replace those that stand there, so a day that got late deliveries is
    counted again by itself, and a run that was cut short is repeated."""
    dated = counts.withColumn("day", F.date_format("period_start", "yyyy-MM-dd"))
    writer = dated.hint("rebalance", "day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("day").parquet(path)


def acl_series(counts: DataFrame, period: str = "1 day") -> DataFrame:
    """Series per web ACL and rule, per web ACL, per rule and in total, from one pass over ``period_counts``.

    ``all_acls`` and ``all_rules`` tell rows that add up over these from rows whose web ACL or rule is unknown (NULL).
    """
    rows = counts.select(F.window("period_start", period).alias("window"), *[c for c in counts.columns if c != "period_start"])
    sets = [["window", "acl_name", "ruleid"], ["window", "acl_name"], ["window", "ruleid"], ["window"]]
    summed = rows.groupingSets(sets, "window", "acl_name", "ruleid").agg(
        (F.grouping("acl_name") == 1).alias("all_acls"),
        (F.grouping("ruleid") == 1).alias("all_rules"),
        F.sum("allowed_requests").alias("allowed_requests"),
        F.sum("blocked_requests").alias("blocked_requests"),
    )
    return _bounds(summed, "acl_name", "ruleid", "all_acls", "all_rules", "allowed_requests", "blocked_requests")
