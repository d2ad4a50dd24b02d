"""Block KPIs over a trailing period: core counts and the top attack vectors."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, functions as F

from ramparts.functions.rounding import rate_half_up

# Labels in the order they are tried, as (how, text, label).
ATTACK_LABELS = [
    ("is", "JuiceShopSQLiRule", "SQL Injection (Juice Shop)"),
    ("has", "SQLi", "SQL Injection (AWS Managed)"),
    ("has", "XSS", "Cross-Site Scripting"),
    ("is", "RateLimitRule", "Rate Limiting"),
    ("is", "GeoRestrictionRule", "Geographic Restriction"),
    ("is", "IPReputationRule", "IP Reputation Block"),
    ("has", "Common", "Common Attack Patterns"),
    ("has", "Emergency", "Emergency Block Rule"),
]
UNKNOWN_LABEL = "Unknown"
CORE, VECTORS, CORE_NAME = "CORE_METRICS", "TOP_ATTACK_VECTORS", "logged_counts"

REPORT = ["metric_type", "total_requests", "blocked_requests", "percent_blocked", "rule_name", "rule_block_count"]


def attack_label(rule_id: Column) -> Column:
    """Label of a rule id; an id without label stands for itself, NULL is Unknown."""
    first, *others = [
        (rule_id == text if how == "is" else rule_id.contains(text), F.lit(label)) for how, text, label in ATTACK_LABELS
    ]
    label = F.when(*first)
    for condition, value in others:
        label = label.when(condition, value)
    return F.coalesce(label.otherwise(rule_id), F.lit(UNKNOWN_LABEL))


def _is(action: str) -> Column:
    return F.col("action") == action


# How long after its event a record may be delivered.
DELIVERY_DELAY_HOURS = 24
EPOCH = datetime(1970, 1, 1)


def trailing(
    logs: DataFrame, as_of: datetime | Column, hours: int = 24, delay_hours: int = DELIVERY_DELAY_HOURS
) -> DataFrame:
    """Rows whose event time, cut to seconds, lies in [as_of - hours, as_of].

    ``as_of`` is a UTC datetime or a timestamp Column such as ``current_timestamp()``. The
    delivery dates and the raw millisecond bounds are added as plain comparisons, so that
    partitions and row groups outside are never read. A record may stand in the folder of a later day, as it is dated
    by its delivery: folders up to ``delay_hours`` after ``as_of`` are read.
    """
    partitioned = {"year", "month", "day"} <= set(logs.columns)
    if isinstance(as_of, Column):
        start = as_of - F.make_dt_interval(hours=F.lit(hours))
        second = F.timestamp_seconds(F.expr("ts_ms div 1000"))
        # Implied by the exact test below, and in a form that reaches the scan.
        near = (F.col("ts_ms") >= F.unix_millis(start)) & (F.col("ts_ms") < F.unix_millis(as_of) + 1000)
        if partitioned:
            day = F.concat_ws("-", "year", "month", "day")
            delivered = as_of + F.make_dt_interval(hours=F.lit(delay_hours))
            near &= day.between(F.date_format(start, "yyyy-MM-dd"), F.date_format(delivered, "yyyy-MM-dd"))
        return logs.filter(near & second.between(start, as_of))
    if as_of.tzinfo is not None:
        as_of = as_of.astimezone(timezone.utc).replace(tzinfo=None)
    return between(logs, *bounds_ms(as_of, hours), delay_hours)


def bounds_ms(as_of: datetime, hours: int) -> tuple[int, int]:
    """First millisecond of [as_of - hours, as_of] at whole seconds, and the one after its last. UTC."""
    start = as_of - timedelta(hours=hours)
    low, high = (int((moment - EPOCH) / timedelta(microseconds=1)) for moment in (start, as_of))
    # second >= low and second <= high, both in microseconds, said of the raw column
    return -(-low // 1_000_000) * 1000, (high // 1_000_000 + 1) * 1000


def delivered_on(first_ms: int, end_ms: int, delay_hours: int) -> Column:
    """Whether a folder's day can hold events of these milliseconds, as comparisons that prune."""
    first = (EPOCH + timedelta(milliseconds=first_ms)).date()
    last = (EPOCH + timedelta(milliseconds=end_ms - 1, hours=delay_hours)).date()
    on_days = F.lit(False)
    for n in range((last - first).days + 1):
        day = first + timedelta(n)
        on_days = on_days | (
            (F.col("year") == day.strftime("%Y"))
            & (F.col("month") == day.strftime("%m"))
            & (F.col("day") == day.strftime("%d"))
        )
    return on_days


def between(logs: DataFrame, first_ms: int, end_ms: int, delay_hours: int = DELIVERY_DELAY_HOURS) -> DataFrame:
    """Rows of first_ms <= ts_ms < end_ms, delivered up to ``delay_hours`` later."""
    kept = logs.filter((F.col("ts_ms") >= first_ms) & (F.col("ts_ms") < end_ms))
    partitioned = {"year", "month", "day"} <= set(logs.columns)
    return kept.filter(delivered_on(first_ms, end_ms, delay_hours)) if partitioned else kept


def per_action_and_rule(logs: DataFrame) -> DataFrame:
    """The one pass over the log. Its small shuffle is reused by every branch of the report."""
    return logs.groupBy("action", "terminatingruleid").agg(F.count(F.lit(1)).alias("n"))


def _core(counts: DataFrame) -> DataFrame:
    sums = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_requests"),
        F.sum(F.when(_is("BLOCK"), F.col("n")).otherwise(0)).alias("blocked_requests"),
        F.sum(F.when(_is("COUNT"), F.col("n")).otherwise(0)).alias("counted_requests"),
    )
    return sums.withColumn("percent_blocked", rate_half_up(F.col("blocked_requests"), F.col("total_requests"), 2))


def _vectors(counts: DataFrame, top: int) -> DataFrame:
    # Blocks are summed conditionally rather than filtered: a filter would be pushed below
    # the shared aggregate and cost a second scan.
    blocks = F.sum(F.when(_is("BLOCK"), F.col("n"))).alias("rule_block_count")
    return (
        counts.groupBy("terminatingruleid")
        .agg(blocks)
        .filter(F.col("rule_block_count").isNotNull())
        .orderBy(F.desc("rule_block_count"), F.asc("terminatingruleid"))
        .limit(top)
        .select(attack_label(F.col("terminatingruleid")).alias("rule_name"), "rule_block_count")
    )


def core_metrics(logs: DataFrame, as_of: datetime | Column, hours: int = 24) -> DataFrame:
    """One row: total, blocked, counted, percent blocked. All but the total are NULL for no rows."""
    return _core(trailing(logs, as_of, hours).groupBy("action").agg(F.count(F.lit(1)).alias("n")))


def top_attack_vectors(logs: DataFrame, as_of: datetime | Column, hours: int = 24, top: int = 5) -> DataFrame:
    """Rules with the most blocks. Grouped by rule id, so two ids with one label stay two rows."""
    blocked = trailing(logs, as_of, hours).filter(_is("BLOCK"))
    return _vectors(per_action_and_rule(blocked), top)


def kpi_report(logs: DataFrame, as_of: datetime | Column, hours: int = 24, top: int = 5) -> DataFrame:
    """Core row first, then the top rules by block count."""
    return report_of(per_action_and_rule(trailing(logs, as_of, hours)), top)


def report_of(counts: DataFrame, top: int) -> DataFrame:
    """The report out of counts ``n`` by action and terminating rule."""
    zero = F.lit(0).cast("bigint")
    core = _core(counts).select(
        F.lit(CORE).alias("metric_type"),
        "total_requests",
        "blocked_requests",
        "percent_blocked",
        F.lit(CORE_NAME).alias("rule_name"),
        F.col("counted_requests").alias("rule_block_count"),
        F.lit(0).alias("sort_key"),
        zero.alias("sort_score"),
    )
    vectors = _vectors(counts, top).select(
        F.lit(VECTORS).alias("metric_type"),
        zero.alias("total_requests"),
        zero.alias("blocked_requests"),
        F.lit(0.0).alias("percent_blocked"),
        "rule_name",
        "rule_block_count",
        F.lit(1).alias("sort_key"),
        F.col("rule_block_count").alias("sort_score"),
    )
    report = core.unionByName(vectors).orderBy(F.asc("sort_key"), F.desc("sort_score"))
    return report.select(*REPORT)
