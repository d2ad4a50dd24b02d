"""Registered queries, each over the whole ``events`` table of a data folder.

Every query takes (spark, sf_dir). Timestamps leave as epoch milliseconds and arrays are exploded,
so that results compare as plain values.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ramparts.operators import decision, detection, governance, indicators, kpi, kpi_states, lists, nested, rate, scorecard, series
from ramparts.operators.requests import as_requests, header_value
from ramparts.session import scratch_path
from ramparts.sources import derived, reference_sets
from ramparts.sources.logs import compact_logs, parse_lines, read_compacted, read_logs, retain, with_hour_partition, write_logs
from ramparts.sources.retention import expire
from ramparts.sources.schema import CORRUPT, PARTITIONS
from ramparts.streaming import drained, ingest, line_stream, rocksdb, stream_rate_limit, stream_request_rates

BLOCKED_RANGES = ["10.0.0.0/28", "10.0.0.77/32", "10.0.1.0/24"]
URI_PATTERNS = ["etc/passwd", "user/login", "Admin/Backdoor"]
RETAINED_DAYS = 7
# Lines in a landed file, at most.
LANDED_LINES = 50_000
# Stands for the last event time where there are no events.
NO_EVENT = datetime(2020, 1, 2)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def registered(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[query.__name__] = query
    return query


def _logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.decision_log(derived.events(spark, sf_dir))


def _requests(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    return as_requests(_logs(spark, sf_dir), *keep)


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = derived.test_results(derived.events(spark, sf_dir))
    return scorecard.score_results(reference_sets.request_cases(spark), results)


def _latest(rows: DataFrame) -> datetime:
    """The table's last event time, or that of no table. Known before the report is planned, so that it prunes the scan."""
    return rows.agg(F.max("ts")).first()[0] or NO_EVENT


def _trailing_day(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, datetime]:
    """Logged rows that can fall in the last day, and the last event time.

    The bound on the stored time column, a second wider than the report's own,
    lets the scan skip row groups.
    """
    rows = derived.events(spark, sf_dir)
    as_of = _latest(rows)
    recent = rows.filter(F.col("ts") >= F.lit(as_of - timedelta(days=1, seconds=1)).cast("timestamp_ntz"))
    return governance.filter_logged(derived.decision_log(recent)), as_of


def _in_ms(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        {"window_start": F.unix_millis("window_start"), "window_end": F.unix_millis("window_end")}
    )


# --- sources and sinks -------------------------------------------------------------------


@registered
def log_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the log as hourly gzip JSON, read ten days of it back with fields out of the request."""
    rows = derived.events(spark, sf_dir)
    root = scratch_path(spark, "log")
    write_logs(derived.decision_log(derived.in_time_order(rows)), root, in_time_order=True)
    first = rows.agg(F.min("ts")).first()[0] or NO_EVENT
    logs = read_logs(spark, root, first + timedelta(days=3), first + timedelta(days=12))
    return as_requests(logs, "action", "terminatingruleid", *PARTITIONS).select(
        "request_id",
        "ts_ms",
        "clientip",
        "country",
        "method",
        "uri",
        "args",
        header_value(F.col("headers"), "user-agent").alias("user_agent"),
        "action",
        "terminatingruleid",
        *PARTITIONS,
    )


@registered
def error_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines parsed under the declared schema, with broken ones told apart."""
    parsed = parse_lines(derived.log_lines(derived.events(spark, sf_dir)))
    destination = F.when(F.col(CORRUPT).isNull(), F.lit("logs")).otherwise(F.lit("errors"))
    return (
        parsed.groupBy(destination.alias("destination"), "action")
        .agg(F.count(F.lit(1)).alias("lines"), F.max(F.length(CORRUPT)).alias("longest_error"))
    )


@registered
def whole_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines in both spellings of the keys, some cut short, counted by what different scans of them read."""
    rows = derived.events(spark, sf_dir)
    root = scratch_path(spark, "lines")
    lines = derived.spelled_lines(rows)
    lines.write.partitionBy(*PARTITIONS).option("compression", "gzip").text(root)
    logs = read_logs(spark, root, with_corrupt=True)
    good = read_logs(spark, root)
    counts = {
        "nothing": good.select(F.lit(None).cast("string").alias("value")),
        "action": good.select(F.col("action").alias("value")),
        "client": good.select(F.col("httprequest.clientip").alias("value")),
        "errors": logs.filter(F.col(CORRUPT).isNotNull()).select(F.length(CORRUPT).cast("string").alias("value")),
    }
    counted = [
        rows.groupBy("value").agg(F.count(F.lit(1)).alias("lines")).select(F.lit(name).alias("read"), "value", "lines")
        for name, rows in counts.items()
    ]
    return reduce(DataFrame.unionByName, counted)


@registered
def retained_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = derived.events(spark, sf_dir)
    kept = retain(derived.decision_log(rows), _latest(rows), RETAINED_DAYS)
    return kept.groupBy(*PARTITIONS).agg(F.count(F.lit(1)).alias("requests"))


@registered
def expired_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a stored columnar log has left, by partition, after its expired folders were removed."""
    rows = derived.events(spark, sf_dir)
    root = scratch_path(spark, "expiring")
    compact_logs(derived.decision_log(derived.in_time_order(rows)), root)
    expire(spark, root, _latest(rows), RETAINED_DAYS)
    return read_compacted(spark, root).groupBy(*PARTITIONS).agg(F.count(F.lit(1)).alias("requests"))


@registered
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land lines as text, ingest them as a stream, read back what was stored and what was refused."""
    work = scratch_path(spark, "ingest")
    lines = derived.log_lines(derived.events(spark, sf_dir))
    # Compressed files are read whole by one task each, so they are kept small however many rows a task derives.
    lines.write.option("compression", "gzip").option("maxRecordsPerFile", str(LANDED_LINES)).text(f"{work}/landing")
    query = ingest(
        line_stream(spark, f"{work}/landing"), f"{work}/log", f"{work}/errors", f"{work}/state", {"availableNow": True}
    )
    query.awaitTermination()
    stored = as_requests(read_logs(spark, f"{work}/log"), "action", "year", "month", "day").select(
        F.lit("logs").alias("destination"),
        F.concat_ws("-", "year", "month", "day").alias("day"),
        "action",
        header_value(F.col("headers"), "cookie").alias("cookie"),
    )
    refused = spark.read.schema("value string").text(f"{work}/errors/*").select(
        F.lit("errors").alias("destination"),
        F.lit(None).cast("string").alias("day"),
        F.lit(None).cast("string").alias("action"),
        F.lit(None).cast("string").alias("cookie"),
    )
    return (
        stored.unionByName(refused)
        .groupBy("destination", "day", "action", "cookie")
        .agg(F.count(F.lit(1)).alias("lines"))
    )


# --- block KPIs --------------------------------------------------------------------------


@registered
def kpi_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi.kpi_report(*_trailing_day(spark, sf_dir))


@registered
def kpi_by_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report over a log whose folders are those of the delivery, up to an hour and a half after the event."""
    logs, as_of = _trailing_day(spark, sf_dir)
    delivered = F.timestamp_millis(F.col("ts_ms") + F.pmod("ts_ms", F.lit(90)) * 60_000)
    return kpi.kpi_report(with_hour_partition(logs, delivered), as_of)


@registered
def kpi_from_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report from stored counts per delivered hour of the whole log; the last half day is counted a second time, as
    after late deliveries. Only the ends of the period are read from the log."""
    rows = derived.events(spark, sf_dir)
    as_of, path = _latest(rows), scratch_path(spark, "kpi-states")
    delivered = F.timestamp_millis(F.col("ts_ms") + F.pmod("ts_ms", F.lit(90)) * 60_000)
    logs = with_hour_partition(governance.filter_logged(derived.decision_log(rows)), delivered)
    counted = kpi_states.hourly_states(logs)
    kpi_states.write_hourly_states(counted, path)
    half = (as_of - timedelta(hours=12)).strftime("%Y-%m-%d-%H")
    kpi_states.write_hourly_states(counted.filter(F.concat_ws("-", *PARTITIONS) >= half), path)
    return kpi_states.kpi_report_from_states(kpi_states.read_hourly_states(spark, path), logs, as_of)


@registered
def core_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi.core_metrics(*_trailing_day(spark, sf_dir))


@registered
def top_attack_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi.top_attack_vectors(*_trailing_day(spark, sf_dir))


@registered
def attack_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every blocking rule id with its label over the whole log."""
    blocked = _logs(spark, sf_dir).filter(F.col("action") == "BLOCK")
    counts = blocked.groupBy("terminatingruleid").agg(F.count(F.lit(1)).alias("blocks"))
    return counts.select("terminatingruleid", kpi.attack_label(F.col("terminatingruleid")).alias("label"), "blocks")


# --- detection ---------------------------------------------------------------------------


@registered
def rule_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = detection.rule_flags(_requests(spark, sf_dir))
    return flagged.select("request_id", *detection.SIGNATURE_RULES)


@registered
def rule_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Emergency, signature, rate, country and address rules together; the rate limit is lowered to fit the data.

    Emergency rules are those that the last day's feed has for single addresses.
    """
    requests = _requests(spark, sf_dir)
    flags = rate.with_rate_flag(detection.rule_flags(requests), limit=6, window_ms=86_400_000)
    flags = lists.with_ip_set_flag(flags, reference_sets.blocked_ranges(spark, BLOCKED_RANGES), "IPReputationRule")
    outside = lists.outside_countries(reference_sets.allowed_countries(spark))
    rows = derived.events(spark, sf_dir)
    recent = rows.filter(F.col("ts") >= F.lit(_latest(rows) - timedelta(days=1)).cast("timestamp_ntz"))
    feed = derived.indicator_feed(recent).filter(F.col("ip").endswith("/32") | ~F.col("ip").contains("/"))
    rules = decision.with_emergency_rules(reference_sets.rule_list(spark, emergency=()), feed, order="seq")
    decided = decision.rule_decision(flags.withColumn("GeoRestrictionRule", outside), rules)
    return decided.select("request_id", "terminatingruleid", "action")


@registered
def emergency_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The emergency rule that decides each request, by the whole feed, ranges and paths."""
    none = reference_sets.rule_list(spark, emergency=()).limit(0)
    feed = derived.indicator_feed(derived.events(spark, sf_dir))
    hits = decision.rule_hits(_requests(spark, sf_dir), decision.with_emergency_rules(none, feed, order="seq"))
    return hits.select("request_id", F.col("_hit.name").alias("rule"), F.col("_hit.priority").alias("priority"))


@registered
def ip_set_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = lists.ip_set_hits(_requests(spark, sf_dir), reference_sets.blocked_ranges(spark, BLOCKED_RANGES))
    return hits.select("request_id", "clientip")


@registered
def geo_blocked(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = lists.geo_blocked(_requests(spark, sf_dir), reference_sets.allowed_countries(spark))
    return hits.select("request_id", "country")


@registered
def uri_pattern_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lists.uri_pattern_hits(_requests(spark, sf_dir), reference_sets.uri_patterns(spark, URI_PATTERNS))


@registered
def rate_limit_breaches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """More than one request in five minutes."""
    hits = rate.rate_limit_breaches(_requests(spark, sf_dir), limit=1)
    return hits.select("request_id", "clientip", "ts_ms", "window_count")


@registered
def rate_limit_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """More than six requests in a day."""
    hits = rate.rate_limit_breaches(_requests(spark, sf_dir), limit=6, window_ms=86_400_000)
    return hits.select("request_id", "clientip", "ts_ms", "window_count")


@registered
def overridden_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    matches = detection.override_actions(nested.rule_group_matches(_logs(spark, sf_dir)))
    return matches.groupBy("rulegroupid", "ruleid", "action").agg(F.count(F.lit(1)).alias("matches"))


# --- governance --------------------------------------------------------------------------


@registered
def log_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = governance.filter_logged(_logs(spark, sf_dir))
    return kept.select(F.col("httprequest.requestid").alias("request_id"), "action")


@registered
def redacted_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = governance.redact(_logs(spark, sf_dir))
    headers = logs.select(
        F.col("httprequest.requestid").alias("request_id"), F.inline("httprequest.headers").alias("name", "value")
    )
    return headers


# --- series ------------------------------------------------------------------------------


@registered
def traffic_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _in_ms(series.traffic_overview(_logs(spark, sf_dir)))


@registered
def blocked_by_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _in_ms(series.blocked_by_rule(_logs(spark, sf_dir)))


@registered
def acl_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily series per web ACL and rule with their totals, from hourly counts that are stored and read back."""
    path = scratch_path(spark, "hourly")
    counts = series.period_counts(_logs(spark, sf_dir))
    series.write_period_counts(counts, path)
    return _in_ms(series.acl_series(spark.read.schema(counts.schema).parquet(path)))


@registered
def stream_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The traffic series as a stream, windows that are open when the input ends included."""
    stream = series.traffic_overview(derived.decision_log(derived.events_stream(spark, sf_dir)))
    work = scratch_path(spark, "overview")
    return _in_ms(drained(stream, f"{work}/out", f"{work}/state"))


@registered
def stream_blocked_by_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = series.blocked_by_rule(derived.decision_log(derived.events_stream(spark, sf_dir)))
    work = scratch_path(spark, "by-rule")
    return _in_ms(drained(stream, f"{work}/out", f"{work}/state"))


@registered
def stream_rate_breaches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clients with more than one request in a five-minute window moving by 30 seconds, as a stream."""
    requests = as_requests(derived.decision_log(derived.events_stream(spark, sf_dir)))
    work = scratch_path(spark, "rate")
    return _in_ms(drained(stream_rate_limit(requests, limit=1), f"{work}/out", f"{work}/state"))


@registered
def stream_request_breaches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests that are more than the first of their client in five minutes, by a stream's verdict on each."""
    stream = as_requests(derived.decision_log(derived.events_stream(spark, sf_dir)))
    work = scratch_path(spark, "requests")
    with rocksdb(spark):
        rates = drained(stream_request_rates(stream), f"{work}/out", f"{work}/state")
    counted = _requests(spark, sf_dir).filter(rate.is_counted()).select("request_id", "clientip", "ts_ms")
    return counted.join(rates.filter("window_count > 1"), ["clientip", "ts_ms"])


# --- scorecard ---------------------------------------------------------------------------


@registered
def score_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results per run, test and verdict, absent tests included."""
    return (
        _scored(spark, sf_dir)
        .groupBy("run_ts", "test_name", "description", "expected_status", "actual_status", "passed", "blocked_by_waf", "error")
        .agg(F.count(F.lit(1)).alias("results"))
    )


@registered
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scorecard.run_summary(_scored(spark, sf_dir))


@registered
def category_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scorecard.category_summary(_scored(spark, sf_dir))


@registered
def missed_attacks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        scorecard.missed_attacks(_scored(spark, sf_dir))
        .groupBy("run_ts", "test_name", "outcome")
        .agg(F.count(F.lit(1)).alias("results"))
    )


@registered
def rate_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scorecard.rate_probe(derived.test_results(derived.events(spark, sf_dir)))


@registered
def run_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scorecard.run_severity(_scored(spark, sf_dir))


@registered
def suite_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suite documents taken apart again: their results per run and test."""
    documents = scorecard.suite_documents(_scored(spark, sf_dir))
    tests = documents.select("url", "timestamp", "total_tests", "passed_tests", F.explode("tests").alias("t"))
    totals = ["url", "timestamp", "total_tests", "passed_tests"]
    return tests.groupBy(*totals, F.col("t.test_name").alias("test_name")).agg(
        F.count(F.lit(1)).alias("results"), F.count_if("t.passed").alias("passed")
    )


@registered
def suite_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suite documents written as JSON, one line a run, and read back: results per description and verdict."""
    path = scratch_path(spark, "suites")
    scored = _scored(spark, sf_dir)
    scorecard.write_suites(scored, path)
    documents = spark.read.schema(scorecard.suite_documents(scored).schema).json(path)
    tests = documents.select("url", F.explode("tests").alias("t"))
    return tests.groupBy("url", "t.test_name", "t.description", "t.passed", "t.error", "t.blocked_by_waf").agg(
        F.count(F.lit(1)).alias("results"), F.count("t.response_time").alias("timed")
    )


# --- indicators --------------------------------------------------------------------------


@registered
def indicator_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = derived.indicator_feed(derived.events(spark, sf_dir))
    return indicators.validate_indicators(feed).select("seq", "name", "ip", "uri_pattern", "valid", "reason", "cidr")


@registered
def merged_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = derived.indicator_feed(derived.events(spark, sf_dir))
    valid = indicators.validate_indicators(feed).filter("valid").select("seq", "name", "cidr", "uri_pattern")
    existing = reference_sets.rule_list(spark).select(
        "name", F.lit(None).cast("string").alias("cidr"), F.lit(None).cast("string").alias("uri_pattern")
    )
    return indicators.merge_indicators(valid, existing, order="seq")


@registered
def feed_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests per client inside the validated feed's ranges, with the narrowest range that holds the client."""
    feed = derived.indicator_feed(derived.events(spark, sf_dir))
    cidrs = indicators.validate_indicators(feed).filter("valid").select("cidr")
    hits = lists.narrowest_range(_requests(spark, sf_dir), cidrs)
    return hits.groupBy("clientip", "prefix_length").agg(F.count(F.lit(1)).alias("requests"))


@registered
def emergency_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detection.emergency_blocks(_logs(spark, sf_dir), reference_sets.rule_list(spark))


@registered
def acl_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        indicators.acl_scope(_logs(spark, sf_dir))
        .groupBy("scope", "acl_name", "acl_id")
        .agg(F.count(F.lit(1)).alias("requests"))
    )


# --- nested columns ----------------------------------------------------------------------


@registered
def count_matches_by_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.count_matches_by_rule(_logs(spark, sf_dir))


@registered
def rule_group_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.rule_group_matches(_logs(spark, sf_dir))


@registered
def matched_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.matched_data(_logs(spark, sf_dir))


@registered
def excluded_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.excluded_rules(_logs(spark, sf_dir))


@registered
def rate_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.rate_rules(_logs(spark, sf_dir))


@registered
def label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.label_counts(_logs(spark, sf_dir))
