from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F
from samples import log_rows

from ramparts import core_metrics, kpi_report, top_attack_vectors
from ramparts.operators.kpi import attack_label, trailing
from ramparts.sources.logs import with_hour_partition

AS_OF = datetime(2024, 1, 5, 12, 0, 0, 500_000)
NOW_MS = 1_704_456_000_500  # AS_OF
DAY_MS = 86_400_000


def log(spark, *entries):
    return log_rows(
        spark, *({"ts_ms": ts, "action": action, "terminatingruleid": rule} for ts, action, rule in entries)
    )


def test_window_is_closed_and_cut_to_seconds(spark):
    stamps = [
        NOW_MS - DAY_MS,  # second 43200 lies before 43200.5
        NOW_MS - DAY_MS + 500,  # next second, inside
        NOW_MS - DAY_MS + 499,
        NOW_MS + 499,  # same second as as_of, inside though after it
        NOW_MS + 500,  # next second
    ]
    logs = log(spark, *((ts, "BLOCK", "r") for ts in stamps))
    kept = {row.ts_ms for row in trailing(logs, AS_OF).collect()}
    assert kept == {NOW_MS - DAY_MS + 500, NOW_MS + 499}
    as_column = F.lit(AS_OF.replace(tzinfo=timezone.utc)).cast("timestamp")
    assert {row.ts_ms for row in trailing(logs, as_column).collect()} == kept
    assert {row.ts_ms for row in trailing(logs, AS_OF.replace(tzinfo=timezone.utc)).collect()} == kept


def test_partitions_prune_to_two_dates_and_agree(spark):
    stamps = range(NOW_MS - 3 * DAY_MS, NOW_MS + DAY_MS, 3_600_000)
    logs = log(spark, *((ts, "BLOCK", "r") for ts in stamps))
    as_column = F.lit(AS_OF.replace(tzinfo=timezone.utc)).cast("timestamp")
    for as_of in (AS_OF, as_column):
        assert trailing(with_hour_partition(logs), as_of).count() == trailing(logs, as_of).count() == 24


def test_report_as_of_now_reaches_the_scan(spark, tmp_path, plan):
    logs = with_hour_partition(log(spark, (NOW_MS, "BLOCK", "a")))
    path = str(tmp_path / "log")
    logs.write.partitionBy("year", "month", "day").parquet(path)
    report = core_metrics(spark.read.schema(logs.schema).parquet(path), F.current_timestamp())
    assert report.first().total_requests == 0
    text = plan(report)
    assert "GreaterThanOrEqual(ts_ms," in text and "(concat_ws(-, year#" in text.split("PartitionFilters: ")[1]


def test_labels(spark):
    expected = {
        "JuiceShopSQLiRule": "SQL Injection (Juice Shop)",
        "AWSManagedRulesSQLiRuleSet": "SQL Injection (AWS Managed)",
        "Emergency-URI-SQLi": "SQL Injection (AWS Managed)",
        "XSSRule": "Cross-Site Scripting",
        "RateLimitRule": "Rate Limiting",
        "GeoRestrictionRule": "Geographic Restriction",
        "IPReputationRule": "IP Reputation Block",
        "AWSManagedRulesCommonRuleSet": "Common Attack Patterns",
        "Emergency-IP-Block-1": "Emergency Block Rule",
        "PathTraversalRule": "PathTraversalRule",
        "sqlirule": "sqlirule",
        None: "Unknown",
    }
    frame = spark.createDataFrame([(rule,) for rule in expected], "rule string")
    assert [row[0] for row in frame.select(attack_label(F.col("rule"))).collect()] == list(expected.values())


def test_empty_log_gives_one_core_row(spark, rows):
    report = kpi_report(log(spark), AS_OF)
    assert rows(report) == [("CORE_METRICS", 0, None, None, "logged_counts", None)]
    assert rows(core_metrics(log(spark), AS_OF)) == [(0, None, None, None)]
    assert rows(top_attack_vectors(log(spark), AS_OF)) == []


def test_report(spark):
    entries = [(NOW_MS, "BLOCK", rule) for rule in "aabbbccdde"]  # ties between a, c, d at the border
    entries += [(NOW_MS, "BLOCK", None), (NOW_MS, "COUNT", "a"), (NOW_MS, None, "a"), (NOW_MS - 2 * DAY_MS, "BLOCK", "e")]
    report = [tuple(row) for row in kpi_report(log(spark, *entries), AS_OF, top=4).collect()]
    assert report[0] == ("CORE_METRICS", 13, 11, 84.62, "logged_counts", 1)
    assert [(row[4], row[5]) for row in report[1:]] == [("b", 3), ("a", 2), ("c", 2), ("d", 2)]
    assert all(row[:4] == ("TOP_ATTACK_VECTORS", 0, 0, 0.0) for row in report[1:])


def test_two_ids_of_one_label_stay_apart(spark):
    entries = [(NOW_MS, "BLOCK", "CustomSQLiRule"), (NOW_MS, "BLOCK", "OtherSQLiRule")]
    top = top_attack_vectors(log(spark, *entries), AS_OF).collect()
    assert [tuple(row) for row in top] == [("SQL Injection (AWS Managed)", 1)] * 2


@pytest.mark.parametrize("suffix", ["", "partitioned"])
def test_one_scan(spark, tmp_path, plan, suffix):
    logs = with_hour_partition(log(spark, (NOW_MS, "BLOCK", "a"), (NOW_MS, "COUNT", "b")))
    path = str(tmp_path / "log")
    logs.write.partitionBy("year", "month", "day").parquet(path)
    report = kpi_report(spark.read.schema(logs.schema).parquet(path), AS_OF)
    report.collect()
    text = plan(report).split("Initial Plan")[0]
    assert text.count("FileScan") == 1 and "ReusedExchange" in text
    assert "PushedFilters: [IsNotNull(ts_ms), GreaterThanOrEqual(ts_ms," in text
    assert "ReadSchema: struct<ts_ms:bigint,terminatingruleid:string,action:string>" in text
    assert "(year#" in text.split("PartitionFilters: ")[1].split("PushedFilters")[0]
