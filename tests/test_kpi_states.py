"""Reports from stored counts against the report that reads the whole period from the log."""

from datetime import datetime, timedelta
from itertools import count

import pytest
from pyspark.sql import functions as F
from samples import log_rows

from ramparts import (
    hourly_states,
    kpi_report,
    kpi_report_from_states,
    read_hourly_states,
    refresh_hourly_states,
    write_hourly_states,
    write_logs,
)
from ramparts.sources.logs import with_hour_partition

NOON = datetime(2024, 1, 5, 12)
NOON_MS, HOUR = 1_704_456_000_000, 3_600_000


@pytest.fixture(scope="module")
def logs(spark):
    """Events around every border of the periods below, delivered up to 20 hours later; some without action or rule."""
    at, number = [], count()
    for hour in range(-30, 3):
        at += [NOON_MS + hour * HOUR + ms for ms in (-1, 0, 499, 500, 999, 1000, 1_800_000, 1_800_999, 1_801_000)]
    entries = [
        {"ts_ms": ts, "action": (None, "BLOCK", "COUNT", "BLOCK", "BLOCK")[n % 5], "terminatingruleid": (None, *"abcdef")[n % 7]}
        for ts, n in zip(at, number)
    ]
    delivered = F.timestamp_millis(F.col("ts_ms") + F.pmod("ts_ms", F.lit(20)) * HOUR)
    return with_hour_partition(log_rows(spark, *entries, {"ts_ms": None, "action": "BLOCK", "terminatingruleid": "z"}), delivered)


@pytest.fixture(scope="module")
def states(spark, logs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("states") / "hours")
    write_hourly_states(hourly_states(logs.filter("hour is not null")), path)
    return read_hourly_states(spark, path)


@pytest.mark.parametrize("hours", [24, 1, 2])
@pytest.mark.parametrize("later", [0, 500_000, 999_999, 1_000_000, 1_800_000_000, 3_599_999_999])
def test_report_is_that_of_the_log(logs, states, hours, later):
    as_of = NOON + timedelta(microseconds=later)
    found = kpi_report_from_states(states, logs, as_of, hours, top=4).collect()
    assert found == kpi_report(logs, as_of, hours, top=4).collect()
    assert found[0].total_requests > 0


def test_whole_hours_do_not_come_from_the_log(logs, states):
    inside = (F.col("ts_ms") >= NOON_MS - 23 * HOUR) & (F.col("ts_ms") < NOON_MS)
    as_of = NOON + timedelta(minutes=30)
    without = kpi_report_from_states(states, logs.filter(~inside), as_of).collect()
    assert without == kpi_report(logs, as_of).collect() != kpi_report(logs.filter(~inside), as_of).collect()


def test_late_deliveries_change_their_hours_alone(spark, tmp_path):
    root, path = str(tmp_path / "log"), str(tmp_path / "states")
    first = [{"ts_ms": NOON_MS - n * HOUR, "action": "BLOCK", "terminatingruleid": "a"} for n in range(1, 6)]
    write_logs(log_rows(spark, *first), root)
    refresh_hourly_states(spark, root, path, NOON - timedelta(hours=6), NOON)
    names = set(read_hourly_states(spark, path).inputFiles())
    assert len(names) == 5
    late = log_rows(spark, {"ts_ms": NOON_MS - 2 * HOUR, "action": "BLOCK", "terminatingruleid": "b"})
    write_logs(with_hour_partition(late, F.lit(NOON - timedelta(hours=1)).cast("timestamp")), root)
    for _ in range(2):
        refresh_hourly_states(spark, root, path, NOON - timedelta(hours=1), NOON - timedelta(hours=1))
    assert len(names - set(read_hourly_states(spark, path).inputFiles())) == 1
    rows = read_hourly_states(spark, path).filter("hour = '11'").collect()
    assert {(r.hour_ms, r.terminatingruleid, r.n) for r in rows} == {(NOON_MS - HOUR, "a", 1), (NOON_MS - 2 * HOUR, "b", 1)}


def test_without_rows(spark, logs, tmp_path):
    none, path = logs.limit(0), str(tmp_path / "none")
    write_hourly_states(hourly_states(none), path)
    report = kpi_report_from_states(read_hourly_states(spark, path), none, NOON).collect()
    assert report == kpi_report(none, NOON).collect() and len(report) == 1
