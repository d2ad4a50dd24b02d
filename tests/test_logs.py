import gzip
import json
import os
import shutil
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from samples import log_rows

from ramparts import (
    compact_logs,
    filter_logged,
    header_value,
    read_compacted,
    read_logs,
    redact,
    register_log_table,
    register_logs,
    retain,
    write_logs,
    write_retained,
)
from ramparts.sources.deliveries import published
from ramparts.sources.logs import parse_lines, with_hour_partition
from ramparts.sources.retention import expire, expired_folders
from ramparts.sources.schema import CONTRACT, WIRE
from ramparts.streaming.ingest import deliver

MATCH = {"ruleId": "r1", "action": "COUNT", "ruleMatchDetails": []}
DETAIL = {"conditionType": "XSS", "sensitivityLevel": "HIGH", "location": "URI", "matchedData": ["<", "script"]}
LINES = [
    {
        "timestamp": 1_704_423_600_000,
        "formatVersion": 1,
        "webaclId": "arn:aws:wafv2:us-east-1:1:regional/webacl/app/id",
        "terminatingRuleId": "AWSManagedRulesCommonRuleSet",
        "terminatingRuleType": "MANAGED_RULE_GROUP",
        "action": "BLOCK",
        "terminatingRuleMatchDetails": [DETAIL],
        "httpSourceName": "ALB",
        "httpSourceId": "id",
        "ruleGroupList": [
            {
                "ruleGroupId": "g1",
                "terminatingRule": {"ruleId": "x", "action": "BLOCK", "ruleMatchDetails": [DETAIL]},
                "nonTerminatingMatchingRules": [MATCH, {**MATCH, "ruleId": "r2"}],
                "excludedRules": None,
            },
            {"ruleGroupId": "g2", "terminatingRule": None, "nonTerminatingMatchingRules": []},
        ],
        "rateBasedRuleList": [{"rateBasedRuleId": "rb", "limitKey": "IP", "maxRateAllowed": 50}],
        "nonTerminatingMatchingRules": [],
        "httpRequest": {
            "clientIp": "192.0.2.44",
            "country": "US",
            "headers": [{"name": "Host", "value": "h"}, {"name": "X-Tag", "value": "1"}, {"name": "x-tag", "value": "2"}],
            "uri": "/a",
            "args": "q=1",
            "httpVersion": "HTTP/1.1",
            "httpMethod": "GET",
            "requestId": "full",
        },
        "labels": [{"name": "l1"}, {"name": "l2"}],
    },
    {"timestamp": 1_704_423_600_001, "action": "BLOCK"},
    {"timestamp": 1_704_423_600_002, "action": "ALLOW", "nonTerminatingMatchingRules": [MATCH]},
    {
        "timestamp": 1_704_423_600_003,
        "action": "COUNT",
        "httpRequest": {
            "requestId": "secret",
            "headers": [
                {"name": "Cookie", "value": "s"},
                {"name": "AUTHORIZATION", "value": "s"},
                {"name": "X-Api-Key", "value": "s"},
                {"name": "Host", "value": "s"},
            ],
        },
    },
]


@pytest.fixture
def delivered(tmp_path):
    """A bucket with one good hour, a broken line in it, and a folder for errors."""
    folder = tmp_path / "bucket" / "year=2024" / "month=01" / "day=05" / "hour=03"
    folder.mkdir(parents=True)
    with gzip.open(folder / "part.gz", "wt") as file:
        for line in LINES:
            file.write(json.dumps(line) + "\n")
        file.write('{"timestamp": 17\n')
    errors = tmp_path / "bucket" / "errors"
    errors.mkdir()
    (errors / "bad.json").write_text('{"timestamp": 1, "action": "BLOCK"}\n')
    return str(tmp_path / "bucket")


def test_scan_gives_the_contract(spark, delivered, rows):
    logs = read_logs(spark, delivered)
    assert logs.columns == [*CONTRACT.names, "year", "month", "day", "hour"]
    assert [f.dataType for f in logs.schema][: len(CONTRACT)] == [f.dataType for f in CONTRACT]
    assert rows(logs, "action", "ts_ms", "year", "month", "day", "hour")[0] == (
        "ALLOW", 1_704_423_600_002, "2024", "01", "05", "03",
    )
    assert logs.select("action").filter("action IS NOT NULL").count() == 4
    full = logs.filter("httprequest.requestid = 'full'").first()
    assert full.rulegrouplist[0].nonterminatingmatchingrules[1].ruleid == "r2"
    assert full.terminatingrulematchdetails[0].matcheddata == ["<", "script"]
    assert full.ratebasedrulelist[0].maxrateallowed == 50 and full.labels[1].name == "l2"


def test_broken_lines(spark, delivered):
    assert read_logs(spark, delivered).filter("ts_ms IS NOT NULL").count() == 4
    assert len(read_logs(spark, delivered).select("ts_ms", "action").collect()) == 4
    assert read_logs(spark, delivered).count() == 4
    broken = read_logs(spark, delivered, with_corrupt=True).filter("_corrupt_record IS NOT NULL").select("ts_ms", "_corrupt_record")
    assert [tuple(row) for row in broken.collect()] == [(None, '{"timestamp": 17')]


def test_a_line_is_judged_as_a_whole(spark, tmp_path, rows):
    """Which lines are rows does not depend on the columns read; the spelling of the keys makes no difference."""
    folder = tmp_path / "year=2024" / "month=01" / "day=05" / "hour=03"
    folder.mkdir(parents=True)
    lower = {"timestamp": 2, "action": "BLOCK", "terminatingruleid": "r", "rulegrouplist": [{"rulegroupid": "g"}],
             "httprequest": {"clientip": "10.0.0.2", "headers": [{"name": "n", "value": "v"}]}}
    camel = {"timestamp": 1, "action": "BLOCK", "terminatingRuleId": "r", "ruleGroupList": [{"ruleGroupId": "g"}],
             "httpRequest": {"clientIp": "10.0.0.2", "headers": [{"name": "n", "value": "v"}]}}
    odd = ['{"timestamp": 3, "action": ["no text"], "formatVersion": "x"}', '{"action": "COUNT"', '{"timestamp": "late"}',
           '["no object"]', "  ", '{"action": 1, "action": 2}', '{"timestamp": null, "httpRequest": "no struct"}']
    (folder / "part.json").write_text("\n".join([json.dumps(lower), json.dumps(camel), *odd, "7"]) + "\n")
    logs = read_logs(spark, str(tmp_path))
    assert logs.count() == 4
    for columns in (["action"], ["ts_ms"], ["ts_ms", "action"], ["httprequest"], ["formatversion", "hour"], logs.columns):
        assert len(logs.select(*columns).collect()) == 4, columns
    found = {r.ts_ms: r for r in logs.collect()}
    assert found[1].asDict() == {**found[2].asDict(), "ts_ms": 1}
    assert found[2].httprequest.clientip == "10.0.0.2" and found[2].rulegrouplist[0].rulegroupid == "g"
    assert found[3].action is not None and found[3].formatversion is None and found[None].httprequest is None
    broken = read_logs(spark, str(tmp_path), with_corrupt=True).filter("_corrupt_record IS NOT NULL")
    assert [r[0] for r in rows(broken, "_corrupt_record")] == sorted([odd[1], odd[2], odd[3], odd[5], "7"], key=lambda t: repr((t,)))


def test_headers_by_name(spark, delivered):
    logs = read_logs(spark, delivered).filter("httprequest.requestid = 'full'")
    headers = F.col("httprequest.headers")
    assert tuple(logs.select(header_value(headers, "X-TAG"), header_value(headers, "none")).first()) == ("1", None)


def test_range_of_hours(spark, delivered):
    hour = datetime(2024, 1, 5, 3, 59)
    assert len(read_logs(spark, delivered, hour, hour).collect()) == 4
    assert len(read_logs(spark, delivered, datetime(2023, 12, 31), datetime(2024, 1, 5, 3)).collect()) == 4
    assert len(read_logs(spark, delivered, datetime(2024, 1, 5, 4), datetime(2024, 1, 9)).collect()) == 0
    assert len(read_logs(spark, delivered, end=datetime(2024, 1, 5, 2)).collect()) == 0
    assert len(read_logs(spark, delivered, start=datetime(2023, 1, 5)).collect()) == 4
    missing = read_logs(spark, delivered, datetime(2025, 1, 1), datetime(2025, 1, 2))
    assert missing.columns == read_logs(spark, delivered).columns and missing.count() == 0
    assert len(read_logs(spark, delivered, datetime(2021, 1, 1), datetime(2025, 1, 2)).collect()) == 4
    with pytest.raises(ValueError):
        read_logs(spark, delivered, datetime(2024, 1, 2), datetime(2024, 1, 1))


def test_scan_prunes(spark, delivered, plan):
    logs = read_logs(spark, delivered, datetime(2024, 1, 5, 3), datetime(2024, 1, 5, 3))
    text = plan(logs.select("action"))
    assert "ReadSchema: struct<value:string>" in text
    assert text.count("parseJson") == 1, text
    assert "$.action" in text and "$.httpRequest" not in text
    assert "(year#" in text.split("PartitionFilters: ")[1].split("PushedFilters")[0]


def test_partition_domain(spark, delivered):
    base = os.path.join(delivered, "year=2031", "month=01", "day=01", "hour=00")
    os.makedirs(base)
    with gzip.open(os.path.join(base, "part.gz"), "wt") as file:
        file.write('{"timestamp": 1, "action": "BLOCK"}\n')
    assert len(read_logs(spark, delivered).collect()) == 4


def test_round_trip(spark, delivered, tmp_path, rows):
    logs = read_logs(spark, delivered)
    for in_time_order in (False, True):
        out = str(tmp_path / f"out{in_time_order}")
        write_logs(logs, out, in_time_order=in_time_order)
        assert os.listdir(os.path.join(out, "year=2024", "month=01", "day=05")) == ["hour=03"]
        assert rows(read_logs(spark, out)) == rows(logs)
    write_logs(logs, out, mode="overwrite")
    assert len(read_logs(spark, out).collect()) == 4


def test_overwrite_keeps_other_hours(spark, tmp_path):
    out = str(tmp_path / "out")
    first = log_rows(spark, {"ts_ms": 1_704_423_600_000}, {"ts_ms": 1_704_427_200_000})
    write_logs(first, out)
    write_logs(first.limit(1), out, mode="overwrite")
    assert len(read_logs(spark, out).collect()) == 2


def test_broken_rows_go_to_errors(spark, tmp_path):
    lines = spark.createDataFrame([(json.dumps(LINES[1]),), ('{"timestamp": 17',), ('{"timestamp": "x"}',)], "value string")
    parsed = parse_lines(lines)
    write_logs(parsed, str(tmp_path / "log"), str(tmp_path / "errors"))
    assert len(read_logs(spark, str(tmp_path / "log")).collect()) == 1
    refused = sorted(row.value for row in spark.read.text(str(tmp_path / "errors")).collect())
    assert refused == ['{"timestamp": "x"}', '{"timestamp": 17']
    with pytest.raises(ValueError):
        write_logs(parsed, str(tmp_path / "log2"))


def test_row_without_a_time_has_no_hour_and_goes_to_errors(spark, tmp_path):
    logs = log_rows(spark, {"action": "BLOCK"}, {"ts_ms": 9 * 10**18}, {"ts_ms": 2_051_222_400_000}, {"ts_ms": 1_704_423_600_000})
    assert [row.hour for row in with_hour_partition(logs).collect()] == [None, None, None, "03"]
    with pytest.raises(Exception, match="no time inside the years"):
        write_logs(logs, str(tmp_path / "strict"))
    write_logs(logs, str(tmp_path / "log"), str(tmp_path / "errors"))
    assert read_logs(spark, str(tmp_path / "log")).count() == 1
    assert spark.read.text(str(tmp_path / "errors")).count() == 3


def test_other_years(spark, tmp_path):
    logs = log_rows(spark, {"ts_ms": 2_051_222_400_000})
    write_logs(logs, str(tmp_path / "log"), years=(2030, 2040))
    assert read_logs(spark, str(tmp_path / "log")).count() == 0
    later = read_logs(spark, str(tmp_path / "log"), years=(2030, 2040))
    assert [row.year for row in later.collect()] == ["2035"]
    compact_logs(later, str(tmp_path / "copy"))
    assert read_compacted(spark, str(tmp_path / "copy")).count() == 1


def test_hot_hour_is_split_into_files(spark, tmp_path):
    """An hour with most of the rows is written by several tasks."""
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        rows = spark.range(60_000).selectExpr(
            "1704423600000 + id % 1000 AS ts_ms", "sha2(cast(id AS string), 256) AS webaclid"
        )
        empty = log_rows(spark)
        logs = empty.unionByName(rows, allowMissingColumns=True)
        write_logs(logs, str(tmp_path / "hot"))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    files = [f for f in os.listdir(tmp_path / "hot/year=2024/month=01/day=05/hour=03") if f.endswith(".gz")]
    assert len(files) > 1
    assert read_logs(spark, str(tmp_path / "hot")).filter("webaclid IS NOT NULL").count() == 60_000


def test_columnar_copy_and_retention(spark, delivered, tmp_path, rows):
    logs = read_logs(spark, delivered)
    path = str(tmp_path / "columnar")
    compact_logs(logs, path)
    assert rows(read_compacted(spark, path)) == rows(logs)
    assert retain(logs, date(2024, 4, 4)).filter("ts_ms > 0").count() == 4  # 90 days later
    assert retain(logs, datetime(2024, 4, 5)).filter("ts_ms > 0").count() == 0
    assert retain(logs, date(2024, 1, 6), days=1).filter("ts_ms > 0").count() == 4
    write_retained(spark, path, str(tmp_path / "kept"), date(2024, 4, 4))
    write_retained(spark, path, str(tmp_path / "kept"), date(2024, 4, 4))
    assert read_compacted(spark, str(tmp_path / "kept")).count() == 4


def test_expiry_touches_no_file_that_stays(spark, tmp_path, rows):
    """Expired days go, whole months and years at once; a run cut short is made good by the next; the table follows."""
    moments = ["2023-03-01 05", "2023-12-31 23", "2024-01-04 00", "2024-01-31 10", "2024-02-08 23", "2024-02-09 00", "2024-02-10 01"]
    stamps = [int(datetime.strptime(m + " +0000", "%Y-%m-%d %H %z").timestamp() * 1000) for m in moments]
    root = str(tmp_path / "log")
    write_logs(log_rows(spark, *({"ts_ms": t, "action": "BLOCK"} for t in stamps)), root)
    deliver(with_hour_partition(log_rows(spark, {"ts_ms": stamps[0], "action": "ALLOW"})), root, "s", 0)
    register_log_table(spark, root, "expiring")
    before = {str(p): p.stat().st_mtime_ns for p in (tmp_path / "log").rglob("*.gz")}
    oldest = date(2024, 2, 9)
    assert expired_folders(spark, root, oldest) == ["year=2023", "year=2024/month=01", "year=2024/month=02/day=08"]
    shutil.rmtree(tmp_path / "log" / "year=2024" / "month=01")
    assert expire(spark, root, datetime(2024, 2, 16, 12), 7, "expiring") == ["year=2023", "year=2024/month=02/day=08"]
    after = {str(p): p.stat().st_mtime_ns for p in (tmp_path / "log").rglob("*.gz")}
    assert len(after) == 2 and all(before[name] == at for name, at in after.items())
    assert rows(read_logs(spark, root), "ts_ms") == [(stamps[5],), (stamps[6],)]
    assert published(spark, root) == []
    kept = {r[0] for r in spark.sql("SHOW PARTITIONS expiring").collect()}
    assert kept >= {"year=2024/month=02/day=09/hour=00", "year=2024/month=02/day=10/hour=01"} and not any("2023" in p for p in kept)
    assert expire(spark, root, datetime(2024, 2, 16, 12), 7, "expiring") == []
    assert expire(spark, str(tmp_path / "none"), datetime(2024, 2, 16), 7) == []
    spark.sql("DROP TABLE expiring")


def test_retention_reads_only_partitions_it_keeps(spark, delivered, plan):
    text = plan(retain(read_logs(spark, delivered), date(2024, 4, 4)).select("action"))
    assert "> 2024" in text.split("PartitionFilters: ")[1].split("PushedFilters")[0]


def test_tables(spark, delivered, tmp_path):
    register_logs(spark, delivered, "log_view")
    query = "SELECT action, count(*) AS n FROM {} WHERE timestamp > 0 AND httprequest.clientip IS NOT NULL GROUP BY action"
    assert [tuple(r) for r in spark.sql(query.format("log_view")).collect()] == [("BLOCK", 1)]
    root = str(tmp_path / "table")
    write_logs(read_logs(spark, delivered), root)
    os.makedirs(os.path.join(root, "errors"))
    register_log_table(spark, root, "log_db.waf_logs")
    register_log_table(spark, root, "log_db.waf_logs")
    assert [tuple(r) for r in spark.sql(query.format("log_db.waf_logs")).collect()] == [("BLOCK", 1)]
    pruned = spark.sql("SELECT terminatingruleid FROM log_db.waf_logs WHERE year = '2023'")
    assert pruned.count() == 0
    spark.sql("DROP DATABASE log_db CASCADE")


def test_log_filter(spark):
    count = [{"ruleid": "r", "action": "COUNT", "rulematchdetails": []}]
    other = [{"ruleid": "r", "action": "ALLOW", "rulematchdetails": None}]
    logs = log_rows(
        spark,
        {"ts_ms": 1, "action": "BLOCK"},
        {"ts_ms": 2, "action": "COUNT"},
        {"ts_ms": 3, "action": "ALLOW"},
        {"ts_ms": 4, "action": "ALLOW", "nonterminatingmatchingrules": []},
        {"ts_ms": 5, "action": "ALLOW", "nonterminatingmatchingrules": other},
        {"ts_ms": 6, "action": "ALLOW", "nonterminatingmatchingrules": count},
        {"ts_ms": 7, "action": None},
        {"ts_ms": 8, "action": "CAPTCHA"},
    )
    assert sorted(row.ts_ms for row in filter_logged(logs).collect()) == [1, 2, 6, 7, 8]


def test_redaction(spark, delivered):
    logs = redact(read_logs(spark, delivered)).filter("httprequest.requestid = 'secret'")
    headers = {h.name: h.value for h in logs.first().httprequest.headers}
    assert headers == {"Cookie": "REDACTED", "AUTHORIZATION": "REDACTED", "X-Api-Key": "REDACTED", "Host": "s"}
    assert redact(log_rows(spark, {"httprequest": {"headers": None}})).first().httprequest.headers is None
    assert len(WIRE) == len(CONTRACT)
