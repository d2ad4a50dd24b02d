import json

import pytest
from pyspark.sql import functions as F

from ramparts import (
    category_summary,
    missed_attacks,
    rate_probe,
    run_severity,
    run_summary,
    score_results,
    suite_documents,
    write_suites,
)
from ramparts.operators.scorecard import blocked_by_firewall
from ramparts.sources import literal_table, request_cases

RESULT = (
    "url string, run_ts string, test_name string, actual_status int, response_time double, "
    "response_headers map<string,string>, body string, error string"
)
CASES = [("good", 200), ("also_good", 200), ("attack", 403)]


def results(spark, *entries, run="r1"):
    filled = [("u", run, name, status, 0.5, {}, "", None) for name, status in entries]
    return spark.createDataFrame(filled, RESULT)


def cases(spark):
    return literal_table(spark, CASES, "test_name string, expected_status int")


def test_firewall_signs(spark):
    frame = spark.createDataFrame(
        [
            (403, {}, ""),
            (200, {"X-Cache": "Miss"}, ""),
            (200, {"x-amzn-WAF": "1"}, ""),
            (200, {"X-Amz-Cf-Id": "1"}, ""),
            (200, {"Server": "x"}, "Request Blocked."),
            (200, {}, "ACCESS DENIED"),
            (200, {}, "a waffle"),
            (200, {}, "by CloudFront"),
            (200, {"Server": "x"}, "fine"),
            (200, None, None),
            (None, None, None),
        ],
        "s int, h map<string,string>, b string",
    )
    signs = [row[0] for row in frame.select(blocked_by_firewall(F.col("s"), F.col("h"), F.col("b"))).collect()]
    assert signs == [True] * 8 + [False] * 3


def test_scores_and_absent_cases(spark, rows):
    seen = results(spark, ("good", 200), ("attack", 200), ("unknown", 200)).unionByName(
        results(spark, ("good", 403), ("also_good", 0), ("attack", 403), run="r2")
    )
    scored = score_results(cases(spark), seen)
    assert rows(scored, "run_ts", "test_name", "actual_status", "passed", "error") == sorted(
        [
            ("r1", "good", 200, True, None),
            ("r1", "attack", 200, False, None),
            ("r1", "also_good", 0, False, "no result recorded"),
            ("r2", "good", 403, False, None),
            ("r2", "also_good", 0, False, None),
            ("r2", "attack", 403, True, None),
        ],
        key=repr,
    )
    assert rows(missed_attacks(scored), "run_ts", "test_name", "outcome") == [
        ("r1", "attack", "attack not blocked"), ("r2", "good", "false positive"),
    ]
    assert rows(run_summary(scored)) == [("u", "r1", 3, 1, 2, 1.0, 33.3), ("u", "r2", 3, 1, 2, 1.5, 33.3)]
    assert rows(category_summary(scored), "run_ts", "expected_status", "passed_tests", "total_tests") == [
        ("r1", 200, 1, 2), ("r1", 403, 0, 1), ("r2", 200, 0, 2), ("r2", 403, 1, 1),
    ]
    assert rows(run_severity(scored), "run_ts", "severity") == [("r1", 2), ("r2", 1)]


def test_clean_run(spark, rows):
    scored = score_results(cases(spark), results(spark, *CASES))
    assert rows(run_severity(scored), "severity") == [(0,)]
    assert rows(run_summary(scored), "success_rate") == [(100.0,)]
    assert score_results(cases(spark), results(spark)).count() == 0


@pytest.mark.parametrize(
    "statuses, verdict",
    [
        ([200, 403, 500, 599], (4, 3, True, 403, 403)),
        ([200, 403, 600, 499], (4, 1, False, 200, 403)),
        ([200, -1], (2, 0, False, 200, 200)),
    ],
)
def test_rate_probe(spark, rows, statuses, verdict):
    seen = results(spark, *(("rate_limit_test", s) for s in statuses), ("other", 403))
    columns = ["sent", "blocked_count", "passed", "expected_status", "actual_status"]
    assert rows(rate_probe(seen), *columns) == [verdict]


def test_suite_document(spark, tmp_path):
    scored = score_results(cases(spark), results(spark, *CASES))
    write_suites(scored, str(tmp_path / "suites"))
    files = list((tmp_path / "suites").glob("*.json"))
    documents = [json.loads(line) for file in files for line in file.read_text().splitlines()]
    assert len(documents) == 1
    assert documents[0]["total_tests"] == 3 and documents[0]["passed_tests"] == 3
    assert {t["test_name"] for t in documents[0]["tests"]} == {name for name, _ in CASES}
    assert documents[0]["tests"][0]["error"] is None


def test_probe_responses_are_one_result(spark, rows):
    """All attacks blocked, the probe blocked three times of 53: a perfect run of 14 results."""
    table = request_cases(spark)
    single = [(c.test_name, c.expected_status) for c in table.collect() if c.test_name != "rate_limit_test"]
    probe = [("rate_limit_test", 200)] * 50 + [("rate_limit_test", 403)] * 3
    scored = score_results(table, results(spark, *single, *probe))
    assert rows(run_summary(scored), "total_tests", "passed_tests", "failed_tests") == [(14, 14, 0)]
    assert rows(run_severity(scored), "severity") == [(0,)]
    assert missed_attacks(scored).count() == 0
    assert rows(scored.filter("test_name = 'rate_limit_test'"), "expected_status", "actual_status", "passed") == [
        (403, 403, True)
    ]
    assert suite_documents(scored).select(F.size("tests")).first()[0] == 14
    described = {r.test_name: r.description for r in scored.collect()}
    assert described["rate_limit_test"] == "Rate limiting test - 3/53 requests blocked"
    assert described["login_page"] == "Login page should be accessible"

    weak = score_results(table, results(spark, *single, *probe[:-1]))
    assert rows(run_severity(weak), "severity") == [(1,)]
    assert rows(missed_attacks(weak), "test_name", "outcome") == [("rate_limit_test", "false positive")]

    absent = score_results(table, results(spark, *single))
    assert rows(absent.filter("test_name = 'rate_limit_test'"), "actual_status", "error") == [(0, "no result recorded")]


def test_case_table(spark):
    table = request_cases(spark)
    assert table.count() == 14
    assert table.filter("special = 'rate_limit'").select("test_name").first()[0] == "rate_limit_test"
    assert table.filter("test_name = 'xss_script_tag'").first().description == "XSS script tag injection should be blocked"
    assert table.filter("expected_status = 403").count() == 9
    assert table.filter("body IS NOT NULL").first().method == "POST"
    assert table.filter("length(header_value) = 8192").first().test_name == "large_header"
