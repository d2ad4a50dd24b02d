import pytest
from pyspark.sql import functions as F
from samples import log_rows, requests

from ramparts import emergency_blocks, emergency_uri, override_actions, rule_decision, rule_flags, with_emergency_rules
from ramparts.operators.detection import SIGNATURE_RULES, all_of, any_of, none_of
from ramparts.sources import literal_table, rule_list
from ramparts.sources.reference_sets import CASES

# Which signature rule answers each request case; the others are left to managed rule groups.
ANSWERED = {
    "juice_shop_sqli": "JuiceShopSQLiRule",
    "path_traversal": "PathTraversalRule",
    "rfi_attempt": "RFIProtectionRule",
    "command_injection": "CommandInjectionRule",
    "large_header": "LargeHeaderRule",
}
RULES = list(ANSWERED.values())


def decided(spark, *records):
    flags = rule_flags(requests(spark, *records))
    result = rule_decision(flags, rule_list(spark).filter(F.col("name").isin(*SIGNATURE_RULES))).orderBy(F.col("request_id").cast("int"))
    return [row.terminatingruleid for row in result.collect()]


def test_request_cases(spark):
    records = []
    for name, _, method, uri, args, header, value, _ in CASES:
        headers = [("Host", "h")] + ([(header, value)] if header else [])
        records.append({"request_id": name, "method": method, "uri": uri, "args": args, "headers": headers})
    flags = rule_flags(requests(spark, *records))
    got = {row.request_id: [rule for rule in RULES if row[rule]] for row in flags.collect()}
    assert got == {case[0]: [ANSWERED[case[0]]] if case[0] in ANSWERED else [] for case in CASES}


@pytest.mark.parametrize(
    "record, rule",
    [
        ({"uri": "/rest/products/search", "args": "q=' or 1=1--"}, "Default_Action"),
        ({"uri": "/rest/products/search/", "args": "q=' OR 1=1--"}, "Default_Action"),
        ({"uri": "/REST/Products/Search", "args": "q=%27%20OR%201=1--"}, "JuiceShopSQLiRule"),
        ({"uri": "/rest/products/search", "args": "q=&#39; OR 1=1--"}, "JuiceShopSQLiRule"),
        ({"uri": "/rest/products/search", "args": "q=%26%2339; OR 1=1--&x=%zz"}, "JuiceShopSQLiRule"),
        ({"args": "u=http%3A%2F%2Fevil"}, "Default_Action"),
        ({"args": "u=HTTPS://evil"}, "RFIProtectionRule"),
        ({"args": "a=1%26 whoami"}, "CommandInjectionRule"),
        ({"args": "a=1& whoami"}, "Default_Action"),
        ({"args": "a=1;&b= cat"}, "Default_Action"),
        ({"args": "a=%7C%20CAT&b=%zz"}, "CommandInjectionRule"),
        ({"uri": "/a/%2e%2e/b"}, "PathTraversalRule"),
        ({"uri": "/ETC/PASSWD"}, "PathTraversalRule"),
        ({"uri": "/a%2"}, "Default_Action"),
        ({"uri": None, "args": None}, "Default_Action"),
        ({"headers": [("a", "x" * 4096)]}, "Default_Action"),
        ({"headers": [("a", "x" * 4097)]}, "LargeHeaderRule"),
        ({"headers": [("a" * 4097, "")]}, "LargeHeaderRule"),
        ({"headers": [("a", None), ("b", "x" * 4097)]}, "LargeHeaderRule"),
        ({"headers": [("a", "é" * 2049)]}, "LargeHeaderRule"),
        ({"headers": [("a", "x" * 3000)] * 3}, "LargeHeaderRule"),
        ({"headers": [("a", "x")] * 201}, "LargeHeaderRule"),
        ({"headers": [("a", "x")] * 200}, "Default_Action"),
        ({"uri": "/../", "args": "http://"}, "PathTraversalRule"),
    ],
)
def test_edges(spark, record, rule):
    assert decided(spark, record) == [rule]


def test_decision_follows_priority_and_skips_counting_rules(spark, rows):
    flags = spark.createDataFrame(
        [("1", True, True), ("2", False, True), ("3", None, None)], "request_id string, a boolean, b boolean"
    )
    schema = "name string, priority int, action string"
    rules = literal_table(spark, [("b", 1, "COUNT"), ("a", 2, "BLOCK"), ("c", 0, "NONE")], schema)
    assert rows(rule_decision(flags, rules), "request_id", "terminatingruleid", "action") == [
        ("1", "a", "BLOCK"), ("2", "Default_Action", "ALLOW"), ("3", "Default_Action", "ALLOW"),
    ]
    rules = literal_table(spark, [("b", 1, "BLOCK"), ("a", 2, "ALLOW")], schema)
    assert rows(rule_decision(flags, rules), "request_id", "terminatingruleid") == [
        ("1", "b"), ("2", "b"), ("3", "Default_Action"),
    ]


def test_a_terminating_rule_that_nothing_evaluates_raises(spark):
    flags = spark.createDataFrame([("1", True)], "request_id string, a boolean")
    for action in ("BLOCK", "ALLOW"):
        rules = literal_table(spark, [("a", 1, "BLOCK"), ("unknown", 9, action)], "name string, priority int, action string")
        with pytest.raises(ValueError, match="unknown"):
            rule_decision(flags, rules)


def test_rules_by_address_and_path_decide_by_priority(spark, rows):
    flags = spark.createDataFrame(
        [("1", "10.0.0.1", "/a", True), ("2", "10.0.0.9", "/x/Secret%2Fy", True), ("3", "10.9.9.9", "/none", True),
         ("4", "10.9.9.9", "/a", False), ("5", None, None, None), ("6", "10.0.0.2", "/secret/", False)],
        "request_id string, clientip string, uri string, a boolean",
    )
    listed = [
        ("a", 60, "BLOCK", None, None), ("wide", 50, "BLOCK", "10.0.0.0/24", None), ("host", 40, "ALLOW", "10.0.0.2", None),
        ("also wide", 50, "BLOCK", "10.0.0.0/8", None), ("path", 45, "BLOCK", None, "secret/"), ("path", 70, "BLOCK", None, "/a"),
        ("counted", 1, "COUNT", "0.0.0.0/0", None), ("bad", 2, "BLOCK", "no range", None),
    ]
    rules = literal_table(spark, listed, "name string, priority int, action string, cidr string, uri_pattern string")
    decided = rule_decision(flags, rules)
    assert decided.columns == [*flags.columns, "terminatingruleid", "action"]
    assert rows(decided, "request_id", "terminatingruleid", "action") == [
        ("1", "also wide", "BLOCK"), ("2", "path", "BLOCK"), ("3", "also wide", "BLOCK"), ("4", "also wide", "BLOCK"),
        ("5", "Default_Action", "ALLOW"), ("6", "host", "ALLOW"),
    ]


def test_feed_becomes_rules(spark, rows):
    feed = spark.createDataFrame(
        [(2, "n", "10.0.0.2", None), (1, "n", "10.0.0.1", None), (3, "p", None, "admin/x"), (4, "bad", "0.0.0.0/0", None),
         (5, "a", "10.0.0.5", None)],
        "seq int, name string, ip string, uri_pattern string",
    )
    listed = literal_table(spark, [("a", 7, "ALLOW")], "name string, priority int, action string")
    assert rows(with_emergency_rules(listed, feed, "seq")) == [
        ("a", 7, "ALLOW", None, None), ("n", 50, "BLOCK", "10.0.0.1/32", None), ("p", 50, "BLOCK", None, "admin/x"),
    ]


def test_combinators_take_null_as_false(spark):
    null = F.lit(None).cast("boolean")
    row = spark.range(1).select(any_of(null, F.lit(True)), all_of(null, F.lit(True)), none_of(null)).first()
    assert tuple(row) == (True, False, True)


def test_emergency_pattern_is_taken_as_written(spark):
    frame = spark.createDataFrame([("/Admin%2FBackdoor",)], "uri string")
    uri = F.col("uri")
    row = frame.select(
        emergency_uri(uri, "admin/backdoor"),
        emergency_uri(uri, "Admin/Backdoor"),
        emergency_uri(uri, "Admin/Backdoor", normalize_pattern=True),
        emergency_uri(uri, F.lit("ADMIN"), normalize_pattern=True),
    ).first()
    assert tuple(row) == (True, False, True, True)


def test_override_actions(spark, rows):
    matches = spark.createDataFrame([("SizeRestrictions_BODY", "BLOCK"), ("Other", "BLOCK")], "ruleid string, action string")
    assert rows(override_actions(matches)) == [("Other", "BLOCK"), ("SizeRestrictions_BODY", "COUNT")]


def test_emergency_blocks(spark, rows):
    logs = log_rows(spark, *({"terminatingruleid": r} for r in ["Emergency-1", "Emergency-1", "Emergency-low", "x", None]))
    rules = literal_table(
        spark,
        [("Emergency-1", 50, "BLOCK"), ("Emergency-2", 100, "BLOCK"), ("Emergency-low", 101, "BLOCK"), ("x", 1, "BLOCK")],
        "name string, priority int, action string",
    )
    assert rows(emergency_blocks(logs, rules)) == [("Emergency-1", 50, "BLOCK", 2), ("Emergency-2", 100, "BLOCK", 0)]


def test_flags_need_no_shuffle(spark, plan):
    assert "Exchange" not in plan(rule_flags(requests(spark, {})))
