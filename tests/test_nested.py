from samples import log_rows

from ramparts import count_matches_by_rule, label_counts, matched_data, rate_rules, rule_group_matches
from ramparts.operators.nested import excluded_rules, rule_matches, with_label


def match(rule, action="COUNT"):
    return {"ruleid": rule, "action": action, "rulematchdetails": None}


def logs(spark):
    detail = {"conditiontype": "XSS", "sensitivitylevel": "HIGH", "location": "URI", "matcheddata": ["<", "script"]}
    empty = {**detail, "matcheddata": []}
    rate = {"ratebasedruleid": "r", "limitkey": "IP", "maxrateallowed": 50}
    return log_rows(
        spark,
        {
            "httprequest": {"requestid": "1"},
            "terminatingruleid": "t",
            "nonterminatingmatchingrules": [match("a"), match("a"), match("b", "ALLOW")],
            "rulegrouplist": [
                {
                    "rulegroupid": "g1",
                    "terminatingrule": match("x", "BLOCK"),
                    "nonterminatingmatchingrules": [match("i1"), match("i2")],
                    "excludedrules": None,
                },
                {"rulegroupid": "g2", "terminatingrule": None, "nonterminatingmatchingrules": [], "excludedrules": None},
            ],
            "terminatingrulematchdetails": [detail, empty],
            "ratebasedrulelist": [rate],
            "labels": [{"name": "l1"}, {"name": "l2"}],
        },
        {"httprequest": {"requestid": "2"}, "nonterminatingmatchingrules": [match("a")], "ratebasedrulelist": [rate]},
        {"httprequest": {"requestid": "3"}, "labels": [{"name": "l1"}], "rulegrouplist": []},
    )


def test_matches(spark, rows):
    assert rows(count_matches_by_rule(logs(spark))) == [("a", 3)]
    assert rows(rule_matches(logs(spark))) == [("1", "a", "COUNT"), ("1", "a", "COUNT"), ("1", "b", "ALLOW"), ("2", "a", "COUNT")]


def test_rule_groups(spark, rows):
    assert rows(rule_group_matches(logs(spark))) == [
        ("1", "g1", "x", "BLOCK", "i1", "COUNT"),
        ("1", "g1", "x", "BLOCK", "i2", "COUNT"),
        ("1", "g2", None, None, None, None),
    ]


def test_details_of_every_place(spark, rows):
    def with_detail(rule, *data):
        detail = {"conditiontype": "C", "sensitivitylevel": None, "location": "L", "matcheddata": list(data)}
        return {"ruleid": rule, "action": "COUNT", "rulematchdetails": [detail]}

    group = {"rulegroupid": "g", "terminatingrule": with_detail("x", "1"), "excludedrules": None,
             "nonterminatingmatchingrules": [with_detail("y", "2", "3"), match("none"), None]}
    bare = {"rulegroupid": "h", "terminatingrule": None, "nonterminatingmatchingrules": None, "excludedrules": None}
    found = matched_data(
        log_rows(
            spark,
            {"httprequest": {"requestid": "1"}, "terminatingruleid": "t", "rulegrouplist": [group, bare, None],
             "nonterminatingmatchingrules": [with_detail("z", "4")]},
            {"httprequest": {"requestid": "2"}, "terminatingruleid": "t"},
        )
    )
    assert rows(found, "request_id", "source", "rulegroupid", "ruleid", "datum") == sorted(
        [
            ("1", "rulegrouplist.terminatingrule.rulematchdetails", "g", "x", "1"),
            ("1", "rulegrouplist.nonterminatingmatchingrules.rulematchdetails", "g", "y", "2"),
            ("1", "rulegrouplist.nonterminatingmatchingrules.rulematchdetails", "g", "y", "3"),
            ("1", "nonterminatingmatchingrules.rulematchdetails", None, "z", "4"),
        ],
        key=repr,
    )


def test_excluded_rules(spark, rows):
    def group(name, text):
        return {"rulegroupid": name, "terminatingrule": None, "nonterminatingmatchingrules": None, "excludedrules": text}

    two = '[{"exclusionType":"E","ruleId":"a"},{"exclusionType":"E","ruleId":"b"}]'
    asked = log_rows(spark, {"httprequest": {"requestid": "1"}, "rulegrouplist": [group("g", two), group("h", None), group("i", "no list")]})
    assert rows(excluded_rules(asked)) == [("1", "g", "E", "a"), ("1", "g", "E", "b")]


def test_data_rates_labels(spark, rows):
    found = matched_data(logs(spark))
    assert rows(found, "request_id", "source", "ruleid", "conditiontype", "location", "datum") == [
        ("1", "terminatingrulematchdetails", "t", "XSS", "URI", "<"), ("1", "terminatingrulematchdetails", "t", "XSS", "URI", "script"),
    ]
    assert rows(rate_rules(logs(spark))) == [("r", "IP", 50, 2)]
    assert rows(label_counts(logs(spark))) == [("l1", 2), ("l2", 1)]
    assert with_label(logs(spark), "l1").count() == 2


def test_only_the_unnested_column_is_read(spark, tmp_path, plan):
    logs(spark).write.parquet(str(tmp_path / "log"))
    text = plan(count_matches_by_rule(spark.read.parquet(str(tmp_path / "log"))))
    schema = text.split("ReadSchema: ")[1]
    assert schema.startswith("struct<nonterminatingmatchingrules:array<struct<ruleid:string,action:string>>>")
