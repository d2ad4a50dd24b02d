from ramparts.session import scratch_path
from ramparts.sources import literal_table, rule_list


def test_literal_table_has_known_size(spark, plan, rows):
    table = literal_table(spark, [("a'b", 1), (None, None)], "name string, n bigint")
    assert rows(table) == [("a'b", 1), (None, None)]
    assert table.schema.simpleString() == "struct<name:string,n:bigint>"
    assert plan(table).startswith("LocalTableScan")
    assert literal_table(spark, [], "name string").count() == 0


def test_rules(spark):
    priorities = [row.priority for row in rule_list(spark, ["Emergency-a", "Emergency-b"]).collect()]
    assert len(priorities) == 12 and min(priorities) == 50


def test_scratch_lies_under_the_named_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(folder) and scratch_path(spark, "x") != scratch_path(spark, "x")
