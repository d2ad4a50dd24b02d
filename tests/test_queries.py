"""Every registered query against its SQL, over the driver's tables."""

import pytest
from compare import SQL_TYPES, actual_rows, duck, expected_rows

import __spark_entry__ as entry
from ramparts.plans import QUERIES, STATEMENTS


@pytest.fixture(scope="module")
def connection(sf_dir):
    return duck(sf_dir)


def test_each_query_has_a_statement():
    assert set(QUERIES) == set(STATEMENTS) <= set(entry.oracle_sql())


def test_entry(spark):
    report = entry.entry(spark)
    assert report.columns == [
        "metric_type", "total_requests", "blocked_requests", "percent_blocked", "rule_name", "rule_block_count",
    ]
    assert report.count() >= 1


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, connection, name):
    names, types, rows = actual_rows(entry.queries()[name](spark, sf_dir))
    expected_names, expected_types, expected = expected_rows(connection, entry.oracle_sql()[name])
    assert names == expected_names
    assert types == [SQL_TYPES.get(t, t) for t in expected_types]
    assert rows == expected


@pytest.fixture(scope="module")
def empty_dir(spark, sf_dir, tmp_path_factory):
    folder = tmp_path_factory.mktemp("empty")
    spark.read.parquet(f"{sf_dir}/events.parquet").limit(0).coalesce(1).write.parquet(f"{folder}/events.parquet")
    return str(folder)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_without_events(spark, empty_dir, name):
    """Nothing crashes without a row; the report still has its row of totals."""
    rows = QUERIES[name](spark, empty_dir).collect()
    if name == "kpi_report":
        assert [(r.metric_type, r.total_requests) for r in rows] == [("CORE", None)] or len(rows) == 1
    elif name in ("merged_indicators", "emergency_blocks"):
        assert rows
