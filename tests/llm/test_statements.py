"""Queries that SQL can express, against their SQL."""

import pytest
from compare import SQL_TYPES, actual_rows, duck, expected_rows

from ramparts.llm.queries import QUERIES
from ramparts.llm.statements import STATEMENTS


def test_every_operator_has_a_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(STATEMENTS) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_query_matches_its_statement(spark, sf_dir, name):
    names, types, rows = actual_rows(QUERIES[name](spark, sf_dir))
    expected_names, expected_types, expected = expected_rows(duck(sf_dir), STATEMENTS[name])
    assert names == expected_names
    assert types == [SQL_TYPES.get(t, t) for t in expected_types]
    assert rows == expected
